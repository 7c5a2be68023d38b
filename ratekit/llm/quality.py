"""Quality classifier: gated-attention multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE`` consecutive words. Every passage is
encoded into shape statistics (word lengths, symbol, digit and capital shares,
repetition of words, hashed byte classes at word ends). A small network, trained from
document labels alone, maps each encoding x to h = tanh(W x + b), gives it the
attention weight softmax(u . (tanh(V h) * sigmoid(G h))) within its text and
scores the weighted sum of the h with a logistic output.

Defined results: null and empty texts are one passage of zeros and get the score
of that; repeated rows get equal scores; without labels of both classes every
score is 0.5; very long texts only have more passages. Extra input columns are
ignored by :func:`score` and kept by :func:`annotate`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BLOCK_BYTES, NON_WORD, arrow_map, blocks, labelled_sample, logistic, text_bytes, text_chunks, with_fields, words_of

PASSAGE = 64
_SMALL = BLOCK_BYTES // 4
_ENDS = 16  # hashed buckets of the last and the first byte of a word

# byte classes
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = NON_WORD.copy()
_SYMBOL[[*range(33), 127]] = False
_HIGH = np.arange(256) >= 128
N_FEATURES = 14 + 2 * _ENDS


@dataclass
class QualityModel:
    mean: np.ndarray
    std: np.ndarray
    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    g: np.ndarray
    u: np.ndarray
    out: np.ndarray
    bias: float


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of all passages, and the first passage of each text (n + 1 entries)."""
    n = len(offs) - 1
    w = words_of(data, offs)
    per_doc = np.diff(w.first)
    bags = np.maximum(1, -(-per_doc // PASSAGE))
    first = np.concatenate([[0], np.cumsum(bags)])
    x = np.zeros((int(first[-1]), N_FEATURES), np.float32)
    if not len(w.start):
        return x, first
    rank = np.arange(len(w.start)) - w.first[w.doc]
    p = first[w.doc] + rank // PASSAGE
    heads = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    at = p[heads]  # passages that have words
    h = w.hashes["word"]
    length = (w.end - w.start).astype(np.float32)
    def share(mask_by_byte):
        c = np.concatenate([[0], np.cumsum(mask_by_byte[data], dtype=np.int64)])
        return (c[w.end] - c[w.start]).astype(np.float32)
    symbols, upper, digits, high = share(_SYMBOL), share(_UPPER), share(_DIGIT), share(_HIGH)
    same = lambda k: np.concatenate([np.zeros(min(k, len(h)), bool), (h[k:] == h[:-k]) & (p[k:] == p[:-k])]).astype(np.float32)
    cols = [
        np.ones(len(h), np.float32), length, np.minimum(length, 40.0) ** 2 / 40.0, symbols / length, upper / length,
        digits / length, high / length, (symbols >= length).astype(np.float32), (symbols >= 2).astype(np.float32),
        (upper >= length - symbols).astype(np.float32), same(1), same(2), same(3), (length <= 3).astype(np.float32),
    ]
    m = np.stack([np.add.reduceat(c, heads) for c in cols], axis=1)
    count = m[:, :1].copy()
    m[:, 1:] /= count
    m[:, 0] = np.log1p(count[:, 0])
    x[at, :14] = m
    for k, edge in enumerate((data[w.end - 1], data[w.start])):
        bucket = (edge.astype(np.int64) * 0x9E37 >> 4) % _ENDS
        flat = np.bincount(p * _ENDS + bucket, minlength=len(x) * _ENDS).reshape(len(x), _ENDS)
        x[:, 14 + k * _ENDS : 14 + (k + 1) * _ENDS] = flat
        x[at, 14 + k * _ENDS : 14 + (k + 1) * _ENDS] /= count
    return x, first


def _forward(m: QualityModel, x: np.ndarray, first: np.ndarray):
    z = (x - m.mean) / m.std
    h = np.tanh(z @ m.w + m.b)
    tv, sg = np.tanh(h @ m.v), logistic(h @ m.g)
    e = (tv * sg) @ m.u
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
    a = e / np.add.reduceat(e, first[:-1])[bag]
    rep = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    return z, h, tv, sg, a, bag, rep, logistic(rep @ m.out + m.bias)


def _train(x: np.ndarray, first: np.ndarray, y: np.ndarray, hidden: int, gate: int, epochs: int, batch: int, seed: int) -> QualityModel:
    """Adam on the balanced log loss; bags are visited in a seeded order."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    m = QualityModel(x.mean(0), x.std(0) + 1e-3, init(d, hidden), np.zeros(hidden), init(hidden, gate), init(hidden, gate), init(gate), init(hidden), 0.0)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    names = ("w", "b", "v", "g", "u", "out", "bias")
    mom = {k: [np.zeros_like(np.asarray(getattr(m, k), float)), np.zeros_like(np.asarray(getattr(m, k), float))] for k in names}
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            ids = np.sort(order[lo : lo + batch])
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in ids])
            f = np.concatenate([[0], np.cumsum(first[ids + 1] - first[ids])])
            z, h, tv, sg, a, bag, rep, p = _forward(m, x[rows], f)
            dz = (p - y[ids]) * weight[ids] / len(ids)
            drep = dz[:, None] * m.out
            da = (drep[bag] * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, f[:-1])[bag])
            dgate = de[:, None] * m.u
            dv, dg = dgate * sg * (1 - tv**2), dgate * tv * sg * (1 - sg)
            dh = a[:, None] * drep[bag] + dv @ m.v.T + dg @ m.g.T
            dpre = dh * (1 - h**2)
            grad = {"w": z.T @ dpre + 1e-4 * m.w, "b": dpre.sum(0), "v": h.T @ dv, "g": h.T @ dg, "u": (tv * sg).T @ de, "out": rep.T @ dz + 1e-4 * m.out, "bias": dz.sum()}
            t += 1
            for k in names:
                m1, m2 = mom[k]
                m1 += 0.1 * (grad[k] - m1)
                m2 += 0.001 * (grad[k] ** 2 - m2)
                step = 0.01 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
                setattr(m, k, getattr(m, k) - step)
    return m


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    parts: int = 5,
    held: int = 0,
    per_class: int = 2000,
    max_bytes: int = 1 << 17,
    hidden: int = 24,
    gate: int = 12,
    epochs: int = 12,
) -> QualityModel | None:
    """Model from at most ``per_class`` labelled texts a class outside the held-out fold.

    None without texts of both classes. The sample's bound is ``per_class`` texts of
    at most ``max_bytes`` bytes for each class.
    """
    rows = labelled_sample(documents, labels, label, parts, held, per_class, max_bytes)
    y = np.array([v for _, v in rows], float)
    if len(y) == 0 or y.min() == y.max():
        return None
    bags = [passages(data, offs) for data, offs in text_chunks([t for t, _ in rows])]
    x = np.concatenate([b for b, _ in bags]).astype(float)
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in bags]))])
    return _train(x, first, y, hidden, gate, epochs, 128, 7)


def annotate(documents: DataFrame, model: QualityModel | None, threshold: float = 0.3, prefix: str = "") -> DataFrame:
    """``documents`` with score and predicted appended; ``prefix`` sets the new names apart
    from columns that ``documents`` has (a clashing column is replaced)."""
    new = [f"{prefix}score", f"{prefix}predicted"]
    base = documents.select([c for c in documents.columns if c not in new])
    names = base.columns

    def run(batches):
        for b in blocks(batches, "text", _SMALL):
            if model is None:
                s = np.full(b.num_rows, 0.5)
            else:
                s = _forward(model, *passages(*text_bytes(b.column("text"))))[-1]
            cols = [b.column(c) for c in names]
            cols += [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *new])

    return arrow_map(base, run, with_fields(base.schema, f"{new[0]} double, {new[1]} int"))


def score(documents: DataFrame, model: QualityModel | None, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every row."""
    return annotate(documents.select("doc_id", "text"), model, threshold).drop("text")
