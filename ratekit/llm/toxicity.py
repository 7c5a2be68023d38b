"""Toxicity: a linear-chain conditional random field tags toxic spans.

Tokens are runs of letters and digits. Token labels come from document labels: in
toxic texts of the fitted sample, a token is labelled toxic if its word, or its
leading bytes, occur in far more toxic than clean texts. A two-state chain (clean,
toxic) with hashed word / prefix / suffix emissions and learned transitions is
fitted by its exact likelihood gradient (forward-backward). Scoring runs
forward-backward over the whole text; the marginals aggregate to (highest
marginal, expected number of toxic tokens), which a logistic calibration turns
into the document score. Runs of tokens with marginal >= 0.5 are the offending
spans (code point offsets).

All chains of a block are one sequence of 2 x 2 matrices whose product restarts at
every text; it is scanned in rows of ``ROW`` tokens, so the work is linear and
vectorised for short and very long texts alike.

Defined results: null and empty texts have no tokens and get the score of a text
without toxic tokens, and no spans; repeated rows get equal scores; without labels
of both classes every score is 0.5 and there are no spans. Extra input columns
are ignored by :func:`score`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BLOCK_BYTES, NON_WORD, Words, arrow_map, blocks, labelled_sample, logistic, mix64, text_bytes, text_chunks, words_of

ROW = 64
KINDS = ("word", "pre7", "pre6", "pre5", "pre4", "suf3")
# kinds whose counts may label a token of the fitted sample
LABEL_KINDS = ("word", "pre7", "pre6", "pre5", "pre4")
BITS = 18
_SMALL = BLOCK_BYTES // 4
_SHIFT = np.uint64(64 - BITS)


@dataclass
class ToxicModel:
    weights: np.ndarray  # (kinds, 2**BITS): score of "toxic" over "clean"
    bias: float
    trans: np.ndarray  # 2 x 2 log potentials
    start: np.ndarray  # 2 log potentials
    calib: np.ndarray  # intercept, logit of highest marginal, log1p(expected count)


def _tokens(data: np.ndarray, offs: np.ndarray):
    w = words_of(data, offs, NON_WORD, KINDS)
    feats = np.stack([(w.hashes[k] >> _SHIFT).astype(np.int64) for k in KINDS]) if len(w.start) else np.zeros((len(KINDS), 0), np.int64)
    return w, feats


def _matrices(emit: np.ndarray, head: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(4, n): entries 00, 01, 10, 11 of the step matrices; the step into a text's first
    token forgets the state. Each step's larger emission is scaled to 1."""
    low = np.exp(-np.maximum(emit, 0.0))
    high = np.exp(np.minimum(emit, 0.0))
    t, s = np.exp(trans), np.exp(start)
    m = np.empty((4, len(emit)))
    for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        np.multiply(np.where(head, s[b], t[a, b]), high if b else low, out=m[k])
    return m


def forward_backward(emit: np.ndarray, head: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """(steps, alpha before each step, alpha, beta), shaped (4, n) and (2, n).

    ``head`` marks the first token of each chain. Potentials lie within exp(+-4), so
    products over a row of ``ROW`` steps stay in the range of doubles; messages are
    scaled to sum 1 from row to row.
    """
    n = len(emit)
    rows = -(-n // ROW)
    steps = np.zeros((4, rows * ROW))
    steps[0, n:] = steps[3, n:] = 1.0
    steps[:, :n] = _matrices(emit, head, trans, start)
    s = np.ascontiguousarray(steps.reshape(4, rows, ROW).transpose(2, 0, 1))  # position, entry, row
    pre, suf = np.empty_like(s), np.empty_like(s)
    pre[0], suf[-1] = s[0], s[-1]

    def times(x, y, out):
        out[0] = x[0] * y[0] + x[1] * y[2]
        out[1] = x[0] * y[1] + x[1] * y[3]
        out[2] = x[2] * y[0] + x[3] * y[2]
        out[3] = x[2] * y[1] + x[3] * y[3]

    for j in range(1, ROW):
        times(pre[j - 1], s[j], pre[j])
        times(s[ROW - 1 - j], suf[ROW - j], suf[ROW - 1 - j])
    into, back = np.empty((2, rows)), np.empty((2, rows))
    a0, a1 = 0.5, 0.5
    for r, (p, q, u, v) in enumerate(pre[-1].T.tolist()):
        into[0, r], into[1, r] = a0, a1
        a0, a1 = a0 * p + a1 * u, a0 * q + a1 * v
        t = a0 + a1
        a0, a1 = (a0 / t, a1 / t) if t > 0 else (0.5, 0.5)
    b0, b1 = 0.5, 0.5
    full = suf[0].T.tolist()
    for r in range(rows - 1, -1, -1):
        back[0, r], back[1, r] = b0, b1
        p, q, u, v = full[r]
        b0, b1 = p * b0 + q * b1, u * b0 + v * b1
        t = b0 + b1
        b0, b1 = (b0 / t, b1 / t) if t > 0 else (0.5, 0.5)
    alpha, beta = np.empty((2, ROW, rows)), np.empty((2, ROW, rows))
    alpha[0] = into[0] * pre[:, 0] + into[1] * pre[:, 2]
    alpha[1] = into[0] * pre[:, 1] + into[1] * pre[:, 3]
    beta[:, -1] = back
    beta[0, :-1] = suf[1:, 0] * back[0] + suf[1:, 1] * back[1]
    beta[1, :-1] = suf[1:, 2] * back[0] + suf[1:, 3] * back[1]
    alpha = np.ascontiguousarray(alpha.transpose(0, 2, 1)).reshape(2, -1)
    beta = np.ascontiguousarray(beta.transpose(0, 2, 1)).reshape(2, -1)
    alpha /= np.maximum(alpha.sum(axis=0), 1e-300)
    beta /= np.maximum(beta.sum(axis=0), 1e-300)
    before = np.concatenate([[[0.5], [0.5]], alpha[:, :-1]], axis=1)
    return steps[:, :n], before[:, :n], alpha[:, :n], beta[:, :n]


def marginals(emit: np.ndarray, head: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """P(toxic) of every token."""
    if not len(emit):
        return np.zeros(0)
    _, _, a, b = forward_backward(emit, head, trans, start)
    g = a * b
    return g[1] / np.maximum(g[0] + g[1], 1e-300)


def _heads(first: np.ndarray, n: int) -> np.ndarray:
    head = np.zeros(n, bool)
    head[first[:-1][first[:-1] < first[1:]]] = True
    return head


def _emit(m: ToxicModel, feats: np.ndarray) -> np.ndarray:
    return m.weights[np.arange(len(KINDS))[:, None], feats].sum(axis=0) + m.bias


def _features(m: ToxicModel, data: np.ndarray, offs: np.ndarray):
    """Words, marginals, and the (highest logit, log1p(count)) pair of each text."""
    w, feats = _tokens(data, offs)
    p = marginals(_emit(m, feats), _heads(w.first, len(w.start)), m.trans, m.start)
    n = len(offs) - 1
    high, total = np.zeros(n), np.zeros(n)
    full = np.flatnonzero(np.diff(w.first))
    if len(full):
        high[full] = np.maximum.reduceat(p, w.first[full])
        total[full] = np.add.reduceat(np.where(p >= 0.05, p, 0.0), w.first[full])
    q = np.clip(high, 1e-4, 1 - 1e-4)
    return w, p, np.stack([np.ones(n), np.log(q / (1 - q)), np.log1p(total)], axis=1)


def label_tokens(w, y: np.ndarray, sure: float, likely: float, odds: float) -> np.ndarray:
    """Tokens of toxic texts whose word or leading bytes are far more frequent in toxic texts.

    A value's evidence is n KL(a / n, share of toxic texts): a of the n texts that hold it
    are toxic. From the highest evidence down, a value counts as toxic from ``sure`` on,
    and from ``likely`` on only if at least two toxic texts hold no toxic value yet; its
    share of the toxic texts must be ``odds`` times its share of the clean ones.
    """
    base = y.mean()
    found = []  # evidence, toxic texts, tokens
    for kind in LABEL_KINDS:
        value, at = np.unique(w.hashes[kind], return_inverse=True)
        pair = np.unique(at.astype(np.int64) * len(y) + w.doc)
        k, d = pair // len(y), pair % len(y)
        n = np.bincount(k, minlength=len(value)).astype(float)
        a = np.bincount(k[y[d] == 1], minlength=len(value))
        q = np.clip(a / n, 1e-12, 1 - 1e-12)
        g = n * (q * np.log(q / base) + (1 - q) * np.log((1 - q) / (1 - base)))
        ok = np.flatnonzero((g >= likely) & (a * (1 - base) >= odds * (n - a) * base))
        lo, hi = np.searchsorted(k, ok), np.searchsorted(k, ok, side="right")
        order = np.argsort(at, kind="stable")
        tl, th = np.searchsorted(at, ok, sorter=order), np.searchsorted(at, ok, side="right", sorter=order)
        found += [(g[v], d[p:q_], order[r:s]) for v, p, q_, r, s in zip(ok, lo, hi, tl, th)]
    toxic, covered = np.zeros(len(w.doc), bool), np.zeros(len(y), bool)
    for g, docs, tokens in sorted(found, key=lambda f: -f[0]):
        mine = docs[y[docs] == 1]
        if g >= sure or (~covered[mine]).sum() >= 2:
            toxic[tokens] = True
            covered[mine] = True
    return toxic & (y[w.doc] == 1)


def _gathered(texts: list[str]) -> Words:
    """Words of all texts, found block by block (byte spans are dropped)."""
    got = [words_of(data, offs, NON_WORD, KINDS) for data, offs in text_chunks(texts)]
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(w.first) for w in got]))])
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    none = np.zeros(0, np.int64)
    return Words(none, none, doc, first, {k: np.concatenate([w.hashes[k] for w in got]) for k in KINDS})


def _distinct(w, n: int, copies: float) -> np.ndarray:
    """False for texts whose set of word pairs is that of an earlier kept one to a share of ``copies`` or more.

    Sets that share their smallest or largest hashed pair are compared whole; every other text stays.
    """
    keep = np.ones(n, bool)
    if len(w.doc) < 2:
        return keep
    inner = w.doc[:-1] == w.doc[1:]
    pair = mix64(w.hashes["word"][:-1] * np.uint64(3) + w.hashes["word"][1:])[inner]
    first = np.searchsorted(w.doc[:-1][inner], np.arange(n + 1))
    seen: dict[tuple[str, int], list[int]] = {}
    sets: list[np.ndarray] = []
    for d in range(n):
        mine = np.unique(pair[first[d] : first[d + 1]])
        sets.append(mine)
        if not len(mine):
            continue
        keys = [("least", int(mine[0])), ("most", int(mine[-1]))]
        for other in sorted({e for k in keys for e in seen.get(k, ())}):
            theirs = sets[other]
            if min(len(mine), len(theirs)) < copies * max(len(mine), len(theirs)):
                continue
            both = len(np.intersect1d(mine, theirs, assume_unique=True))
            if both >= copies * (len(mine) + len(theirs) - both):
                keep[d] = False
                break
        if keep[d]:
            for k in keys:
                seen.setdefault(k, []).append(d)
    return keep


def _train(feats: np.ndarray, head: np.ndarray, label: np.ndarray, rounds: int, l2: float) -> ToxicModel:
    """Full-batch Adam on the exact log likelihood of the labelled chains."""
    size = 1 << BITS
    used = [np.unique(f, return_inverse=True) for f in feats]
    w = [np.zeros(len(u)) for u, _ in used]
    m = ToxicModel(np.zeros((len(KINDS), size)), -3.0, np.zeros((2, 2)), np.zeros(2), np.array([0.0, 1.0, 0.0]))
    pars = [*w, np.array([m.bias]), m.trans.copy(), m.start.copy()]
    mom = [[np.zeros_like(p), np.zeros_like(p)] for p in pars]
    lab = label.astype(np.int64)
    prev = np.concatenate([[0], lab[:-1]])
    inner = ~head
    gold_t = np.zeros((2, 2))
    np.add.at(gold_t, (prev[inner], lab[inner]), 1)
    gold_s = np.bincount(lab[head], minlength=2).astype(float)
    n = len(lab)
    for t in range(1, rounds + 1):
        emit = sum(p[i] for p, (_, i) in zip(pars[: len(KINDS)], used)) + pars[-3][0]
        s, before, a, b = forward_backward(emit, head, pars[-2], pars[-1])
        g = a * b
        p1 = g[1] / np.maximum(g[0] + g[1], 1e-300)
        edge = np.stack([before[0] * s[0] * b[0], before[0] * s[1] * b[1], before[1] * s[2] * b[0], before[1] * s[3] * b[1]])
        edge /= np.maximum(edge.sum(axis=0), 1e-300)
        res = lab - p1
        grads = [np.bincount(i, res, len(u)) for u, i in used]
        grads += [np.array([res.sum()]), gold_t - edge[:, inner].sum(1).reshape(2, 2), gold_s - np.array([(1 - p1[head]).sum(), p1[head].sum()])]
        for p, gr, (m1, m2) in zip(pars, grads, mom):
            gr = gr / n - l2 * p
            m1 += 0.1 * (gr - m1)
            m2 += 0.01 * (gr**2 - m2)
            p += 0.2 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
        for p in pars[-2:]:
            np.clip(p, -4.0, 4.0, out=p)
    for k, (u, _) in enumerate(used):
        m.weights[k, u] = pars[k]
    m.bias, m.trans, m.start = float(pars[-3][0]), pars[-2], pars[-1]
    return m


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps, classes weighed equally."""
    wt = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    c = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * len(y)
    for _ in range(25):
        p = logistic(x @ c)
        hess = (x * (wt * p * (1 - p))[:, None]).T @ x + ridge
        c = c + np.linalg.solve(hess, x.T @ (wt * (y - p)) - ridge @ c)
    return c


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    parts: int = 3,
    held: int = 1,
    per_class: int = 1500,
    max_bytes: int = 1 << 17,
    segment: int = 48,
    max_segments: int = 8000,
    rounds: int = 40,
    sure: float = 11.0,
    likely: float = 6.0,
    odds: float = 12.0,
    copies: float = 0.8,
) -> ToxicModel | None:
    """Model from at most ``per_class`` labelled texts a class outside the held-out fold.

    Of texts whose sets of word pairs are alike to a share of ``copies`` the first is fitted
    on: copies would count as independent evidence.
    The chain is fitted on at most ``max_segments`` segments of ``segment`` tokens of
    them: those with a toxic token first, the rest spread evenly. None without texts of
    both classes.
    """
    rows = labelled_sample(documents, labels, label, parts, held, per_class, max_bytes)
    y = np.array([v for _, v in rows], np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    w = _gathered([t for t, _ in rows])
    keep = _distinct(w, len(y), copies)
    if not len(w.doc) or y[keep].min() == y[keep].max():
        return None
    if not keep.all():
        rows, y = [r for r, k in zip(rows, keep) if k], y[keep]
        w = _gathered([t for t, _ in rows])
    toxic = label_tokens(w, y, sure, likely, odds)
    seg = (np.arange(len(w.doc)) - w.first[w.doc]) // segment
    starts = np.flatnonzero(np.concatenate([[True], (w.doc[1:] != w.doc[:-1]) | (seg[1:] != seg[:-1])]))
    hit = np.add.reduceat(toxic, starts) > 0
    rank = np.argsort(~hit, kind="stable")
    n_hit = int(hit.sum())
    take = rank[: max_segments // 2] if n_hit >= max_segments // 2 else rank[:n_hit]
    rest = rank[n_hit:]
    more = min(len(rest), max_segments - len(take))
    take = np.sort(np.concatenate([take, rest[np.linspace(0, len(rest) - 1, more).astype(int)]])) if more else np.sort(take)
    ends = np.append(starts[1:], len(w.doc))
    rows_ = np.concatenate([np.arange(starts[i], ends[i]) for i in take])
    head = np.zeros(len(rows_), bool)
    head[np.concatenate([[0], np.cumsum(ends[take] - starts[take])[:-1]])] = True
    feats = np.stack([(w.hashes[k][rows_] >> _SHIFT).astype(np.int64) for k in KINDS])
    model = _train(feats, head, toxic[rows_], rounds, 1e-6)
    # calibration over the whole texts of the sample
    x = [_features(model, data, offs)[2] for data, offs in text_chunks([t for t, _ in rows])]
    model.calib = _calibrate(np.concatenate(x), y)
    return model


SPANS = "array<struct<begin: bigint, end: bigint, marginal: double>>"


def _spans(w, p: np.ndarray, data: np.ndarray, offs: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(offs) - 1)]
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return out
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    group = np.concatenate([[True], (np.diff(hot) > 1) | (w.doc[hot[1:]] != w.doc[hot[:-1]])])
    lows = np.flatnonzero(group)
    highs = np.append(lows[1:], len(hot)) - 1
    best = np.maximum.reduceat(p[hot], lows)
    for lo, hi, m in zip(hot[lows], hot[highs], best):
        d = w.doc[lo]
        zero = chars[offs[d]]
        out[d].append({"begin": int(chars[w.start[lo]] - zero), "end": int(chars[w.end[hi]] - zero), "marginal": float(m)})
    return out


def score(documents: DataFrame, model: ToxicModel | None, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted and the offending spans of every row."""

    def run(batches):
        for b in blocks(batches, "text", _SMALL):
            if model is None:
                s, spans = np.full(b.num_rows, 0.5), [[] for _ in range(b.num_rows)]
            else:
                data, offs = text_bytes(b.column("text"))
                w, p, x = _features(model, data, offs)
                s, spans = logistic(x @ model.calib), _spans(w, p, data, offs)
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
            cols = [b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "predicted", "spans"])

    src = documents.select("doc_id", "text")
    id_type = src.schema["doc_id"].dataType.simpleString()
    return arrow_map(src, run, f"doc_id {id_type}, score double, predicted int, spans {SPANS}")
