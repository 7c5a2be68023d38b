"""Language identification: nearest of several clustered TF-IDF centroids per language.

A text becomes a vector of hashed byte 2-, 3- and 4-grams (A-Z lowered, white space
runs as one blank, ASCII digits and punctuation skipped), weighted log(1 + tf) * idf
and normalised. Document frequencies are counted over *all* training rows in a
distributed pass; the centroids (spherical k-means per language) are fitted on a
bounded sample of them. A text gets the language of the centroid with the highest
cosine. It is rejected when its distance 1 - cosine exceeds that language's radius.

The radius is measured on texts that the measuring centroids were not fitted on: each half of a
language's sample is compared with centroids of the other half, whole and cut to a half, a
quarter, ... of its length, since the fewer n-grams a text has, the farther it lies from any
centroid. For every doubling of the number of n-grams the median distance and the one that a twentieth of
the pieces exceeds are taken, and the radius lies ``spread`` times their difference beyond the
median: a few mislabelled or odd texts in the sample do not widen it. Between the doublings
it runs on linearly, so it depends smoothly on the length; towards a single n-gram it ends at distance 1.

Defined results: a null text or one without a letter is ``und`` with score 0 and
rejected; a text with letters but no n-gram in common with any centroid gets the
language of the most fitted rows with score 0 and is rejected; repeated rows get
equal results; with no training rows every text is ``und``. Extra columns of the
input are ignored by :func:`classify` and kept by :func:`annotate`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, LOWER, NON_WORD, arrow_map, blocks, fold, free_prefix, sample_ids, text_bytes, text_chunks, with_fields

BUCKETS = 4096
#: Doublings of the number of n-grams for which a radius is kept, pieces that each needs, and the shortest piece.
DOUBLINGS, LEAST_PIECES, SHORTEST = 24, 30, 16
_SMALL = BLOCK_BYTES // 4
_ROWS = 256  # a text takes a row of BUCKETS counters
# Fixed odd multipliers of the n-gram hash.
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@dataclass
class LanguageModel:
    idf: np.ndarray  # float32 per bucket
    centroids: np.ndarray  # float32, unit rows
    langs: list[str]  # of each centroid
    nearest: np.ndarray  # smallest accepted cosine: a row for each centroid, a column for each doubling of n-grams


def gram_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """n-gram counts, one float32 row of ``BUCKETS`` for each text."""
    n = len(offs) - 1
    out = np.zeros(n * BUCKETS, np.float32)
    if len(data) < 2:
        return out.reshape(n, BUCKETS)
    # blanks for what is no letter; runs of them shrink to one
    low = np.where(NON_WORD[data] | ((data >= 48) & (data <= 57)), np.uint8(32), LOWER[data])
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offs))
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32) | (doc[1:] != doc[:-1])
    low, doc = low[keep].astype(np.uint32), doc[keep]
    code = low
    for k in (2, 3, 4):
        if len(low) < k:
            break
        code = code[:-1] * np.uint32(257) + low[k - 1 :] + np.uint32(k)
        same = doc[: len(code)] == doc[k - 1 :]
        bucket = ((code * _MULT[k - 2]) >> np.uint32(20)).astype(np.int64)
        at = (doc[: len(code)] * BUCKETS + bucket)[same]
        out += np.bincount(at, minlength=len(out)).astype(np.float32)
    return out.reshape(n, BUCKETS)


def vectors(data: np.ndarray, offs: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF rows, and the number of n-grams of each text."""
    v = gram_counts(data, offs)
    grams = v.sum(axis=1)
    np.log1p(v, out=v)
    v *= idf
    v /= np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-30)[:, None]
    return v, grams


def document_frequencies(docs: DataFrame, column: str = "text") -> tuple[np.ndarray, int]:
    """Rows that hold each bucket, over all rows; BUCKETS + 1 sums reach the driver."""

    def count(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in blocks(batches, column, _SMALL, _ROWS):
            c = gram_counts(*text_bytes(b.column(column)))
            df += (c > 0).sum(axis=0)
            n += len(c)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(BUCKETS + 1), "n": np.append(df, n)})

    got = arrow_map(docs.select(column), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(BUCKETS + 1, np.int64)
    for r in got:
        total[r["bucket"]] = r["n"]
    return total[:BUCKETS], int(total[BUCKETS])


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from evenly spread rows; empty clusters vanish."""
    c = x[np.unique(np.linspace(0, len(x) - 1, min(k, len(x))).astype(int))]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) for j in np.unique(near)])
        c /= np.maximum(np.linalg.norm(c, axis=1), 1e-30)[:, None]
    return c


def _pieces(texts: list[str]) -> list[str]:
    """The texts, and their first half, quarter, ... down to ``SHORTEST`` characters."""
    out = []
    for t in texts:
        size = len(t)
        while size >= SHORTEST or size == len(t):
            out.append(t[:size])
            if size < 2 * SHORTEST:
                break
            size //= 2
    return out


def _floor(halves: list[list[str]], cents: list[np.ndarray], idf: np.ndarray, spread: float) -> np.ndarray:
    """Smallest accepted cosine for each doubling of n-grams, from either half against the other's centroids."""
    grams, near = [np.zeros(0)], [np.zeros(0)]
    for texts, c in zip(halves, cents[::-1]):
        for data, offs in text_chunks(_pieces(texts), _SMALL):
            x, n = vectors(data, offs, idf)
            grams.append(n[n > 0])
            near.append((x @ c.T).max(axis=1)[n > 0])
    at, cosine = np.log2(np.concatenate(grams)), np.concatenate(near)
    xs, ys = [0.0], [0.0]
    for k in range(1, DOUBLINGS):
        mine = cosine[np.abs(at - k) <= 0.5]
        if len(mine) >= LEAST_PIECES:
            xs.append(float(k))
            low, middle = np.quantile(mine, (0.05, 0.5))
            ys.append(max(float(middle - spread * (middle - low)), 0.0))
    # a longer text lies no farther away
    return np.interp(np.arange(DOUBLINGS), xs, np.maximum.accumulate(ys))


def fit(
    documents: DataFrame,
    parts: int = 4,
    held: int = 2,
    per_lang: int = 400,
    clusters: int = 4,
    max_bytes: int = 1 << 17,
    spread: float = 2.75,
    max_langs: int = 200,
) -> LanguageModel | None:
    """Model from the rows with a language outside fold ``held`` of ``parts``; None without any.

    ``per_lang``: fitted rows per language, of at most ``max_bytes`` bytes each, of the ``max_langs``
    languages with the most rows (the bound of the sample). Document frequencies come from
    every training row. ``spread``: how far beyond the median distance a radius lies.
    """
    train = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", parts) != held))
    train = train.filter(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    df, n = document_frequencies(train)
    if not n:
        return None
    idf = (np.log((1.0 + n) / (1.0 + df)) + 1.0).astype(np.float32)
    small = train.withColumn("_size", F.octet_length("text")).filter(F.col("_size") <= max_bytes)
    known = small.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).select("lang")
    small = small.join(F.broadcast(known), "lang", "left_semi")
    ids = sample_ids(small.select("doc_id", "lang").distinct(), "lang", per_lang)
    # at most per_lang ids a language: a proven bound
    rows = small.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text").collect()
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["doc_id"], r["text"]))
    cents, langs, nearest = [], [], []
    for lang in sorted(by_lang, key=lambda k: (-len(by_lang[k]), k)):
        texts = [t for _, t in sorted(by_lang[lang])]
        got = [vectors(data, offs, idf) for data, offs in text_chunks(texts, _SMALL)]
        x, grams = np.concatenate([v for v, _ in got]), np.concatenate([g for _, g in got])
        texts, x = [t for t, g in zip(texts, grams) if g > 0], x[grams > 0]
        if not len(x):
            continue
        c = _cluster(x, clusters)
        halves = [texts[::2], texts[1::2]] if len(texts) > 1 else []
        floor = _floor(halves, [_cluster(x[k::2], clusters) for k in range(len(halves))], idf, spread)
        cents.append(c)
        langs += [lang] * len(c)
        nearest += [floor] * len(c)
    if not cents:
        return None
    return LanguageModel(idf, np.concatenate(cents).astype(np.float32), langs, np.array(nearest))


_OUT = "lang_pred string, score double, rejected boolean"


def _predict(model: LanguageModel | None, batch: pa.RecordBatch, mark: str) -> dict:
    n = batch.num_rows
    letter = np.asarray(batch.column(mark).to_numpy(zero_copy_only=False), bool)
    if model is None:
        return {"lang_pred": ["und"] * n, "score": np.zeros(n), "rejected": np.ones(n, bool)}
    x, grams = vectors(*text_bytes(batch.column("text")), model.idf)
    sim = x @ model.centroids.T
    best = sim.argmax(axis=1)
    score = np.where(letter, np.clip(sim[np.arange(n), best], 0.0, 1.0).astype(np.float64), 0.0)
    at = np.clip(np.log2(np.maximum(grams, 1)), 0, DOUBLINGS - 1)
    k = np.minimum(at.astype(int), DOUBLINGS - 2)
    floor = model.nearest[best, k] * (k + 1 - at) + model.nearest[best, k + 1] * (at - k)
    rejected = ~letter | (score <= 0.0) | (1.0 - score > 1.0 - floor)
    lang = [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letter.tolist())]
    return {"lang_pred": lang, "score": score, "rejected": rejected}


def annotate(documents: DataFrame, model: LanguageModel | None, prefix: str = "") -> DataFrame:
    """``documents`` with lang_pred, score and rejected appended; ``prefix`` sets the new names
    apart from columns that ``documents`` has (a clashing column is replaced)."""
    out = ", ".join(prefix + c for c in _OUT.split(", "))
    new = [c.split()[0] for c in out.split(", ")]
    base = documents.select([c for c in documents.columns if c not in new])
    names = base.columns
    mark = free_prefix(names, "_has_", ("letter",)) + "letter"
    src = base.withColumn(mark, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def predict(batches):
        for b in blocks(batches, "text", _SMALL, _ROWS):
            got = _predict(model, b, mark)
            cols = [b.column(c) for c in names]
            cols += [pa.array(got["lang_pred"], pa.string()), pa.array(got["score"]), pa.array(got["rejected"])]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *new])

    return arrow_map(src, predict, with_fields(base.schema, out))


def classify(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    return annotate(documents.select("doc_id", "text"), model).drop("text")
