"""Document fingerprints: quartile digests of hashed byte triplets.

A window of five bytes slides over the UTF-8 text; each of the triplets that hold its
newest byte is hashed into one of ``BUCKETS`` counters. A bucket's code is its quartile
among the counters (0 to 3), so a fingerprint is two bits a bucket, behind a length
code and the ratios of the quartiles. Two fingerprints differ by the sum of their
code distances (a distance of 3 counts 6) plus the differences of the header
codes; likeness is 1 - difference / ``LIMIT``, and 0 from ``LIMIT`` on.

Defined results: null is the empty text, whose counters are all 0; texts shorter than
a window have the triplets they hold; equal texts have equal fingerprints and
likeness 1. For :func:`edited_likeness` null ids come first and rows with equal ids
are ordered by a hash of the text; the only row of a table is its own next; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratekit.session import scratch_path

from .common import BLOCK_BYTES, arrow_map, blocks, text_bytes

BUCKETS = 128
#: Difference from which texts count as unlike.
LIMIT = 2.0 * BUCKETS
_SMALL = BLOCK_BYTES // 4
# Triplets of a window by distance from its newest byte.
_TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
_RNG = np.random.Generator(np.random.PCG64(10))
_A, _B, _C = (_RNG.integers(1, 1 << 31, 256, dtype=np.uint32) for _ in range(3))
_FAR = np.array([0, 1, 2, 6])


def triplet_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Counters of each text (n x BUCKETS)."""
    n = len(offs) - 1
    out = np.zeros(n * BUCKETS, np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offs))
    a, b, c = _A[data], _B[data], _C[data]
    for k, (p, q) in enumerate(_TRIPLETS):
        if len(data) <= q:
            continue
        h = a[q:] + b[q - p : len(data) - p] + c[: len(data) - q] + np.uint32(k * 0x1F123BB5)
        h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(25)
        same = doc[q:] == doc[: len(data) - q]
        out += np.bincount((doc[q:] + h)[same], minlength=len(out))
    return out.reshape(n, BUCKETS)


def codes(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Digest rows as uint8: length code, two ratio codes, a code a bucket."""
    order = np.sort(counts, axis=1)
    q1, q2, q3 = (order[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    body = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = np.minimum(255, np.round(np.log1p(sizes) / np.log(1.1))).astype(np.uint8)
    top = np.maximum(q3[:, 0], 1)
    ratios = [np.minimum(15, q[:, 0] * 15 // top).astype(np.uint8) for q in (q1, q2)]
    return np.concatenate([length[:, None], ratios[0][:, None], ratios[1][:, None], body.astype(np.uint8)], axis=1)


def digest(texts: list[str]) -> np.ndarray:
    out = []
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= _SMALL):
            size += len(texts[to])
            to += 1
        data, offs = text_bytes(pa.array(texts[at:to], pa.string()))
        out.append(codes(triplet_counts(data, offs), np.diff(offs)))
        at = to
    return np.concatenate(out) if out else np.zeros((0, 3 + BUCKETS), np.uint8)


def hexes(d: np.ndarray) -> list[str]:
    """Fingerprints as text: length byte, a byte of ratios, 2 bits a bucket."""
    body = d[:, 3:].reshape(len(d), -1, 4)
    packed = (body[:, :, 0] << 6) | (body[:, :, 1] << 4) | (body[:, :, 2] << 2) | body[:, :, 3]
    head = np.stack([d[:, 0], (d[:, 1] << 4) | d[:, 2]], axis=1)
    return [r.tobytes().hex() for r in np.concatenate([head, packed], axis=1).astype(np.uint8)]


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 for equal digests down to 0, row by row."""
    gap = np.abs(x.astype(np.int64) - y.astype(np.int64))
    header = np.maximum(gap[:, 0] - 1, 0) + gap[:, 1] + gap[:, 2]
    return 1.0 - np.minimum(LIMIT, header + _FAR[gap[:, 3:]].sum(axis=1)) / LIMIT


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str]) -> dict:
    """Result columns of all texts but the last, each with its follower."""
    edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
    d, e = digest(texts), digest(edited)
    n = len(edited)
    return {
        "doc_id": ids[:n],
        "n_chars": [len(t) for t in texts[:n]],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": hexes(d[:n]),
        "edited_fingerprint": hexes(e),
        "near_edited": likeness(d[:n], e),
        "near_next": likeness(d[:n], d[1:]),
    }


def edited_likeness(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, by ascending doc_id.

    One range shuffle sorts the texts; a task joins each to its follower as it streams.
    The first and last text of every partition (``part``) are written out and the
    borders, one a partition, are joined afterwards.
    """
    spark = documents.sparkSession
    src = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.withColumn("tie", F.xxhash64("text"))
    ordered = src.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    fields = f"doc_id long, {_FIELDS}, part int, edge int, tie long, text string"
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.int32()), ("tie", pa.int64()), ("text", pa.string())])

    def batch(**cols):
        n = len(cols["doc_id"])
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name] if f.name in cols else [None] * n, f.type) for f in schema], schema=schema)

    def stream(batches):
        part = TaskContext.get().partitionId()
        held = None  # the text that waits for its follower
        for b in blocks(batches, "text"):
            ids, texts, ties = (b.column(k).to_pylist() for k in ("doc_id", "text", "tie"))
            if held is None:
                yield batch(doc_id=ids[:1], text=texts[:1], tie=ties[:1], part=[part], edge=[0])
            else:
                ids, texts, ties = [held[0], *ids], [held[1], *texts], [held[2], *ties]
            held = (ids[-1], texts[-1], ties[-1])
            if len(texts) > 1:
                yield batch(**_rows(ids, texts))
        if held is not None:
            yield batch(doc_id=[held[0]], text=[held[1]], tie=[held[2]], part=[part], edge=[1])

    path = scratch_path(spark, "digests")
    arrow_map(ordered, stream, fields).write.parquet(path)
    done = spark.read.parquet(path)
    names = ["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))]
    # borders: one first and one last text a partition, in the order of the first ones
    heads = done.filter("edge = 0").select(F.struct(F.col("doc_id"), "tie", "part").alias("at"), "part")
    order = Window.orderBy("at")
    first = F.min("at").over(Window.partitionBy())["part"]
    follow = heads.select("part", F.coalesce(F.lead("part").over(order), first).alias("next"))
    tails = done.filter("edge = 1").select("part", "doc_id", "text").join(follow, "part")
    starts = done.filter("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("following"))
    borders = tails.join(starts, "next").select("doc_id", "text", "following")

    def finish(batches):
        for b in blocks(batches, "text"):
            for i, a, c in zip(*(b.column(k).to_pylist() for k in ("doc_id", "text", "following"))):
                got = _rows([i], [a, c])
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in schema if f.name in names], names=names)

    return done.filter("edge IS NULL").select(names).unionByName(arrow_map(borders, finish, f"doc_id long, {_FIELDS}"))
