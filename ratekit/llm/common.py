"""Shared helpers: Arrow text blocks, vectorised words, fold hashes, samples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratekit.session import scratch_path

#: Bytes and rows of text that a task works on at once (a longer text is one block).
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 2000
#: Rows that Spark hands to Python at once, where the session keeps Spark's own default.
BATCH_ROWS, _DEFAULT_ROWS = 2000, "10000"

#: A key that holds more than this part of all rows is hot; there are at most as many of them.
HOT_PART = 1000

# Fixed value: ASCII white space 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of letter-and-digit words: every ASCII byte but 0-9, A-Z, a-z.
NON_WORD = np.zeros(256, bool)
NON_WORD[:128] = True
NON_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240817))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.cumprod(np.full(32, _BASE), dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % parts


def held_out(doc_id: Column | str, parts: int, part: int) -> Column:
    """True where the fold equals ``part``; a null id is in no fold."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (a bijection)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` in smaller batches than Spark's default of 10,000 rows.

    Texts are large: the JVM and the Python worker each hold a whole batch. A size
    that the session sets itself is left alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == _DEFAULT_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES, max_rows: int = BLOCK_ROWS):
    """Slices of the batches of about ``max_bytes`` text and ``max_rows`` rows at most, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offs = text_bytes(batch.column(column))
        at = 0
        while at < n:
            to = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), at + max_rows, n)
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """Words of a block of texts: byte spans, text index, hashes per kind."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of the first word of each text, n + 1 entries
    hashes: dict[str, np.ndarray]


def words_of(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE, kinds: tuple[str, ...] = ("word",)) -> Words:
    """Maximal runs of non-separator bytes, with 64-bit hashes of the A-Z-lowered bytes.

    ``kinds``: ``word``; ``preK`` / ``sufK``, the hash of the first / last K bytes.
    """
    n_docs, n = len(offs) - 1, len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(n_docs + 1, np.int64), {k: np.zeros(0, np.uint64) for k in kinds})
    inside = ~sep[data]
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    prev[heads] = False
    start = np.flatnonzero(inside & ~prev)
    first = np.searchsorted(start, offs).astype(np.int64)
    if len(start) == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, first, {k: np.zeros(0, np.uint64) for k in kinds})
    count = np.add.reduceat(inside, start, dtype=np.int64)
    # a word that ends with its text is followed at once by the next text's word or blanks
    end = start + count
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    idx = np.flatnonzero(inside)
    pos = np.arange(len(idx)) - np.repeat(np.cumsum(count) - count, count)
    val = _BYTE[LOWER[data[idx]]]
    top = int(count.max())
    power = np.full(top, _BASE)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    at = np.cumsum(count) - count
    out = {}
    for kind in kinds:
        k = int(kind[3:] or 0) if kind != "word" else 0
        if kind == "word":
            h = np.add.reduceat(val * power[pos], at)
        else:
            h = np.full(len(start), 7919 * (k + 10 * kind.startswith("suf")), np.uint64)
            for j in range(k):  # bytes beyond the word add nothing
                byte = data[np.minimum(start + j, end - 1) if kind.startswith("pre") else np.maximum(end - 1 - j, start)]
                h += np.where(count > j, _BYTE[LOWER[byte]] * _POWER[j], np.uint64(0))
        out[kind] = mix64(h)
    return Words(start, end, doc, first, out)


def sample_ids(labels: DataFrame, by: str, per_value: int, seed: int = 17, few: bool = False) -> DataFrame:
    """At most ``per_value`` rows of each value of ``by``, those with the smallest hashed id.

    Bounded by values x ``per_value`` and the same in every run. Counts per value give
    a hash threshold that lets about twice as many rows through, so a hot value does
    not meet whole in one task; the rest are ranked. ``few``: ``by`` has a known small
    number of values, so that their counts can be broadcast.
    """
    unit = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    counts = labels.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    near = labels.join(F.broadcast(counts) if few else counts, by).withColumn("_u", unit).filter(F.col("_u") * F.col("_n") <= 2.0 * per_value + 20)
    w = Window.partitionBy(by).orderBy("_u", "doc_id")
    near = near.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= per_value)
    return near.drop("_rank", "_u", "_n")


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, parts: int, part: int, per_class: int, max_bytes: int
) -> list[tuple[str, int]]:
    """(text, 0 or 1) of at most ``per_class`` labelled texts a class, outside the held-out fold.

    Texts over ``max_bytes`` bytes are not fitted on, so the sample is bounded in
    bytes too. Rows whose label is null or neither 0 nor 1 teach nothing; of
    repeated ids the largest label counts.
    """
    lab = (
        labels.select("doc_id", F.col(label).cast("int").alias("_y"))
        .filter(F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", parts) != part))
        .groupBy("doc_id")
        .agg(F.max("_y").alias("_y"))
    )
    docs = documents.select("doc_id", "text").filter(F.octet_length("text") <= max_bytes)
    ids = sample_ids(lab, "_y", per_class, few=True)
    # at most 2 x per_class ids: a proven bound
    rows = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_y")
    got = {}
    for r in rows.collect():
        key = (r["doc_id"], r["text"])
        got[key] = r["_y"]
    return [(t, y) for (_, t), y in sorted(got.items())]


def as_block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.string()))


def text_chunks(texts: list[str], max_bytes: int = BLOCK_BYTES):
    """Blocks of the texts in order, of about ``max_bytes`` each, so that token arrays stay small."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= max_bytes:
            yield as_block(part)
            part, size = [], 0
    if part:
        yield as_block(part)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Left join with ``right``, one row a key with the number ``weight`` of left rows it has.

    Keys of more than 1 / ``HOT_PART`` of these rows are broadcast (at most ``HOT_PART`` rows: a proven
    bound), so their left rows stay where they are; the others are joined by key.
    """
    part = right.agg(F.sum(weight)).scalar() / HOT_PART
    hot = F.broadcast(right.filter(F.col(weight) > part).drop(weight))
    given = [c for c in right.columns if c not in [*on, weight]]
    near = left.join(hot, on)
    far = left.join(hot.select(*on), on, "left_anti").join(right.filter(F.col(weight) <= part).drop(weight), on, "left")
    return near.unionByName(far).select(*left.columns, *given)


def free_prefix(columns: list[str], prefix: str, names: tuple[str, ...]) -> str:
    """``prefix``, after as many ``_`` as it takes for ``prefix`` + name to be no column (in any case of letters)."""
    have = {c.lower() for c in columns}
    while any((prefix + n).lower() in have for n in names):
        prefix = "_" + prefix
    return prefix


def numbered_copy(documents: DataFrame) -> DataFrame:
    """(doc, row): each row of ``documents`` as one struct, so that no column name clashes, with a number.

    Written to the shared folder and read again, which fixes the numbers.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "numbered")
    documents.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    return spark.read.parquet(path)


def plain_rows(numbered: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of :func:`numbered_copy`'s input again."""
    return numbered.select([F.col("doc").getField(c).alias(c) for c in columns])


def with_fields(schema: StructType, ddl: str) -> StructType:
    """A new schema: the fields of ``schema``, then those of the DDL text."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])
