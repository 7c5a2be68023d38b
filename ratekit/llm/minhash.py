"""Near-duplicates by min-max hashing of word shingles, confirmed on the full sets.

Each hash permutation yields two signature values, the minimum and the maximum over a
text's shingles, so half the hash evaluations give signatures whose agreement is an
unbiased estimate of the Jaccard similarity with a lower variance. The values are
banded (``BANDS`` bands of ``ROWS``); two texts with similarity 0.8 share no band with
probability (1 - 0.8**6)**48 < 1e-6. Sets of fewer than ``PREFIX_BELOW`` shingles, where the two values
of one permutation are far from independent, also share a bucket for each of the smallest shingles that
two similar sets cannot all differ in (an exact prefix filter). Texts that share a bucket are candidates
and are compared on their full shingle sets.

Groups of copies never become all pairs, and no task meets all copies of a text: texts with equal sets are one
class, gathered by partial aggregates; classes that hold over a thousandth of all rows (a thousand at
most) are broadcast to their rows, and leaders of that many pairs are copied over several tasks. Within
a band's bucket every class is first compared with the bucket's smallest class; after
that, only pairs that are still in different components need comparing, first
with a member of the bucket's largest component while there are many, at last all
of them whose sizes and parity sketches allow the similarity (an exact bound). No bucket is capped.

Defined results: null, empty and blank texts have n_shingles 0 and link with
nothing; fewer words than a shingle count as one shingle; repeated rows are one class;
a null doc_id takes part in nothing and is kept (component_id null); rows with
equal doc_id are one document, which links with whatever one of its texts links with. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.session import materialize, scratch_path

from .common import BLOCK_BYTES, HOT_PART, arrow_map, blocks, mix64, spread_join, text_bytes, words_of
from .components import components

ROWS, BANDS = 6, 48
#: Sets of fewer shingles are also found by a prefix filter.
PREFIX_BELOW = 16
WORDS = 16
PARITY = [f"q{k}" for k in range(WORDS)]
_SMALL = BLOCK_BYTES // 4
_RNG = np.random.Generator(np.random.PCG64(7))
_MUL = _RNG.integers(1, 1 << 63, ROWS * BANDS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 1 << 63, ROWS * BANDS // 2, dtype=np.uint64)
_PLACE = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and each text's first (n + 1 entries)."""
    w = words_of(data, offs)
    h = w.hashes["word"]
    out, first = [], [0]
    if len(h) >= width:
        grams = h[: len(h) - width + 1] * _PLACE[0]
        for k in range(1, width):
            grams = grams + h[k : len(h) - width + 1 + k] * _PLACE[k]
        grams = mix64(grams)
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        n = hi - lo
        if n >= width:
            out.append(np.unique(grams[lo : hi - width + 1]))
        elif n:
            out.append(mix64(np.array([(h[lo:hi] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)])))
        first.append(first[-1] + (len(out[-1]) if n else 0))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.array(first, np.int64)


def set_keys(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 2 x 64-bit key of each whole set, of texts that have shingles (n + 1 entries in ``first``)."""
    return np.stack([np.add.reduceat(mix64(sets + np.uint64(s)), first[:-1]) for s in (1, 2)], axis=1)


def prefixes(sets: np.ndarray, first: np.ndarray, percent: int) -> list[np.ndarray]:
    """Buckets of small sets: the first n - ceil(t n) + 1 shingles (sets are sorted), none for others.

    Of two sets with similarity t or more, sorted alike, these prefixes share a shingle.
    """
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        n = hi - lo
        k = n - -(-percent * n // 100) + 1 if 0 < n < PREFIX_BELOW else 0
        out.append(mix64(sets[lo : lo + k] ^ np.uint64(0x5851F42D4C957F2D)))
    return out


def signatures(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (texts x BANDS) and the set keys, of texts that have shingles."""
    heads = first[:-1]
    half = np.empty((2 * len(_MUL), len(heads)), np.uint64)
    v = np.empty_like(sets)
    for k in range(len(_MUL)):
        np.bitwise_xor(sets, _XOR[k], out=v)
        np.multiply(v, _MUL[k], out=v)
        half[2 * k] = np.minimum.reduceat(v, heads)
        half[2 * k + 1] = np.maximum.reduceat(v, heads)
    bands = np.empty((len(heads), BANDS), np.uint64)
    for b in range(BANDS):
        acc = np.full(len(heads), b + 1, np.uint64)
        for r in range(ROWS):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + half[b * ROWS + r])
        bands[:, b] = acc
    return bands, set_keys(sets, first)


def sketch(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands) of every row; bands are empty for an empty set."""

    def run(batches):
        for b in blocks(batches, "text", _SMALL):
            sets, first = shingle_sets(*text_bytes(b.column("text")), width)
            size = np.diff(first)
            full = np.flatnonzero(size)
            k = np.zeros((b.num_rows, 2), np.int64)
            flat = np.zeros(0, np.int64)
            if len(full):
                starts = np.append(first[full], first[-1])
                bands, keys = signatures(sets, starts)
                k[full] = keys.view(np.int64)
                small = prefixes(sets, starts, percent)
                flat = np.concatenate([x for pair in zip(bands, small) for x in pair]).view(np.int64)
                size_of = np.zeros(b.num_rows, np.int64)
                size_of[full] = BANDS + np.array([len(x) for x in small])
            else:
                size_of = size
            offs = np.concatenate([[0], np.cumsum(size_of)]).astype(np.int32)
            cols = [b.column("doc_id"), pa.array(size), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    src = documents.select(F.col("doc_id").cast("long"), "text")
    return arrow_map(src, run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<bigint>")


def parities(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 x ``WORDS`` cells of the hash space a text, each 1 bit: its number of shingles, odd or even.

    Cells that differ hold at least one shingle of only one text, so the differing
    bits of two texts never exceed the size of their sets' symmetric difference.
    """
    n, cells = len(first) - 1, 64 * WORDS
    doc = np.repeat(np.arange(n, dtype=np.int64) * cells, np.diff(first))
    odd = np.bincount(doc + (sets >> np.uint64(64 - 10)).astype(np.int64), minlength=n * cells) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, cells), axis=1).view(np.int64)


def _sets(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, shingles, parity words) of the classes in ``wanted`` (id, doc_id, k1, k2)."""

    def run(batches):
        for b in blocks(batches, "text", _SMALL):
            sets, first = shingle_sets(*text_bytes(b.column("text")), width)
            full = np.flatnonzero(np.diff(first))
            if not len(full):
                continue
            # a document may have several texts: only the class's own counts
            keys = set_keys(sets, np.append(first[full], first[-1])).view(np.int64)
            own = (keys[:, 0] == b.column("k1").to_numpy()[full]) & (keys[:, 1] == b.column("k2").to_numpy()[full])
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))
            words = [pa.array(w) for w in parities(sets, first).T]
            out = pa.RecordBatch.from_arrays([b.column("id"), lists, *words], names=["id", "shingles", *PARITY])
            yield out.take(pa.array(full[own]))

    # Repeated rows go where the join has put them, before the larger sets exist.
    src = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
    src = src.withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "id", "h"]).drop("doc_id", "h")
    fields = ", ".join(f"{w} long" for w in PARITY)
    return arrow_map(src, run, f"id long, shingles array<bigint>, {fields}")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    part = counts.agg(F.sum("n")).scalar() / HOT_PART
    # at most HOT_PART leaders: a proven bound; each is copied to several tasks
    hot = F.broadcast(counts.filter(F.col("n") > part).select("a", F.ceil(F.col("n") / part).cast("int").alias("copies")))
    copies = F.coalesce("copies", F.lit(1))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")).join(hot, "a", "left")
    left = left.select("a", "sa", F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"))
    pairs = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), copies).cast("int").alias("salt"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(left, ["a", "salt"]).join(right, "b").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
    return joined.filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b")


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _same_document(live: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the classes of documents that have texts of several classes."""
    key = F.struct("k1", "k2")
    several = live.groupBy("doc_id").agg(F.min(key).alias("x"), F.max(key).alias("y")).filter("x <> y").select("doc_id", "x")
    each = live.select("doc_id", "k1", "k2").join(several, "doc_id").distinct()
    name = classes.select("k1", "k2", "id")
    first = name.select(F.col("k1").alias("x1"), F.col("k2").alias("x2"), F.col("id").alias("a"))
    named = each.select("k1", "k2", F.col("x.k1").alias("x1"), F.col("x.k2").alias("x2")).join(name, ["k1", "k2"])
    return named.join(first, ["x1", "x2"]).select("a", F.col("id").alias("b")).filter("a <> b").distinct()


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80, pivots: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``documents`` (doc_id, text)."""
    rows = _table(sketch(documents, width, percent), "minhash-rows")
    live = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets have equal bands; a class's number is fixed by its written row
    classes = live.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = _table(classes.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
    member = classes.select("id", "n_shingles", F.explode("bands").alias("bucket"))
    counted = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min_by(F.struct("id", "n_shingles"), "id").alias("lead"))
    member = _table(member.join(counted.filter("size > 1"), "bucket"), "minhash-members")
    wanted = classes.select("id", "doc_id", "k1", "k2").join(member.select("id").distinct(), "id", "left_semi")
    sets = _table(_sets(documents, wanted, width), "minhash-sets")

    def fits(n, m):  # sizes that allow the similarity at all
        return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))

    lead = F.col("lead")
    compared = materialize(
        member.filter((F.col("id") != lead["id"]) & fits(F.col("n_shingles"), lead["n_shingles"]))
        .select(lead["id"].alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    links = materialize(_confirmed(compared, sets, percent).unionByName(_same_document(live, classes)))
    label = materialize(components(links))
    wide = member.filter("size > 2").select("bucket", "id", "n_shingles")
    for turn in range(pivots + 1):
        # buckets that still hold several components, and how many pairs those make
        named = wide.join(label, "id", "left").withColumn("c", F.coalesce("component_id", "id")).drop("component_id")
        parts = named.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("id", "n_shingles", "c"), F.xxhash64("id", F.lit(turn))).alias("p"))
        mixed = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).cast("double").alias("across"), F.max_by("p", "n").alias("pivot")).filter("parts > 1")
        named = materialize(named.join(mixed.select("bucket", "across", "pivot"), "bucket"))
        # a bucket's pairs are counted with one of its rows
        first = F.col("id") == F.col("pivot.id")
        total = named.agg(F.sum(F.when(first, F.col("across"))).alias("pairs"), F.count(F.lit(1)).alias("n")).first()
        if not total["n"]:
            break
        last = turn == pivots or total["pairs"] <= 256 * total["n"]
        if last:
            bits = named.join(sets.select("id", *PARITY), "id")
            x = bits.select("bucket", F.col("id").alias("a"), F.col("n_shingles").alias("n"), "c", *PARITY)
            y = bits.select("bucket", F.col("id").alias("b"), F.col("n_shingles").alias("m"), F.col("c").alias("d"), *(F.col(w).alias(f"r{w}") for w in PARITY))
            apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"r{w}"))) for w in PARITY), F.lit(0))
            # similar sets differ in at most this share of their sizes
            near = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("m"))
            on = (F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & fits(F.col("n"), F.col("m")) & near
            pairs = x.join(y, "bucket").filter(on).select("a", "b")
        else:
            p = F.col("pivot")
            pairs = named.filter((F.col("c") != p["c"]) & fits(F.col("n_shingles"), p["n_shingles"])).select(F.least("id", p["id"]).alias("a"), F.greatest("id", p["id"]).alias("b"))
        fresh = materialize(pairs.distinct().join(compared, ["a", "b"], "left_anti"))
        more = materialize(_confirmed(fresh, sets, percent))
        compared = compared.unionByName(fresh)
        links = links.unionByName(more)
        if not more.isEmpty():
            label = materialize(components(links))
        if last:
            break
        wide = named.select("bucket", "id", "n_shingles")
    # the smallest doc_id of each component, then of each class, then of each row
    c = classes.select("id", "k1", "k2", "n", "doc_id").join(label, "id", "left").withColumn("c", F.coalesce("component_id", "id"))
    c = _table(c.select("k1", "k2", "n", "doc_id", "c"), "minhash-components")
    least = c.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    named = spread_join(c.drop("doc_id"), least, ["c"], "classes").select("k1", "k2", "n", "component_id")
    every = rows.select("doc_id", "n_shingles", "k1", "k2")
    none = F.lit(None).cast("bigint").alias("component_id")
    out = spread_join(every.filter("n_shingles > 0"), _table(named, "minhash-named"), ["k1", "k2"], "n")
    out = out.select("doc_id", "n_shingles", "component_id").unionByName(every.filter("n_shingles = 0").select("doc_id", "n_shingles", none))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    out = out.select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(words) >= 4
    THEN list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, e.y FROM r JOIN e ON e.x = r.other),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.id = d.doc_id
"""
