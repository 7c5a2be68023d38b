"""Mixing sources to target weights by Efraimidis-Spirakis weighted sampling.

Sources, by code point with null last, weigh 1, 2, 3, repeating, and share the budget
of all words; a target stops at ``CAP`` times its source's words and the excess is
reshared by weight until none is above. The reshared shares are a water level: with
sources ordered by words / weight, the first source that its level does not
fill fixes the level for it and all after it.

Within a source every complete epoch takes each document once. The fractional epoch
orders the documents by the exponential key -ln(u) / weight (u hashed from the
doc_id, or the text of a document without one, weight the document's quality weight), so better documents come first more
often, and takes words from the front until the rest of the target is used up; the
document at the border gives its first words up to that.

The order within a source is a range-partitioned sort with prefix sums per partition,
so a source that holds a third of all rows spreads over many tasks. Only
per-source and per-partition totals are ranked globally.

Defined results: null texts have size 0; empty texts take 0 words; a source
without words has target 0; repeated rows with one doc_id share a key and are
ordered by size; the null source is a source; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratekit.session import scratch_path

from .common import numbered_copy, plain_rows

CAP = 3
# The word separators of the contract, and characters that lower the quality weight.
_BLANKS = " \t\n\x0b\f\r"
_NOISE = "0123456789#$%&*@^~|<>{}=+\\"
SEED = "mix"


def n_words(text: str) -> Column:
    """Number of runs of other characters than 0x20 and 0x09-0x0D; null counts 0."""
    marked = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marked, _BLANKS, "")).cast("long")


def quality_weight(text: str) -> Column:
    """0.1 to 1: the share of characters outside ``_NOISE``; 1 for an empty text."""
    n = F.length(F.col(text))
    share = F.length(F.translate(F.col(text), _NOISE, "")) / n
    return F.when(n > 0, 0.1 + 0.9 * share).otherwise(F.lit(1.0))


def sampling_key(doc_id: str, text: str, weight: Column) -> Column:
    own = F.concat(F.lit("#"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    text = F.concat(F.lit(SEED + "|"), F.coalesce(F.col(doc_id).cast("string"), own))
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of the per-source totals (source, source_size)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))
    full = F.col("source_size") * CAP
    by = Window.orderBy(full / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.select(
        "*",
        F.row_number().over(by).alias("at"),
        (F.sum(full).over(by.rowsBetween(Window.unboundedPreceding, 0)) - full).alias("filled"),
        F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        F.sum("source_size").over(everything).alias("total"),
    )
    s = s.withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
    fits = F.col("level") * F.col("w") <= full
    level = F.min(F.when(fits, F.struct("at", "level"))).over(everything)["level"]
    return s.select("source", "source_size", F.least(full.cast("double"), level * F.col("w")).alias("target"))


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``documents``."""
    return _mix(documents.select("doc_id", "source", "text")).drop("row")


def _mix(documents: DataFrame) -> DataFrame:
    """:func:`mix` of (doc_id, source, text), with the column ``row`` where it is given."""
    key = sampling_key("doc_id", "text", quality_weight("text")).alias("key")
    carried = [c for c in documents.columns if c == "row"]
    rows = documents.select("doc_id", "source", n_words("text").alias("size"), key, *carried)
    # Narrow rows first: the range sort samples its input and would read the texts twice.
    rows = _table(rows, "mix-rows")
    ordered = ["key", "doc_id", "size"]
    rows = _table(rows.repartitionByRange("source", *ordered).withColumn("part", F.spark_partition_id()), "mix-order")
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    sizes = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    run = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "part", F.coalesce(F.sum("words").over(run), F.lit(0)).alias("offset"))
    t = targets(sizes)
    plan = offsets.join(t, offsets["source"].eqNullSafe(t["source"])).select(
        offsets["source"].alias("s"), F.col("part").alias("p"), "offset", "source_size", "target", F.round("target").cast("long").alias("budget")
    )
    inner = Window.partitionBy("source", "part").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("before", F.sum("size").over(inner) - F.col("size"))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    n = F.greatest("source_size", F.lit(1))
    epochs = F.floor(F.col("budget") / n)
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("offset") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *carried)


def mixed_documents(documents: DataFrame) -> DataFrame:
    """Rows of ``documents`` as often as the mix takes them, whole texts only.

    A row comes round(taken / size) times, so the one at a source's border comes
    once more or not at all. Every row is mixed for itself, whatever its doc_id: rows are
    numbered in a written copy, and their copies come back by that number. Documents
    without words are not taken. Columns of any name pass through.
    """
    whole = numbered_copy(documents)
    taken = _mix(whole.select("doc.doc_id", "doc.source", "doc.text", "row"))
    copies = taken.select("row", F.floor(F.try_divide("taken", "size") + 0.5).cast("int").alias("n")).filter("n > 0")
    joined = whole.join(copies, "row").select("doc", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    return plain_rows(joined, documents.columns)


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CASE WHEN length(text) > 0 THEN 0.1::DOUBLE + 0.9::DOUBLE
      * (length(translate(text, '{_NOISE}', '')) / length(text)) ELSE 1.0::DOUBLE END AS w,
    (('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '#' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / w AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS w FROM k GROUP BY source),
o AS (SELECT *, row_number() OVER r AS pos, sum({CAP} * n) OVER r - {CAP} * n AS filled,
    sum(w) OVER (ORDER BY ({CAP} * n) / w DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS open,
    sum(n) OVER () AS total
  FROM s WINDOW r AS (ORDER BY ({CAP} * n) / w ASC, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, CAST(total - filled AS DOUBLE) / CAST(open AS DOUBLE) AS level FROM o),
t AS (SELECT source, n, least(CAST({CAP} * n AS DOUBLE),
    (SELECT arg_min(level, pos) FROM l WHERE level * w <= {CAP} * n) * w) AS target FROM l),
p AS (SELECT k.*, t.n, t.target, CAST(round(t.target) AS BIGINT) AS budget,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
  CAST((budget // greatest(n, 1)) * size
    + greatest(0, least(size, budget - (budget // greatest(n, 1)) * n - before)) AS BIGINT) AS taken
FROM p
"""
