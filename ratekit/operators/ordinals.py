"""Numbers of rows: copies of equal rows, and positions in a total order.

Both are the same under any partitioning and in every run, and neither brings an
unbounded group into one task.

* :func:`numbered_copies` counts equal rows (partially aggregated, so a row repeated a
  million times is one row a task before the shuffle) and writes them out again in
  chunks that are dealt over all partitions.
* :func:`row_numbers` sorts by range partitions, keeps the sorted rows with their places, and adds
  to each place the number of rows in the partitions before. Only the partition sizes
  reach the driver, one number a partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratekit.operators.joins import shuffle_partitions
from ratekit.session import materialize

#: Copies of one row that are written out by one row of a task.
CHUNK = 1 << 16
# monotonically_increasing_id holds the partition above 33 bits of place.
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def numbered_copies(df: DataFrame, name: str = "copy", chunk: int = CHUNK) -> DataFrame:
    """``df`` with the number 1, 2, ... of each row among the rows equal to it in every column."""
    cols = df.columns
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(chunk).cast("bigint"))
    parts = counts.select(*cols, "_n", F.explode(starts).alias("_from"))
    # Chunks of a hot row go to different tasks; a row that occurs once stays where it is.
    many = parts.filter(F.col("_n") > F.lit(chunk)).repartition(shuffle_partitions(df), *cols, "_from")
    few = parts.filter(F.col("_n") <= F.lit(chunk))

    def out(p: DataFrame) -> DataFrame:
        last = F.least(F.col("_from") + F.lit(chunk), F.col("_n"))
        return p.select(*cols, F.explode(F.sequence(F.col("_from") + 1, last)).alias(name))

    return out(few).unionByName(out(many))


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_number", start: int = 1) -> DataFrame:
    """``df`` with its position ``start``, ``start`` + 1, ... in the order of ``order``.

    The order should be total: rows that tie are numbered arbitrarily and lie in one range
    partition (number copies first, see :func:`numbered_copies`). The sorted rows are
    checkpointed once, which fixes their places.
    """
    placed = materialize(
        df.repartitionByRange(shuffle_partitions(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _PLACE_BITS).cast("int")
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = accumulate((n for _, n in sizes), initial=start)
    # One row a partition.
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part int, _before bigint")
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_place").bitwiseAND(F.lit(_PLACE_MASK))
    return joined.select(*df.columns, (F.col("_before") + place).alias(name))
