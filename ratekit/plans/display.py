"""What the command line prints, as frames whose order is a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.operators.ordinals import row_numbers
from ratekit.operators.ranking import LISTS
from ratekit.plans.values import ValueAnalysis


def value_table(counts: DataFrame, limit: int | None = None) -> DataFrame:
    """(line, value, item_count): the values by falling number of items, then by name.

    ``limit`` keeps the first lines only: every task ships its own first ``limit`` rows.
    Lines are numbered by range partitions, so the vocabulary may be of any size.
    """
    order = [F.desc("item_count"), F.asc("value")]
    kept = counts.orderBy(*order).limit(limit) if limit else counts
    return row_numbers(kept, order, "line").select("line", "value", "item_count")


def list_tables(va: ValueAnalysis) -> DataFrame:
    """(section, rank, value, list_name, item_id, title, rating_count, avg_rating): the printed lists.

    Sections follow the chosen values and, within a value, the four lists.
    """
    at = lambda names, c: F.array_position(F.array(*[F.lit(x) for x in names]), F.col(c)) - 1
    section = at(va.values, "value") * F.lit(len(LISTS)) + at(LISTS, "list_name")
    return va.lists.select(
        section.cast("bigint").alias("section"), "rank", "value", "list_name", "item_id", "title", "rating_count", "avg_rating"
    )


def print_value_table(va: ValueAnalysis, limit: int | None = None) -> None:
    """Shows the value table (``limit`` lines, or all) and how many values are left."""
    n = va.counts.count()
    shown = min(limit or n, n)
    value_table(va.counts, shown or None).orderBy("line").select("value", "item_count").show(max(shown, 1), truncate=False)
    if shown < n:
        print(f"{n - shown} more values")


def print_list_tables(va: ValueAnalysis) -> None:
    """Shows every list as a table of its own."""
    rows = list_tables(va).persist()  # at most values x lists x n rows
    for k, (v, name) in enumerate((v, name) for v in va.values for name in LISTS):
        print(f"\n{v}: {name}")
        rows.filter(F.col("section") == k).orderBy("rank").select("rank", "title", "rating_count", "avg_rating").show(va.n, truncate=False)
    rows.unpersist()
