"""Multi-valued tags: explode and count items per value (K1, K2)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_values(
    items: DataFrame,
    tags_col: str = "tags",
    sep: str = "|",
    out_col: str = "value",
    keep: tuple[str, ...] = ("item_id", "title"),
) -> DataFrame:
    """One row per (item, value).

    The separator is matched literally (a bare '|' is a regex alternation and
    would split into characters). NULL tag strings produce no row; an empty
    string produces one empty value, as a string split does.
    """
    # Java-regex literal quoting: the separator never acts as a pattern.
    pattern = "\\Q" + sep + "\\E" if "\\E" not in sep else re.escape(sep)
    parts = F.split(F.col(tags_col), pattern)
    return items.select(*keep, F.explode(parts).alias(out_col))


def value_counts(item_values: DataFrame, value_col: str = "value") -> DataFrame:
    """Distinct items per value, ordered by count desc, value asc.

    Planned as aggregate(value, item) -> aggregate(value): the first level
    removes duplicates before the shuffle on ``value``, so one value holding
    a third of all rows reaches the second shuffle as one row per map task.
    """
    return (
        item_values.groupBy(value_col)
        .agg(F.count_distinct("item_id").alias("item_count"))
        .orderBy(F.desc("item_count"), F.asc(value_col))
    )
