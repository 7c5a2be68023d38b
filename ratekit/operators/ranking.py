"""Rating statistics per (value, item) and top-n lists per value (K3-K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratekit.operators.state import batch_state, mean_rating


def rating_stats(
    item_values: DataFrame,
    ratings: DataFrame,
    values: Sequence[str] | None = None,
    plan: str = "aggregate_first",
) -> DataFrame:
    """(value, item_id, title, rating_count, avg_rating) for the chosen values.

    Items without any rating row drop out (inner join). ``rating_count``
    counts non-NULL ratings.

    ``plan="aggregate_first"`` (default) aggregates ratings per item before
    the join: the join input shrinks from |ratings| to |items| and the
    per-item partial aggregate collapses hot items on the map side.
    ``plan="join_first"`` joins first and aggregates per (value, item, title);
    both plans give equal rows.
    """
    iv = item_values
    if values is not None:
        iv = iv.filter(F.col("value").isin(list(values)))
    if plan == "join_first":
        joined = iv.join(ratings.select("item_id", "rating"), "item_id", "inner")
        return joined.groupBy("value", "item_id", "title").agg(
            F.count("rating").alias("rating_count"),
            F.avg("rating").alias("avg_rating"),
        )
    if plan != "aggregate_first":
        raise ValueError(f"unknown plan {plan!r}")
    return rating_stats_of(iv, batch_state(ratings, "item_id"))


def rating_stats_of(item_values: DataFrame, state: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """:func:`rating_stats` from a state by item (:mod:`ratekit.operators.state`) instead of the ratings."""
    iv = item_values if values is None else item_values.filter(F.col("value").isin(list(values)))
    # The join-first plan multiplies ratings by how often an item carries the
    # same (value, title); keep that multiplicity so both plans agree exactly.
    iv = iv.groupBy("value", "item_id", "title").agg(F.count(F.lit(1)).alias("mult"))
    j = iv.join(state, "item_id", "inner")
    return j.select(
        "value",
        "item_id",
        "title",
        (F.col("rating_count") * F.col("mult")).alias("rating_count"),
        mean_rating().alias("avg_rating"),
    )


# The four list orderings and their tie-breaks, as
# (column, direction) pairs, and whether the list needs rating_count > min.
#   most_rated : rating_count desc, title asc            (no minimum count)
#   least_rated: rating_count asc,  title asc            (rating_count > min)
#   best       : avg_rating desc, rating_count desc, title asc  (> min)
#   worst      : avg_rating asc,  rating_count desc, title asc  (> min)
# item_id asc is appended to every ordering so equal titles rank stably.
ORDERINGS: dict[str, tuple[tuple[tuple[str, str], ...], bool]] = {
    "most_rated": ((("rating_count", "desc"), ("title", "asc")), False),
    "least_rated": ((("rating_count", "asc"), ("title", "asc")), True),
    "best": ((("avg_rating", "desc"), ("rating_count", "desc"), ("title", "asc")), True),
    "worst": ((("avg_rating", "asc"), ("rating_count", "desc"), ("title", "asc")), True),
}


def _sort_keys(by: str) -> list[Column]:
    keys = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in ORDERINGS[by][0]]
    return keys + [F.col("item_id").asc()]


LISTS = ("most_rated", "least_rated", "best", "worst")
DEFAULT_N = 10
DEFAULT_MIN_COUNT = 10


def top_n(
    stats: DataFrame,
    by: str,
    n: int = DEFAULT_N,
    min_count: int = DEFAULT_MIN_COUNT,
    decimals: int = 3,
) -> DataFrame:
    """At most ``n`` rows per value, ranked 1..n by the named ordering.

    Ranking uses the unrounded average; rounding to ``decimals`` happens after
    the rank filter. Lists other than ``most_rated`` keep only items with
    ``rating_count > min_count`` (strict).

    ``row_number() <= n`` is planned as a partial WindowGroupLimit before the
    shuffle on ``value`` and a final one after it, so a value holding a third
    of all items ships at most n rows per map task.
    """
    if by not in ORDERINGS:
        raise ValueError(f"unknown ordering {by!r}; one of {sorted(ORDERINGS)}")
    df = stats
    if ORDERINGS[by][1] and min_count is not None:
        df = df.filter(F.col("rating_count") > F.lit(min_count))
    w = Window.partitionBy("value").orderBy(*_sort_keys(by))
    ranked = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(n))
    return ranked.select(
        "value",
        F.col("rank").cast("bigint").alias("rank"),
        "item_id",
        "title",
        "rating_count",
        F.round("avg_rating", decimals).alias("avg_rating"),
    )


def top_lists(
    stats: DataFrame,
    n: int = DEFAULT_N,
    min_count: int = DEFAULT_MIN_COUNT,
    lists: Sequence[str] = LISTS,
    decimals: int = 3,
) -> DataFrame:
    """All lists in one DataFrame with a ``list_name`` column.

    One window instead of one per list: every stats row is repeated once per
    list (``explode`` of a literal array), the per-list orderings are mapped
    onto shared sort keys, and a single ``row_number`` over
    (value, list_name) ranks them. One shuffle and one sort serve all lists,
    still with the partial WindowGroupLimit before the shuffle. Rows equal
    :func:`top_n` for each list.
    """
    for name in lists:
        if name not in ORDERINGS:
            raise ValueError(f"unknown ordering {name!r}")
    cnt, avg = F.col("rating_count"), F.col("avg_rating")
    lst = F.col("list_name")
    needs_min = [name for name in lists if ORDERINGS[name][1]]
    rows = stats.select("*", F.explode(F.array(*[F.lit(x) for x in lists])).alias("list_name"))
    if min_count is not None and needs_min:
        rows = rows.filter(~lst.isin(needs_min) | (cnt > F.lit(min_count)))
    # Sort keys, ascending: k1 = primary, k2 = secondary, then title, item_id.
    # most_rated: -count | least_rated: count | best: -avg, -count | worst: avg, -count
    # The averages' NULL placement follows the per-list direction: NULLS LAST
    # for a descending average, NULLS FIRST for an ascending one.
    k1 = (
        F.when(lst == "most_rated", -cnt.cast("double"))
        .when(lst == "least_rated", cnt.cast("double"))
        .when(lst == "best", -avg)
        .otherwise(avg)
    )
    k1_null_rank = F.when((lst == "best") & avg.isNull(), F.lit(1)).otherwise(F.lit(0))
    k2 = F.when(lst.isin("best", "worst"), -cnt).otherwise(F.lit(0))
    w = Window.partitionBy("value", "list_name").orderBy(
        k1_null_rank.asc(), k1.asc_nulls_first(), k2.asc(), F.col("title").asc(), F.col("item_id").asc()
    )
    ranked = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(n))
    return ranked.select(
        "list_name",
        "value",
        F.col("rank").cast("bigint").alias("rank"),
        "item_id",
        "title",
        "rating_count",
        F.round("avg_rating", decimals).alias("avg_rating"),
    )
