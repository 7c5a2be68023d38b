"""Value analytics: items per value and the four top-n lists per value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ratekit.operators.ranking import DEFAULT_MIN_COUNT, DEFAULT_N, rating_stats, top_lists
from ratekit.operators.values import explode_values, value_counts
from ratekit.session import Kept, keeping, persist_tracked


@dataclass
class ValueAnalysis:
    item_values: DataFrame
    counts: DataFrame
    stats: DataFrame
    lists: DataFrame
    values: tuple[str, ...]
    n: int
    min_count: int
    kept: Kept | None = field(default=None, repr=False)

    def release(self) -> None:
        """Drop what this analysis keeps."""
        if self.kept is not None:
            self.kept.release()


def value_analysis(
    items: DataFrame,
    ratings: DataFrame,
    values: Sequence[str],
    n: int = DEFAULT_N,
    min_count: int = DEFAULT_MIN_COUNT,
    sep: str = "|",
) -> ValueAnalysis:
    """Stats defined once and shared by all lists.

    Unlike one action per (list, value), the lists come out of one plan. The
    stats (one row per chosen value and rated item, bounded by the item
    table) are persisted, so showing the lists and writing the report do not
    aggregate all ratings again.
    """
    iv = explode_values(items, sep=sep)
    with keeping(items.sparkSession) as kept:
        stats = persist_tracked(rating_stats(iv, ratings, values))
    return ValueAnalysis(
        item_values=iv,
        counts=value_counts(iv),
        stats=stats,
        lists=top_lists(stats, n=n, min_count=min_count),
        values=tuple(values),
        n=n,
        min_count=min_count,
        kept=kept,
    )
