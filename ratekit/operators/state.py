"""Rating statistics that take new batches without reading the old ratings again.

The state of a batch is one row a key with the number of ratings and their sum. States add up, so
a folder that holds one state a batch gives the statistics of all batches, and a
batch that is written again replaces its earlier state instead of counting twice (a retried job is safe).
:func:`compact` folds many batches into one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratekit.functions.columns import safe_ratio


def batch_state(ratings: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, rating_rows, rating_count, rating_sum): rows, non-null ratings and their sum; partially aggregated."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("rating_rows"),
        F.count("rating").alias("rating_count"),
        F.sum("rating").alias("rating_sum"),
    )


def merge_states(state: DataFrame, key: str = "item_id") -> DataFrame:
    """One row a key from the rows of any number of states."""
    return state.groupBy(key).agg(
        F.sum("rating_rows").alias("rating_rows"),
        F.sum("rating_count").alias("rating_count"),
        F.sum("rating_sum").alias("rating_sum"),
    )


def put_batch(ratings: DataFrame, path: str, batch: str | int, key: str = "item_id") -> None:
    """Writes the state of one batch below ``path``; only the batch is read."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", str(batch)):
        raise ValueError(f"batch {batch!r}: letters, digits, _ and - only")
    batch_state(ratings, key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_state(spark: SparkSession, path: str, key: str = "item_id") -> DataFrame:
    """The merged state of every batch below ``path``; its size is that of the states, not of the ratings."""
    return merge_states(spark.read.parquet(path), key)


def compact(spark: SparkSession, path: str, to: str, key: str = "item_id", batch: str | int = "compacted") -> None:
    """Writes the merged state of ``path`` as one batch below another folder."""
    read_state(spark, path, key).write.mode("overwrite").parquet(f"{to.rstrip('/')}/batch={batch}")


def mean_rating() -> Column:
    """Mean of the non-null ratings of a state row; null without one."""
    return safe_ratio("rating_sum", "rating_count")


def user_stats_of(state: DataFrame) -> DataFrame:
    """(user_id, train_rating_count, user_mean) from a state by user."""
    return state.select("user_id", F.col("rating_rows").alias("train_rating_count"), mean_rating().alias("user_mean"))
