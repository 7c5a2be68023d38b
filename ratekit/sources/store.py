"""Ratings stored by user.

The self-join, the centring and the candidate join all meet ratings by user. Written once as a
table that is bucketed by user, they lie where these joins need them, and none of them
shuffles the ratings again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ratekit.operators.joins import partitions_for, shuffle_partitions
from ratekit.session import keep_table, scratch_path


def user_buckets(ratings: DataFrame, rows: int) -> int:
    """Buckets for ``rows`` ratings: the session's shuffle partitions, and more where a bucket would exceed a task's rows."""
    return max(shuffle_partitions(ratings), partitions_for(ratings, rows))


def store_by_user(ratings: DataFrame, key: str = "user_id", n_buckets: int | None = None) -> DataFrame:
    """``ratings`` as a table of ``n_buckets`` buckets by ``key`` (default: the shuffle partitions), sorted in each.

    One shuffle deals the rows, one task writes each bucket. The files lie in the session's shared
    scratch folder, so a lost executor loses nothing. The table goes with the result
    that uses it (``CFResult.release``) or with the session.
    """
    spark, n = ratings.sparkSession, n_buckets or shuffle_partitions(ratings)
    name = f"ratekit_{uuid.uuid4().hex}"
    (
        ratings.repartition(n, key)
        .write.bucketBy(n, key)
        .sortBy(key)
        .option("path", scratch_path(spark, "by-user"))
        .saveAsTable(name, format="parquet")
    )
    keep_table(spark, name)
    return spark.table(name)
