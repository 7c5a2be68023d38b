"""Mapping of the generated TPC-H-like tables onto the rating data model.

* items: ``part`` -> item_id = p_partkey, title = p_name,
  tags = p_name with spaces replaced by '|' (so the split is exercised);
* ratings for the value rankings: ``lineitem`` -> item_id = l_partkey,
  rating = ceil(l_quantity / 5) / 2 (half stars 0.5 .. 5.0);
* ratings for collaborative filtering: ``orders`` join ``lineitem`` ->
  user_id = o_custkey, item_id = l_suppkey, rating from the largest quantity
  the customer ordered from that supplier; unique per (user, item) by
  construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratekit.functions.columns import half_star_rating
from ratekit.operators.joins import partitions_for, spread


# Columns (and types) read from each generated table. A declared schema
# skips the footer-inference job and prunes the scan to these columns.
COLUMNS = {
    "part": "p_partkey BIGINT, p_name STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
}

def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table with its declared columns."""
    reader = spark.read
    if name in COLUMNS:
        reader = reader.schema(COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("tags"),
    )


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("item_id"),
        half_star_rating("l_quantity").alias("rating"),
    )


def _order_lines(spark: SparkSession, sf_dir: str, item: str) -> tuple[DataFrame, int]:
    """(user_id, item_id, l_quantity) of every order line, and how many partitions its rows take.

    The lines are counted (file footers only). Where they are too many for the session's
    partitions, join and grouping get more."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", item, "l_quantity")
    n = partitions_for(li, li.count())
    j = spread(li, n, "l_orderkey").join(spread(o, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return j.select(F.col("o_custkey").alias("user_id"), F.col(item).alias("item_id"), "l_quantity"), n


def repeated_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating) of every order line: a customer may rate a supplier often."""
    j, _ = _order_lines(spark, sf_dir, "l_suppkey")
    return j.select("user_id", "item_id", half_star_rating("l_quantity").alias("rating"))


def tail_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating), one row per key, of customers and parts: most parts have few ratings."""
    return _best_rating(*_order_lines(spark, sf_dir, "l_partkey"))


def _best_rating(j: DataFrame, n: int) -> DataFrame:
    grouped = spread(j, n, "user_id", "item_id").groupBy("user_id", "item_id")
    return grouped.agg(half_star_rating(F.max("l_quantity")).alias("rating"))


def cf_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating), one row per key.

    Aggregating quantity first and mapping afterwards equals mapping each line
    first (the mapping is monotone); the max is partially aggregated on the
    map side, so a hot customer or supplier is collapsed before the shuffle.
    """
    return _best_rating(*_order_lines(spark, sf_dir, "l_suppkey"))
