"""The adjusted model at the published size: about 33.8 million ratings.

Usage: python tools/bench_scale.py [sf_dir] [copies]

No table of that size is at hand, so the ratings of customers x parts are repeated ``copies`` times by
Spark, each time for other users and with the items permuted (multiplied by a number
prime to their count). In one copy of five each customer is three users, so that, as in the published
run, a part of the users has at most 30 training ratings and teaches. Prints one JSON line with the
seconds of writing the ratings and of the whole model (split, similarity, neighbours, prediction, metrics).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ratekit.plans import centered_knn  # noqa: E402
from ratekit.session import build_session, scratch_path  # noqa: E402
from ratekit.sources import load, tail_ratings  # noqa: E402


def repeated_users(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """(user_id, item_id, rating) of ``copies`` times the customers x parts ratings."""
    n_items = load(spark, sf_dir, "part").count()
    base = tail_ratings(spark, sf_dir)
    c = F.col("copy")
    third = F.when(c % 5 == 0, F.col("item_id") % 3).otherwise(F.lit(3))
    many = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    return many.select(
        ((F.col("user_id") * F.lit(copies) + c) * 4 + third).alias("user_id"),
        ((F.col("item_id") * (10 * c + 1)) % F.lit(n_items)).alias("item_id"),  # the parts number a power of ten times two
        "rating",
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 57
    spark = build_session("local[8]", shuffle_partitions=32, driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "14g"))
    t = time.time()
    path = scratch_path(spark, "ratings")
    repeated_users(spark, sf_dir, copies).write.parquet(path)
    wrote = time.time() - t
    ratings = spark.read.parquet(path)
    t = time.time()
    m = centered_knn(ratings, max_user_ratings=30).metrics.first()
    out = {"ratings": m["train_rows"] + m["test_rows"], "write_seconds": round(wrote, 1), "model_seconds": round(time.time() - t, 1)}
    out |= {k: round(m[k], 6) for k in ("baseline_rmse", "cf_rmse", "coverage")}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
