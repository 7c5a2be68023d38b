"""Evaluation of scored test rows in one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.functions.columns import safe_ratio
from ratekit.operators.split import train_summary


def evaluate(scored: DataFrame, train: DataFrame) -> DataFrame:
    """One row: train_rows, test_rows, train_mean, baseline_rmse, cf_rmse,
    fallback_count, coverage.

    Baseline and model errors, counts and coverage come out of a single pass
    over ``scored``; train size and mean are a scalar subquery.
    """
    s = train_summary(train)
    mean = s.getField("mean")
    e = F.col("true_rating") - F.col("prediction")
    b = F.col("true_rating") - mean
    agg = scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sqrt(F.avg(b * b)).alias("baseline_rmse"),
        F.sqrt(F.avg(e * e)).alias("cf_rmse"),
        F.count_if(F.col("is_fallback")).alias("fallback_count"),
    )
    return agg.select(
        s.getField("rows").alias("train_rows"),
        "test_rows",
        mean.alias("train_mean"),
        "baseline_rmse",
        "cf_rmse",
        "fallback_count",
        (F.lit(1.0) - safe_ratio(F.col("fallback_count"), F.col("test_rows"))).alias("coverage"),
    )
