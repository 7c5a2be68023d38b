"""Hold-out split, train mean and mean baseline.

Three methods:

* ``hash`` (default): a row is train when a deterministic hash bucket of its
  (user, item) key is below ``frac * buckets`` (as many buckets as the fraction
  needs). No shuffle, identical under any partitioning, and a recomputed
  partition after a lost executor gives the same rows.
* ``exact``: exactly ``round(frac * n)`` train rows, chosen as the smallest
  rows in (hash, user, item) order, repeated rows included. Distributed: a
  histogram over 2^20 hash prefixes (bounded size) finds the boundary prefix;
  only the distinct keys of that one prefix (about n / 2^20) are ranked, and
  then the repeated rows of the one key at the border.
* ``random``: a Bernoulli draw for every row, repeated rows drawn one by one. The
  draw is a counter hash: of the seed, the row and its number among equal rows
  (:func:`ratekit.operators.ordinals.numbered_copies`), 32 bits wide. So it depends neither on
  partitioning nor on the run, and train and test stay complementary without a
  copy of the table. Columns must be groupable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratekit.functions.columns import hash_bucket, hash_key32, split_buckets
from ratekit.operators.ordinals import numbered_copies
from ratekit.session import persist_tracked

_PREFIX_SHIFT = 12  # 32-bit hash >> 12 = 2^20 histogram cells


def split_flag(
    ratings: DataFrame,
    frac: float = 0.8,
    method: str = "hash",
    seed: int | None = None,
    user_col: str = "user_id",
    item_col: str = "item_id",
) -> DataFrame:
    """``ratings`` plus a boolean ``is_train`` column.

    ``seed`` is mixed into the hashed key; each seed gives another split, and without one
    the plain key is hashed.
    """
    if not 0.0 <= frac <= 1.0:
        raise ValueError("frac must lie in [0, 1]")
    key = [user_col, item_col] if seed is None else [F.lit(seed), user_col, item_col]
    if method == "hash":
        buckets, cut = split_buckets(frac)
        return ratings.withColumn("is_train", hash_bucket(*key, buckets=buckets) < F.lit(cut))
    if method == "random":
        numbered = numbered_copies(ratings, "_copy")
        draw = hash_key32(*([] if seed is None else [F.lit(seed)]), *numbered.columns)
        return numbered.withColumn("is_train", draw < F.lit(round(frac * 2**32))).drop("_copy")
    if method == "exact":
        return _exact_flag(ratings, frac, key, user_col, item_col)
    raise ValueError(f"unknown split method {method!r}")


def _exact_flag(ratings: DataFrame, frac: float, key: list, user_col: str, item_col: str) -> DataFrame:
    # Read several times below: kept, so that the input is read once.
    keyed = persist_tracked(
        ratings.withColumn("_h", hash_key32(*key)).withColumn("_hb", F.shiftright(F.col("_h"), _PREFIX_SHIFT))
    )
    hist = keyed.groupBy("_hb").agg(F.count(F.lit(1)).alias("_n"))
    total = hist.agg(F.sum("_n")).scalar()
    k = F.round(total * F.lit(frac)).cast("bigint")

    def crossing(counts: DataFrame, order: list[str], need: Column) -> DataFrame:
        """The first row of ``counts`` whose running count reaches ``need``, with what is left for it."""
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ran = counts.withColumn("_cum", F.sum("_n").over(w)).filter(F.col("_cum") >= need)
        return ran.orderBy(*order).limit(1).withColumn("_left", need - (F.col("_cum") - F.col("_n")))

    # At most 2^20 histogram rows, then the distinct keys of one cell.
    cell = crossing(hist, ["_hb"], k).select(F.struct("_hb", "_left")).scalar()
    names = ["_h", user_col, item_col]
    keys = keyed.filter(F.col("_hb") == cell["_hb"]).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    cut = crossing(keys, names, cell["_left"]).select(F.struct(F.struct(*names).alias("key"), "_left")).scalar()
    here = F.struct(*names)
    tied = F.coalesce(here == cut["key"], F.lit(False))
    rest = keyed.filter(~tied).withColumn("is_train", F.coalesce(here < cut["key"], F.lit(False)))
    # Repeated rows of the border key: as many of them as are left, by their other columns.
    others = [c for c in ratings.columns if c not in names] or [user_col]
    among = Window.partitionBy(*names).orderBy(*others)
    last = keyed.filter(tied).withColumn("is_train", F.row_number().over(among) <= cut["_left"])
    return rest.unionByName(last).drop("_h", "_hb")


def holdout(
    ratings: DataFrame,
    frac: float = 0.8,
    method: str = "hash",
    seed: int | None = None,
    persist: bool = False,
    **kw,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as complementary filters of one flagged frame.

    ``persist=True`` keeps the flagged ratings in executor memory/disk for
    pipelines that read train and test many times (similarity, scalar
    subqueries, prediction). Cached blocks lost with an executor are
    recomputed from lineage; the hash split makes that recomputation give
    the same rows.
    """
    flagged = split_flag(ratings, frac=frac, method=method, seed=seed, **kw)
    if persist:
        flagged = persist_tracked(flagged)
    train = flagged.filter(F.col("is_train")).drop("is_train")
    test = flagged.filter(~F.col("is_train")).drop("is_train")
    return train, test


def train_summary(train: DataFrame) -> F.Column:
    """Scalar subquery ``struct(rows, mean)`` of the training ratings.

    Stays inside the plan (no driver round trip); Spark runs it once and
    inlines the value.
    """
    return train.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.avg("rating").alias("mean"),
        )
    ).scalar()


def baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: train_rows, test_rows, train_mean, baseline_rmse.

    The baseline predicts the train mean m for every test row. One aggregate
    over both sides: mean((r - m)^2) over test equals
    var_pop(test) + (mean(test) - m)^2, and Spark's ``var_pop`` merges
    partial moments stably, so no second pass with m is needed.
    """
    tr = F.col("_train")
    both = train.select("rating", F.lit(True).alias("_train")).unionByName(
        test.select("rating", F.lit(False).alias("_train"))
    )
    agg = both.agg(
        F.count_if(tr).alias("train_rows"),
        F.avg(F.when(tr, F.col("rating"))).alias("train_mean"),
        F.count_if(~tr).alias("test_rows"),
        F.avg(F.when(~tr, F.col("rating"))).alias("_test_mean"),
        F.var_pop(F.when(~tr, F.col("rating"))).alias("_test_var"),
    )
    gap = F.col("_test_mean") - F.col("train_mean")
    return agg.select(
        "train_rows",
        "test_rows",
        "train_mean",
        F.sqrt(F.col("_test_var") + gap * gap).alias("baseline_rmse"),
    )
