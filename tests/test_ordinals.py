"""Numbers of rows, counter draws and mergeable states."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ratekit.operators import (
    batch_state,
    compact,
    numbered_copies,
    prediction_ids,
    put_batch,
    rating_stats,
    rating_stats_of,
    read_state,
    row_numbers,
    split_flag,
    user_stats,
    user_stats_of,
)
from ratekit.operators import explode_values
from ratekit.session import scratch_path
from ratekit.sources import cf_ratings, item_ratings, items, repeated_ratings


def test_copies_are_numbered_and_hot_rows_are_dealt_out(spark):
    rows = [(1, "a")] * 25 + [(2, None)] * 4 + [(None, None)] * 3 + [(3, "b")]
    df = spark.createDataFrame(rows, "id long, text string")
    for chunk in (1, 4, 1000):
        got = Counter(map(tuple, numbered_copies(df, "n", chunk=chunk).collect()))
        assert got == Counter((i, t, n + 1) for (i, t), c in Counter(rows).items() for n in range(c))
    hot = spark.range(4000).select(F.lit(1).alias("id"))
    sizes = numbered_copies(hot, "n", chunk=100).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2500  # 40 chunks over 4 partitions
    assert numbered_copies(df.limit(0)).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_row_numbers_follow_the_order(spark, parts):
    rows = [(int(x * 7919 % 1009), int(x % 5)) for x in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(parts)
    order = [F.desc("b"), F.asc("a")]
    got = row_numbers(numbered_copies(df, "copy"), [*order, "copy"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 3001))
    assert [(r["a"], r["b"]) for r in got] == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert row_numbers(df.limit(0), ["a", "b"]).collect() == []


def test_prediction_ids_are_the_same_under_any_partitioning(spark):
    test = repeated_ratings(spark, SF0001)
    one, two = (sorted(map(tuple, prediction_ids(t).collect())) for t in (test, test.repartition(9)))
    assert one == two and [r[0] for r in one] == list(range(1, len(one) + 1))
    assert [r[1:] for r in one] == sorted(r[1:] for r in one)


def test_draws_are_per_row_and_partition_free(spark):
    r = repeated_ratings(spark, SF0001)
    one, two = (Counter(map(tuple, split_flag(x, method="random", seed=3).collect())) for x in (r, r.repartition(11)))
    assert one == two
    for (u, i, x, flag), _ in list(one.items())[:200]:
        draws = [int(hashlib.md5(f"3|{u}|{i}|{x}|{n}".encode()).hexdigest()[:8], 16) < round(0.8 * 2**32) for n in (1, 2, 3)]
        assert flag in draws
    # equal rows are drawn one by one
    same = spark.range(2000).select(F.lit(1).alias("user_id"), F.lit(1).alias("item_id"), F.lit(2.0).alias("rating"))
    train = split_flag(same, method="random").filter("is_train").count()
    assert 1500 < train < 1700
    assert "Checkpoint" not in split_flag(r, method="random")._jdf.queryExecution().toString()


def test_states_of_batches_equal_one_pass(spark):
    r, iv = item_ratings(spark, SF0001), explode_values(items(spark, SF0001))
    path, whole = scratch_path(spark, "state"), scratch_path(spark, "state")
    for k in range(3):
        put_batch(r.filter(F.pmod(F.xxhash64("rating"), F.lit(3)) == k), path, k)
    put_batch(r.filter(F.pmod(F.xxhash64("rating"), F.lit(3)) == 1), path, 1)  # a retried batch counts once
    want = sorted(map(tuple, rating_stats(iv, r).collect()))
    assert sorted(map(tuple, rating_stats_of(iv, read_state(spark, path)).collect())) == want
    compact(spark, path, whole)
    put_batch(r, whole, "again")
    doubled = read_state(spark, whole)
    assert doubled.agg(F.sum("rating_rows")).first()[0] == 2 * r.count()
    with pytest.raises(ValueError):
        put_batch(r, path, "../x")


def test_user_stats_of_a_state(spark):
    r = cf_ratings(spark, SF0001)
    got = user_stats_of(batch_state(r, "user_id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, user_stats(r).collect()))
    nulls = spark.createDataFrame([(1, None), (1, 4.0), (2, None)], "user_id long, rating double")
    assert sorted(map(tuple, user_stats_of(batch_state(nulls, "user_id")).collect()), key=str) == [(1, 2, 4.0), (2, 1, None)]
