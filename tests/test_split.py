"""Hold-out split properties on the generated CF ratings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ratekit.functions import split_buckets
from ratekit.operators import holdout, split_flag
from ratekit.sources import cf_ratings


def _bucket(u, i):
    return int(hashlib.md5(f"{u}|{i}".encode()).hexdigest()[:8], 16) % 100


def test_hash_bucket_matches_python_md5(spark):
    df = spark.createDataFrame([(1, 2), (5, 7), (123456, 99)], "user_id long, item_id long")
    from ratekit.functions import hash_bucket

    got = [r[0] for r in df.select(hash_bucket("user_id", "item_id")).collect()]
    assert got == [_bucket(1, 2), _bucket(5, 7), _bucket(123456, 99)] == [73, 62, 90]


def test_hash_split_disjoint_complete_stable(spark):
    r = cf_ratings(spark, SF0001)
    train, test = holdout(r)
    n, a, b = r.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    # Independent of partitioning.
    train2, _ = holdout(r.repartition(7))
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, train2.collect()))


def test_exact_split_count_and_definition(spark):
    r = cf_ratings(spark, SF0001)
    flagged = split_flag(r, frac=0.8, method="exact").collect()
    n = len(flagged)
    assert sum(1 for x in flagged if x.is_train) == int(0.8 * n + 0.5)
    # Brute force: smallest round(0.8 n) keys in (hash32, user, item) order.
    def h(u, i):
        return int(hashlib.md5(f"{u}|{i}".encode()).hexdigest()[:8], 16)

    keys = sorted((h(x.user_id, x.item_id), x.user_id, x.item_id) for x in flagged)
    want = {(u, i) for _, u, i in keys[: int(0.8 * n + 0.5)]}
    assert {(x.user_id, x.item_id) for x in flagged if x.is_train} == want


@pytest.mark.parametrize("frac", [0.0, 1.0, 0.33])
def test_exact_split_edges(spark, frac):
    r = cf_ratings(spark, SF0001)
    n = r.count()
    got = split_flag(r, frac=frac, method="exact").filter(F.col("is_train")).count()
    assert got == int(frac * n + 0.5)


def test_random_split_complementary(spark):
    r = cf_ratings(spark, SF0001)
    train, test = holdout(r, method="random", seed=42)
    assert train.count() + test.count() == r.count()
    assert train.join(test, ["user_id", "item_id"]).count() == 0


def test_hash_split_counts_sf001(spark):
    train, test = holdout(cf_ratings(spark, SF001))
    assert (train.count(), test.count()) == (38843, 9675)


@pytest.mark.parametrize("frac,want", [(0.8, (100, 80)), (0.804, (1000, 804)), (0.996, (1000, 996)), (0.004, (1000, 4)), (0.0, (100, 0)), (1.0, (100, 100)), (1 / 3, (10**9, 333333333))])
def test_buckets_hold_the_fraction(frac, want):
    assert split_buckets(frac) == want


@pytest.mark.parametrize("method", ["hash", "exact"])
def test_seeds_give_other_splits(spark, method):
    r = cf_ratings(spark, SF0001)
    sides = [{tuple(x) for x in holdout(r, method=method, seed=s)[0].collect()} for s in (None, 1, 2, 1)]
    assert sides[1] == sides[3] and len({frozenset(s) for s in sides}) == 3


@pytest.mark.parametrize("frac", [0.996, 0.004])
def test_small_fractions_leave_no_side_empty(spark, frac):
    r = cf_ratings(spark, SF001)
    train, test = holdout(r, frac=frac)
    n, a = r.count(), train.count()
    assert a and test.count() == n - a and abs(a / n - frac) < 0.002


def test_exact_split_of_equal_rows(spark):
    df = spark.createDataFrame([(1, 1, 3.0)] * 10 + [(2, 2, 4.0)] * 7, "user_id long, item_id long, rating double")
    for frac in (0.0, 0.3, 0.5, 1.0):
        got = split_flag(df, frac=frac, method="exact")
        assert got.filter("is_train").count() == int(frac * 17 + 0.5) and got.count() == 17
    assert split_flag(df.limit(0), method="exact").count() == 0
