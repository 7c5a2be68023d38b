"""Properties of the CF pipelines on the generated tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ratekit.operators import co_rating_pairs, cosine_similarity, holdout, mirror
from ratekit.plans import centered_knn, cosine_knn
from ratekit.sources import cf_ratings


@pytest.fixture(scope="module")
def knn(spark):
    return cosine_knn(cf_ratings(spark, SF001))


@pytest.fixture(scope="module")
def centered(spark):
    return centered_knn(cf_ratings(spark, SF001), max_user_ratings=30)


def test_metrics_targets(knn, centered):
    a = knn.metrics.collect()[0]
    assert (a.train_rows, a.test_rows, a.fallback_count) == (38843, 9675, 0)
    assert a.train_mean == pytest.approx(2.922663, abs=1e-6)
    assert a.baseline_rmse == pytest.approx(1.443483, abs=1e-6)
    assert a.cf_rmse == pytest.approx(1.468903, abs=1e-6)
    b = centered.metrics.collect()[0]
    assert b.cf_rmse == pytest.approx(1.570565, abs=1e-6)
    assert b.fallback_count == 9
    assert b.coverage == pytest.approx(1 - 9 / 9675)


def test_similarity_bounds_and_symmetry(knn):
    s = knn.sim_all
    lo, hi = s.agg(F.min("similarity"), F.max("similarity")).collect()[0]
    assert 0.0 < lo and hi <= 1.0 + 1e-12
    assert s.count() == 2 * knn.similarity.count()
    rev = s.select(
        F.col("item_j").alias("item_i"), F.col("item_i").alias("item_j"), "similarity", "common_users"
    )
    assert s.drop("abs_similarity").exceptAll(rev).count() == 0


def test_each_test_row_scored_once(knn, centered):
    for r in (knn, centered):
        assert r.scored.count() == r.test.count()
        assert r.scored.select("user_id", "item_id").distinct().count() == r.test.count()


def test_centered_predictions_clipped(centered):
    lo, hi = centered.scored.agg(F.min("prediction"), F.max("prediction")).collect()[0]
    assert 0.5 <= lo and hi <= 5.0


def test_neighbour_list_bound(centered):
    per = centered.neighbours.groupBy("target_item").count()
    assert per.agg(F.max("count")).collect()[0][0] <= 30
    ranks = centered.neighbours.groupBy("target_item").agg(
        F.min("neighbor_rank").alias("lo"), F.max("neighbor_rank").alias("hi"), F.count("*").alias("n")
    )
    assert ranks.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n"))).count() == 0


def test_pairs_blocked_equal_plain(spark):
    train, _ = holdout(cf_ratings(spark, SF0001))
    a = co_rating_pairs(train).groupBy("user_id").count()
    b = co_rating_pairs(train, block_size=3).groupBy("user_id").count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_skewed_user_blocked(spark):
    # One user holds most rows: the blocked self-join must give the same
    # similarity table as the plain one.
    rows = [(1, i, float(1 + (i * 7) % 9) / 2) for i in range(60)]
    rows += [(u, i, float(1 + (u * i) % 9) / 2) for u in range(2, 12) for i in range(0, 60, 6)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    a = sorted(map(tuple, cosine_similarity(train, min_common=2).collect()))
    b = sorted(map(tuple, cosine_similarity(train, min_common=2, block_size=7).collect()))
    close = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert close(a) == close(b) and len(a) > 0


def test_partition_count_independent(spark):
    r = cf_ratings(spark, SF0001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = cosine_knn(r).scored.collect()
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = cosine_knn(r.repartition(5)).scored.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    norm = lambda rows: sorted((x.user_id, x.item_id, round(x.prediction, 9)) for x in rows)
    assert norm(a) == norm(b)


def test_mirror_single_pass(spark):
    sim = spark.createDataFrame([(1, 2, 0.5, 5), (1, 3, -0.25, 6)], "item_i long, item_j long, similarity double, common_users long")
    got = sorted(tuple(r) for r in mirror(sim).collect())
    assert got == [(1, 2, 0.5, 5, 0.5), (1, 3, -0.25, 6, 0.25), (2, 1, 0.5, 5, 0.5), (3, 1, -0.25, 6, 0.25)]


def test_knn_blocked_equals_plain(spark):
    from ratekit.operators import knn_neighbours

    train, test = holdout(cf_ratings(spark, SF0001))
    sim_all = mirror(cosine_similarity(train, min_common=5))
    a = sorted(map(tuple, knn_neighbours(test, train, sim_all).collect()))
    b = sorted(map(tuple, knn_neighbours(test, train, sim_all, block_size=2).collect()))
    close = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert close(a) == close(b) and len(a) > 0


def test_release_cached(spark):
    from ratekit import release_cached

    holdout(cf_ratings(spark, SF0001), persist=True)
    assert release_cached(spark) >= 1
    assert release_cached(spark) == 0
