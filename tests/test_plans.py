"""Physical-plan properties the design relies on (executed AQE plans)."""

import os
import sys

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as se
from conftest import SF0001
from ratekit.operators import (
    centered_ratings,
    co_rating_pairs,
    cosine_similarity,
    holdout,
    knn_candidates,
    mirror,
    pair_sums,
    top_neighbours,
    user_stats,
)
from ratekit.operators.joins import blocked_join
from ratekit.operators.predict import listed_candidates, related_pairs
from ratekit.operators.similarity import _block_pairs, packed_ratings
from ratekit.plans import centered_knn, cf_report_lines, cosine_knn
from ratekit.session import keeping, persist_tracked, release_cached
from ratekit.sources import cf_ratings, store_by_user

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from explain_plans import summarise  # noqa: E402


def _plan(spark, name):
    df = se.queries()[name](spark, SF0001)
    df.collect()
    lines = summarise(df._jdf.queryExecution().executedPlan())
    spark.catalog.clearCache()
    return lines


@pytest.mark.parametrize("name", sorted(se._own_queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    text = "\n".join(_plan(spark, name))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def test_top_n_limits_before_shuffle(spark):
    lines = [ln.strip() for ln in _plan(spark, "top_lists")]
    partial = [i for i, ln in enumerate(lines) if ln.startswith("WindowGroupLimit") and ln.endswith("Partial")]
    final = [i for i, ln in enumerate(lines) if ln.startswith("WindowGroupLimit") and ln.endswith("Final")]
    assert partial and final and final[0] < partial[0]  # output-first order: final above partial


def test_scans_are_pruned(spark):
    for name in ("rating_stats", "evaluate_knn"):
        for ln in _plan(spark, name):
            if "FileScan" in ln:
                schema = ln.split("ReadSchema=")[1]
                assert schema.count(":") <= 4, ln  # only the needed columns of wide tables


def test_aggregates_are_partial(spark):
    text = "\n".join(_plan(spark, "cosine_similarity"))
    assert "partial_count(1), partial_sum" in text


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark):
    """12,000 ratings, a third of them by one user."""
    hot = spark.range(4000).select(F.lit(0).alias("user_id"), F.col("id").alias("item_id"), F.lit(3.0).alias("rating"))
    rest = spark.range(8000).select((F.col("id") % 800 + 1).alias("user_id"), (F.col("id") * 7 % 4000).alias("item_id"), F.lit(4.0).alias("rating"))
    return hot.unionByName(rest)


def test_self_join_keeps_the_configured_partitions(spark, no_broadcast):
    for block in (100_000, 200):
        pairs = co_rating_pairs(_hot(spark), block_size=block)
        # a plain join of 13 partitions, or light and blocked joins of 13 each
        assert pairs.rdd.getNumPartitions() == (13 if block > 4000 else 26)
        release_cached(spark)


def test_hot_user_spreads_over_tasks(spark, no_broadcast):
    n = co_rating_pairs(_hot(spark), block_size=200).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in n)
    # each light user has five items twice
    assert sum(sizes) == 4000 * 3999 // 2 + 800 * 40
    assert len(sizes) >= 13 and sizes[-1] < 3 * sizes[len(sizes) - 10]
    release_cached(spark)


def test_support_pruning_is_exact(spark):
    ratings = cf_ratings(spark, SF0001)
    pruned = co_rating_pairs(ratings, min_common=5)
    whole = co_rating_pairs(ratings)
    count = lambda p: {(r.item_i, r.item_j): r.n for r in p.groupBy("item_i", "item_j").agg(F.count("*").alias("n")).filter("n >= 5").collect()}
    assert count(pruned) == count(whole)
    release_cached(spark)


def test_report_scores_once(spark):
    r = cosine_knn(cf_ratings(spark, SF0001))
    assert r.metrics.storageLevel.useMemory
    lines = cf_report_lines(r.metrics, "m", "d")
    lines.collect()
    plan = summarise(lines._jdf.queryExecution().executedPlan())
    assert sum("InMemoryTableScan" in ln for ln in plan) == 1
    assert not any("Window" in ln or "Join" in ln for ln in plan)
    r.release()
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_cache_inputs_false_keeps_no_ratings(spark):
    release_cached(spark)
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    r = centered_knn(cf_ratings(spark, SF0001), cache_inputs=False)
    r.metrics.collect()
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size() - before
    assert kept <= 4  # metrics, counts and the lists of heavy users
    r.release()


def _lines(df):
    df.collect()
    return [ln.strip() for ln in summarise(df._jdf.queryExecution().executedPlan())]


def test_stored_ratings_are_not_shuffled_again(spark, no_broadcast):
    train, test = (store_by_user(x) for x in holdout(cf_ratings(spark, SF0001)))
    stats = user_stats(train)
    centered = centered_ratings(train, stats)
    scored = test.join(stats, "user_id", "left")
    packed = _block_pairs(packed_ratings(train, "rating", 4, by_user=True))
    met = blocked_join(test.withColumnRenamed("item_id", "target_item"), train, "user_id", None, ["target_item"], ["item_id"], right_placed=True)
    for df in (stats, centered, scored, packed, met):
        assert not [ln for ln in _lines(df) if "Exchange" in ln]


def test_pair_sums_stay_in_the_task_that_forms_them(spark, no_broadcast):
    train, _ = holdout(cf_ratings(spark, SF0001))
    lines = _lines(pair_sums(train))
    sums = next(k for k, ln in enumerate(lines) if ln.startswith("HashAggregate") and "partial_sum" in ln)
    # output first: no exchange above the partial sums, and the ratings are read once
    assert not [ln for ln in lines[:sums] if "Exchange" in ln]
    exchanges = [ln for ln in lines[sums:] if "Exchange" in ln]
    assert any("bi" in ln for ln in exchanges)
    assert sum("ReusedExchange" in ln for ln in lines) == 1


def test_pair_sums_equal_the_self_join(spark):
    r = _hot(spark).filter("item_id < 400")
    want = co_rating_pairs(r).groupBy("item_i", "item_j").agg(
        F.count("*").alias("common_users"), F.sum(F.col("r_i") * F.col("r_j")).alias("dot"),
        F.sum(F.col("r_i") * F.col("r_i")).alias("sq_i"), F.sum(F.col("r_j") * F.col("r_j")).alias("sq_j"),
    )
    want = sorted(map(tuple, want.collect()))
    for kw in ({}, {"block_size": 50}, {"n_blocks": 1}, {"n_blocks": 17}, {"block_size": 7, "n_blocks": 3}):
        assert sorted(map(tuple, pair_sums(r, **kw).collect())) == want
    release_cached(spark)


def test_heavy_user_is_dealt_over_block_pairs(spark, no_broadcast):
    # as on a cluster with more tasks than this table has megabytes
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sums = pair_sums(_hot(spark), block_size=200)
        sizes = sorted(r["count"] for r in sums.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 13 and sizes[-1] < 3 * sizes[0]
    release_cached(spark)


def test_only_related_pairs_leave_the_join(spark):
    train, test = holdout(cf_ratings(spark, SF0001), persist=True)
    sim = mirror(cosine_similarity(train)).persist()
    table = sim.filter(F.pmod(F.xxhash64("item_i", "item_j"), F.lit(3)) == 0).select(F.col("item_i").alias("target_item"), F.col("item_j").alias("rated_item"), "similarity")
    t = test.select("user_id", F.col("item_id").alias("target_item")).distinct()
    r = train.select("user_id", F.col("item_id").alias("rated_item"), "rating")
    every = t.join(r, "user_id")
    want = every.join(table, ["target_item", "rated_item"], "left_semi").select("user_id", "target_item", "rated_item")
    met = related_pairs(t, r, table).select("user_id", "target_item", "rated_item")
    assert sorted(map(tuple, met.collect())) == sorted(map(tuple, want.collect()))
    assert 0 < met.count() < every.count()
    release_cached(spark)


def test_partners_far_apart_and_odd_ids(spark):
    """Item ids that are no small numbers, members beyond the first words, heavy users in blocks."""
    rated = [(u, f"i{k}", 1.0) for u in (1, 2) for k in range(300)] + [(3, "i299", 2.0), (3, None, 2.0), (None, "i1", 2.0)]
    table = [("t", f"i{k}", 0.5) for k in (0, 63, 64, 130, 299, 301)] + [("i5", "i299", 0.1)]
    test = [(1, "t"), (2, "i5"), (3, "t"), (3, "none"), (None, "t"), (4, "t")]
    t = spark.createDataFrame(test, "user_id long, target_item string")
    r = spark.createDataFrame(rated, "user_id long, rated_item string, r double")
    s = spark.createDataFrame(table, "target_item string, rated_item string, s double")
    want = sorted((u, a, i) for u, a in test for v, i, _ in rated for b, j, _ in table if u is not None and u == v and a == b and i == j)
    cols = ["user_id", "target_item", "rated_item"]
    from ratekit.operators.predict import neighbour_candidates

    for kw in ({}, {"max_broadcast_rows": 0}, {"max_broadcast_rows": 0, "block_size": 20}, {"block_size": 20}):
        assert sorted(map(tuple, neighbour_candidates(t, r, s, **kw).select(*cols).collect())) == want
    assert sorted(map(tuple, listed_candidates(t, r, s, max_broadcast_rows=0).select(*cols).collect())) == want
    release_cached(spark)


def test_lists_are_looked_up_entry_by_entry(spark):
    """No test row meets more rows than its target's list holds."""
    train, test = holdout(cf_ratings(spark, SF0001), persist=True)
    lists = top_neighbours(mirror(cosine_similarity(train)), k=5).select("target_item", F.col("neighbor_item").alias("rated_item"), "similarity")
    t = test.select("user_id", F.col("item_id").alias("target_item")).distinct()
    r = train.select("user_id", F.col("item_id").alias("rated_item"), "rating")
    joined = listed_candidates(t, r, lists, max_broadcast_rows=0)
    text = "\n".join(_lines(joined))
    assert "rated_item" in text and "Generate" in text
    want = t.join(lists, "target_item").join(r, ["user_id", "rated_item"])
    assert sorted(map(tuple, joined.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    release_cached(spark)


@pytest.mark.parametrize("name", ["report_lines", "value_table", "predict_knn_repeated"])
def test_no_window_over_a_single_partition(spark, name):
    text = "\n".join(_plan(spark, name))
    assert "SinglePartition" not in text or "Window" not in text


def test_release_drops_only_its_own(spark):
    release_cached(spark)
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    a = cosine_knn(cf_ratings(spark, SF0001))
    a.metrics.collect()
    mine = held()
    b = centered_knn(cf_ratings(spark, SF0001), stored=True)
    b.metrics.collect()
    tables = len(spark.catalog.listTables())
    assert held() > mine and tables >= 2
    b.release()
    assert held() == mine and len(spark.catalog.listTables()) == tables - 2
    a.release()
    assert not held()


def test_release_keeps_what_an_equal_plan_persisted(spark):
    """Equal plans share one cached copy, which the first release dropped for all."""
    release_cached(spark)
    held = lambda df: df.storageLevel.useMemory
    made = lambda: spark.range(100).withColumn("x", F.col("id") % 7)
    with keeping(spark) as first:
        a = persist_tracked(made())
    with keeping(spark) as second:
        b, c = persist_tracked(made()), persist_tracked(made().filter("x > 2"))
        persist_tracked(c)
    assert a.count() == 100 and c.count() and held(b)
    second.release()
    assert held(a) and not held(c)
    first.release()
    assert not held(a) and not held(b)
    with keeping(spark) as third:
        persist_tracked(a)
    with keeping(spark) as fourth:
        persist_tracked(a)
    fourth.release()
    assert held(a)
    third.release()
    assert not held(a)
