"""Value analytics on the hand-made ranking fixture (FIXTURES section 4)."""

import pytest
from pyspark.sql import functions as F

from ratekit.operators import explode_values, rating_stats, top_lists, top_n, value_counts

ITEMS = [
    (1, "Alpha", "Animation|Romance"),
    (2, "Beta", "Animation"),
    (3, "Gamma", "Documentary|Animation"),
    (4, "Delta", "(no genres listed)"),
    (5, "Beta", "Romance"),
]
RATINGS = [(1, 5.0), (1, 4.0), (1, 3.0), (2, 4.0), (2, 4.0), (3, 2.0), (3, 2.0), (4, 5.0)]
VALUES = ["Animation", "Romance", "Documentary"]


@pytest.fixture(scope="module")
def frames(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, title string, tags string")
    ratings = spark.createDataFrame(RATINGS, "item_id long, rating double")
    iv = explode_values(items)
    return items, ratings, iv, rating_stats(iv, ratings, VALUES)


def _list(df, value):
    rows = df.filter(F.col("value") == value).orderBy("rank").collect()
    return [(r.title, r.rating_count, r.avg_rating) for r in rows]


def test_explode_is_literal_pipe(frames):
    _, _, iv, _ = frames
    vals = sorted({r.value for r in iv.collect()})
    assert vals == ["(no genres listed)", "Animation", "Documentary", "Romance"]
    assert iv.count() == 7


def test_value_counts_order(frames):
    _, _, iv, _ = frames
    got = [(r.value, r.item_count) for r in value_counts(iv).collect()]
    assert got == [("Animation", 3), ("Romance", 2), ("(no genres listed)", 1), ("Documentary", 1)]


def test_most_rated(frames):
    stats = frames[3]
    got = _list(top_n(stats, "most_rated", n=10, min_count=1), "Animation")
    assert got == [("Alpha", 3, 4.0), ("Beta", 2, 4.0), ("Gamma", 2, 2.0)]


def test_least_rated(frames):
    got = _list(top_n(frames[3], "least_rated", n=10, min_count=1), "Animation")
    assert got == [("Beta", 2, 4.0), ("Gamma", 2, 2.0), ("Alpha", 3, 4.0)]


def test_best(frames):
    got = _list(top_n(frames[3], "best", n=10, min_count=1), "Animation")
    assert got == [("Alpha", 3, 4.0), ("Beta", 2, 4.0), ("Gamma", 2, 2.0)]


def test_worst(frames):
    got = _list(top_n(frames[3], "worst", n=10, min_count=1), "Animation")
    assert got == [("Gamma", 2, 2.0), ("Alpha", 3, 4.0), ("Beta", 2, 4.0)]


def test_inner_join_drops_unrated_and_single_value(frames):
    stats = frames[3]
    for by in ("most_rated", "least_rated", "best", "worst"):
        t = top_n(stats, by, n=10, min_count=1)
        assert [r[0] for r in _list(t, "Romance")] == ["Alpha"]
        assert [r[0] for r in _list(t, "Documentary")] == ["Gamma"]


def test_strict_min_count(frames):
    # count > 2 keeps only Alpha (3 ratings); most_rated has no minimum.
    stats = frames[3]
    assert [r[0] for r in _list(top_n(stats, "best", min_count=2), "Animation")] == ["Alpha"]
    assert len(_list(top_n(stats, "most_rated", min_count=2), "Animation")) == 3


def test_top_n_limit_and_ranks(frames):
    t = top_n(frames[3], "most_rated", n=2, min_count=1)
    ranks = [r.rank for r in t.filter(F.col("value") == "Animation").orderBy("rank").collect()]
    assert ranks == [1, 2]


def test_top_lists_equals_top_n(frames):
    stats = frames[3]
    all_lists = top_lists(stats, n=2, min_count=1)
    for by in ("most_rated", "least_rated", "best", "worst"):
        one = sorted(tuple(r) for r in top_n(stats, by, n=2, min_count=1).collect())
        got = sorted(
            tuple(r)
            for r in all_lists.filter(F.col("list_name") == by).drop("list_name").collect()
        )
        assert got == one, by


def test_plans_agree_even_with_duplicate_tags(spark):
    items = spark.createDataFrame(
        ITEMS + [(6, "Eps", "Romance|Romance")], "item_id long, title string, tags string"
    )
    ratings = spark.createDataFrame(
        RATINGS + [(6, 1.0), (6, 2.0)], "item_id long, rating double"
    )
    iv = explode_values(items)
    a = sorted(tuple(r) for r in rating_stats(iv, ratings, VALUES, plan="join_first").collect())
    b = sorted(tuple(r) for r in rating_stats(iv, ratings, VALUES, plan="aggregate_first").collect())
    assert a == b
    eps = [r for r in a if r[2] == "Eps"]
    assert eps[0][3] == 4  # duplicated tag doubles the ratings, as a join does


def test_avg_rounded_after_ranking(spark):
    # Unrounded averages 2.0625 vs 2.0626 rank differently although both
    # display as 2.063 after rounding.
    items = spark.createDataFrame([(1, "A", "x"), (2, "B", "x")], "item_id long, title string, tags string")
    r1 = [(1, v) for v in [2.0, 2.0, 2.0, 2.25]]  # 2.0625
    r2 = [(2, v) for v in [2.0] * 4999 + [315.0]]  # 10313 / 5000 = 2.0626
    ratings = spark.createDataFrame(r1 + r2, "item_id long, rating double")
    stats = rating_stats(explode_values(items), ratings, ["x"])
    worst = top_n(stats, "worst", min_count=0).orderBy("rank").collect()
    assert [r.title for r in worst] == ["A", "B"]
    assert worst[0].avg_rating == 2.063
