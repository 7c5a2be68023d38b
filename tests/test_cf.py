"""Item CF on the hand-made fixture (FIXTURES section 5), min_common=2."""

import math

import pytest

from ratekit.functions import clip
from ratekit.operators import (
    adjusted_cosine_similarity,
    centered_ratings,
    cosine_similarity,
    evaluate,
    mirror,
    predict_centered,
    predict_knn,
    top_neighbours,
    train_summary,
    user_stats,
)

TRAIN = [
    (1, 10, 5.0), (1, 20, 4.0), (1, 30, 1.0),
    (2, 10, 4.0), (2, 20, 5.0), (2, 30, 2.0),
    (3, 10, 1.0), (3, 20, 2.0), (3, 30, 5.0),
    (4, 10, 3.0), (4, 20, 4.0), (5, 40, 4.0),
]
TEST = [(4, 30, 2.0), (5, 10, 4.0), (6, 20, 3.0), (5, 50, 5.0)]
SCHEMA = "user_id long, item_id long, rating double"


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(TRAIN, SCHEMA), spark.createDataFrame(TEST, SCHEMA)


def _sims(df):
    return {(r.item_i, r.item_j): (r.similarity, r.common_users) for r in df.collect()}


def test_cosine_similarity(data):
    train, _ = data
    s = _sims(cosine_similarity(train, min_common=2))
    assert set(s) == {(10, 20), (10, 30), (20, 30)}
    assert s[(10, 20)][0] == pytest.approx(0.9681524621520468, abs=1e-9)
    assert s[(10, 20)][1] == 4
    assert s[(10, 30)][0] == pytest.approx(0.50709255283711, abs=1e-9)
    assert s[(20, 30)][0] == pytest.approx(0.6531972647421808, abs=1e-9)
    assert s[(10, 30)][1] == s[(20, 30)][1] == 3


def test_blocked_self_join_equals_plain(data):
    train, _ = data
    a = _sims(cosine_similarity(train, min_common=2))
    b = _sims(cosine_similarity(train, min_common=2, block_size=1))
    assert a == b


def test_adjusted_cosine(data):
    train, _ = data
    c = centered_ratings(train, user_stats(train))
    s = _sims(adjusted_cosine_similarity(c, min_common=2, max_user_ratings=30))
    assert s[(10, 20)][0] == pytest.approx(0.5817478693566535, abs=1e-9)
    assert s[(10, 30)][0] == pytest.approx(-0.9469425238482128, abs=1e-9)
    assert s[(20, 30)][0] == pytest.approx(-0.8834522085987724, abs=1e-9)
    assert s[(10, 20)][1] == 4


def test_user_cap_selects_teachers(data):
    train, _ = data
    c = centered_ratings(train, user_stats(train))
    # With a cap of 2 only user 4 (two ratings) teaches: one common user.
    s = _sims(adjusted_cosine_similarity(c, min_common=1, max_user_ratings=2))
    assert set(s) == {(10, 20)} and s[(10, 20)][1] == 1


def test_cosine_knn_predictions(data):
    train, test = data
    sim_all = mirror(cosine_similarity(train, min_common=2))
    mean = train_summary(train).getField("mean")
    scored = predict_knn(test, train, sim_all, mean, k=30)
    p = {(r.user_id, r.item_id): r for r in scored.collect()}
    assert p[(4, 30)].prediction == pytest.approx(3.562960438716031, abs=1e-9)
    assert p[(4, 30)].neighbor_count == 2
    for key in [(5, 10), (5, 50), (6, 20)]:
        assert p[key].prediction == pytest.approx(10 / 3, abs=1e-9)
        assert p[key].is_fallback
    m = evaluate(scored, train).collect()[0]
    assert m.train_rows == 12 and m.test_rows == 4
    assert m.train_mean == pytest.approx(3.333333, abs=1e-6)
    assert m.baseline_rmse == pytest.approx(1.130388, abs=1e-6)
    assert m.cf_rmse == pytest.approx(1.201684, abs=1e-6)
    assert m.fallback_count == 3
    assert m.coverage == pytest.approx(0.25)


def test_centered_knn_predictions(data):
    train, test = data
    stats = user_stats(train)
    c = centered_ratings(train, stats)
    nb = top_neighbours(mirror(adjusted_cosine_similarity(c, 2, 30)), k=30)
    mean = train_summary(train).getField("mean")
    scored = predict_centered(test, c, nb, stats, mean)
    p = {(r.user_id, r.item_id): r for r in scored.collect()}
    assert p[(4, 30)].prediction == pytest.approx(3.51734333969716, abs=1e-9)
    assert p[(4, 30)].neighbor_count == 2
    assert p[(5, 10)].prediction == pytest.approx(4.0)
    assert p[(5, 50)].prediction == pytest.approx(4.0)
    assert p[(6, 20)].prediction == pytest.approx(10 / 3, abs=1e-9)
    m = evaluate(scored, train).collect()[0]
    assert m.cf_rmse == pytest.approx(0.923775, abs=1e-6)
    assert m.fallback_count == 3


def test_top_k_truncates_neighbours(data):
    train, test = data
    stats = user_stats(train)
    c = centered_ratings(train, stats)
    nb = top_neighbours(mirror(adjusted_cosine_similarity(c, 2, 30)), k=1)
    got = {(r.target_item, r.neighbor_item) for r in nb.collect()}
    # |sim| order: (10,30) 0.947 > (20,30) 0.883 > (10,20) 0.582
    assert got == {(10, 30), (30, 10), (20, 30)}


def test_clip(spark):
    df = spark.createDataFrame([(5.3,), (0.2,), (3.0,), (None,)], "x double")
    got = [r[0] for r in df.select(clip("x", 0.5, 5.0)).collect()]
    assert got == [5.0, 0.5, 3.0, None]


def test_zero_norm_user_gives_no_pair_and_no_error(spark):
    # User 8 rates 60 and 70 alike: centred ratings are 0, the norm is 0.
    rows = TRAIN + [(8, 60, 3.0), (8, 70, 3.0)]
    train = spark.createDataFrame(rows, SCHEMA)
    c = centered_ratings(train, user_stats(train))
    s = _sims(adjusted_cosine_similarity(c, min_common=1, max_user_ratings=30))
    assert (60, 70) not in s
    for v, _ in s.values():
        assert -1.0 - 1e-12 <= v <= 1.0 + 1e-12 and not math.isnan(v)


def test_neighbour_summary(data):
    from ratekit.operators import neighbour_summary

    train, _ = data
    c = centered_ratings(train, user_stats(train))
    nb = top_neighbours(mirror(adjusted_cosine_similarity(c, 2, 30)), k=30)
    row = neighbour_summary(nb).collect()[0]
    assert (row.neighbour_rows, row.learned_items) == (6, 3)
