"""Top-n lists against a plain brute force of the same rules (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratekit.operators import explode_values, rating_stats, top_lists, top_n

VALUES = ["a", "b", "c"]

items_st = st.lists(
    st.tuples(
        st.sampled_from(["t1", "t2", "t3", "t4"]),  # titles collide on purpose
        st.lists(st.sampled_from(VALUES + ["z"]), min_size=1, max_size=3, unique=True),
    ),
    min_size=1,
    max_size=12,
)
ratings_st = st.lists(
    st.tuples(st.integers(0, 11), st.sampled_from([x / 2 for x in range(1, 11)])),
    max_size=60,
)


def brute(items, ratings, by, n, min_count):
    """Lists from plain dictionaries: gather each item's ratings, then sort by the rule's key."""
    got: dict[int, list[float]] = {}
    for item, rating in ratings:
        got.setdefault(item, []).append(rating)
    out = []
    for value in VALUES:
        rows = []
        for i, (title, tags) in enumerate(items):
            r = got.get(i, [])
            if value in tags and r and (by == "most_rated" or len(r) > min_count):
                mean = sum(r) / len(r)
                first = {"most_rated": (-len(r),), "least_rated": (len(r),), "best": (-mean, -len(r)), "worst": (mean, -len(r))}[by]
                rows.append((*first, title, i))
        out += [(value, k + 1, row[-1]) for k, row in enumerate(sorted(rows)[:n])]
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=items_st, ratings=ratings_st, n=st.integers(1, 4), min_count=st.integers(0, 3))
def test_top_n_matches_brute_force(spark, items, ratings, n, min_count):
    idf = spark.createDataFrame(
        [(i, t, "|".join(vs)) for i, (t, vs) in enumerate(items)], "item_id long, title string, tags string"
    )
    rdf = spark.createDataFrame(ratings, "item_id long, rating double") if ratings else spark.createDataFrame(
        [], "item_id long, rating double"
    )
    stats = rating_stats(explode_values(idf), rdf, VALUES)
    lists = top_lists(stats, n=n, min_count=min_count).collect()
    for by in ("most_rated", "least_rated", "best", "worst"):
        want = brute(items, ratings, by, n, min_count)
        got = sorted((r.value, r.rank, r.item_id) for r in top_n(stats, by, n=n, min_count=min_count).collect())
        assert got == want, by
        got_all = sorted((r.value, r.rank, r.item_id) for r in lists if r.list_name == by)
        assert got_all == want, by
