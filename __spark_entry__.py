"""

``entry(spark)`` runs the flagship query (the four top-n lists per value) on
sf0.001. ``queries()`` maps every implemented operator to a callable
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the equivalent DuckDB
SQL over the same parquet tables. Every query reads whole tables; floating
columns are rounded (see ``_round``) on both sides so the value hash does not
depend on summation order.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package lives next to this file; make it importable however the file
# is loaded (by path, from another working directory).
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ratekit.operators import (
    adjusted_cosine_similarity,
    baseline,
    centered_ratings,
    co_rating_pairs,
    compact,
    cosine_similarity,
    explode_values,
    holdout,
    knn_neighbours,
    mirror,
    neighbour_summary,
    predict_centered,
    predict_knn,
    prediction_ids,
    put_batch,
    rating_stats,
    rating_stats_of,
    read_state,
    split_flag,
    top_lists,
    top_n,
    top_neighbours,
    train_summary,
    user_stats,
    user_stats_of,
    value_counts,
)
from ratekit.operators.joins import partitions_for
from ratekit.operators.overlap import formed_pairs
from ratekit.operators.predict import one_rating
from ratekit.plans import (
    centered_knn,
    cf_report_lines,
    cosine_knn,
    list_tables,
    model_notes,
    value_analysis,
    value_report_lines,
    value_table,
)
from ratekit.session import persist_tracked, scratch_path
from ratekit.sources import (
    cf_ratings,
    item_ratings,
    items,
    read_items_csv,
    read_ratings_csv,
    rejected_ratings_csv,
    repeated_ratings,
    tail_ratings,
    write_csv,
)

try:
    # The training-data operators are an optional part: without their folder and
    # the pipeline module the other queries stay as they are.
    import corpus_pipeline
    from ratekit.llm import queries as _llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "ratekit.llm"):
        raise
    corpus_pipeline = _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
# The three values that stand in for the chosen genres.
VALUES = ("red", "ring", "widget")
N, MIN_COUNT = 10, 10
MIN_COMMON, K, CAP = 5, 30, 30
# Output rounding for the oracle comparison: every double is rounded at 8 digits, far
# above summation-order noise. Operators compute with full values.
DIGITS = 8


def _round(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), DIGITS).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _iv(spark, d):
    return explode_values(items(spark, d))


def _stats(spark, d, plan="aggregate_first"):
    return rating_stats(_iv(spark, d), item_ratings(spark, d), VALUES, plan=plan)


def _split(spark, d, method="hash", persist=True):
    """``persist`` for the queries that read train and test more than once."""
    return holdout(cf_ratings(spark, d), method=method, persist=persist)


def _n(ratings):
    """Partitions by rows, of ratings that are kept."""
    return partitions_for(ratings, ratings.count())


def q_explode_values(spark, d):
    return _iv(spark, d)


def q_value_counts(spark, d):
    return value_counts(_iv(spark, d))


def q_rating_stats_join_first(spark, d):
    return _round(_stats(spark, d, "join_first"))


def q_rating_stats(spark, d):
    return _round(_stats(spark, d))


def _q_top(by):
    def q(spark, d):
        return _round(top_n(_stats(spark, d), by, n=N, min_count=MIN_COUNT))

    q.__name__ = f"q_top_{by}"
    return q


def q_top_lists(spark, d):
    return _round(top_lists(_stats(spark, d), n=N, min_count=MIN_COUNT))


def q_report_lines(spark, d):
    va = value_analysis(items(spark, d), item_ratings(spark, d), VALUES, n=N, min_count=MIN_COUNT)
    return value_report_lines(va)


def q_value_table(spark, d):
    """The printed table of values: its order is the column line."""
    return value_table(value_counts(_iv(spark, d)))


def q_value_table_limited(spark, d):
    """Its first 10 lines, as a limited display prints them."""
    return value_table(value_counts(_iv(spark, d)), limit=10)


def q_list_tables(spark, d):
    """The printed lists: their order is section, rank."""
    va = value_analysis(items(spark, d), item_ratings(spark, d), VALUES, n=N, min_count=MIN_COUNT)
    return _round(list_tables(va))


def _in_batches(spark, ratings, key, by, n=3):
    """State by ``key`` of the whole table, put batch by batch; the last batch is put twice."""
    path = scratch_path(spark, f"state-{key}")
    for batch in [*range(n), n - 1]:
        put_batch(ratings.filter(F.pmod(F.xxhash64(by), F.lit(n)) == batch), path, batch, key=key)
    whole = scratch_path(spark, f"state-{key}-compacted")
    compact(spark, path, whole, key=key)
    return read_state(spark, whole, key=key)


def q_rating_stats_merged(spark, d):
    """The statistics of all ratings from states of three batches."""
    state = _in_batches(spark, item_ratings(spark, d), "item_id", "rating")
    return _round(rating_stats_of(_iv(spark, d), state, VALUES))


def q_user_stats_merged(spark, d):
    train, _ = _split(spark, d)
    return _round(user_stats_of(_in_batches(spark, train, "user_id", "item_id")))


def _odd_items(spark, d):
    """Items with white space at the ends, line breaks, quotes, empty and null texts."""
    i, t, g = F.col("item_id"), F.col("title"), F.col("tags")
    title = (
        F.when(i % 7 == 1, F.concat(F.lit("  "), t, F.lit(" ")))
        .when(i % 7 == 2, F.concat(t, F.lit("\nline, two")))
        .when(i % 7 == 3, F.concat(F.lit('"'), t, F.lit('" \\')))
        .when(i % 7 == 4, F.lit(""))
        .when(i % 7 == 5, F.lit(None).cast("string"))
        .otherwise(t)
    )
    tags = F.when(i % 11 == 0, F.lit("")).when(i % 13 == 0, F.lit(None).cast("string")).otherwise(g)
    return items(spark, d).select("item_id", title.alias("title"), tags.alias("tags"))


def q_csv_round_trip(spark, d):
    path = scratch_path(spark, "items-csv")
    write_csv(_odd_items(spark, d), path)
    return read_items_csv(spark, path)


def q_csv_ratings_by_name(spark, d):
    """Ratings written in another column order, among other columns."""
    path = scratch_path(spark, "ratings-csv")
    r = cf_ratings(spark, d)
    write_csv(r.select("rating", F.lit("x").alias("note"), F.col("item_id").alias("movieId"), F.col("user_id").alias("userId")), path)
    return read_ratings_csv(spark, path)


def q_csv_ratings_rejected(spark, d):
    """Rows whose user or rating is no number come out as text."""
    path = scratch_path(spark, "ratings-csv")
    user = F.when(F.col("user_id") % 10 == 0, "?").otherwise(F.col("user_id").cast("string"))
    rating = F.when(F.col("item_id") % 10 == 0, None).otherwise(F.col("rating").cast("string"))
    write_csv(cf_ratings(spark, d).select(user.alias("userId"), F.col("item_id").alias("movieId"), rating.alias("rating")), path)
    return rejected_ratings_csv(spark, path)


def _q_holdout(method, **kw):
    def q(spark, d):
        return split_flag(cf_ratings(spark, d), method=method, **kw)

    q.__name__ = f"q_holdout_{method}"
    return q


def q_holdout_exact_repeated(spark, d):
    return split_flag(repeated_ratings(spark, d), method="exact")


def q_holdout_random_summary(spark, d):
    """Checkable facts of the random split: all rows, and a share within five deviations of 0.8."""
    flagged = split_flag(cf_ratings(spark, d), method="random", seed=42)
    n, t = F.count(F.lit(1)), F.count_if("is_train")
    share_ok = F.abs(t / n - 0.8) < 5 * F.sqrt(0.16 / n)
    return flagged.agg(n.alias("n_rows"), (F.count("is_train") == n).alias("complete"), share_ok.alias("share_ok"))


def q_holdout_random_repeated(spark, d):
    """Order lines as they are: equal rows are drawn one by one."""
    return split_flag(repeated_ratings(spark, d), method="random", seed=42)


def q_baseline(spark, d):
    train, test = _split(spark, d, persist=False)
    return _round(baseline(train, test))


def q_user_stats(spark, d):
    train, _ = _split(spark, d, persist=False)
    return _round(user_stats(train))


def q_centered_ratings(spark, d):
    train, _ = _split(spark, d, persist=False)
    c = centered_ratings(train, user_stats(train))
    c = c.filter(F.col("train_rating_count") >= 2)
    return _round(c.select("user_id", "item_id", "centered_rating"))


def _q_pair_counts(block_size):
    def q(spark, d):
        train, _ = _split(spark, d)
        pairs = co_rating_pairs(train, block_size=block_size)
        return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("pair_count"))

    return q


def _cos(spark, d):
    train, _ = _split(spark, d)
    return cosine_similarity(train, min_common=MIN_COMMON)


def _adj(spark, d, cap=None, **kw):
    train, _ = _split(spark, d)
    # Read for the counts, the values and the lists: kept.
    c = persist_tracked(centered_ratings(train, user_stats(train), _n(train)))
    return adjusted_cosine_similarity(c, min_common=MIN_COMMON, max_user_ratings=cap, **kw)


def q_cosine_similarity(spark, d):
    return _round(_cos(spark, d))


def q_cosine_similarity_blocked(spark, d):
    train, _ = _split(spark, d)
    return _round(cosine_similarity(train, min_common=MIN_COMMON, block_size=8))


def q_cosine_similarity_overlap(spark, d):
    # Pairs are formed from the items' prefixes only.
    train, _ = _split(spark, d)
    return _round(cosine_similarity(train, min_common=MIN_COMMON, method="overlap"))


def q_adjusted_cosine_overlap(spark, d):
    train, _ = _split(spark, d)
    c = persist_tracked(centered_ratings(train, user_stats(train), _n(train)))
    return _round(adjusted_cosine_similarity(c, min_common=MIN_COMMON, method="overlap"))


def q_cosine_similarity_tail(spark, d):
    # Customers x parts: most parts have few ratings, and few pairs reach two common users.
    # Read for the counts and for both sides of the prefix filter: kept.
    return _round(cosine_similarity(persist_tracked(tail_ratings(spark, d)), min_common=2, method="overlap"))


def q_formed_pairs(spark, d):
    # How many pairs the ratings of customers x parts form, and how many their prefixes form.
    return formed_pairs(tail_ratings(spark, d), min_common=MIN_COMMON)


def q_adjusted_cosine_uncapped(spark, d):
    # Heavy users are forced through the blocked self-join.
    return _round(_adj(spark, d, block_size=8))


def q_adjusted_cosine_capped(spark, d):
    # Opt-in: only users with at most 30 training ratings teach similarity.
    return _round(_adj(spark, d, cap=CAP))


def q_adjusted_cosine(spark, d):
    return _round(_adj(spark, d))


def q_similarity_mirrored(spark, d):
    return _round(mirror(_cos(spark, d)))


def q_top_neighbours(spark, d):
    return _round(top_neighbours(mirror(_adj(spark, d)), k=K))


def q_knn_neighbours(spark, d):
    train, test = _split(spark, d)
    return _round(knn_neighbours(test, train, mirror(cosine_similarity(train, MIN_COMMON)), k=K))


def q_knn_neighbours_blocked(spark, d):
    # Threshold 8: users with more than 8 test or training ratings are split into blocks.
    train, test = _split(spark, d)
    sim_all = mirror(cosine_similarity(train, MIN_COMMON))
    return _round(knn_neighbours(test, train, sim_all, k=K, block_size=8))


def q_knn_neighbours_bitmap(spark, d):
    # Broadcast bound 0: pairs are formed by the targets' partner bitmaps.
    train, test = _split(spark, d)
    sim_all = mirror(cosine_similarity(train, MIN_COMMON))
    return _round(knn_neighbours(test, train, sim_all, k=K, max_broadcast_rows=0))


def q_predict_knn_bitmap(spark, d):
    # As above, and users with more than 8 test or training ratings are split into blocks.
    train, test = _split(spark, d)
    sim_all = mirror(cosine_similarity(train, MIN_COMMON))
    mean = train_summary(train).getField("mean")
    return _round(predict_knn(test, train, sim_all, mean, k=K, block_size=8, max_broadcast_rows=0))


def q_predict_knn(spark, d):
    train, test = _split(spark, d)
    sim_all = mirror(cosine_similarity(train, MIN_COMMON))
    mean = train_summary(train).getField("mean")
    return _round(predict_knn(test, train, sim_all, mean, k=K))


def q_predict_centered(spark, d):
    train, test = _split(spark, d)
    stats = user_stats(train)
    c = persist_tracked(centered_ratings(train, stats, _n(train)))
    nb = top_neighbours(mirror(adjusted_cosine_similarity(c, MIN_COMMON)), k=K)
    mean = train_summary(train).getField("mean")
    return _round(predict_centered(test, c, nb, stats, mean))


def q_predict_centered_blocked(spark, d):
    # The packed lists are not broadcast: test rows are shuffled to them.
    train, test = _split(spark, d)
    stats = user_stats(train)
    c = persist_tracked(centered_ratings(train, stats, _n(train)))
    nb = top_neighbours(mirror(adjusted_cosine_similarity(c, MIN_COMMON)), k=K)
    mean = train_summary(train).getField("mean")
    return _round(predict_centered(test, c, nb, stats, mean, max_broadcast_rows=0))


def q_predict_knn_repeated(spark, d):
    # Order lines as they are: customers rate a supplier more than once. Every test row has its number.
    train, test = holdout(repeated_ratings(spark, d), persist=True)
    train, test = persist_tracked(one_rating(train, _n(train))), prediction_ids(test)
    sim_all = mirror(cosine_similarity(train, MIN_COMMON))
    mean = train_summary(train).getField("mean")
    return _round(predict_knn(test, train, sim_all, mean, k=K))


def q_evaluate_knn(spark, d):
    return _round(cosine_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K).metrics)


def q_evaluate_knn_stored(spark, d):
    # Ratings stored by user: no join shuffles them.
    return _round(cosine_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K, stored=True).metrics)


def q_evaluate_centered_stored(spark, d):
    return _round(centered_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K, stored=True).metrics)


def q_evaluate_centered(spark, d):
    r = centered_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K)
    return _round(r.metrics)


def q_evaluate_centered_capped(spark, d):
    r = centered_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K, max_user_ratings=CAP)
    return _round(r.metrics)


def q_evaluate_knn_exact_split(spark, d):
    r = cosine_knn(cf_ratings(spark, d), split="exact", min_common=MIN_COMMON, k=K)
    return _round(r.metrics)


def q_neighbour_summary(spark, d):
    return neighbour_summary(top_neighbours(mirror(_adj(spark, d)), k=K))


def q_cf_report_lines_centered(spark, d):
    r = centered_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K)
    return cf_report_lines(
        r.metrics,
        "Adjusted item-based collaborative filtering",
        f"adjusted cosine, min_common_users={MIN_COMMON}, top_k={K}",
        neighbours=r.neighbours,
        notes=model_notes("centered", MIN_COMMON, K),
    )


def q_cf_report_lines(spark, d):
    r = cosine_knn(cf_ratings(spark, d), min_common=MIN_COMMON, k=K)
    return cf_report_lines(
        r.metrics,
        "Item-based collaborative filtering",
        f"cosine similarity, min_common_users={MIN_COMMON}, top_k={K}",
        notes=model_notes("cosine", MIN_COMMON, K),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the four top-n lists for the chosen values on sf0.001."""
    return q_top_lists(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = _own_queries()
    if _llm is not None:
        out |= _llm.queries() | {"pipeline": corpus_pipeline.run}
    return out


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "explode_values": q_explode_values,
        "value_counts": q_value_counts,
        "rating_stats": q_rating_stats,
        "rating_stats_join_first": q_rating_stats_join_first,
        "top_most_rated": _q_top("most_rated"),
        "top_least_rated": _q_top("least_rated"),
        "top_best": _q_top("best"),
        "top_worst": _q_top("worst"),
        "top_lists": q_top_lists,
        "report_lines": q_report_lines,
        "value_table": q_value_table,
        "value_table_limited": q_value_table_limited,
        "list_tables": q_list_tables,
        "rating_stats_merged": q_rating_stats_merged,
        "user_stats_merged": q_user_stats_merged,
        "csv_round_trip": q_csv_round_trip,
        "csv_ratings_by_name": q_csv_ratings_by_name,
        "csv_ratings_rejected": q_csv_ratings_rejected,
        "holdout_hash": _q_holdout("hash"),
        "holdout_hash_804": _q_holdout("hash", frac=0.804),
        "holdout_hash_996": _q_holdout("hash", frac=0.996),
        "holdout_hash_seed": _q_holdout("hash", seed=7),
        "holdout_exact_repeated": q_holdout_exact_repeated,
        "holdout_random_summary": q_holdout_random_summary,
        "holdout_exact": _q_holdout("exact"),
        "holdout_random": _q_holdout("random"),
        "holdout_random_repeated": q_holdout_random_repeated,
        "baseline": q_baseline,
        "user_stats": q_user_stats,
        "centered_ratings": q_centered_ratings,
        "pair_counts_per_user": _q_pair_counts(4096),
        "pair_counts_blocked": _q_pair_counts(8),
        "cosine_similarity": q_cosine_similarity,
        "cosine_similarity_blocked": q_cosine_similarity_blocked,
        "cosine_similarity_overlap": q_cosine_similarity_overlap,
        "cosine_similarity_tail": q_cosine_similarity_tail,
        "formed_pairs": q_formed_pairs,
        "adjusted_cosine_overlap": q_adjusted_cosine_overlap,
        "adjusted_cosine": q_adjusted_cosine,
        "adjusted_cosine_uncapped": q_adjusted_cosine_uncapped,
        "adjusted_cosine_capped": q_adjusted_cosine_capped,
        "similarity_mirrored": q_similarity_mirrored,
        "top_neighbours": q_top_neighbours,
        "neighbour_summary": q_neighbour_summary,
        "knn_neighbours": q_knn_neighbours,
        "knn_neighbours_blocked": q_knn_neighbours_blocked,
        "knn_neighbours_bitmap": q_knn_neighbours_bitmap,
        "predict_knn": q_predict_knn,
        "predict_knn_bitmap": q_predict_knn_bitmap,
        "predict_knn_repeated": q_predict_knn_repeated,
        "predict_centered": q_predict_centered,
        "predict_centered_blocked": q_predict_centered_blocked,
        "evaluate_knn": q_evaluate_knn,
        "evaluate_knn_stored": q_evaluate_knn_stored,
        "evaluate_centered": q_evaluate_centered,
        "evaluate_centered_stored": q_evaluate_centered_stored,
        "evaluate_centered_capped": q_evaluate_centered_capped,
        "evaluate_knn_exact_split": q_evaluate_knn_exact_split,
        "cf_report_lines": q_cf_report_lines,
        "cf_report_lines_centered": q_cf_report_lines_centered,
    }


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

_VALUES_SQL = ", ".join(f"'{v}'" for v in VALUES)

_CTE = {
    "items": "SELECT p_partkey AS item_id, p_name AS title, replace(p_name, ' ', '|') AS tags FROM part",
    "item_values": "SELECT item_id, title, unnest(string_split(tags, '|')) AS value FROM items",
    "item_ratings": "SELECT l_partkey AS item_id, CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS rating FROM lineitem",
    "stats": (
        "SELECT value, item_id, title, count(rating) AS rating_count, avg(rating) AS avg_rating "
        f"FROM item_values JOIN item_ratings USING (item_id) WHERE value IN ({_VALUES_SQL}) "
        "GROUP BY value, item_id, title"
    ),
    "cf": (
        "SELECT o_custkey AS user_id, l_suppkey AS item_id, "
        "CAST(ceil(max(l_quantity) / 5) / 2 AS DOUBLE) AS rating "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey"
    ),
    "hashed": (
        "SELECT *, ('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), "
        "CAST(item_id AS VARCHAR))), 1, 8))::BIGINT AS h FROM cf"
    ),
    "flagged": "SELECT user_id, item_id, rating, (h % 100) < 80 AS is_train FROM hashed",
    "train": "SELECT user_id, item_id, rating FROM flagged WHERE is_train",
    "test": "SELECT user_id, item_id, rating FROM flagged WHERE NOT is_train",
    "tsum": "SELECT count(*) AS train_rows, avg(rating) AS train_mean FROM train",
    "ustats": (
        "SELECT user_id, count(*) AS train_rating_count, avg(rating) AS user_mean FROM train GROUP BY user_id"
    ),
    "centered": (
        "SELECT t.user_id, t.item_id, t.rating, s.train_rating_count, s.user_mean, "
        "t.rating - s.user_mean AS centered_rating FROM train t JOIN ustats s USING (user_id)"
    ),
    "teach": (
        "SELECT user_id, item_id, centered_rating AS r FROM centered WHERE train_rating_count >= 2"
    ),
    "cos_sums": (
        "SELECT a.item_id AS item_i, b.item_id AS item_j, count(*) AS common_users, "
        "sum(a.rating * b.rating) AS dot, sum(a.rating * a.rating) AS sq_i, sum(b.rating * b.rating) AS sq_j "
        "FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2"
    ),
    "cos_sim": (
        "SELECT item_i, item_j, similarity, common_users FROM ("
        "SELECT *, CASE WHEN sq_i * sq_j > 0 THEN dot / sqrt(sq_i * sq_j) END AS similarity "
        f"FROM cos_sums) WHERE common_users >= {MIN_COMMON} AND similarity > 1e-12"
    ),
    "cos_all": (
        "SELECT item_i, item_j, similarity, common_users, abs(similarity) AS abs_similarity FROM cos_sim "
        "UNION ALL SELECT item_j, item_i, similarity, common_users, abs(similarity) FROM cos_sim"
    ),
    "adj_sums": (
        "SELECT a.item_id AS item_i, b.item_id AS item_j, count(*) AS common_users, "
        "sum(a.r * b.r) AS dot, sum(a.r * a.r) AS sq_i, sum(b.r * b.r) AS sq_j "
        "FROM teach a JOIN teach b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2"
    ),
    "adj_sim": (
        "SELECT item_i, item_j, similarity, common_users FROM ("
        "SELECT *, CASE WHEN sq_i * sq_j > 0 THEN dot / sqrt(sq_i * sq_j) END AS similarity "
        f"FROM adj_sums) WHERE common_users >= {MIN_COMMON} AND sq_i > 0 AND sq_j > 0 AND abs(similarity) > 1e-12"
    ),
    "adj_all": (
        "SELECT item_i, item_j, similarity, common_users, abs(similarity) AS abs_similarity FROM adj_sim "
        "UNION ALL SELECT item_j, item_i, similarity, common_users, abs(similarity) FROM adj_sim"
    ),
    "nb": (
        "SELECT item_i AS target_item, item_j AS neighbor_item, similarity, abs_similarity, common_users, "
        "neighbor_rank FROM (SELECT *, row_number() OVER (PARTITION BY item_i ORDER BY round(abs_similarity, 10) DESC, "
        f"common_users DESC, item_j ASC) AS neighbor_rank FROM adj_all) WHERE neighbor_rank <= {K}"
    ),
    "kc": (
        "SELECT t.user_id, t.item_id AS target_item, r.item_id AS rated_item, r.rating AS neighbor_rating, "
        "s.similarity, s.abs_similarity, s.common_users FROM test t "
        "JOIN train r ON r.user_id = t.user_id AND r.item_id <> t.item_id "
        "JOIN cos_all s ON s.item_i = t.item_id AND s.item_j = r.item_id"
    ),
    "kn": (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, target_item ORDER BY "
        f"round(abs_similarity, 10) DESC, common_users DESC, rated_item ASC) AS neighbor_rank FROM kc) WHERE neighbor_rank <= {K}"
    ),
    "kpred": (
        "SELECT user_id, target_item, sum(similarity * neighbor_rating) AS weighted_sum, "
        "sum(abs_similarity) AS denom, count(*) AS neighbor_count FROM kn GROUP BY 1, 2"
    ),
    "scored_k": (
        "SELECT t.user_id, t.item_id, t.rating AS true_rating, "
        "coalesce(CASE WHEN p.denom <> 0 THEN p.weighted_sum / p.denom END, (SELECT train_mean FROM tsum)) "
        "AS prediction, coalesce(p.neighbor_count, 0) AS neighbor_count, "
        "coalesce(p.neighbor_count, 0) = 0 AS is_fallback "
        "FROM test t LEFT JOIN kpred p ON p.user_id = t.user_id AND p.target_item = t.item_id"
    ),
    "cand_c": (
        "SELECT t.user_id, t.item_id AS target_item, n.similarity, n.abs_similarity, c.centered_rating "
        "FROM test t JOIN nb n ON n.target_item = t.item_id "
        "JOIN centered c ON c.user_id = t.user_id AND c.item_id = n.neighbor_item"
    ),
    "cpred": (
        "SELECT user_id, target_item, sum(similarity * centered_rating) AS weighted_sum, "
        "sum(abs_similarity) AS denom, count(*) AS neighbor_count FROM cand_c GROUP BY 1, 2"
    ),
    "craw": (
        "SELECT t.user_id, t.item_id, t.rating AS true_rating, p.denom, p.neighbor_count, "
        "CASE WHEN p.denom IS NOT NULL "
        "THEN coalesce(s.user_mean, (SELECT train_mean FROM tsum)) + CASE WHEN p.denom <> 0 THEN p.weighted_sum / p.denom END "
        "ELSE coalesce(s.user_mean, (SELECT train_mean FROM tsum)) END AS raw "
        "FROM test t LEFT JOIN ustats s ON s.user_id = t.user_id "
        "LEFT JOIN cpred p ON p.user_id = t.user_id AND p.target_item = t.item_id"
    ),
    "scored_c": (
        "SELECT user_id, item_id, true_rating, "
        "CASE WHEN raw < 0.5 THEN 0.5 WHEN raw > 5.0 THEN 5.0 ELSE raw END AS prediction, denom, "
        "coalesce(neighbor_count, 0) AS neighbor_count, denom IS NULL AS is_fallback FROM craw"
    ),
}

# Dependencies, so each query only carries the CTEs it needs.
_DEPS = {
    "item_values": ["items"],
    "stats": ["item_values", "item_ratings"],
    "hashed": ["cf"],
    "flagged": ["hashed"],
    "train": ["flagged"],
    "test": ["flagged"],
    "tsum": ["train"],
    "ustats": ["train"],
    "centered": ["train", "ustats"],
    "teach": ["centered"],
    "cos_sums": ["train"],
    "cos_sim": ["cos_sums"],
    "cos_all": ["cos_sim"],
    "adj_sums": ["teach"],
    "adj_sim": ["adj_sums"],
    "adj_all": ["adj_sim"],
    "nb": ["adj_all"],
    "kc": ["test", "train", "cos_all"],
    "kn": ["kc"],
    "kpred": ["kn"],
    "scored_k": ["test", "kpred", "tsum"],
    "cand_c": ["test", "nb", "centered"],
    "cpred": ["cand_c"],
    "craw": ["test", "ustats", "cpred", "tsum"],
    "scored_c": ["craw"],
}


def _with(*needed: str, overrides: dict[str, str] | None = None) -> str:
    cte = {**_CTE, **(overrides or {})}
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({cte[n]})" for n in order) + "\n"


def _r(col: str) -> str:
    return f"round({col}, {DIGITS}) AS {col}"


_TOP_ORDER = {
    "most_rated": ("rating_count DESC, title ASC NULLS FIRST, item_id ASC", False),
    "least_rated": ("rating_count ASC, title ASC NULLS FIRST, item_id ASC", True),
    "best": ("avg_rating DESC, rating_count DESC, title ASC NULLS FIRST, item_id ASC", True),
    "worst": ("avg_rating ASC NULLS FIRST, rating_count DESC, title ASC NULLS FIRST, item_id ASC", True),
}


def _top_sql(by: str) -> str:
    order, needs_min = _TOP_ORDER[by]
    where = f"WHERE rating_count > {MIN_COUNT}" if needs_min else ""
    return (
        'SELECT value, CAST("rank" AS BIGINT) AS "rank", item_id, title, rating_count, '
        "round(avg_rating, 3) AS avg_rating FROM (SELECT *, row_number() OVER "
        f'(PARTITION BY value ORDER BY {order}) AS "rank" FROM stats {where}) WHERE "rank" <= {N}'
    )


def _metrics_sql(scored: str) -> str:
    return (
        f"SELECT (SELECT train_rows FROM tsum) AS train_rows, count(*) AS test_rows, "
        f"round((SELECT train_mean FROM tsum), {DIGITS}) AS train_mean, "
        f"round(sqrt(avg((true_rating - (SELECT train_mean FROM tsum)) * (true_rating - (SELECT train_mean FROM tsum)))), {DIGITS}) AS baseline_rmse, "
        f"round(sqrt(avg((true_rating - prediction) * (true_rating - prediction))), {DIGITS}) AS cf_rmse, "
        "count(*) FILTER (WHERE is_fallback) AS fallback_count, "
        f"round(1.0 - CAST(count(*) FILTER (WHERE is_fallback) AS DOUBLE) / count(*), {DIGITS}) AS coverage "
        f"FROM {scored}"
    )


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The report's list sections in order: list name and title.
_SECTIONS = (
    ("most_rated", "{v}: top 10 by number of ratings"),
    ("least_rated", "{v}: top 10 by smallest number of ratings, rating_count > 10"),
    ("best", "{v}: top 10 by highest average rating, rating_count > 10"),
    ("worst", "{v}: top 10 by lowest average rating, rating_count > 10"),
)


def _report_sql() -> str:
    fixed = [
        (0, 0, "# Rating report"), (0, 1, ""), (0, 2, "Values: red, ring, widget."),
        (1, 0, ""), (1, 1, "## Items per value"), (1, 2, ""), (1, 3, "| value | item_count |"), (1, 4, "| --- | --- |"),
    ]
    case = ""
    for i, (v, (name, title)) in enumerate((v, x) for v in VALUES for x in _SECTIONS):
        fixed += [
            (i + 2, 0, ""), (i + 2, 1, "## " + title.format(v=v)), (i + 2, 2, ""),
            (i + 2, 3, "| title | rating_count | avg_rating |"), (i + 2, 4, "| --- | --- | --- |"),
        ]
        case += f"WHEN value = {_sql_str(v)} AND list_name = '{name}' THEN {i + 2} "
    fixed_rows = ", ".join(f"({a}, {b}, {_sql_str(t)})" for a, b, t in fixed)
    lists = " UNION ALL ".join(
        f"SELECT '{by}' AS list_name, * FROM ({_top_sql(by)})" for by in _TOP_ORDER
    )
    cell = lambda c: f"replace(CAST({c} AS VARCHAR), '|', '\\|')"
    return (
        _with("stats", "item_values")
        + f", counts AS (SELECT value, count(DISTINCT item_id) AS item_count FROM item_values GROUP BY value), "
        f"lists AS ({lists}) "
        f"SELECT CAST(col0 AS BIGINT) AS section, CAST(col1 AS BIGINT) AS line, col2 AS text FROM (VALUES {fixed_rows}) "
        "UNION ALL SELECT 1, 4 + row_number() OVER (ORDER BY item_count DESC, value ASC), "
        f"'| ' || {cell('value')} || ' | ' || {cell('item_count')} || ' |' FROM counts "
        f"UNION ALL SELECT CASE {case} END, 4 + \"rank\", "
        f"'| ' || {cell('title')} || ' | ' || {cell('rating_count')} || ' | ' || "
        "replace(printf('%.3f', round(avg_rating, 3)), '|', '\\|') || ' |' FROM lists"
    )


_NOTES = {
    "cosine": (
        "- RMSE is the root of the mean squared difference of rating and prediction over all test rows.",
        "- Two items are similar by the cosine of their ratings over the users of both, 5 users at least; only positive values count.",
        "- A prediction is the similarity-weighted mean of the user's 30 most similar rated items.",
        "- Without such an item the train mean is predicted.",
    ),
    "centered": (
        "- RMSE is the root of the mean squared difference of rating and prediction over all test rows.",
        "- Two items are similar by the cosine of ratings less the user's mean over the users of both, 5 users at least.",
        "- Similarities are learned from users with 2 or more training ratings; every training rating is used to predict.",
        "- A prediction adds the weighted deviation on the item's 30 nearest neighbours to the user's mean, within the rating scale.",
        "- Without a rated neighbour the user's mean is predicted, for an unknown user the train mean.",
    ),
}


def _cf_report_sql(scored: str = "scored_k", model: str = "Item-based collaborative filtering",
                   details: str = f"cosine similarity, min_common_users={MIN_COMMON}, top_k={K}",
                   with_neighbours: bool = False) -> str:
    fixed = [
        (0, 0, "# Collaborative filtering results"),
        (0, 1, ""),
        (0, 2, "Split: deterministic hash of (user, item), 80 of 100 buckets."),
        (1, 0, ""), (1, 1, "## Split and baseline"), (1, 2, ""), (1, 3, "| metric | value |"), (1, 4, "| --- | --- |"),
        (2, 0, ""), (2, 1, "## Collaborative filtering result"), (2, 2, ""),
        (2, 3, "| model | rmse | details |"), (2, 4, "| --- | --- | --- |"),
        (3, 0, ""), (3, 1, "## Notes"), (3, 2, ""),
    ]
    fixed += [(3, 6 + k, t) for k, t in enumerate(_NOTES["centered" if with_neighbours else "cosine"])]
    fixed_rows = ", ".join(f"({a}, {b}, {_sql_str(t)})" for a, b, t in fixed)
    f6 = lambda c: f"printf('%.6f', round({c}, 6))"
    nb_lines = ""
    needed = [scored, "tsum"]
    if with_neighbours:
        needed.append("nb")
        nb_lines = (
            "UNION ALL SELECT 3, 4, '- Top-similarity table rows: ' || CAST(count(*) AS VARCHAR) || '.' FROM nb "
            "UNION ALL SELECT 3, 5, '- Items with learned neighbors: ' || CAST(count(DISTINCT target_item) AS VARCHAR) || '.' FROM nb "
        )
    return (
        _with(*needed)
        + f", m AS ({_metrics_sql(scored)}) "
        f"SELECT CAST(col0 AS BIGINT) AS section, CAST(col1 AS BIGINT) AS line, col2 AS text FROM (VALUES {fixed_rows}) "
        "UNION ALL SELECT 1, 5, '| train rows | ' || CAST(train_rows AS VARCHAR) || ' |' FROM m "
        "UNION ALL SELECT 1, 6, '| test rows | ' || CAST(test_rows AS VARCHAR) || ' |' FROM m "
        f"UNION ALL SELECT 1, 7, '| mean rating in train | ' || {f6('train_mean')} || ' |' FROM m "
        f"UNION ALL SELECT 1, 8, '| baseline RMSE on test | ' || {f6('baseline_rmse')} || ' |' FROM m "
        f"UNION ALL SELECT 2, 5, '| Train mean baseline | ' || {f6('baseline_rmse')} || ' | prediction = ' || {f6('train_mean')} || ' |' FROM m "
        f"UNION ALL SELECT 2, 6, '| {model} | ' || {f6('cf_rmse')} || ' | {details}, coverage=' || printf('%.2f', round(coverage * 100.0, 2)) || '% |' FROM m "
        "UNION ALL SELECT 3, 3, '- Fallback predictions: ' || CAST(fallback_count AS VARCHAR) || ' of ' || CAST(test_rows AS VARCHAR) || ' test rows.' FROM m "
        + nb_lines
    )


_REPEATED = (
    "SELECT o_custkey AS user_id, l_suppkey AS item_id, CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS rating "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
_EXACT_FLAG = (
    "SELECT user_id, item_id, rating, row_number() OVER (ORDER BY h, user_id, item_id) "
    "<= round(0.8 * count(*) OVER ()) AS is_train FROM hashed"
)


def oracle_sql() -> dict[str, str]:
    out = _own_oracle_sql()
    if _llm is not None:
        out |= _llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def _own_oracle_sql() -> dict[str, str]:
    top = {f"top_{by}": _with("stats") + _top_sql(by) for by in _TOP_ORDER}
    pair_counts = (
        _with("train")
        + "SELECT a.user_id, count(*) AS pair_count FROM train a JOIN train b "
        "ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY a.user_id"
    )
    def flags(test: str, seed: str = "") -> str:
        hashed = _CTE["hashed"].replace("md5(", f"md5({seed}", 1)
        flagged = f"SELECT user_id, item_id, rating, {test} AS is_train FROM hashed"
        return _with("flagged", overrides={"hashed": hashed, "flagged": flagged}) + "SELECT * FROM flagged"

    def drawn(seed: str) -> str:
        # 0.8 of 2^32; every row is drawn by itself and its number among equal rows.
        return (
            "SELECT user_id, item_id, rating, ('0x' || substr(md5(concat_ws('|', " + seed + "user_id, item_id, rating, copy)), 1, 8))::BIGINT "
            "< 3435973837 AS is_train FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, rating) AS copy FROM cf)"
        )

    value_lines = (
        _with("item_values")
        + "SELECT row_number() OVER (ORDER BY count(DISTINCT item_id) DESC, value) AS line, value, "
        "count(DISTINCT item_id) AS item_count FROM item_values GROUP BY value"
    )
    adj_sim = f"SELECT item_i, item_j, {_r('similarity')}, common_users FROM adj_sim"
    capped = {"teach": _CTE["teach"].replace(">= 2", f"BETWEEN 2 AND {CAP}")}
    repeated = {
        "cf": _REPEATED,
        "train": "SELECT user_id, item_id, avg(rating) AS rating FROM flagged WHERE is_train GROUP BY ALL",
        "kc": _CTE["kc"].replace("FROM test t", "FROM (SELECT DISTINCT user_id, item_id FROM test) t"),
    }
    knn = (
        _with("kn")
        + f"SELECT user_id, target_item, rated_item, neighbor_rating, {_r('similarity')}, {_r('abs_similarity')}, "
        "common_users, neighbor_rank FROM kn"
    )
    predicted = (
        _with("scored_k")
        + f"SELECT user_id, item_id, true_rating, {_r('prediction')}, neighbor_count, is_fallback FROM scored_k"
    )
    tail = {"cf": _CTE["cf"].replace("l_suppkey", "l_partkey")}
    cos_sim = _with("cos_sim") + f"SELECT item_i, item_j, {_r('similarity')}, common_users FROM cos_sim"
    return {
        "explode_values": _with("item_values") + "SELECT item_id, title, value FROM item_values",
        "value_counts": _with("item_values")
        + "SELECT value, count(DISTINCT item_id) AS item_count FROM item_values GROUP BY value",
        "rating_stats": _with("stats")
        + f"SELECT value, item_id, title, rating_count, {_r('avg_rating')} FROM stats",
        "rating_stats_join_first": _with("stats")
        + f"SELECT value, item_id, title, rating_count, {_r('avg_rating')} FROM stats",
        **top,
        "top_lists": _with("stats")
        + " UNION ALL ".join(f"SELECT '{by}' AS list_name, * FROM ({_top_sql(by)})" for by in _TOP_ORDER),
        "report_lines": _report_sql(),
        "value_table": value_lines,
        "value_table_limited": value_lines + " QUALIFY line <= 10",
        "list_tables": _with("stats")
        + "SELECT CAST(4 * (CASE value "
        + " ".join(f"WHEN '{v}' THEN {k}" for k, v in enumerate(VALUES))
        + " END) + (CASE list_name "
        + " ".join(f"WHEN '{x}' THEN {k}" for k, (x, _) in enumerate(_SECTIONS))
        + ' END) AS BIGINT) AS section, "rank", value, list_name, item_id, title, rating_count, avg_rating FROM ('
        + " UNION ALL ".join(f"SELECT '{by}' AS list_name, * FROM ({_top_sql(by)})" for by in _TOP_ORDER)
        + ")",
        "rating_stats_merged": _with("stats")
        + f"SELECT value, item_id, title, rating_count, {_r('avg_rating')} FROM stats",
        "user_stats_merged": _with("ustats") + f"SELECT user_id, train_rating_count, {_r('user_mean')} FROM ustats",
        "csv_round_trip": _with("items")
        + "SELECT item_id, CASE item_id % 7 WHEN 1 THEN '  ' || title || ' ' WHEN 2 THEN title || chr(10) || 'line, two' "
        "WHEN 3 THEN '\"' || title || '\" \\' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE title END AS title, "
        "CASE WHEN item_id % 11 = 0 THEN '' WHEN item_id % 13 = 0 THEN NULL ELSE tags END AS tags FROM items",
        "csv_ratings_by_name": _with("cf") + "SELECT user_id, item_id, rating FROM cf",
        "csv_ratings_rejected": _with("cf")
        + "SELECT CASE WHEN user_id % 10 = 0 THEN '?' ELSE CAST(user_id AS VARCHAR) END AS user_id, "
        "CAST(item_id AS VARCHAR) AS item_id, CASE WHEN item_id % 10 = 0 THEN NULL ELSE printf('%.1f', rating) END AS rating "
        "FROM cf WHERE user_id % 10 = 0 OR item_id % 10 = 0",
        "holdout_hash_804": flags("(h % 1000) < 804"),
        "holdout_hash_996": flags("(h % 1000) < 996"),
        "holdout_hash_seed": flags("(h % 100) < 80", seed="'7|' || "),
        "holdout_exact_repeated": _with("flagged", overrides={"cf": _REPEATED, "flagged": _EXACT_FLAG.replace("item_id)", "item_id, rating)")})
        + "SELECT user_id, item_id, rating, is_train FROM flagged",
        "holdout_random_summary": _with("cf") + "SELECT count(*) AS n_rows, true AS complete, true AS share_ok FROM cf",
        "holdout_random": _with("cf") + drawn(""),
        "holdout_random_repeated": _with("cf", overrides={"cf": _REPEATED}) + drawn("42, "),
        "holdout_hash": _with("flagged") + "SELECT user_id, item_id, rating, is_train FROM flagged",
        "holdout_exact": _with("flagged", overrides={"flagged": _EXACT_FLAG})
        + "SELECT user_id, item_id, rating, is_train FROM flagged",
        "baseline": _with("tsum", "test")
        + "SELECT train_rows, (SELECT count(*) FROM test) AS test_rows, "
        f"round(train_mean, {DIGITS}) AS train_mean, "
        "(SELECT round(sqrt(avg((rating - tsum.train_mean) * (rating - tsum.train_mean))), "
        f"{DIGITS}) FROM test) AS baseline_rmse FROM tsum",
        "user_stats": _with("ustats") + f"SELECT user_id, train_rating_count, {_r('user_mean')} FROM ustats",
        "centered_ratings": _with("teach") + f"SELECT user_id, item_id, round(r, {DIGITS}) AS centered_rating FROM teach",
        "pair_counts_per_user": pair_counts,
        "pair_counts_blocked": pair_counts,
        "cosine_similarity": cos_sim,
        "cosine_similarity_blocked": cos_sim,
        "cosine_similarity_overlap": cos_sim,
        "cosine_similarity_tail": _with("cos_sums", overrides={**tail, "train": "SELECT * FROM cf"})
        + "SELECT item_i, item_j, round(similarity, 8) AS similarity, common_users FROM (SELECT *, "
        "CASE WHEN sq_i * sq_j > 0 THEN dot / sqrt(sq_i * sq_j) END AS similarity FROM cos_sums) "
        "WHERE common_users >= 2 AND similarity > 1e-12",
        "formed_pairs": _with("cf", overrides=tail)
        + ", sized AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS size FROM cf), "
        "placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY size DESC, user_id DESC) AS place FROM sized) "
        "SELECT CAST((SELECT sum(n * (n - 1) // 2) FROM (SELECT count(*) AS n FROM cf GROUP BY user_id)) AS BIGINT) AS all_pairs, "
        "CAST(coalesce((SELECT sum(n * (n - 1) // 2) FROM (SELECT count(*) AS n FROM placed "
        f"WHERE place >= {MIN_COMMON} GROUP BY user_id)), 0) AS BIGINT) AS prefix_pairs",
        "adjusted_cosine_overlap": _with("adj_sim") + adj_sim,
        "adjusted_cosine": _with("adj_sim") + adj_sim,
        "adjusted_cosine_uncapped": _with("adj_sim") + adj_sim,
        "adjusted_cosine_capped": _with("adj_sim", overrides=capped) + adj_sim,
        "predict_knn_repeated": _with("scored_k", overrides=repeated)
        + "SELECT row_number() OVER (ORDER BY user_id, item_id, true_rating) AS prediction_id, user_id, item_id, "
        f"true_rating, {_r('prediction')}, neighbor_count, is_fallback FROM scored_k",
        "evaluate_centered_capped": _with("scored_c", "tsum", overrides=capped) + _metrics_sql("scored_c"),
        "predict_centered_blocked": _with("scored_c")
        + f"SELECT user_id, item_id, true_rating, {_r('prediction')}, {_r('denom')}, neighbor_count, is_fallback "
        "FROM scored_c",
        "similarity_mirrored": _with("cos_all")
        + f"SELECT item_i, item_j, {_r('similarity')}, common_users, {_r('abs_similarity')} FROM cos_all",
        "top_neighbours": _with("nb")
        + f"SELECT target_item, neighbor_item, {_r('similarity')}, {_r('abs_similarity')}, common_users, "
        "neighbor_rank FROM nb",
        "knn_neighbours": knn,
        "knn_neighbours_blocked": knn,
        "knn_neighbours_bitmap": knn,
        "predict_knn": predicted,
        "predict_knn_bitmap": predicted,
        "predict_centered": _with("scored_c")
        + f"SELECT user_id, item_id, true_rating, {_r('prediction')}, {_r('denom')}, neighbor_count, is_fallback "
        "FROM scored_c",
        "evaluate_knn": _with("scored_k", "tsum") + _metrics_sql("scored_k"),
        "evaluate_centered": _with("scored_c", "tsum") + _metrics_sql("scored_c"),
        "evaluate_knn_stored": _with("scored_k", "tsum") + _metrics_sql("scored_k"),
        "evaluate_centered_stored": _with("scored_c", "tsum") + _metrics_sql("scored_c"),
        "evaluate_knn_exact_split": _with("scored_k", "tsum", overrides={"flagged": _EXACT_FLAG})
        + _metrics_sql("scored_k"),
        "cf_report_lines": _cf_report_sql(),
        "cf_report_lines_centered": _cf_report_sql(
            "scored_c",
            "Adjusted item-based collaborative filtering",
            f"adjusted cosine, min_common_users={MIN_COMMON}, top_k={K}",
            with_neighbours=True,
        ),
        "neighbour_summary": _with("nb")
        + "SELECT count(*) AS neighbour_rows, count(DISTINCT target_item) AS learned_items FROM nb",
    }
