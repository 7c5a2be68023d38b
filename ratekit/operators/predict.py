"""kNN rating prediction.

Two models:

* :func:`predict_knn` - query-time neighbours: for a test row (user, target)
  the candidates are the items the user rated in train that have a
  similarity to the target; the ``k`` best by |similarity| predict
  ``sum(s * r) / sum(|s|)``; no candidate -> train mean.
* :func:`predict_centered` - model-time neighbours: the fixed top-``k`` list of
  the target item is met with the user's training ratings; prediction is
  ``user_mean + sum(s * (r - user_mean)) / sum(|s|)``, falling back to the
  user mean, then the train mean, and clipped into the rating range.

Predictions are made per distinct (user_id, item_id) and joined back to all test
rows, so repeated test rows stay as they are. Training ratings are expected once per
(user, item); :func:`one_rating` makes them so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratekit.functions.columns import clip, safe_ratio
from ratekit.operators.joins import (
    DEFAULT_BLOCK_SIZE,
    DEFAULT_MAX_BROADCAST_ROWS,
    blocked_join,
    broadcast_if_small,
    dealt,
    heavy_keys,
    listed_join,
    partitions_for,
    spread,
)
from ratekit.operators.ordinals import numbered_copies, row_numbers
from ratekit.operators.similarity import TOP_K, rank_key
from ratekit.operators.similarity import user_counts as _user_counts
from ratekit.session import persist_tracked

# The rating range used for clipping.
MIN_RATING = 0.5
MAX_RATING = 5.0
PREDICTION_ID, RANK = "prediction_id", "neighbor_rank"
#: Words of a partner bitmap at most: members beyond share bits.
BITMAP_WORDS = 128
#: Candidate pairs that one task forms.
CANDIDATES_PER_TASK = 1 << 20


def prediction_ids(test: DataFrame) -> DataFrame:
    """``test`` with a number 1, 2, ... for every row, in the order of its columns.

    The same in every run and under any partitioning; equal rows take consecutive
    numbers. Both models carry the number to the scored row.
    """
    cols = test.columns
    return row_numbers(numbered_copies(test, "_copy"), [*cols, "_copy"], PREDICTION_ID).select(PREDICTION_ID, *cols)


def one_rating(ratings: DataFrame, n: int = 0) -> DataFrame:
    """One row per (user, item): the mean of its repeated ratings. ``n``: partitions (:func:`partitions_for`)."""
    return spread(ratings, n, "user_id", "item_id").groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def partner_bitmaps(table: DataFrame, key: str, member: str) -> tuple[DataFrame, DataFrame]:
    """Which members a key is related to, as one row a key.

    Returns (``member``, _no), the members numbered from 0, and (``key``, _words), an array of longs
    in which bit _no % 64 of word _no / 64 is set for every related member. A key takes at
    most members / 8 bytes, and its bits are gathered word by word with partial sums. Numbers start
    again after ``BITMAP_WORDS`` words, so a bitmap stays 1 KB however many members there are; a set
    bit then says that the member may be related.
    """
    numbers = row_numbers(table.select(member).distinct(), [member], "_no", start=0)
    numbers = numbers.withColumn("_no", F.col("_no") % F.lit(64 * BITMAP_WORDS))
    bit = F.expr("shiftleft(1L, CAST(_no % 64 AS INT))")
    word = F.expr("CAST(_no DIV 64 AS INT)")
    bits = table.select(key, member).join(numbers, member).groupBy(key, word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    # Words without a bit are filled in, so that a word's place in the array is its number.
    upto = bits.groupBy(key).agg(F.max("_word").alias("_last"))
    none = upto.select(key, F.explode(F.sequence(F.lit(0), "_last")).alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    whole = bits.unionByName(none).groupBy(key, "_word").agg(F.bit_or("_bits").alias("_bits"))
    listed = F.sort_array(F.collect_list(F.struct("_word", "_bits")))
    return numbers, whole.groupBy(key).agg(F.transform(listed, lambda x: x["_bits"]).alias("_words"))


def related_pairs(
    test: DataFrame,
    rated: DataFrame,
    table: DataFrame,
    heavy: DataFrame | None = None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    n: int = 0,
    n_pairs: int = 0,
    order: Sequence[Column] = (),
    k: int | None = None,
) -> DataFrame:
    """Rows of (user, target) x the user's ratings of items that ``table`` relates to the target, with its values.

    Every test row takes the user's ratings along as one list, to the task of its target. There
    pairs whose bit is not set in the target's bitmap of partners go, and the others are looked up among
    the table's rows. So what is shuffled is one row a test row, not a pair, and no pair is sorted. Items without any
    partner go before. ``heavy`` (user_id, _nl, _nr): users whose rows are split into blocks, and their
    lists with them. ``n`` and ``n_pairs``: partitions by user and by target (:func:`partitions_for`). ``order`` and
    ``k`` as in :func:`neighbour_candidates`: a whole list is ranked where it is looked up, and only the k best leave; the
    best of the lists of a user in blocks are ranked together afterwards.
    """
    numbers, words = partner_bitmaps(table, "target_item", "rated_item")
    r = rated.join(broadcast_if_small(numbers, max_broadcast_rows), "rated_item")
    chunk = F.lit(0)
    if heavy is not None:
        r = r.join(heavy.select("user_id", "_nr"), "user_id", "left")
        chunk = F.pmod(F.xxhash64("rated_item"), F.coalesce("_nr", F.lit(1))).cast("int")
    entry = F.struct(*[c for c in rated.columns if c != "user_id"], F.col("_no").cast("int").alias("_no")).alias("_e")
    r = spread(r.select("user_id", chunk.alias("_chunk"), entry), n, "user_id", "_chunk")
    lists = r.groupBy("user_id", "_chunk").agg(F.collect_list("_e").alias("_rated"))

    def related(tests: DataFrame, chunks: DataFrame, blocks: DataFrame | None) -> DataFrame:
        met = blocked_join(tests, chunks, "user_id", blocks, ["target_item"], ["_chunk"], partitions=n).drop("_chunk")
        return listed_join(met, table, "target_item", "rated_item", "_rated", n_pairs, words, "_no", order, k, RANK).drop("_no")

    if heavy is None or k is None:
        return related(test, lists, heavy)
    side = lambda how: [df.join(heavy.select("user_id"), "user_id", how) for df in (test, lists)]
    blocks = best(related(*side("left_semi"), heavy).drop(RANK), order, k)
    return related(*side("left_anti"), None).unionByName(blocks)


def best(candidates: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first candidates of every (user, target) by ``order`` (ascending, nulls last), with ``neighbor_rank`` 1..k."""
    w = Window.partitionBy("user_id", "target_item").orderBy(*[o.asc_nulls_last() for o in order])
    first = candidates.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= F.lit(k))
    return first.withColumn(RANK, F.col("_rank").cast("bigint")).drop("_rank")


def neighbour_candidates(
    test: DataFrame,
    rated: DataFrame,
    table: DataFrame,
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    user_counts: DataFrame | None = None,
    materialized_inputs: bool = False,
    by_user: bool = False,
    order: Sequence[Column] = (),
    k: int | None = None,
) -> DataFrame:
    """Rows of (user, target) x the user's ratings that ``table`` relates to the target.

    ``test``: user_id, target_item (distinct). ``rated``: user_id, rated_item and any
    values. ``table``: target_item, rated_item and any values, no self pairs.

    Every test row meets the user's ratings where they lie; users with more than
    ``block_size`` test or training rows are split into blocks. What is kept of these
    meetings is decided on the spot, in one of two ways to the same rows:

    * a table of at most ``max_broadcast_rows`` rows (some 40 bytes each) is broadcast
      and joined there;
    * beyond that the test rows carry the user's ratings to their target, where its partners lie (see
      :func:`related_pairs`).

    ``materialized_inputs=True`` says ``table`` is read from a checkpoint, so it is not
    persisted again. ``by_user`` says that ``rated`` is stored by user. With ``k`` only the k first rows of a (user, target) by
    ``order``, values of ``table`` (ascending, nulls last), are kept, with ``neighbor_rank``.
    """
    table = table if materialized_inputs else persist_tracked(table)
    small = table.count() <= max_broadcast_rows
    counts = user_counts if user_counts is not None else persist_tracked(_user_counts(rated, test))
    heavy = persist_tracked(heavy_keys(counts, "user_id", "n_test", "n_train", block_size))
    heavy = heavy if heavy.count() else None
    if small:
        met = blocked_join(test, rated, "user_id", heavy, ["target_item"], ["rated_item"], right_placed=by_user)
        met = met.join(F.broadcast(table), ["target_item", "rated_item"])
        return met if k is None else best(met, order, k)
    tr, te = F.col("n_train").cast("double"), F.col("n_test")
    n_rows, n_pairs = (int(x or 0) for x in counts.agg(F.sum(tr + te), F.sum(tr * te)).first())
    n, n_pairs = partitions_for(rated, n_rows), partitions_for(rated, n_pairs, CANDIDATES_PER_TASK)
    return related_pairs(test, rated, table, heavy, max_broadcast_rows, n, n_pairs, order, k)


def listed_candidates(
    test: DataFrame,
    rated: DataFrame,
    table: DataFrame,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    materialized_inputs: bool = False,
    block_size: int = DEFAULT_BLOCK_SIZE,
) -> DataFrame:
    """Rows of (user, target) x the user's ratings on the target's list of neighbours.

    ``table``: target_item, rated_item and any values, at most k rows a target. The list is packed into one
    row a target, so a test row meets one row and takes at most k entries, each
    looked up by (user, item). Of the entries only items and places travel; those that meet a rating, mostly few, take
    their values from the list afterwards. Nothing is multiplied by the user's ratings, so
    a user of any size is not quadratic. Test rows travel to the user's ratings with their lists packed; those
    of users with more than ``block_size`` test rows are unpacked before, so that their entries are
    spread by (user, item) and no task holds the user. Packed lists are broadcast under
    ``max_broadcast_rows`` targets; beyond that test rows are shuffled to them once.
    """
    entry = F.struct(*[c for c in table.columns if c != "target_item"])
    # Sorted: read twice, and an entry has the same place both times.
    packed = table.groupBy("target_item").agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    lists = broadcast_if_small(packed, max_broadcast_rows, persist=not materialized_inputs)
    counts = persist_tracked(_user_counts(rated, test))
    n_rows = counts.agg(F.sum(F.col("n_train") + F.col("n_test") * TOP_K)).first()[0] or 0
    n = partitions_for(rated, n_rows)
    heavy = counts.filter((F.col("n_test") > F.lit(block_size)) | (F.col("n_train") > F.lit(block_size))).select("user_id")

    def unpacked(met: DataFrame) -> DataFrame:
        return met.select(*test.columns, F.explode("_list").alias("_e")).select(*test.columns, "_e.*")

    def light(rows: DataFrame) -> DataFrame:
        return rows if n_heavy == 0 else rows.join(hv, "user_id", "left_anti")

    n_heavy = heavy.count()
    hv = F.broadcast(heavy) if n_heavy <= max_broadcast_rows else heavy
    key = ["user_id", "rated_item"]
    met = test.join(lists, "target_item")
    places = F.transform("_list", lambda x, i: F.struct(x["rated_item"].alias("rated_item"), i.alias("_place")))
    out = listed_join(light(met).withColumn("_list", places), light(rated), "user_id", "rated_item", "_list", n)
    values = [c for c in table.columns if c not in ("target_item", "rated_item")]
    found = out.join(lists, "target_item").withColumn("_e", F.get("_list", "_place"))
    out = found.select(*test.columns, "rated_item", *[f"_e.{c}" for c in values], *[c for c in rated.columns if c not in ("user_id", "rated_item")])
    if n_heavy:
        hot = unpacked(met.join(hv, "user_id", "left_semi")).join(rated.join(hv, "user_id", "left_semi"), key)
        out = out.unionByName(hot)
    return out


def knn_candidates(
    test: DataFrame,
    train: DataFrame,
    sim_all: DataFrame,
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    user_counts: DataFrame | None = None,
    materialized_inputs: bool = False,
    by_user: bool = False,
    k: int | None = None,
) -> DataFrame:
    """(user_id, target_item, rated_item, neighbor_rating, similarity,
    abs_similarity, common_users) for every usable neighbour rating: an item
    the user rated in train that has a similarity to the test target. Repeated test
    rows count once; ``train`` holds one rating per (user, item). With ``k`` the k best of a test
    row, with ``neighbor_rank``: |similarity| (rounded, see ``rank_key``) desc, common users desc, rated item asc."""
    return neighbour_candidates(
        test.select("user_id", F.col("item_id").alias("target_item")).distinct(),
        train.select(
            "user_id", F.col("item_id").alias("rated_item"), F.col("rating").alias("neighbor_rating")
        ),
        sim_all.select(
            F.col("item_i").alias("target_item"),
            F.col("item_j").alias("rated_item"),
            "similarity",
            "abs_similarity",
            "common_users",
        ),
        block_size=block_size,
        max_broadcast_rows=max_broadcast_rows,
        user_counts=user_counts,
        materialized_inputs=materialized_inputs,
        by_user=by_user,
        order=[-rank_key(), -F.col("common_users"), F.col("rated_item")],
        k=k,
    )


def knn_neighbours(
    test: DataFrame,
    train: DataFrame,
    sim_all: DataFrame,
    k: int = TOP_K,
    block_size: int = DEFAULT_BLOCK_SIZE,
    user_counts: DataFrame | None = None,
    materialized_inputs: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    by_user: bool = False,
) -> DataFrame:
    """The ``k`` best candidates per test row, with ``neighbor_rank`` 1..k.

    Order: |similarity| (rounded, see ``rank_key``) desc, common users desc, rated item asc.
    """
    return knn_candidates(
        test,
        train,
        sim_all,
        block_size=block_size,
        max_broadcast_rows=max_broadcast_rows,
        user_counts=user_counts,
        materialized_inputs=materialized_inputs,
        by_user=by_user,
        k=k,
    )


def predict_knn(
    test: DataFrame,
    train: DataFrame,
    sim_all: DataFrame,
    train_mean: Column,
    k: int = TOP_K,
    block_size: int = DEFAULT_BLOCK_SIZE,
    user_counts: DataFrame | None = None,
    materialized_inputs: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    by_user: bool = False,
) -> DataFrame:
    """Scored test rows: user_id, item_id, true_rating, prediction,
    neighbor_count, is_fallback, after the test rows' ``prediction_id`` where they have one.

    A (user, item) is predicted once, and every test row of it gets that prediction.
    :func:`prediction_ids` numbers the test rows, so that repeated ones can be told apart."""
    top = knn_neighbours(
        test,
        train,
        sim_all,
        k=k,
        block_size=block_size,
        max_broadcast_rows=max_broadcast_rows,
        user_counts=user_counts,
        materialized_inputs=materialized_inputs,
        by_user=by_user,
    )
    pred = top.groupBy("user_id", "target_item").agg(
        F.sum(F.col("similarity") * F.col("neighbor_rating")).alias("weighted_sum"),
        F.sum("abs_similarity").alias("denom"),
        F.count(F.lit(1)).alias("neighbor_count"),
    )
    ids = [c for c in test.columns if c == PREDICTION_ID]
    t = test.select(*ids, "user_id", "item_id", F.col("rating").alias("true_rating"))
    p = pred.withColumnRenamed("target_item", "item_id")
    scored = t.join(p, ["user_id", "item_id"], "left")
    nc = F.coalesce(F.col("neighbor_count"), F.lit(0)).cast("bigint")
    return scored.select(
        *ids,
        "user_id",
        "item_id",
        "true_rating",
        F.coalesce(safe_ratio("weighted_sum", "denom"), train_mean).alias("prediction"),
        nc.alias("neighbor_count"),
        (nc == F.lit(0)).alias("is_fallback"),
    )


def predict_centered(
    test: DataFrame,
    centered: DataFrame,
    neighbours: DataFrame,
    stats: DataFrame,
    train_mean: Column,
    lo: float = MIN_RATING,
    hi: float = MAX_RATING,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    materialized_inputs: bool = False,
) -> DataFrame:
    """Scored test rows: user_id, item_id, true_rating, prediction, denom,
    neighbor_count, is_fallback.

    ``centered`` holds *all* training ratings with ``centered_rating``
    (every training rating predicts, whoever teaches), and
    ``neighbours`` is the top-k table of :func:`top_neighbours`, met with the
    user's ratings as in :func:`listed_candidates`. A (user, item) is
    predicted once, and every test row of it gets that prediction, after its
    ``prediction_id`` where it has one.
    """
    ids = [c for c in test.columns if c == PREDICTION_ID]
    t = test.select(
        *ids, "user_id", F.col("item_id").alias("target_item"), F.col("rating").alias("true_rating")
    )
    cand = listed_candidates(
        t.select("user_id", "target_item").distinct(),
        centered.select("user_id", F.col("item_id").alias("rated_item"), "centered_rating"),
        neighbours.select(
            "target_item", F.col("neighbor_item").alias("rated_item"), "similarity"
        ),
        max_broadcast_rows=max_broadcast_rows,
        materialized_inputs=materialized_inputs,
    )
    pred = cand.groupBy("user_id", "target_item").agg(
        F.sum(F.col("similarity") * F.col("centered_rating")).alias("weighted_sum"),
        F.sum(F.abs("similarity")).alias("denom"),
        F.count(F.lit(1)).alias("neighbor_count"),
    )
    base = F.coalesce(F.col("user_mean"), train_mean)
    raw = F.when(
        F.col("denom").isNotNull(), base + safe_ratio("weighted_sum", "denom")
    ).otherwise(base)
    scored = t.join(stats.select("user_id", "user_mean"), "user_id", "left").join(
        pred, ["user_id", "target_item"], "left"
    )
    return scored.select(
        *ids,
        "user_id",
        F.col("target_item").alias("item_id"),
        "true_rating",
        clip(raw, lo, hi).alias("prediction"),
        "denom",
        F.coalesce(F.col("neighbor_count"), F.lit(0)).cast("bigint").alias("neighbor_count"),
        F.col("denom").isNull().alias("is_fallback"),
    )
