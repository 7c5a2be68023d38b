"""Item-item similarity from co-rating users.

The norms are taken over co-rating users only: for a pair (i, j) the sums
``sum(ri*rj)``, ``sum(ri^2)``, ``sum(rj^2)`` run over the users who rated
both items.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from ratekit.functions.columns import safe_ratio
from ratekit.session import persist_tracked
from ratekit.operators.joins import (
    DEFAULT_BLOCK_SIZE,
    DEFAULT_MAX_BROADCAST_ROWS,
    blocked_join,
    dealt,
    heavy_keys,
    partitions_for,
    shuffle_partitions,
    spread,
)
from ratekit.operators.overlap import overlap_pair_sums

# Reference thresholds.
MIN_COMMON_USERS = 5
TOP_K = 30
# Only the ranking key is rounded, to this many decimals, so that neighbour lists
# do not depend on summation order; filters and predictions use the full value.
RANK_DECIMALS = 10
# A similarity within this of 0 is a sum that cancelled, not a similarity.
ZERO = 1e-12
#: Rating pairs that one task forms and sums.
PAIRS_PER_TASK = 1 << 20
#: Rating pairs that one task writes as lists: 64 MB before compression, which its sorter holds without a spill.
PAIRS_PER_LIST_TASK = 1 << 22
#: Different ratings, at most, that travel as numbers.
MAX_VALUES = 1 << 6
# Item numbers are mixed by this odd factor, and hold so many bits at most.
_MIX = 0x9E3779B1
_ITEM_BITS = 31


def user_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    """(user_id, n_train, n_test) in one partially aggregated pass.

    The skew checks of the self-join and of the test x train join both read
    it, so a pipeline counts once.
    """
    return (
        train.select("user_id", F.lit(1).alias("_tr"), F.lit(0).alias("_te"))
        .unionByName(test.select("user_id", F.lit(0).alias("_tr"), F.lit(1).alias("_te")))
        .groupBy("user_id")
        .agg(F.sum("_tr").cast("bigint").alias("n_train"), F.sum("_te").cast("bigint").alias("n_test"))
    )


def user_stats(train: DataFrame) -> DataFrame:
    """(user_id, train_rating_count, user_mean) over all training ratings."""
    return train.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("train_rating_count"),
        F.avg("rating").alias("user_mean"),
    )


def centered_ratings(train: DataFrame, stats: DataFrame, n: int = 0) -> DataFrame:
    """Training ratings with ``centered_rating = rating - user_mean``.

    Keeps ``train_rating_count`` so callers can select who teaches similarity.
    A hot user is a skewed key of this join; AQE splits it (the stats side
    has one row per user). ``n``: partitions (:func:`partitions_for`).
    """
    return spread(train, n, "user_id").join(spread(stats, n, "user_id"), "user_id", "inner").select(
        "user_id",
        "item_id",
        "rating",
        "train_rating_count",
        "user_mean",
        (F.col("rating") - F.col("user_mean")).alias("centered_rating"),
    )


def co_rating_pairs(
    rated: DataFrame,
    value_col: str = "rating",
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_user_ratings: int | None = None,
    user_counts: DataFrame | None = None,
    min_common: int = 1,
) -> DataFrame:
    """(user_id, item_i, r_i, item_j, r_j) for every user and item_i < item_j.

    Items with fewer than ``min_common`` rows cannot reach that many common users;
    they are dropped first, which takes the long tail of items out of the quadratic
    part exactly. The output is sum_u n_u*(n_u-1)/2 rows. Users with more than
    ``block_size`` ratings are split into blocks so no task receives a whole
    heavy user; when a cap on ratings per user is known to be within the
    block size, no blocking is needed and the plain join is used.
    """
    if min_common > 1:
        enough = rated.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= F.lit(min_common))
        rated = rated.join(enough.select("item_id"), "item_id", "left_semi")
    heavy = None
    if max_user_ratings is None or max_user_ratings > block_size:
        if user_counts is not None:  # (user_id, n_train) computed once by the caller
            counts = user_counts.select("user_id", F.col("n_train").alias("_n"))
        else:
            counts = rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
        heavy = heavy_keys(counts, "user_id", "_n", "_n", block_size)
        heavy = persist_tracked(heavy)
        if heavy.count() == 0:
            heavy = None
    # Without heavy users blocked_join hash-partitions both sides on user with
    # a pinned partition count: the output is quadratic in the input, and
    # AQE's input-size coalescing would otherwise starve the pair aggregation.
    left = rated.select(
        "user_id", F.col("item_id").alias("item_i"), F.col(value_col).alias("r_i")
    )
    right = rated.select(
        "user_id", F.col("item_id").alias("item_j"), F.col(value_col).alias("r_j")
    )
    pairs = blocked_join(left, right, "user_id", heavy, ["item_i"], ["item_j"])
    return pairs.filter(F.col("item_i") < F.col("item_j"))


def block_count(parts: int, largest: int, block_size: int) -> int:
    """Item blocks for :func:`pair_sums`: four times as many block pairs as its ``parts`` partitions, and
    enough of them that the largest user has about ``block_size`` ratings a block."""
    return max(math.ceil(math.sqrt(8 * parts)), math.ceil(largest / block_size), 1)


def packed_ratings(rated: DataFrame, value_col: str, n_blocks: int, by_user: bool = False, n: int = 0) -> DataFrame:
    """(user_id, block, entries): a user's ratings of one item block as an array of (item, r).
    ``n``: partitions (:func:`partitions_for`)."""
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int")
    entry = F.struct(F.col("item_id").alias("item"), F.col(value_col).alias("r"))
    src = rated.select("user_id", block.alias("block"), entry.alias("_e"))
    if not by_user:
        # No fixed number: a small table is packed by few tasks (AQE keeps the cluster's parallelism).
        src = dealt(src, n, "user_id")
    # Partitioned by user: packing and the join of a user's blocks need no other shuffle.
    return src.groupBy("user_id", "block").agg(F.collect_list("_e").alias("entries"))


def _block_pairs(packed: DataFrame) -> DataFrame:
    """(bi, bj, vi, vj) for every user and every two of the user's blocks, bi <= bj."""
    left = packed.select("user_id", F.col("block").alias("bi"), F.col("entries").alias("vi"))
    right = packed.select("user_id", F.col("block").alias("bj"), F.col("entries").alias("vj"))
    return left.join(right, "user_id").filter(F.col("bi") <= F.col("bj")).drop("user_id")


def _spread_block_pairs(packed: DataFrame, n_blocks: int) -> DataFrame:
    """The same for users whose ratings should not meet in one task: every block is sent
    to all block pairs it belongs to, where the two sides of a user meet."""
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_x")
    sent = packed.select("user_id", "block", "entries", other)
    mine, x = F.col("block"), F.col("_x")
    first = mine <= x
    sides = sent.select(
        "user_id",
        F.least(mine, x).alias("bi"),
        F.greatest(mine, x).alias("bj"),
        F.when(first, F.col("entries")).alias("vi"),
        F.when(mine >= x, F.col("entries")).alias("vj"),
    )
    met = sides.groupBy("user_id", "bi", "bj")
    return (
        met.agg(F.first("vi", ignorenulls=True).alias("vi"), F.first("vj", ignorenulls=True).alias("vj"))
        .filter("vi IS NOT NULL AND vj IS NOT NULL")
        .drop("user_id")
    )


def listed_pairs(rated: DataFrame, value_col: str, block_size: int, heavy: DataFrame | None, by_user: bool = False, n: int = 0) -> DataFrame:
    """(item_i, r_i, items, rs): every rating with the user's ratings of all later items, as arrays.

    A pair is one array entry of 16 bytes, whatever the number of tasks. A user in ``heavy`` (user_id, _k) is
    cut into _k chunks by item; every two chunks are one list, so no task meets the whole user. A
    boolean ``in_prefix`` of ``rated`` comes along as p_i and ps. ``n`` as in :func:`packed_ratings`.
    """
    values = {"item": "items", "r": "rs"} | ({"p": "ps"} if "in_prefix" in rated.columns else {})
    flag = [F.col("in_prefix").alias("p")] if "p" in values else []
    src = rated.select("user_id", F.col("item_id").alias("item"), F.col(value_col).alias("r"), *flag)
    src = src.filter("user_id IS NOT NULL AND item IS NOT NULL")
    entry = F.struct(*values)

    def listed(lists: DataFrame, later) -> DataFrame:
        at = lists.select("*", F.posexplode("v").alias("_at", "e"))
        at = at.withColumn("later", later(F.slice("v", F.col("_at") + 2, F.size("v")))).filter(F.size("later") > 0)
        return at.select(*[F.col(f"e.{v}").alias(f"{v}_i") for v in values], *[F.col(f"later.{v}").alias(m) for v, m in values.items()])

    light = src if heavy is None else src.join(heavy, "user_id", "left_anti")
    light = light if by_user else dealt(light, n, "user_id")
    rows = listed(light.groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("v")), lambda later: later)
    if heavy is not None:
        mine, x = F.col("_c"), F.col("_x")
        cut = src.join(heavy, "user_id").withColumn("_c", F.pmod(F.xxhash64("item"), F.col("_k")).cast("int"))
        entry = F.struct(*values, "_c")
        cut = dealt(cut.select("user_id", "_k", "_c", entry.alias("e")), n, "user_id", "_c")
        chunks = cut.groupBy("user_id", "_c", "_k").agg(F.collect_list("e").alias("es"))
        sent = chunks.withColumn("_x", F.explode(F.sequence(F.lit(0), (F.col("_k") - 1).cast("int"))))
        sent = sent.select("user_id", F.least(mine, x).alias("_a"), F.greatest(mine, x).alias("_b"), "es")
        met = dealt(sent, n, "user_id", "_a", "_b").groupBy("user_id", "_a", "_b")
        unit = met.agg(F.sort_array(F.flatten(F.collect_list("es"))).alias("v"))
        # Within one chunk all pairs, of two chunks those between them.
        between = lambda later: F.filter(later, lambda y: y["_c"] != F.col("e._c"))
        rows = rows.unionByName(listed(unit, lambda later: F.when(F.col("_a") == F.col("_b"), later).otherwise(between(later))))
    return rows


@dataclass(frozen=True)
class Packing:
    """(item, value) as one whole number, which takes 4 or 8 bytes of an array.

    Items are numbered from ``low`` and the numbers mixed: multiplied modulo 2 ** ``bits``, which the inverse
    undoes. So equal cuts of their range hold about equally many items however the ids are spread.
    Below the item's number stands the place of the value among ``values``; one place more is null. With
    ``flag``, a boolean column, the lowest bit is that.
    """

    low: int
    bits: int
    values: tuple
    item_type: str
    value_type: str
    flag: str | None = None

    @property
    def flags(self) -> int:
        return 0 if self.flag is None else 1

    @property
    def places(self) -> int:
        return len(self.values).bit_length() + self.flags

    def _values(self) -> Column:
        return F.array(*[F.lit(v).cast(self.value_type) for v in self.values])

    def entry(self, item: str, value: str) -> Column:
        number = ((F.col(item).cast("bigint") - F.lit(self.low)) * F.lit(_MIX)).bitwiseAND(F.lit((1 << self.bits) - 1))
        place = F.coalesce(F.array_position(self._values(), F.col(value)) - 1, F.lit(len(self.values)).cast("bigint"))
        if self.flag is not None:
            place = F.shiftleft(place, 1) + F.col(self.flag).cast("bigint")
        return (F.shiftleft(number, self.places) + place).cast("int" if self.bits + self.places <= 31 else "bigint")

    def number(self, entry: str) -> Column:
        return F.shiftright(entry, self.places)

    def value(self, entry: str) -> Column:
        place = F.shiftright(F.col(entry).bitwiseAND(F.lit((1 << self.places) - 1)), self.flags)
        return F.get(self._values(), place.cast("int"))

    def flagged(self, entry: str) -> Column:
        return F.col(entry).bitwiseAND(F.lit(1)) == 1

    def item(self, number: str) -> Column:
        mask = (1 << self.bits) - 1
        back = (F.col(number).cast("bigint") * F.lit(pow(_MIX, -1, 1 << self.bits))).bitwiseAND(F.lit(mask))
        return (back + F.lit(self.low)).cast(self.item_type)


def packing_of(rated: DataFrame, value_col: str, flag: str | None = None) -> Packing | None:
    """The packing of ``rated``; None if its items are no whole numbers within 2 ** 31 of each other or
    its values are more than ``MAX_VALUES`` (continuous ones). ``flag`` names a boolean that is to come along."""
    item_type, value_type = rated.schema["item_id"].dataType, rated.schema[value_col].dataType
    if not isinstance(item_type, IntegralType) or not isinstance(value_type, NumericType):
        return None
    ends = rated.filter("item_id IS NOT NULL").groupBy(F.col(value_col).alias("v"))
    found = ends.agg(F.min("item_id").alias("low"), F.max("item_id").alias("high")).limit(MAX_VALUES + 2).collect()
    values = tuple(sorted(r.v for r in found if r.v is not None))
    if not 0 < len(values) <= MAX_VALUES:
        return None
    low = min(r.low for r in found)
    bits = max((max(r.high for r in found) - low).bit_length(), 1)
    return Packing(low, bits, values, item_type.simpleString(), value_type.simpleString(), flag) if bits <= _ITEM_BITS else None


def packed_pairs(
    rated: DataFrame, value_col: str, shift: str | None, packing: Packing, heavy: DataFrame | None, by_user: bool = False, n: int = 0
) -> DataFrame:
    """(e, later): every rating with the user's ratings of all later items, as entries of ``packing``.

    As :func:`listed_pairs`, in 4 bytes a pair where the items allow; later is by mixed number. ``shift``, a column that is
    one value a user, comes along once a list. The chunks of a ``heavy`` user are ranges of mixed numbers, so of two
    chunks every item of the first meets the whole second as one list.
    """
    more = [F.col(shift).alias("shift")] if shift else []
    kept = [F.first("shift").alias("shift")] if shift else []
    src = rated.filter("user_id IS NOT NULL AND item_id IS NOT NULL")
    src = src.select("user_id", packing.entry("item_id", value_col).alias("e"), *more)

    def listed(lists: DataFrame, other: Column) -> DataFrame:
        names = ["shift"] if shift else []
        at = lists.select(*names, "v", other.alias("w"), F.posexplode("v").alias("_at", "e"))
        at = at.withColumn("later", F.coalesce("w", F.slice("v", F.col("_at") + 2, F.size("v"))))
        return at.filter(F.size("later") > 0).select("e", *names, "later")

    light = src if heavy is None else src.join(heavy, "user_id", "left_anti")
    light = light if by_user else dealt(light, n, "user_id")
    light = light.groupBy("user_id").agg(F.sort_array(F.collect_list("e")).alias("v"), *kept)
    rows = listed(light, F.lit(None).cast(light.schema["v"].dataType))
    if heavy is not None:
        names = ["shift"] if shift else []
        mine, x = F.col("_c"), F.col("_x")
        chunk = F.shiftright(packing.number("e").cast("bigint") * F.col("_k"), packing.bits).cast("int").alias("_c")
        cut = dealt(src.join(heavy, "user_id").select("user_id", "_k", chunk, "e", *names), n, "user_id", "_c")
        chunks = cut.groupBy("user_id", "_c", "_k").agg(F.sort_array(F.collect_list("e")).alias("es"), *kept)
        sent = chunks.withColumn("_x", F.explode(F.sequence(F.lit(0), (F.col("_k") - 1).cast("int"))))
        sent = sent.select("user_id", F.least(mine, x).alias("_a"), F.greatest(mine, x).alias("_b"), F.struct("_c", "es").alias("_s"), *names)
        met = dealt(sent, n, "user_id", "_a", "_b").groupBy("user_id", "_a", "_b")
        unit = met.agg(F.sort_array(F.collect_list("_s")).alias("s"), *kept).filter((F.col("_a") == F.col("_b")) | (F.size("s") == 2))
        # Within one chunk all pairs, of two chunks those between them.
        unit = unit.withColumn("v", F.get("s", F.lit(0))["es"])
        rows = rows.unionByName(listed(unit, F.get("s", F.lit(1))["es"]))
    return rows


def packed_sums(rows: DataFrame, parts: int, packing: Packing, *more: Column) -> DataFrame:
    """The sums of :func:`packed_pairs`, each formed in the task of its first item. ``more``: sums besides, of
    the flags p_i and p_j too; they should not depend on which of two items is the first."""
    shifts = [c for c in rows.columns if c == "shift"]
    met = dealt(rows, parts, packing.number("e")).select("e", *shifts, F.explode("later").alias("f"))
    value = lambda e: packing.value(e) - F.col("shift") if shifts else packing.value(e)
    flags = [] if packing.flag is None else [packing.flagged("e").alias("p_i"), packing.flagged("f").alias("p_j")]
    met = met.select(packing.number("e").alias("item_i"), packing.number("f").alias("item_j"), value("e").alias("r_i"), value("f").alias("r_j"), *flags)
    sums = _sums(met.filter(F.col("item_i") < F.col("item_j")), more=more)
    a, b = packing.item("item_i"), packing.item("item_j")
    sq_i, sq_j = F.col("sq_i"), F.col("sq_j")
    return sums.select(
        F.least(a, b).alias("item_i"),
        F.greatest(a, b).alias("item_j"),
        "common_users",
        "dot",
        F.when(a < b, sq_i).otherwise(sq_j).alias("sq_i"),
        F.when(a < b, sq_j).otherwise(sq_i).alias("sq_j"),
        *sums.columns[6:],
    )


def pair_sums(
    rated: DataFrame,
    value_col: str = "rating",
    block_size: int = DEFAULT_BLOCK_SIZE,
    max_user_ratings: int | None = None,
    user_counts: DataFrame | None = None,
    by_user: bool = False,
    n_blocks: int | None = None,
    pairs_per_task: int = PAIRS_PER_TASK,
    difference: tuple[str, str] | None = None,
) -> DataFrame:
    """(item_i, item_j, common_users, dot, sq_i, sq_j) of all pairs item_i < item_j with a common user.

    A blocked Gram product. Items are dealt into blocks, every user's ratings of a block are packed
    into one row, and a user's packed rows meet two by two. These block pairs, not the rating
    pairs, are shuffled, to the task of their two blocks; the pairs are formed and summed there, and no
    sum leaves it. So ratings are read and shuffled once, and a rating travels once for
    each block of its user, while a shuffle of partial sums would carry nearly every pair from
    every task.

    Users with more than ``block_size`` ratings do not meet in one task: their blocks, of about
    ``block_size`` ratings at most, are sent to their block pairs directly. ``by_user`` says that ``rated``
    is stored by user (see ``ratekit.sources.store``), so not even the first shuffle is made.

    A task forms ``pairs_per_task`` pairs at most, in more partitions than the session's if need be. Beyond one such
    task, where blocks would cut users of few ratings into single ratings, these
    travel as :func:`packed_pairs`, or as :func:`listed_pairs` where nothing can be packed. ``difference`` says
    that the value is one column less another that is one value a user: these two travel instead.
    """
    if user_counts is not None:  # (user_id, n_train) computed once by the caller
        counts = user_counts.select("user_id", F.col("n_train").alias("_n"))
    else:
        counts = rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    if max_user_ratings is not None:
        counts = counts.filter(F.col("_n") <= F.lit(max_user_ratings))
    n_heavy, largest, n_ratings, n_pairs = sizes(counts, block_size)
    heavy = persist_tracked(counts.filter(F.col("_n") > F.lit(block_size))) if n_heavy else None
    hinted = F.broadcast if n_heavy <= DEFAULT_MAX_BROADCAST_ROWS else lambda df: df
    parts, n = partitions_for(rated, n_pairs, pairs_per_task), partitions_for(rated, n_ratings)
    blocks = n_blocks or block_count(max(parts, shuffle_partitions(rated)), largest, block_size)
    if n_blocks is None and n_pairs > pairs_per_task and n_pairs <= 2 * blocks * n_ratings:
        # The buckets that ratings are stored in follow the rows; where their lists are too long, they are dealt again.
        buckets, n = max(n, shuffle_partitions(rated)), max(n, partitions_for(rated, n_pairs, PAIRS_PER_LIST_TASK))
        by_user = by_user and n <= buckets
        chunks = None if heavy is None else hinted(heavy.select("user_id", F.ceil(F.col("_n") / F.lit(block_size)).alias("_k")))
        value, shift = difference or (value_col, None)
        packing = packing_of(rated, value)
        if packing is not None:
            return packed_sums(packed_pairs(rated, value, shift, packing, chunks, by_user, n), parts, packing)
        return listed_sums(listed_pairs(rated, value_col, block_size, chunks, by_user, n), parts)
    if heavy is None:
        cells = _block_pairs(packed_ratings(rated, value_col, blocks, by_user, n))
    else:
        hv = hinted(heavy.select("user_id"))
        light = packed_ratings(rated.join(hv, "user_id", "left_anti"), value_col, blocks, by_user, n)
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
        entry = F.struct(F.col("item_id").alias("item"), F.col(value_col).alias("r")).alias("_e")
        packed = rated.join(hv, "user_id", "left_semi").select("user_id", block, entry)
        packed = packed.groupBy("user_id", "block").agg(F.collect_list("_e").alias("entries"))
        cells = _block_pairs(light).unionByName(_spread_block_pairs(packed, blocks))
    met = dealt(cells, parts, "bi", "bj").select("bi", "bj", F.explode("vi").alias("a"), "vj")
    met = met.select("bi", "bj", "a", F.explode("vj").alias("b"))
    # Within one block every two entries meet twice and each meets itself: one order is kept.
    a, b, rising = F.col("a"), F.col("b"), F.col("a.item") < F.col("b.item")
    met = met.filter((F.col("bi") < F.col("bj")) | rising).select(
        "bi",
        "bj",
        F.least(a.item, b.item).alias("item_i"),
        F.greatest(a.item, b.item).alias("item_j"),
        F.when(rising, a.r).otherwise(b.r).alias("r_i"),
        F.when(rising, b.r).otherwise(a.r).alias("r_j"),
    )
    # Partitioned by block pair: partial and final sums run in one stage.
    return _sums(met, "bi", "bj").drop("bi", "bj")


def sizes(counts: DataFrame, block_size: int) -> tuple[int, int, int, int]:
    """Users above ``block_size``, the largest user, ratings and rating pairs, of (user_id, _n)."""
    size = F.col("_n").cast("double")
    largest, total, pairs = F.max("_n"), F.sum("_n"), F.sum(size * (size - 1) / 2)
    found = counts.agg(F.count_if(F.col("_n") > F.lit(block_size)), largest, total, pairs).first()
    return tuple(int(x or 0) for x in found)


def listed_sums(rows: DataFrame, parts: int, *more: Column) -> DataFrame:
    """The sums of :func:`listed_pairs`, each formed in the task of its first item."""
    values = {"items": "item_j", "rs": "r_j"} | ({"ps": "p_j"} if "ps" in rows.columns else {})
    met = dealt(rows, parts, "item_i").select(*[c for c in rows.columns if c not in values], F.explode(F.arrays_zip(*values)).alias("b"))
    met = met.select(*[c for c in rows.columns if c not in values], *[F.col(f"b.{m}").alias(c) for m, c in values.items()])
    return _sums(met.filter(F.col("item_i") < F.col("item_j")), more=more)


def _sums(pairs: DataFrame, *within: str, more: Sequence[Column] = ()) -> DataFrame:
    return pairs.groupBy(*within, "item_i", "item_j").agg(
        F.count(F.lit(1)).alias("common_users"),
        F.sum(F.col("r_i") * F.col("r_j")).alias("dot"),
        F.sum(F.col("r_i") * F.col("r_i")).alias("sq_i"),
        F.sum(F.col("r_j") * F.col("r_j")).alias("sq_j"),
        *more,
    )


def _with_similarity(sums: DataFrame) -> DataFrame:
    return sums.withColumn("similarity", safe_ratio(F.col("dot"), F.sqrt(F.col("sq_i") * F.col("sq_j"))))


def rank_key(abs_similarity: str = "abs_similarity") -> Column:
    """|similarity| as neighbour lists order it."""
    return F.round(F.col(abs_similarity), RANK_DECIMALS)


def cosine_similarity(
    train: DataFrame,
    min_common: int = MIN_COMMON_USERS,
    block_size: int = DEFAULT_BLOCK_SIZE,
    user_counts: DataFrame | None = None,
    by_user: bool = False,
    method: str = "gram",
) -> DataFrame:
    """Half matrix (item_i < item_j) of raw-rating cosine similarity.

    Keeps pairs with ``common_users >= min_common`` and ``similarity > 0``.
    ``user_counts`` (user_id, n_train, ...) may be passed to reuse counts. ``method``: ``gram``
    forms all pairs (:func:`pair_sums`), ``overlap`` those that can reach ``min_common``, for long-tailed
    items (:mod:`ratekit.operators.overlap`).
    """
    if method == "overlap":
        sums = overlap_pair_sums(train, "rating", min_common, block_size=block_size, user_counts=user_counts)
    elif method == "gram":
        sums = pair_sums(train, "rating", block_size=block_size, user_counts=user_counts, by_user=by_user)
    else:
        raise ValueError(f"unknown method {method!r}")
    s = _with_similarity(sums)
    return s.filter(
        (F.col("common_users") >= F.lit(min_common)) & (F.col("similarity") > F.lit(ZERO))
    ).select("item_i", "item_j", "similarity", "common_users")


def adjusted_cosine_similarity(
    centered: DataFrame,
    min_common: int = MIN_COMMON_USERS,
    max_user_ratings: int | None = None,
    min_user_ratings: int = 2,
    block_size: int = DEFAULT_BLOCK_SIZE,
    user_counts: DataFrame | None = None,
    by_user: bool = False,
    method: str = "gram",
) -> DataFrame:
    """Half matrix of user-centred (adjusted) cosine similarity.

    ``centered`` comes from :func:`centered_ratings`. Only users with
    ``min_user_ratings <= train_rating_count <= max_user_ratings`` teach
    similarity; by default there is no upper cap. Keeps pairs with enough common
    users, non-zero norms and a non-zero similarity (negative ones stay). ``method`` as in
    :func:`cosine_similarity`.
    """
    teach = centered.filter(F.col("train_rating_count") >= F.lit(min_user_ratings))
    if max_user_ratings is not None:
        teach = teach.filter(F.col("train_rating_count") <= F.lit(max_user_ratings))
    difference = ("rating", "user_mean") if {"rating", "user_mean"} <= set(teach.columns) else None
    if method == "overlap":
        sums = overlap_pair_sums(teach, "centered_rating", min_common, block_size=block_size, difference=difference)
    elif method == "gram":
        sums = pair_sums(
            teach,
            "centered_rating",
            block_size=block_size,
            max_user_ratings=max_user_ratings,
            user_counts=user_counts,
            by_user=by_user,
            difference=difference,
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    s = _with_similarity(sums)
    return s.filter(
        (F.col("common_users") >= F.lit(min_common))
        & (F.col("sq_i") > F.lit(0.0))
        & (F.col("sq_j") > F.lit(0.0))
        & (F.abs("similarity") > F.lit(ZERO))
    ).select("item_i", "item_j", "similarity", "common_users")


def mirror(sim: DataFrame) -> DataFrame:
    """Both directions of a half matrix, plus ``abs_similarity``.

    One pass: every pair row is exploded into (i, j) and (j, i). Unlike a
    union of the table with its swapped copy, the (possibly unmaterialised)
    similarity plan is evaluated once.
    """
    both = F.explode(
        F.array(
            F.struct(F.col("item_i").alias("a"), F.col("item_j").alias("b")),
            F.struct(F.col("item_j").alias("a"), F.col("item_i").alias("b")),
        )
    ).alias("_d")
    return sim.select(both, "similarity", "common_users").select(
        F.col("_d.a").alias("item_i"),
        F.col("_d.b").alias("item_j"),
        "similarity",
        "common_users",
        F.abs("similarity").alias("abs_similarity"),
    )


def top_neighbours(sim_all: DataFrame, k: int = TOP_K) -> DataFrame:
    """Per target item the ``k`` neighbours with the largest |similarity|.

    Ties: more common users first, then the smaller neighbour id. Planned as
    partial + final WindowGroupLimit, so a popular item ships at most ``k``
    rows per map task to the ranking shuffle.
    """
    w = Window.partitionBy("item_i").orderBy(
        rank_key().desc(), F.col("common_users").desc(), F.col("item_j").asc()
    )
    return (
        sim_all.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= F.lit(k))
        .select(
            F.col("item_i").alias("target_item"),
            F.col("item_j").alias("neighbor_item"),
            "similarity",
            "abs_similarity",
            "common_users",
            F.col("_rank").cast("bigint").alias("neighbor_rank"),
        )
    )


def neighbour_summary(neighbours: DataFrame) -> DataFrame:
    """One row: neighbour_rows, learned_items (targets with at least one
    neighbour). Both are partially aggregated."""
    return neighbours.agg(
        F.count(F.lit(1)).alias("neighbour_rows"),
        F.count_distinct("target_item").alias("learned_items"),
    )
