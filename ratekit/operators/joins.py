"""Join helpers for skewed keys and size-checked broadcasts.

``blocked_join`` is an inner equi-join in which every key whose rows exceed
``block_size`` on either side is split into ``nl x nr`` blocks: a left row
goes to block ``(bl, *)`` by a hash of its own columns and is copied to all
``nr`` right blocks, a right row likewise. Each (left, right) row pair meets
in exactly one block, so the result equals the plain join, while a key holding
a third of all rows is spread over many tasks instead of one. Keys below the
threshold are joined plainly; both ways keep the configured number of partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ratekit.operators.lookup import LISTS, MARKS, ROWS, lookup
from ratekit.session import persist_tracked

DEFAULT_BLOCK_SIZE = 4096
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
#: Rows that one task sorts or groups.
ROWS_PER_TASK = 1 << 19
#: Tasks that share ``ROWS_PER_TASK`` rows where the session has partitions for them.
SHARES = 8


def shuffle_partitions(df: DataFrame) -> int:
    """Partition count for joins whose output is much larger than their input.

    The session's ``spark.sql.shuffle.partitions`` as configured; AQE would
    coalesce by the small input, so the count is pinned.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for ``rows``: at most ``per_task`` rows a task, and as many as the session has while a task
    keeps an eighth of that. 1 says that the rows are few, and that AQE may choose.

    AQE chooses by the cores and by the packed size of the rows it reads, up to 64 MB a task: so what a task sorts,
    groups or unpacks would grow with the input, whatever the session's partitions.
    """
    return max(math.ceil(rows / per_task), min(shuffle_partitions(df), math.ceil(SHARES * rows / per_task)), 1)


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` partitioned by ``keys`` into ``n`` partitions, which AQE leaves as they are; below 2 into the session's, which it merges."""
    return df.repartition(n, *keys) if n > 1 else df.repartition(*keys)


def spread(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` partitioned by ``keys`` into ``n`` partitions, and as it is where ``n`` is below 2."""
    return df.repartition(n, *keys) if n > 1 else df


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, persist: bool = True
) -> DataFrame:
    """Count ``df`` and hint a broadcast only under ``max_rows``.

    Above the bound the frame is returned unhinted and joins shuffle (AQE may
    still convert at runtime, behind its own byte threshold). ``persist``
    keeps an expensive plan from running twice (count, then join); pass False
    when ``df`` is already materialised (a checkpoint), where re-reading is
    cheaper than caching it again.
    """
    if persist:
        df = persist_tracked(df)
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def heavy_keys(
    counts: DataFrame,
    key: str,
    left_count: str,
    right_count: str,
    block_size: int = DEFAULT_BLOCK_SIZE,
) -> DataFrame:
    """(key, _nl, _nr) for keys that need more than one block."""
    nl = F.greatest(F.lit(1), F.ceil(F.col(left_count) / F.lit(block_size))).cast("int")
    nr = F.greatest(F.lit(1), F.ceil(F.col(right_count) / F.lit(block_size))).cast("int")
    return (
        counts.select(key, nl.alias("_nl"), nr.alias("_nr"))
        .filter((F.col("_nl") > 1) | (F.col("_nr") > 1))
    )


def blocked_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    heavy: DataFrame | None,
    left_salt: Sequence[str],
    right_salt: Sequence[str],
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    right_placed: bool = False,
    partitions: int = 0,
) -> DataFrame:
    """Inner join on ``key`` with heavy keys split into blocks (see module doc).

    ``heavy`` comes from :func:`heavy_keys`; ``None`` means a plain join.
    Salt columns must identify a row within its key on each side. ``right_placed``
    says that the right side is stored by ``key``: it stays where it is, and the left
    side is shuffled to it. ``partitions``: as many, where they are more than the session's.
    """

    def plain(lt: DataFrame, rt: DataFrame) -> DataFrame:
        if right_placed:
            return lt.join(rt, key, "inner")
        return lt.repartition(n, key).join(rt.repartition(n, key), key, "inner")

    n = max(shuffle_partitions(left), partitions)
    if heavy is not None:
        heavy = persist_tracked(heavy)
        n_heavy = heavy.count()  # cheap when the caller already persisted it
    if heavy is None or n_heavy == 0:
        return plain(left, right)
    hv = F.broadcast(heavy) if n_heavy <= max_broadcast_rows else heavy
    lcols, rcols = left.columns, right.columns
    # Only heavy keys take the blocked way. The others hold at most ``block_size``
    # rows a side, so hashing them by key leaves no task much above the mean.
    light = plain(left.join(hv, key, "left_anti"), right.join(hv, key, "left_anti"))
    l = left.join(hv, key, "inner").select(
        *lcols,
        F.pmod(F.xxhash64(*left_salt), F.col("_nl")).cast("int").alias("_bl"),
        F.explode(F.sequence(F.lit(0), F.col("_nr") - 1)).alias("_br"),
    )
    r = right.join(hv, key, "inner").select(
        *rcols,
        F.explode(F.sequence(F.lit(0), F.col("_nl") - 1)).alias("_bl"),
        F.pmod(F.xxhash64(*right_salt), F.col("_nr")).cast("int").alias("_br"),
    )
    block = [key, "_bl", "_br"]
    blocked = l.repartition(n, *block).join(r.repartition(n, *block), block, "inner").drop("_bl", "_br")
    return light.unionByName(blocked.select(light.columns))


def listed_join(
    lists: DataFrame,
    right: DataFrame,
    key: str,
    item: str,
    listed: str,
    n: int = 0,
    marks: DataFrame | None = None,
    bit: str | None = None,
    order: Sequence[Column] = (),
    k: int | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Inner equi-join on (``key``, ``item``) of the entries in the array ``listed`` of ``lists`` with ``right``.

    ``listed`` holds structs with ``item`` and any values. Lists travel packed to the task of their ``key``, where the
    rows of ``right`` lie, and are looked up and unpacked there (:mod:`ratekit.operators.lookup`). A join on both columns would
    shuffle and sort every entry. ``marks`` (one row a ``key``: _words) says which entries can have rows at
    all: those whose bit, number ``bit`` of the entry, is set. With ``k`` only the ``k`` entries of a list go on whose rows of
    ``right`` come first by ``order`` (ascending, nulls last), numbered from 1 in ``rank``. ``n``: partitions (:func:`partitions_for`).
    """
    entry = lists.schema[listed].dataType.elementType
    kept = [c for c in lists.columns if c not in (key, listed)]
    values = [c for c in right.columns if c not in (key, item)]
    kind = lambda x: F.lit(x).alias("_kind")
    named = lambda cols, name: [F.col(c).alias(f"_{name}_{c}") for c in cols]
    entries = [F.col(listed)[f].alias(f"_list_{f}") for f in entry.names]
    both = lists.filter(F.size(listed) > 0).select(key, kind(LISTS), *named(kept, "row"), *entries)
    rows = right.filter(F.col(item).isNotNull()).select(key, kind(ROWS), F.col(item).alias("_item"), *named(values, "value"))
    both = both.unionByName(rows, allowMissingColumns=True)
    if marks is not None:
        both = both.unionByName(marks.select(key, kind(MARKS), "_words"), allowMissingColumns=True)
    both = dealt(both.filter(F.col(key).isNotNull()), n, key)
    names = both.columns
    # By the names that ``order`` uses, and worked out once a row, not at every comparison.
    both = both.withColumns({item: F.col("_item"), **{v: F.col(f"_value_{v}") for v in values}})
    both = both.select(*names, *[o.alias(f"_order_{i}") for i, o in enumerate(order)])
    both = both.sortWithinPartitions(key, "_kind", *[F.col(f"_order_{i}").asc_nulls_last() for i in range(len(order))]).select(*names)
    # Empty lists, not nulls: at every row Spark's Arrow writer goes over all nulls since the last list.
    plain = [F.coalesce(c.name, F.array().cast(c.dataType)).alias(c.name) if isinstance(c.dataType, ArrayType) else c.name for c in both.schema]
    both = both.select(*plain)
    found = [*entry.fields, *[right.schema[v] for v in values]]
    met = [StructField(f"_met_{f.name}", ArrayType(f.dataType)) for f in found]
    schema = StructType([both.schema[key], *[both.schema[f"_row_{c}"] for c in kept], *met])
    at = both.mapInArrow(lookup(key, kept, item, entry.names, values, bit, k), schema).select("*", F.posexplode(f"_met_{item}").alias("_at", "_it"))
    rest = [F.col("_it").alias(item) if f.name == item else F.get(f"_met_{f.name}", "_at").alias(f.name) for f in found]
    ranked = [] if k is None else [(F.col("_at") + 1).cast("bigint").alias(rank)]
    return at.select(key, *[F.col(f"_row_{c}").alias(c) for c in kept], *rest, *ranked)
