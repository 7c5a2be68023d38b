"""Connected components of a distributed edge list."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.session import materialize

#: Edges that one task contracts at once; the number of tasks follows the number of edges.
TASK_EDGES = 500_000


def _contract(edges: DataFrame, tasks: int) -> DataFrame:
    """(u, v): each id of a task's edges but the smallest of its component, and that smallest."""

    def run(batches):
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := up.setdefault(x, x)) != x:
                up[x] = x = up[p]
            return x

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, y = root(x), root(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        ids = [x for x in up if root(x) != x]
        for k in range(0, len(ids), 100_000):
            part = ids[k : k + 100_000]
            yield pa.RecordBatch.from_pydict({"u": pa.array(part, pa.int64()), "v": pa.array([root(x) for x in part], pa.int64())})

    return edges.coalesce(tasks).mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", task_edges: int = TASK_EDGES) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (checkpointed or written): the smallest id reachable.

    Tasks first contract their own edges to one edge an id; if one task held all
    of them, that is the result. Otherwise alternating stars join the tasks' parts:
    large-star hangs every larger neighbour of a node on its smallest neighbour, small-star
    the smaller ones. Both only need a minimum per node (partially aggregated) and an
    equi-join with that one row a node, so no neighbour list is ever gathered. Each round
    is checkpointed in the shared folder and contracted again; the rounds grow with
    the logarithm of the number of nodes.
    """
    e = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    tasks = max(1, -(-e.count() // task_edges))
    e = materialize(_contract(e, tasks))
    seen = None
    while tasks > 1:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = materialize(small)
        state = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == seen:
            break
        seen = state
        if state["n"] <= task_edges:
            e, tasks = materialize(_contract(e, 1)), 1
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component_id", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
