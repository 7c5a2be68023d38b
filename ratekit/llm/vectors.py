"""Exact near-duplicate join of vectors: cosine at least ``threshold`` within equal labels.

Angles are a metric. Pivots, centred on dense spots of a bounded sample, partition
the vectors of a label: a vector belongs to the nearest pivot within ``rho`` =
r = acos(threshold), or to the label's open cell. By the triangle inequality a vector
of an earlier cell can only link into cell j if its angle to pivot j is at most
rho + r (and at most 2 r more than to its own pivot); only then is it replicated
there, so every pair meets in exactly one cell. Cells are cut into blocks and
block pairs are joined independently, so a hot cell spreads over many tasks.

Copies never become all pairs: equal vectors are one weighted class, and all
vectors within r / 2 of their pivot are linked by the triangle inequality itself, so
they are counted, not compared. Tasks return link counts and a spanning forest
of their links, never the pairs.

Where vectors have no structure in many dimensions no metric partition prunes:
the open cell then holds most vectors and its block join is quadratic.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label, link with nothing (n_links 0, own
component); vectors of different length never link; each of several equal rows counts
as a vector; rows with one vec_id are one node of the components, and their links
add up; a null vec_id links with nothing and is kept (component_id null).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.session import scratch_path

from .common import arrow_map, spread_join
from .components import components

_EPS = 1e-9
OPEN = -1  # cell of the vectors far from every pivot


def _units(col: pa.Array | pd.Series) -> np.ndarray:
    """Rows of one length scaled to norm 1, in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in col]) if len(col) else np.zeros((0, 1))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def choose_pivots(rows: list, angle: float, most: int, least: int) -> dict[tuple[int, int], np.ndarray]:
    """Centres of spots with at least ``least`` sampled vectors within angle / 2, densest first."""
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    out, left = {}, most
    for key in sorted(groups, key=lambda k: (-len(groups[k]), k)):
        x = _units(groups[key])
        near = (x @ x.T) >= np.cos(angle / 2)
        free = np.ones(len(x), bool)
        got = []
        while left:
            n = (near & free[None, :]).sum(axis=1) * free
            i = int(n.argmax())
            if n[i] < least:
                break
            c = x[near[i] & free].mean(axis=0)
            c /= np.linalg.norm(c)
            free &= (x @ c) < np.cos(angle)
            free[i] = False
            got.append(c)
            left -= 1
        if got:
            out[key] = np.stack(got)
    return out


def _cells(classes: DataFrame, pivots: dict, angle: float) -> DataFrame:
    """Own row and boundary replicas of every class: role 0 core, 1 own, 2 replica."""

    def run(batches):
        for b in batches:
            d = b.to_pandas()
            for (label, dim), g in d.groupby(["label", "dim"]):
                p = pivots.get((label, dim))
                n = len(g)
                at, cell, role = np.arange(n), np.full(n, OPEN), np.ones(n, np.int32)
                if p is not None:
                    far = np.arccos(np.clip(_units(g["embedding"]) @ p.T, -1.0, 1.0))
                    near = far.argmin(axis=1)
                    own = far[np.arange(n), near]
                    home = np.where(own <= angle, near, OPEN)
                    core = own <= angle / 2 - _EPS
                    reach = far <= 2 * angle + _EPS
                    reach &= (home == OPEN)[:, None] | (far <= own[:, None] + 2 * angle + _EPS)
                    reach &= np.arange(len(p))[None, :] > home[:, None]
                    i, j = np.nonzero(reach)
                    at = np.concatenate([at, i])
                    cell = np.concatenate([home, j])
                    role = np.concatenate([np.where(core, 0, 1), np.full(len(i), 2)]).astype(np.int32)
                e = g.iloc[at]
                yield pa.RecordBatch.from_pydict(
                    {"label": e["label"].to_numpy(), "dim": e["dim"].to_numpy(), "cell": cell.astype(np.int32), "role": role, "id": e["id"].to_numpy(), "m": e["m"].to_numpy(), "embedding": pa.array(list(e["embedding"]), pa.list_(pa.float64() if e["embedding"].iloc[0].dtype == np.float64 else pa.float32()))}
                )

    kind = classes.schema["embedding"].dataType.simpleString()
    return arrow_map(classes, run, f"label long, dim int, cell int, role int, id long, m long, embedding {kind}")


def _join_block(threshold: float):
    def join(d: pd.DataFrame) -> pd.DataFrame:
        left, right = d[d["side"] == 0], d[d["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")
        ok = (_units(left["embedding"]) @ _units(right["embedding"]).T) >= threshold
        li, ri = left["id"].to_numpy(), right["id"].to_numpy()
        lr, rr = left["role"].to_numpy(), right["role"].to_numpy()
        i, j = np.nonzero(ok)
        other = (li[i] != ri[j]) | (lr[i] == 2)
        i, j = i[other], j[other]
        lm, rm = left["m"].to_numpy(), right["m"].to_numpy()
        links_l = np.bincount(i, rm[j], len(li))
        both = (lr[i] == 2) | (rr[j] == 0)  # else the mirrored block counts the other side
        links_r = np.bincount(j[both], lm[i[both]], len(ri))
        # spanning forest: smallest id over the block's links
        a, b = li.copy(), ri.copy()
        while len(i):
            a2, b2 = a.copy(), b.copy()
            np.minimum.at(a2, i, b[j])
            np.minimum.at(b2, j, a2[i])
            if (a2 == a).all() and (b2 == b).all():
                break
            a, b = a2, b2
        out = pd.DataFrame({"id": np.concatenate([li, ri]), "links": np.concatenate([links_l, links_r]).astype(np.int64), "root": np.concatenate([a, b])})
        return out[(out["links"] > 0) | (out["root"] != out["id"])]

    return join


def _table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def near_vectors(
    embeddings: DataFrame, threshold: float = 0.93, sample: int = 4096, pivots: int = 512, least: int = 6, block: int = 2048
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings`` (vec_id, embedding, label).

    ``sample`` vectors choose at most ``pivots`` pivots; they only steer the partition.
    """
    angle = float(np.arccos(threshold))
    e = F.col("embedding")
    kind = "array<double>" if "double" in embeddings.schema["embedding"].dataType.simpleString() else "array<float>"
    good = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(e, lambda x: x != 0)
    )
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), e.cast(kind).alias("embedding"))
    rows = rows.withColumn("dim", F.size("embedding")).withColumn("ok", F.coalesce(good, F.lit(False)))
    keys = [F.xxhash64(F.lit(s), "label", "embedding").alias(f"k{s}") for s in (1, 2)]
    rows = rows.select("*", *keys)
    classes = rows.filter("ok").groupBy("k1", "k2", "label", "dim").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.min_by("embedding", "vec_id").alias("embedding"))
    classes = _table(classes, "vector-classes")
    chosen = classes.select("label", "dim", "embedding", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(sample).collect()
    cells = _table(_cells(classes.select("id", "m", "label", "dim", "embedding"), choose_pivots(chosen, angle, pivots, least), angle), "vector-cells")
    where = ["label", "dim", "cell"]
    sizes = cells.groupBy(where).agg(
        F.ceil(F.sum((F.col("role") < 2).cast("long")) / block).cast("int").alias("nb"),
        F.ceil(F.sum((F.col("role") > 0).cast("long")) / block).cast("int").alias("na"),
        F.sum(F.when(F.col("role") == 0, F.col("m"))).alias("core_m"),
        F.min(F.when(F.col("role") == 0, F.col("id"))).alias("lead"),
    )
    placed = cells.join(sizes, where)
    spot = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    some = placed.filter("na > 0 AND nb > 0")
    keep = [*where, "id", "m", "role", "embedding"]
    left = some.filter("role > 0").select(*keep, spot(F.col("na")).alias("a"), F.explode(upto(F.col("nb"))).alias("b"), F.lit(0).alias("side"))
    right = some.filter("role < 2").select(*keep, F.explode(upto(F.col("na"))).alias("a"), spot(F.col("nb")).alias("b"), F.lit(1).alias("side"))
    joined = left.unionByName(right).groupBy(*where, "a", "b").applyInPandas(_join_block(threshold), "id long, links long, root long")
    core = placed.filter("role = 0").select("id", (F.col("core_m") - F.col("m")).alias("links"), F.col("lead").alias("root"))
    found = _table(joined.unionByName(core), "vector-links")
    label = components(found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    info = classes.select("k1", "k2", "id", "m").join(counts, "id", "left").join(label, "id", "left")
    info = info.select("k1", "k2", "m", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component_id", "id").alias("c"))
    # invalid vectors meet nothing, and a class of very many equal vectors is broadcast to them
    found = spread_join(rows.filter("ok").select("vec_id", "k1", "k2"), _table(info, "vector-named"), ["k1", "k2"], "m")
    alone = rows.filter("NOT ok").select("vec_id", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("c"))
    out = found.select("vec_id", "n", "c").unionByName(alone)
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings WHERE label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT r.id, l.y FROM r JOIN l ON l.x = r.other),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT t.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.component_id, t.vec_id = m.component_id AS kept
FROM embeddings t LEFT JOIN n ON n.x = t.vec_id JOIN m ON m.id = t.vec_id
"""
