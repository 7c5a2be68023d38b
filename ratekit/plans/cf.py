"""Item-based collaborative filtering, two models end to end.

* :func:`cosine_knn` - raw-rating cosine, positive similarities only,
  neighbours chosen per prediction among the items the user rated.
* :func:`centered_knn` - adjusted (user-centred) cosine learned from all users
  with two or more training ratings (``max_user_ratings`` can cap that),
  negative similarities kept, a fixed top-k neighbour list per item,
  mean-centred prediction with fallbacks and clipping.

The similarity table (the quadratic part) is checkpointed into the shared
checkpoint folder so later stages never re-run the self-join after an
executor loss.

``cache_inputs`` (default True) persists the split ratings, which the
pipeline reads about eight times (counts, both self-join sides, scalar
subqueries, candidates, scoring). Keep it when the ratings are derived by an
expensive plan; turn it off when they are a plain columnar scan much larger
than the cluster's memory and disk, where re-reading the files with the
pushed-down split predicate is cheaper than caching them. Only the one-row metrics
and per-user counts are kept then. ``CFResult.release`` drops what its pipeline keeps.

``stored=True`` writes train and test once as tables bucketed by user instead of caching them:
self-join, centring and candidates then read them where they lie, without a shuffle of ratings.

``repeated=True`` is for ratings that may hold a (user, item) more than once: the
training rows of a key are averaged, and each test row is scored on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratekit.operators.evaluate import evaluate
from ratekit.operators.joins import DEFAULT_BLOCK_SIZE, partitions_for
from ratekit.operators.predict import MAX_RATING, MIN_RATING, one_rating, predict_centered, predict_knn
from ratekit.operators.similarity import (
    MIN_COMMON_USERS,
    TOP_K,
    adjusted_cosine_similarity,
    centered_ratings,
    cosine_similarity,
    mirror,
    top_neighbours,
    user_counts,
    user_stats,
)
from ratekit.operators.split import holdout, train_summary
from ratekit.session import Kept, keeping, materialize, persist_tracked
from ratekit.sources.store import store_by_user, user_buckets


@dataclass
class CFResult:
    train: DataFrame
    test: DataFrame
    similarity: DataFrame
    sim_all: DataFrame
    scored: DataFrame
    metrics: DataFrame
    stats: DataFrame | None = None
    neighbours: DataFrame | None = None
    kept: Kept | None = field(default=None, repr=False)

    def release(self) -> None:
        """Drop everything that was kept for this result, and nothing of others."""
        if self.kept is not None:
            self.kept.release()


def _owning(model):
    """What a model keeps while it is built belongs to its result."""

    @wraps(model)
    def run(ratings: DataFrame, *args, **kw) -> CFResult:
        with keeping(ratings.sparkSession) as kept:
            result = model(ratings, *args, **kw)
        result.kept = kept
        return result

    return run


def _sides(
    ratings: DataFrame, frac: float, split: str, seed: int | None, cache: bool, repeated: bool, stored: bool
) -> tuple[DataFrame, DataFrame]:
    """(train, test), stored by user or cached."""
    if stored:
        # Read for the number of buckets and for both tables, which have the same: kept until they are written.
        with keeping(ratings.sparkSession) as kept:
            train, test = holdout(ratings, frac=frac, method=split, seed=seed, persist=True)
            rows = train.count() + test.count()
        n = user_buckets(ratings, rows)
        train = one_rating(train, partitions_for(ratings, rows)) if repeated else train
        sides = store_by_user(train, n_buckets=n), store_by_user(test, n_buckets=n)
        kept.release()
        return sides
    train, test = holdout(ratings, frac=frac, method=split, seed=seed, persist=cache)
    if repeated:
        train = one_rating(train)
        train = persist_tracked(train) if cache else train
    return train, test


@_owning
def cosine_knn(
    ratings: DataFrame,
    frac: float = 0.8,
    split: str = "hash",
    seed: int | None = None,
    min_common: int = MIN_COMMON_USERS,
    k: int = TOP_K,
    block_size: int = DEFAULT_BLOCK_SIZE,
    checkpoint: bool = True,
    cache_inputs: bool = True,
    repeated: bool = False,
    stored: bool = False,
) -> CFResult:
    train, test = _sides(ratings, frac, split, seed, cache_inputs, repeated, stored)
    # Per-user counts once: both skew checks (self-join, test x train) read it.
    counts = persist_tracked(user_counts(train, test))
    sim = cosine_similarity(train, min_common=min_common, block_size=block_size, user_counts=counts, by_user=stored)
    if checkpoint:
        sim = materialize(sim)
    sim_all = mirror(sim)
    mean = train_summary(train).getField("mean")
    scored = predict_knn(
        test,
        train,
        sim_all,
        mean,
        k=k,
        block_size=block_size,
        user_counts=counts,
        materialized_inputs=checkpoint,
        by_user=stored,
    )
    # One row: kept, so that reports and the command line score once.
    metrics = persist_tracked(evaluate(scored, train))
    return CFResult(train, test, sim, sim_all, scored, metrics)


@_owning
def centered_knn(
    ratings: DataFrame,
    frac: float = 0.8,
    split: str = "hash",
    seed: int | None = None,
    min_common: int = MIN_COMMON_USERS,
    k: int = TOP_K,
    max_user_ratings: int | None = None,
    lo: float = MIN_RATING,
    hi: float = MAX_RATING,
    block_size: int = DEFAULT_BLOCK_SIZE,
    checkpoint: bool = True,
    cache_inputs: bool = True,
    repeated: bool = False,
    stored: bool = False,
) -> CFResult:
    train, test = _sides(ratings, frac, split, seed, cache_inputs, repeated, stored)
    stats = user_stats(train)
    counts = persist_tracked(user_counts(train, test))
    n = partitions_for(train, counts.agg(F.sum("n_train")).first()[0] or 0)
    # Read by the self-join and by the prediction.
    centered = centered_ratings(train, stats, 0 if stored else n)
    if cache_inputs and not stored:
        stats, centered = persist_tracked(stats), persist_tracked(centered)
    sim = adjusted_cosine_similarity(
        centered,
        min_common=min_common,
        max_user_ratings=max_user_ratings,
        block_size=block_size,
        user_counts=counts,
        by_user=stored,
    )
    if checkpoint:
        sim = materialize(sim)
    sim_all = mirror(sim)
    nb = top_neighbours(sim_all, k=k)
    if checkpoint:
        nb = materialize(nb)
    mean = train_summary(train).getField("mean")
    scored = predict_centered(
        test,
        centered,
        nb,
        stats,
        mean,
        lo=lo,
        hi=hi,
        materialized_inputs=checkpoint,
    )
    metrics = persist_tracked(evaluate(scored, train))
    return CFResult(train, test, sim, sim_all, scored, metrics, stats=stats, neighbours=nb)
