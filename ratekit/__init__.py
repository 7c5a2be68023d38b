"""ratekit: rating analytics expressed as Spark DataFrame plans.

Two families of operators, both taking and returning DataFrames:

* value analytics over items with multi-valued tags: explode, items per
  value, rating statistics per (value, item), top-n lists per value;
* item-based collaborative filtering: deterministic hold-out split, mean
  baseline, cosine / adjusted-cosine item similarity from a skew-safe
  blocked self-join, neighbour lists, kNN prediction and evaluation.
"""

from ratekit.session import (
    build_session,
    checkpoint_dir,
    materialize,
    persist_tracked,
    release_cached,
)

__all__ = ["build_session", "checkpoint_dir", "materialize", "persist_tracked", "release_cached"]
