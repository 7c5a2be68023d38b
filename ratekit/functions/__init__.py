"""Column-level helpers: all built-in Catalyst expressions, no UDFs."""

from ratekit.functions.columns import (
    clip,
    half_star_rating,
    hash_bucket,
    hash_key32,
    md_cell,
    md_row,
    safe_ratio,
    split_buckets,
)

__all__ = [
    "clip",
    "half_star_rating",
    "hash_bucket",
    "hash_key32",
    "md_cell",
    "md_row",
    "safe_ratio",
    "split_buckets",
]
