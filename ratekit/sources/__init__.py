"""Sources and sinks: typed CSV readers/writers and the test-table mapping."""

from ratekit.sources.csv import (
    has_line_breaks,
    read_items_csv,
    read_ratings_csv,
    rejected_items_csv,
    rejected_ratings_csv,
    write_csv,
)
from ratekit.sources.store import store_by_user
from ratekit.sources.testdata import cf_ratings, item_ratings, items, load, repeated_ratings, tail_ratings

__all__ = [
    "cf_ratings",
    "has_line_breaks",
    "item_ratings",
    "items",
    "load",
    "read_items_csv",
    "read_ratings_csv",
    "rejected_items_csv",
    "repeated_ratings",
    "rejected_ratings_csv",
    "store_by_user",
    "tail_ratings",
    "write_csv",
]
