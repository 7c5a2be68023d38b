"""DataFrame operators (each takes and returns DataFrames)."""

from ratekit.operators.evaluate import evaluate
from ratekit.operators.joins import blocked_join, broadcast_if_small, heavy_keys
from ratekit.operators.ordinals import numbered_copies, row_numbers
from ratekit.operators.predict import (
    knn_candidates,
    knn_neighbours,
    predict_centered,
    predict_knn,
    prediction_ids,
)
from ratekit.operators.ranking import LISTS, rating_stats, rating_stats_of, top_lists, top_n
from ratekit.operators.similarity import (
    adjusted_cosine_similarity,
    centered_ratings,
    co_rating_pairs,
    cosine_similarity,
    mirror,
    neighbour_summary,
    pair_sums,
    top_neighbours,
    user_counts,
    user_stats,
)
from ratekit.operators.split import baseline, holdout, split_flag, train_summary
from ratekit.operators.state import batch_state, compact, merge_states, put_batch, read_state, user_stats_of
from ratekit.operators.values import explode_values, value_counts

__all__ = [
    "LISTS",
    "adjusted_cosine_similarity",
    "baseline",
    "batch_state",
    "blocked_join",
    "broadcast_if_small",
    "centered_ratings",
    "co_rating_pairs",
    "compact",
    "cosine_similarity",
    "evaluate",
    "explode_values",
    "heavy_keys",
    "holdout",
    "knn_candidates",
    "knn_neighbours",
    "merge_states",
    "mirror",
    "neighbour_summary",
    "numbered_copies",
    "pair_sums",
    "predict_centered",
    "predict_knn",
    "prediction_ids",
    "put_batch",
    "rating_stats",
    "rating_stats_of",
    "read_state",
    "row_numbers",
    "split_flag",
    "top_lists",
    "top_n",
    "top_neighbours",
    "train_summary",
    "user_counts",
    "user_stats",
    "user_stats_of",
    "value_counts",
]
