"""Reusable DataFrame operators behind the jobs."""

from tidewatch.operators.limits import cap_per_key
from tidewatch.operators.ranking import top_n_per_window, window_report
from tidewatch.operators.reconcile import earliest_per_key, first_pair_outcomes, interval_match
from tidewatch.operators.sequences import bursts, followed_by, sequence_match, strict_pairs
from tidewatch.operators.windows import (
    windowed_agg, windowed_count, windowed_count_sets, windowed_distinct,
)

__all__ = [
    "cap_per_key", "top_n_per_window", "window_report", "earliest_per_key",
    "first_pair_outcomes", "interval_match", "bursts", "followed_by", "sequence_match", "strict_pairs",
    "windowed_agg", "windowed_count", "windowed_count_sets", "windowed_distinct",
]
