"""DataFrame operators: normalise, newest row per key, upsert, counts."""

from tidemark.operators.counts import change_counts, observed_counts, row_count
from tidemark.operators.latest import latest_per_key
from tidemark.operators.normalize import normalize_orders
from tidemark.operators.upsert import matched_updates, unmatched_updates, upsert

__all__ = [
    "change_counts",
    "latest_per_key",
    "matched_updates",
    "normalize_orders",
    "observed_counts",
    "row_count",
    "unmatched_updates",
    "upsert",
]
