"""Column functions that normalise feed values."""

from tidemark.functions.names import quoted
from tidemark.functions.normalize import normalize_op, parse_amount, parse_event_ts

__all__ = ["normalize_op", "parse_amount", "parse_event_ts", "quoted"]
