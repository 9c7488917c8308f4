"""Feed values to table types. A bad value becomes NULL, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_amount(amount: Column) -> Column:
    """Amount text with a decimal point or comma as DECIMAL(12,2), rounded half up.

    Every comma counts as a decimal point, so ``1,234.56`` has two and becomes NULL, as do
    other text and values out of range.
    """
    return F.replace(amount.cast("string"), F.lit(","), F.lit(".")).try_cast("decimal(12,2)")


def normalize_op(operation: Column) -> Column:
    """``u`` for anything that starts with U or u, ``i`` for all else, NULL included."""
    # One test is enough: whatever does not start with "u" maps to "i".
    return F.when(F.lower(operation.cast("string")).startswith("u"), F.lit("u")).otherwise(F.lit("i"))


def parse_event_ts(timestamp: Column) -> Column:
    """ISO text, with or without fraction or zone, as TIMESTAMP in the session zone (UTC)."""
    return F.try_to_timestamp(timestamp)
