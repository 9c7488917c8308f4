"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import quoted


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row of each key with the greatest ``order_by``, ties decided by ``tiebreak``.

    Rows without a time come last; NULL is one key. A frame that lacks a key or the order
    column passes through unchanged.

    Catalyst turns the rank filter into a group limit on both sides of the shuffle: each map
    task sends at most one row per key, so a key that holds a third of all rows costs the
    reducer one row per map task.
    """
    if not {*keys, order_by} <= set(df.columns):
        return df
    newest_first = [F.col(quoted(name)).desc() for name in (order_by, *tiebreak)]
    ranked = Window.partitionBy(*map(quoted, keys)).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")
