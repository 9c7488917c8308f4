"""Insert-or-replace on key equality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import quoted


def any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, (F.col(quoted(key)).isNull() for key in keys))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with every row of ``updates`` put in, replacing rows of equal key.

    ``updates`` holds one row per key (see `latest_per_key`). The update wins whatever its
    timestamp or operation is, and there is no delete. NULL keys equal nothing: such target
    rows stay and such updates are inserted.

    Both sides are read once and shuffled once, as one union that ranks updates before target rows. Catalyst limits the
    ranks on both sides of that shuffle. Rows with a NULL key are each a group of their own content, so they are
    spread over all tasks. Column pruning and filters on keys reach both scans.
    """
    names = list(map(quoted, target.columns))
    both = target.withColumn("_side", F.lit(0)).unionByName(updates.select(*names).withColumn("_side", F.lit(1)))
    keyless = any_null(keys)
    # Of rows without a key all rank first.
    group = [*map(quoted, keys), F.when(keyless, F.xxhash64(*names))]
    side_first = F.when(~keyless, F.col("_side")).desc()
    ranked = both.withColumn("_rank", F.rank().over(Window.partitionBy(*group).orderBy(side_first)))
    return ranked.where(F.col("_rank") == 1).select(*names)


def matched_updates(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The updates that replace a row of ``target``."""
    return updates.join(target.select(*map(quoted, keys)), list(keys), "left_semi").select(*map(quoted, updates.columns))


def unmatched_updates(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The updates that `upsert` inserts as new rows."""
    return updates.join(target.select(*map(quoted, keys)), list(keys), "left_anti").select(*map(quoted, updates.columns))
