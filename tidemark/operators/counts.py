"""Row counts that the jobs report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import quoted


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows as ``cnt``."""
    return df.agg(F.count("*").alias("cnt"))


def change_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all changes, those left after `latest_per_key`, and the difference.

    Counting groups equals running the window and counting its output, but reads only the
    keys and combines on the map side, whatever share of the rows one key holds.
    """
    per_key = df.groupBy(*map(quoted, keys)).agg(F.count("*").alias("changes"))
    counts = per_key.agg(
        F.coalesce(F.sum("changes"), F.lit(0)).alias("raw_count"),
        F.count("*").alias("dedup_count"),
    )
    return counts.withColumn("removed_count", F.col("raw_count") - F.col("dedup_count"))


def observed_counts(
    df: DataFrame, change: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]
) -> DataFrame:
    """One row: the rows that went into ``change``, those that came out, and the difference, as ``write`` saw them pass.

    No job of its own reads the rows for it. Spark may count rows twice when a lost executor's tasks run again, so these
    are for reports; `change_counts` is exact in any case.
    """
    before, after = Observation(), Observation()
    counted = change(df.observe(before, F.count(F.lit(1)).alias("n"))).observe(after, F.count(F.lit(1)).alias("n"))
    write(counted)
    raw, dedup = before.get["n"], after.get["n"]
    row = df.sparkSession.range(1)
    return row.select(
        F.lit(raw).cast("long").alias("raw_count"),
        F.lit(dedup).cast("long").alias("dedup_count"),
        F.lit(raw - dedup).cast("long").alias("removed_count"),
    )
