"""Bootstrap the current-state table from the raw history."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import latest_per_key, row_count
from tidemark.schema import BATCH
from tidemark.sources import CurrentTable, read_table
from tidemark.sources.tables import partition_numbers, planned_bytes

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    """``status`` is ``loaded``, ``target_not_empty`` or ``source_empty``."""

    status: str
    raw_count: int = 0
    dedup_count: int = 0
    target_count: int = 0

    @property
    def removed_count(self) -> int:
        return self.raw_count - self.dedup_count


def initial_load(spark: SparkSession, raw_table: str, target: CurrentTable) -> LoadResult:
    """Write the newest row per key of the raw table to an empty ``target``, or change nothing.

    Run once, before the upserts are started; the ingest may run. The load reads the raw batches that there are
    when it starts and leaves their last number with the target, and the upserts start behind it. Errors while
    looking at either side fail the load. The rows are shuffled and written once; the counts afterwards read only
    Parquet footers, and unlike counters kept by the tasks they stay exact when tasks run again.
    """
    if not target.is_empty():
        log.warning("%s already has rows; the initial load would duplicate them", target.name)
        return LoadResult("target_not_empty", target_count=_count(target.read()))
    last = max(partition_numbers(spark, raw_table, BATCH), default=-1)
    raw = read_table(spark, raw_table).where(F.col(BATCH) <= last)
    if raw.isEmpty():
        log.warning("no rows in %s", raw_table)
        return LoadResult("source_empty")

    newest = latest_per_key(raw, target.keys, target.order_by, target.tiebreak)
    target.load(newest, planned_bytes(raw) or 0, raw_batch=last)

    loaded = _count(target.read())
    result = LoadResult("loaded", raw_count=_count(raw), dedup_count=loaded, target_count=loaded)
    log.info("loaded %s of %s rows", result.dedup_count, result.raw_count)
    return result


def _count(df: DataFrame) -> int:
    return row_count(df).first()["cnt"]
