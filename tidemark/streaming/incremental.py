"""The raw history table to the current-state table, as a stream of upserts."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schema import BATCH
from tidemark.sources import CurrentTable, stream_table
from tidemark.streaming.batches import bounded, first_number, start

log = logging.getLogger(__name__)


def incremental_upsert(
    spark: SparkSession,
    raw_table: str,
    target: CurrentTable,
    checkpoint: str,
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
    after_batch: Callable[[int, int], None] | None = None,
) -> StreamingQuery:
    """Start upserting the rows of ``raw_table`` into ``target``, one micro-batch at a time.

    After an initial load the stream starts behind the raw batches that the load read: their partitions are not read
    again. Without one it starts at the table's first row. ``options`` are those of `stream_table`, which `bounded` completes. ``after_batch`` is called with the commit and the number of records of each batch once its rows
    are written. An error there or in the write fails the query, and a restart repeats that batch, which replaces
    what it left.
    """
    first = first_number(spark, checkpoint, target.next_commit())
    rows = stream_table(spark, raw_table, bounded(options))
    loaded = target.loaded_through()
    if loaded is not None:
        rows = rows.where(F.col(BATCH) > loaded)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # Counted while the batch is written; a log line does not justify reading it twice.
        seen = Observation()
        if not target.apply(batch.observe(seen, F.count("*").alias("records")), first + batch_id):
            log.info("commit %s is in the base", first + batch_id)
            return
        records = seen.get["records"]
        log.info("commit %s: %s records", first + batch_id, records)
        if after_batch is not None:
            after_batch(first + batch_id, records)

    return start(rows, f"upsert {target.name}", checkpoint, upsert_batch, trigger, mode="update")
