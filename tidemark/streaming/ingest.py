"""Landing files to the raw history table, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import normalize_orders
from tidemark.schema import BATCH, CORRUPT, LANDING, PARTITION, RAW
from tidemark.sources import ensure_database, ensure_table, select_malformed, stream_landing, write_quarantine
from tidemark.sources.tables import name_parts
from tidemark.streaming.batches import bounded, start, table_sink

_FILE = "_file"


def ensure_raw(spark: SparkSession, table: str, location: str) -> None:
    """Register the raw history table: the order columns, by date and then by the batch that brought them."""
    ensure_database(spark, name_parts(spark, table)[0])
    ensure_table(spark, table, location, RAW, (PARTITION, BATCH), replace_partitions=True)


def ingest_raw(
    spark: SparkSession,
    landing: str,
    table: str,
    location: str,
    checkpoint: str,
    schema: T.StructType = LANDING,
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
    rebalance: bool = False,
    errors: str | None = None,
) -> StreamingQuery:
    """Start appending normalised landing records to the raw table, which is made if missing.

    The plan is map-only: scan, project, write. A landing file lies in one date folder, so
    tasks write few files each. ``rebalance`` adds a shuffle by date that merges small output
    files, for a backfill over many dates.

    A micro-batch is one value of the partition column `BATCH` under each date it has. When it is repeated, as after a
    crash, its partitions are replaced. With ``errors``, malformed lines are also written there, outside the landing
    folder, from the same read: the micro-batch is kept until both are written. In the raw table each malformed line is
    a row of NULL fields.

    ``trigger`` takes the arguments of ``DataStreamWriter.trigger``; the default runs until
    stopped, ``{"availableNow": True}`` until the files present now are read. ``options`` are
    those of `stream_landing`, which `bounded` completes. A restart with the same checkpoint reads only new files.
    """
    ensure_raw(spark, table, location)
    if errors is not None:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    records = stream_landing(spark, landing, schema, bounded(options))
    write_raw = table_sink(spark, table, checkpoint, rebalance)
    if errors is None:
        return start(normalize_orders(records), f"ingest {table}", checkpoint, write_raw, trigger)

    def write_both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_raw(normalize_orders(batch, source_file=F.col(_FILE)), batch_id)
            write_quarantine(select_malformed(batch), errors, batch_id)
        finally:
            batch.unpersist()

    parsed = records.select("*", F.col("_metadata.file_path").alias(_FILE))
    return start(parsed, f"ingest {table}", checkpoint, write_both, trigger)
