"""Streams that write a micro-batch as partitions of their own, so that a repeated one replaces what it left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schema import BATCH
from tidemark.sources import files
from tidemark.sources.tables import partition_numbers

# Bounds a micro-batch over a long history.
BYTES_PER_TRIGGER = 256 * 1024**3

Sink = Callable[[DataFrame, int], None]


def bounded(options: dict[str, str] | None) -> dict[str, str]:
    """Options of a file source, with `BYTES_PER_TRIGGER` where they set no bound for a micro-batch."""
    options = dict(options or {})
    if not {"maxfilespertrigger", "maxbytespertrigger"} & {name.lower() for name in options}:
        options["maxBytesPerTrigger"] = str(BYTES_PER_TRIGGER)
    return options


def first_number(spark: SparkSession, checkpoint: str, following: int) -> int:
    """The number of a checkpoint's batch 0 in a table whose next number is ``following``.

    Batch ids start again at 0 with a new checkpoint, and numbers must not. The first number stays with the checkpoint.
    A checkpoint that another one has overtaken is refused, as its numbers are taken.
    """
    path = f"{checkpoint}/_first_number"
    if "_first_number" not in files.list_names(spark, checkpoint):
        files.publish_text(spark, path, str(following))
        return following
    first = int(files.read_text(spark, path))
    done = [int(name) for name in files.list_names(spark, f"{checkpoint}/commits") if name.isdigit()]
    # The batch after the last committed one may be written too.
    if following > first + max(done, default=-1) + 2:
        raise ValueError(f"batches of another checkpoint came after those of {checkpoint}")
    return first


def start(stream: DataFrame, name: str, checkpoint: str, sink: Sink, trigger: dict | None, mode: str = "append") -> StreamingQuery:
    """Start ``sink`` on every micro-batch. An error in it fails the query, and a restart repeats that batch."""
    writer = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def append_stream(
    stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, rebalance: bool = False
) -> StreamingQuery:
    """Start appending a stream's rows to a table that is partitioned by `BATCH`, among others, and replaces partitions."""
    write = table_sink(stream.sparkSession, table, checkpoint, rebalance)
    return start(stream, f"append {table}", checkpoint, write, trigger)


def table_sink(spark: SparkSession, table: str, checkpoint: str, rebalance: bool = False) -> Sink:
    columns = spark.catalog.listColumns(table)
    names = [column.name for column in columns]
    partitions = [column.name for column in columns if column.isPartition]
    first = first_number(spark, checkpoint, max(partition_numbers(spark, table, BATCH), default=-1) + 1)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BATCH, F.lit(first + batch_id).cast("long")).select(*names)
        if rebalance:
            rows = rows.hint("rebalance", *partitions)
        rows.write.insertInto(table, overwrite=True)

    return write
