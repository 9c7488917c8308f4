"""Folders, tables and jobs of one run of the pipeline over the derived feed."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.feed import feed_from_events, read_events
from tidemark.plans.initial_load import LoadResult, initial_load
from tidemark.schema import ORDERS
from tidemark.session import scratch_dir
from tidemark.sources import CurrentTable, ensure_database, read_table, write_landing
from tidemark.streaming import ensure_raw, incremental_upsert, ingest_raw

AVAILABLE_NOW = {"availableNow": True}

# The feed lands in three parts, each followed by a run of the streams. Landing order is then
# batch order on any file system, with no reliance on file times. Rows without a date come last.
PARTS = [
    "event_date < DATE '2024-01-11'",
    "event_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-20'",
    "event_date IS NULL OR event_date > DATE '2024-01-20'",
]


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, label: str) -> None:
        self.spark = spark
        self.feed = feed_from_events(read_events(spark, sf_dir))
        self.root = scratch_dir(spark, label)
        self.database = f"tidemark_{uuid4().hex[:12]}"
        ensure_database(spark, self.database, f"{self.root}/database")
        self.landing = f"{self.root}/landing/orders"
        self.raw_table = f"{self.database}.orders"
        self.raw_location = f"{self.root}/raw/orders"
        ensure_raw(spark, self.raw_table, self.raw_location)
        self.processed = f"{self.database}.processed_orders"
        self.current = CurrentTable(spark, self.processed, f"{self.root}/processed/orders")

    def land(self, part: int | None = None) -> None:
        write_landing(self.feed if part is None else self.feed.where(PARTS[part]), self.landing)

    def ingest(self, errors: str | None = None, landing: str | None = None) -> None:
        ingest_raw(
            self.spark,
            landing or self.landing,
            self.raw_table,
            self.raw_location,
            f"{self.root}/checkpoints/raw",
            trigger=AVAILABLE_NOW,
            errors=errors,
        ).awaitTermination()

    def raw(self) -> DataFrame:
        return read_table(self.spark, self.raw_table).select(*ORDERS.fieldNames())

    def initial_load(self) -> LoadResult:
        return initial_load(self.spark, self.raw_table, self.current)

    def upsert(self, checkpoint: str = "processed", after_batch: Callable[[int, int], None] | None = None) -> None:
        incremental_upsert(
            self.spark,
            self.raw_table,
            self.current,
            f"{self.root}/checkpoints/{checkpoint}",
            trigger=AVAILABLE_NOW,
            after_batch=after_batch,
        ).awaitTermination()
