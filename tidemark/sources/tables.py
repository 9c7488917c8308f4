"""Catalog tables: external, Parquet, partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions import quoted
from tidemark.schema import ORDERS, PARTITION
from tidemark.sources import files

# Spark takes frames that do not come from files to be of its largest number of bytes.
UNKNOWN_SIZE = 1024**5


def name_parts(spark: SparkSession, identifier: str) -> list[str]:
    """The names in a SQL identifier such as ``raw.orders``, as Spark's parser reads it."""
    parts = spark._jsparkSession.sessionState().sqlParser().parseMultipartIdentifier(identifier)
    return [parts.apply(i) for i in range(parts.size())]


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Make a database unless it exists; its own folder stays empty, as all tables are external."""
    where = f"LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} {where}")


def ensure_table(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType = ORDERS,
    partition_by: Sequence[str] = (PARTITION,),
    replace_partitions: bool = False,
) -> None:
    """Register the external table ``database.name`` at ``location`` unless it exists.

    With ``replace_partitions``, overwriting replaces the partitions that get rows, else all of them. Partitions that the
    location holds already are registered with a new table.
    """
    if spark.catalog.tableExists(table):
        return
    mode = "dynamic" if replace_partitions else "static"
    partitions = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE EXTERNAL TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"OPTIONS (partitionOverwriteMode '{mode}') {partitions} LOCATION {text_literal(location)}"
    )
    if partition_by and files.list_names(spark, location):
        spark.catalog.recoverPartitions(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget a table. The files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows up to now. A session would else keep the file list of its first read."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def stream_table(spark: SparkSession, table: str, options: dict[str, str] | None = None) -> DataFrame:
    """Rows added to a table since the last micro-batch, from its first row on.

    ``options`` go to the file source, such as ``maxFilesPerTrigger``. A filter on partition columns leaves the other
    partitions' files unread.
    """
    return spark.readStream.options(**(options or {})).table(table)


def partition_numbers(spark: SparkSession, table: str, column: str) -> list[int]:
    """The values of a partition column of numbers, in order, from the catalog alone."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    found = (dict(part.split("=", 1) for part in row["partition"].split("/")) for row in rows)
    return sorted({int(values[column]) for values in found})


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that a plan reads, as Spark estimates them without running it; None if it cannot tell."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_SIZE else None


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, matching columns by name."""
    _insert(df, table, overwrite=False)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace all rows of an existing table that the rows are not read from."""
    _insert(df, table, overwrite=True)


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    columns = df.sparkSession.catalog.listColumns(table)
    rows = df.select(*(quoted(column.name) for column in columns))
    partition_by = [column.name for column in columns if column.isPartition]
    if partition_by:
        # Gather the rows of a partition first, in tasks of even size, else every task leaves
        # a file in every partition folder.
        rows = rows.hint("rebalance", *map(quoted, partition_by))
    # An insert keeps the table's definition and location.
    rows.write.insertInto(table, overwrite=overwrite)
