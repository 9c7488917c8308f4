"""Landing zone: GZIP JSON lines under ``event_date=YYYY-MM-DD`` folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import BATCH, CORRUPT, LANDING, LANDING_WITH_CORRUPT, LINE, PARTITION, QUARANTINE
from tidemark.sources import files

# A GZIP file is read by one task, so its size bounds that task's work.
RECORDS_PER_FILE = 1_000_000


def write_landing(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Append records as one JSON object per line, GZIP, in a folder per ``event_date``.

    The rebalance step gathers the rows of a date before the write, else every task would
    leave a file in every date folder. It splits a date that holds most of the rows and
    merges small ones. NULL fields are left out of the JSON, and read back as NULL.
    """
    (
        records.hint("rebalance", PARTITION)
        .write.mode("append")
        .partitionBy(PARTITION)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .json(path)
    )


def infer_landing(spark: SparkSession, path: str) -> T.StructType:
    """The schema found in the files. Reads all of them, and fails if there is none."""
    return spark.read.json(path).schema


def read_landing(spark: SparkSession, path: str, schema: T.StructType = LANDING) -> DataFrame:
    """Landing files as a batch. A filter on ``event_date`` reads only those folders."""
    return spark.read.schema(schema).json(path)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LANDING,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Landing files as a stream.

    ``options`` go to the file source. ``maxBytesPerTrigger`` or ``maxFilesPerTrigger`` bound a
    micro-batch. Over years of small files, ``cleanSource`` and ``maxFileAge`` bound the
    listing and the record of files already read.
    """
    return spark.readStream.schema(schema).options(**(options or {})).json(path)


def read_landing_with_corrupt(spark: SparkSession, path: str) -> DataFrame:
    """As `read_landing`, with the text of malformed lines for `split_malformed`."""
    return read_landing(spark, path, LANDING_WITH_CORRUPT)


def split_malformed(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed records in the landing schema, and malformed lines in the quarantine schema.

    Spark does not run a query on JSON files that uses only the corrupt-record field, so to
    count either side alone, write or normalise it first.
    """
    good = landing.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, select_malformed(landing)


def select_malformed(landing: DataFrame) -> DataFrame:
    malformed = landing.where(F.col(CORRUPT).isNotNull())
    return malformed.withColumnRenamed(CORRUPT, LINE).select(*QUARANTINE.fieldNames())


def write_quarantine(malformed: DataFrame, errors_path: str, batch: int = 0) -> None:
    """Write malformed lines under ``malformed/event_date=../ingest_batch=..``, outside the landing folder.

    A batch that is written again replaces what it left. The rebalance step gathers the lines of a date.
    """
    (
        malformed.withColumn(BATCH, F.lit(batch).cast("long"))
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION, BATCH)
        .option("compression", "gzip")
        .json(f"{errors_path}/malformed")
    )


def read_quarantine(spark: SparkSession, errors_path: str) -> DataFrame:
    """The malformed lines of all batches; none where no batch had any."""
    if not files.list_names(spark, f"{errors_path}/malformed"):
        return spark.createDataFrame([], QUARANTINE)
    schema = T.StructType([*QUARANTINE.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).json(f"{errors_path}/malformed").select(*QUARANTINE.fieldNames())
