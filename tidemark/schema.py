"""Schemas of the landing files and of the order tables."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "order_id"
TS = "event_timestamp"
PARTITION = "event_date"
CORRUPT = "_corrupt_record"
# Partition columns that number the micro-batches of the raw table and the commits of the current one.
BATCH = "ingest_batch"
COMMIT = "_commit"

# Every field is text: numbers arrive as their raw text, so a feed that mixes 3.5 and "3,5"
# neither changes type nor fails. `event_date` comes from the directory name.
LANDING = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("database_operation", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# PERMISSIVE readers put the text of a malformed line in this extra field.
LANDING_WITH_CORRUPT = T.StructType([*LANDING.fields, T.StructField(CORRUPT, T.StringType())])

# Quarantined lines, with the fields that could be read before the error.
LINE = "line"
QUARANTINE = T.StructType([*LANDING.fields, T.StructField(LINE, T.StringType())])

# The raw history and the current state share one schema.
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("database_operation", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("etl_timestamp", T.TimestampType()),
        T.StructField("source_filename", T.StringType()),
    ]
)

# The raw history as it is stored.
RAW = T.StructType([*ORDERS.fields, T.StructField(BATCH, T.LongType())])

# Rows of one key with equal event time are ordered by these, newest load first, so that a
# recomputed task picks the same row again.
TIEBREAK = (
    "etl_timestamp",
    "source_filename",
    "database_operation",
    "amount",
    "payment_method",
    "product_id",
    "user_id",
    "event_date",
)
