"""A change feed derived from the ``events`` table: one change per event, one key per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import LANDING

# Fixed values of the feed.
PAYMENT_METHODS = ["credit_card", "debit_card", "pix", "boleto", "paypal"]
OPERATIONS = {
    "signup": "INSERT",
    "purchase": "Update",
    "click": "u",
    "view": "I",
    "error": "delete",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def feed_from_events(events: DataFrame) -> DataFrame:
    """Events as landing records, numeric order ids and all.

    Amounts paid by boleto have a decimal comma.
    """
    payment = F.element_at(
        F.array(*map(F.lit, PAYMENT_METHODS)), (F.col("event_id") % 5 + 1).cast("int")
    )
    operation = F.element_at(
        F.create_map(*(F.lit(text) for pair in OPERATIONS.items() for text in pair)),
        F.col("event_type"),
    )
    amount = F.col("value").cast("string")
    columns = {
        "order_id": F.col("user_id"),
        "user_id": F.col("user_id").cast("string"),
        "product_id": (F.col("event_id") % 500 + 1).cast("string"),
        "database_operation": operation,
        "amount": F.when(payment == "boleto", F.replace(amount, F.lit("."), F.lit(","))).otherwise(amount),
        "payment_method": payment,
        "event_timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "event_date": F.to_date("ts"),
    }
    return events.select(*(columns[name].alias(name) for name in LANDING.fieldNames()))


def lines_with_malformed(events: DataFrame) -> DataFrame:
    """The feed as text lines with ``event_date``; lines of ``error`` events lack their end."""
    fields = [name for name in LANDING.fieldNames() if name != "event_date"]
    feed = feed_from_events(events)
    line = F.to_json(F.struct(*fields))
    cut = F.expr("left(line, length(line) - 1)")
    return feed.select("event_date", "database_operation", line.alias("line")).select(
        "event_date",
        F.when(F.col("database_operation") == "delete", cut).otherwise(F.col("line")).alias("value"),
    )
