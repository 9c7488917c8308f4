"""Landing records to the order schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import normalize_op, parse_amount, parse_event_ts
from tidemark.schema import ORDERS


def normalize_orders(landing: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Landing columns as the ten order columns, stamped with load time and source file.

    ``source_file`` defaults to the path of the file a row was read from; give another column
    when ``landing`` does not come from a file source. The load time is one value per query,
    and on a stream one per micro-batch.
    """
    if source_file is None:
        source_file = F.col("_metadata.file_path")
    columns = {
        "order_id": F.col("order_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "product_id": F.col("product_id").cast("string"),
        "database_operation": normalize_op(F.col("database_operation")),
        "amount": parse_amount(F.col("amount")),
        "payment_method": F.col("payment_method").cast("string"),
        "event_date": F.col("event_date").try_cast("date"),
        "event_timestamp": parse_event_ts(F.col("event_timestamp")),
        "etl_timestamp": F.current_timestamp(),
        "source_filename": source_file,
    }
    return landing.select(*(columns[name].alias(name) for name in ORDERS.fieldNames()))
