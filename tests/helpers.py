"""Small order frames, and the plan text that the plan tests look at."""

from __future__ import annotations

import datetime as dt
import gzip
from decimal import Decimal
from pathlib import Path

from tidemark.schema import ORDERS

START = dt.datetime(2025, 1, 1)


def order(key, minute, amount=1, **other):
    """An order row whose event time is ``minute`` minutes after `START`; None for no time."""
    at = None if minute is None else START + dt.timedelta(minutes=minute)
    row = {
        "order_id": key,
        "user_id": "1",
        "product_id": "2",
        "database_operation": "u",
        "amount": Decimal(amount).quantize(Decimal("0.01")),
        "payment_method": "pix",
        "event_date": START.date(),
        "event_timestamp": at,
        "etl_timestamp": START,
        "source_filename": "file:/landing/a.json.gz",
    }
    return {**row, **other}


def orders(spark, rows):
    return spark.createDataFrame([tuple(row[name] for name in ORDERS.fieldNames()) for row in rows], ORDERS)


def pairs(df):
    """(key, amount) of every row, in order."""
    rows = [(row["order_id"], row["amount"]) for row in df.select("order_id", "amount").collect()]
    return sorted(rows, key=lambda pair: (pair[0] or "", pair[1]))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def write_gzip(path, text):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(text)
