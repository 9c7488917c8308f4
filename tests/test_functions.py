from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import normalize_op, parse_amount, parse_event_ts
from tidemark.session import sql_settings

AMOUNTS = {
    "12,34": "12.34",
    "12.34": "12.34",
    "1,234.56": None,
    "1.0E7": "10000000.00",
    "abc": None,
    "": None,
    " 5 ": "5.00",
    "1.005": "1.01",
    "-3,1": "-3.10",
    "99999999999.999": None,
    None: None,
}

OPERATIONS = {
    "i": "i",
    "I": "i",
    "insert": "i",
    "u": "u",
    "U": "u",
    "Update": "u",
    "upsert": "u",
    "d": "i",
    "delete": "i",
    " u": "i",
    "": "i",
    None: "i",
}

TIMES = {
    "2025-01-01T00:00:00": datetime(2025, 1, 1),
    "2025-01-01T00:00:00.123456": datetime(2025, 1, 1, 0, 0, 0, 123456),
    "2025-01-01T00:00:00Z": datetime(2025, 1, 1),
    "2025-01-01T00:00:00-03:00": datetime(2025, 1, 1, 3),
    "2025-01-01 10:20:30": datetime(2025, 1, 1, 10, 20, 30),
    "x": None,
    "2025-13-01": None,
    None: None,
}


def evaluate(spark, function, inputs, result_type=None):
    df = spark.createDataFrame([(text,) for text in inputs], "text string")
    result = function(F.col("text"))
    if result_type:
        result = result.cast(result_type)
    return {row["text"]: row["result"] for row in df.select("text", result.alias("result")).collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_amount(spark, ansi):
    expected = {text: value and Decimal(value) for text, value in AMOUNTS.items()}
    with sql_settings(spark, {"spark.sql.ansi.enabled": ansi}):
        assert evaluate(spark, parse_amount, AMOUNTS) == expected


def test_parse_amount_of_numbers(spark):
    df = spark.createDataFrame([(1, 10.5), (2, 1.0e12), (3, None)], "id int, amount double")
    rows = df.select("id", parse_amount(F.col("amount")).alias("amount")).collect()
    assert [(row["id"], row["amount"]) for row in rows] == [(1, Decimal("10.50")), (2, None), (3, None)]


def test_normalize_op(spark):
    assert evaluate(spark, normalize_op, OPERATIONS) == OPERATIONS


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_event_ts(spark, ansi):
    with sql_settings(spark, {"spark.sql.ansi.enabled": ansi}):
        assert evaluate(spark, parse_event_ts, TIMES, "timestamp_ntz") == TIMES
