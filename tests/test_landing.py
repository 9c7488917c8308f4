import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan, write_gzip
from tidemark.operators import normalize_orders
from tidemark.plans.feed import feed_from_events, read_events
from tidemark.schema import ORDERS
from tidemark.sources import (
    append_table,
    drop_table,
    ensure_database,
    ensure_table,
    infer_landing,
    overwrite_table,
    read_landing,
    read_landing_with_corrupt,
    read_quarantine,
    read_table,
    split_malformed,
    write_landing,
    write_quarantine,
)

SF = "/root/testdata/sf0.001"
DAY = "event_date=2025-01-01"


def test_round_trip(spark, folder):
    feed = feed_from_events(read_events(spark, SF))
    write_landing(feed, folder)
    assert all(path.name.endswith(".json.gz") for path in Path(folder).glob("event_date=*/part-*"))
    back = read_landing(spark, folder)
    assert back.exceptAll(feed.withColumn("order_id", F.col("order_id").cast("string"))).isEmpty()
    assert back.count() == feed.count()


def test_a_date_folder_gets_few_files_from_many_tasks(spark, folder):
    feed = feed_from_events(read_events(spark, SF)).repartition(20)
    write_landing(feed, folder)
    files = list(Path(folder).glob("event_date=*/*.gz"))
    assert len(files) == len(list(Path(folder).glob("event_date=*")))


def test_records_per_file_bounds_a_hot_date(spark, folder):
    feed = feed_from_events(read_events(spark, SF)).withColumn("event_date", F.lit("2025-01-01").cast("date"))
    write_landing(feed, folder, records_per_file=100)
    assert len(list(Path(folder).glob(f"{DAY}/*.gz"))) >= 10
    assert read_landing(spark, folder).count() == feed.count()


def test_date_filter_reads_only_its_folders(spark, folder):
    write_landing(feed_from_events(read_events(spark, SF)), folder)
    pruned = read_landing(spark, folder).where("event_date = DATE '2024-01-05'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(pruned)
    assert {Path(path).parent.name for path in pruned.inputFiles()} >= {"event_date=2024-01-05"}


def test_declared_schema_accepts_what_producers_send(spark, folder):
    write_gzip(
        f"{folder}/{DAY}/a.json.gz",
        '{"order_id": 1, "user_id": "7", "product_id": "9", "database_operation": "i", "amount": 10.5,'
        ' "payment_method": "pix", "event_timestamp": "2025-01-01T00:00:00.123456"}\n'
        '{"order_id":"2","amount":"3,5"}\n'
        '{"order_id":3}\n'
        '[{"order_id":4}]\n',
    )
    rows = {row["order_id"]: row for row in normalize_orders(read_landing(spark, folder)).collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"]["amount"] == Decimal("10.50")
    assert rows["1"]["event_date"] == dt.date(2025, 1, 1)
    assert rows["2"]["amount"] == Decimal("3.50")
    assert rows["3"]["amount"] is None and rows["3"]["database_operation"] == "i"


def test_inferred_schema(spark, folder):
    write_gzip(f"{folder}/{DAY}/a.json.gz", '{"order_id": 1, "amount": 10.5}\n')
    assert infer_landing(spark, folder).simpleString() == "struct<amount:double,order_id:bigint,event_date:date>"
    # A comma in one amount turns the field into text; the declared schema has text throughout.
    write_gzip(f"{folder}/{DAY}/b.json.gz", '{"order_id": 2, "amount": "10,5"}\n')
    schema = infer_landing(spark, folder)
    assert schema["amount"].dataType.simpleString() == "string"


def test_inference_needs_files(spark, folder):
    Path(folder).mkdir()
    with pytest.raises(AnalysisException, match="UNABLE_TO_INFER_SCHEMA"):
        infer_landing(spark, folder)
    assert read_landing(spark, folder).isEmpty()


def test_malformed_lines(spark, folder):
    landing, errors = f"{folder}/landing/orders", f"{folder}/landing/errors/orders"
    write_gzip(f"{landing}/{DAY}/a.json.gz", '{"order_id": 1}\nbroken\n{"order_id": 2, "amo\n')
    good, bad = split_malformed(read_landing_with_corrupt(spark, landing))
    assert [row["order_id"] for row in good.collect()] == ["1"]
    write_quarantine(bad, errors)
    lines = read_quarantine(spark, errors).collect()
    assert sorted(row["line"] for row in lines) == ["broken", '{"order_id": 2, "amo']
    assert {row["event_date"] for row in lines} == {dt.date(2025, 1, 1)}
    # Without the split, a line that is no JSON is a row of NULL fields with operation "i".
    rows = normalize_orders(read_landing(spark, landing)).where("order_id IS NULL").collect()
    assert {row["database_operation"] for row in rows} == {"i"}
    # Errors lie outside what the raw job reads.
    assert read_landing(spark, landing).count() == 3


def test_lineage(spark, folder):
    write_gzip(f"{folder}/{DAY}/a b.json.gz", '{"order_id": 1}\n{"order_id": 2}\n')
    rows = normalize_orders(read_landing(spark, folder)).collect()
    assert {row["source_filename"].rsplit("/", 1)[1] for row in rows} == {"a%20b.json.gz"}
    assert len({row["etl_timestamp"] for row in rows}) == 1


def test_table_definition(spark, folder):
    database = f"t_{Path(folder).name[-12:]}"
    ensure_database(spark, database)
    ensure_database(spark, database)
    table = f"{database}.orders"
    ensure_table(spark, table, f"{folder}/orders")
    ensure_table(spark, table, f"{folder}/elsewhere")
    assert {f.name: f.dataType for f in read_table(spark, table).schema} == {f.name: f.dataType for f in ORDERS}
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["event_date"]

    feed = feed_from_events(read_events(spark, SF))
    rows = normalize_orders(feed, F.lit("events")).persist()
    append_table(rows.where("event_date < DATE '2024-01-10'"), table)
    append_table(rows.where("event_date >= DATE '2024-01-10'"), table)
    assert read_table(spark, table).count() == 1000
    assert len(list(Path(folder, "orders").glob("event_date=*/*.parquet"))) == 30
    pruned = read_table(spark, table).where("event_date = DATE '2024-01-05' AND amount > 5")
    assert "PartitionFilters: [isnotnull(event_date" in plan(pruned)
    overwrite_table(rows.where("event_date = DATE '2024-01-05'").select(*reversed(rows.columns)), table)
    day = rows.where("event_date = DATE '2024-01-05'")
    assert read_table(spark, table).select(*day.columns).exceptAll(day).isEmpty()
    assert read_table(spark, table).count() == day.count()
    detail = {row[0]: row[1] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert (detail["Type"], detail["Location"]) == ("EXTERNAL", f"file:{folder}/orders")
    kept = list(Path(folder, "orders").glob("event_date=*/*.parquet"))
    assert {path.parent.name for path in kept} == {"event_date=2024-01-05"}
    rows.unpersist()

    drop_table(spark, table)
    drop_table(spark, table)
    assert not spark.catalog.tableExists(table)
    assert Path(folder, "orders").exists()
