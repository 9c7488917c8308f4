"""Every split of a table keeps all rows, those with nulls too."""

from pyspark.sql import functions as F

from tidemark.plans.queries import is_old, is_returned
from tidemark.plans.workspace import PARTS


def test_parts_keep_rows_without_a_date(spark):
    rows = spark.range(40).selectExpr(
        "id", "CASE WHEN id % 5 > 0 THEN date_add(DATE '2024-01-01', CAST(id AS INT)) END AS event_date"
    )
    found = [r["id"] for part in PARTS for r in rows.where(part).collect()]
    assert sorted(found) == list(range(40))


def test_first_part_and_its_opposite_keep_all_rows(spark):
    rows = spark.createDataFrame([(1, None)], "id int, event_date date")
    assert rows.where(F.expr(f"NOT coalesce({PARTS[0]}, false)")).count() == 1


def test_targets_and_updates_keep_all_rows(spark):
    dates = spark.sql("SELECT * FROM VALUES (DATE '2024-01-14'), (DATE '2024-01-15'), (NULL) AS t(event_date)")
    assert (dates.where(is_old()).count(), dates.where(~is_old()).count()) == (1, 2)
    flags = spark.sql("SELECT * FROM VALUES ('R'), ('N'), (NULL) AS t(l_returnflag)")
    assert (flags.where(is_returned()).count(), flags.where(~is_returned()).count()) == (1, 2)
