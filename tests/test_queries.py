"""Every registered query of the change feed against its DuckDB SQL on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import registered

SF = "/root/testdata/sf0.001"
TABLES = ["events", "lineitem"]

QUERIES = registered()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def normal(rows):
    return sorted(tuple(map(repr, row)) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert normal(map(tuple, df.select(*columns).collect())) == normal(expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 15
