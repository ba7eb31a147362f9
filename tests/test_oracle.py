"""Every registered query with a SQL twin gives the same rows and types as DuckDB."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from lectern.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value.isoformat() if isinstance(value, dt.datetime) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    rows = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    assert sql, f"{name} has no SQL twin"
    cursor = duck.execute(sql)
    types = {c[0]: str(c[1]) for c in cursor.description}
    names = [c[0] for c in cursor.description]
    expected = [tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(names) == columns
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == types


def test_entry(spark):
    assert entry.entry(spark).count() > 0
