"""Queries with a SQL twin give its rows and types; those without are compared with brute force in their own tests."""

import duckdb
import pytest

from lectern.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = Q.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = con.execute(Q.SQL[name])
    names, types = [c[0] for c in cursor.description], {c[0]: str(c[1]) for c in cursor.description}
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(names) == columns and {c: SAME_TYPE[t] for c, t in df.dtypes} == types
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_gives_a_row_per_row(spark, name):
    source = "embeddings" if name.startswith("op8") else "pages" if name.startswith("op7") else "documents"
    assert Q.QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
