"""Numbering gives plain window results, whichever way it goes, also with one hot group."""

import random

from pyspark.sql import functions as F
from pyspark.sql import Window
import pytest

from helpers import tuples
from lectern.operators import numbering as N


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"k{i % 40}" if i % 7 else None, n, f"{rng.randrange(50):03d}")
            for i, n in enumerate(rng.sample(range(100_000), 3000))]
    return spark.createDataFrame(data, "k string, n int, s string").repartition(5).cache()


def test_positions_by_range(rows):
    order = [F.col("s").desc(), F.col("n").asc()]
    plain = rows.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert tuples(N.positions(rows, ["k"], order)) == tuples(plain)


def test_positions_without_group(rows):
    order = [F.col("s"), F.col("n")]
    plain = rows.withColumn("pos", F.row_number().over(Window.orderBy(*order)))
    assert tuples(N.positions(rows, [], order)) == tuples(plain)


def test_positions_with_totals_null_keys_and_sparse_ids(rows):
    sparse = rows.withColumn("n", F.col("n").cast("long") * 1_000_003)
    w = Window.partitionBy("k")
    plain = sparse.withColumn("pos", F.row_number().over(w.orderBy("n"))).withColumn("all", F.count("*").over(w))
    got = N.positions(sparse, ["k"], ["n"], total="all")
    assert got.filter("k IS NULL").count() == rows.filter("k IS NULL").count() > 0
    assert tuples(got.select(plain.columns)) == tuples(plain)


def test_positions_spread_a_large_group(rows):
    plan = N.positions(rows, ["k"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    # The only windows are over the per-partition counts (both sides of the join number the same written rows).
    assert plan.count("Window") == 2 and "_before" in plan


def test_ids_are_dense_and_ordered(rows):
    numbered = N.assign_ids(rows, "id", 11, ["n"])
    assert [r.id for r in numbered.orderBy("n").collect()] == list(range(11, 3011))
    assert sorted(r.id for r in N.assign_ids(rows, "id", 1).collect()) == list(range(1, 3001))


def test_ids_do_not_gather_rows_in_one_task(rows):
    plan = N.assign_ids(rows, "id", 1, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    # The only ordering without a partition is over the per-partition counts.
    assert plan.count("Window") == 1 and "_before" in plan


def test_in_first(rows):
    plain = rows.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("n"))).filter("pos <= 4")
    first = N.in_first(rows, ["k"], [F.col("n").asc()], 4)
    assert tuples(first) == tuples(plain)
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
