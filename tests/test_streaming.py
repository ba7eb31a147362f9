import datetime as dt
import os
import random

from pyspark.sql import functions as F

from helpers import tuples
from lectern.streaming import ingest, sessions, shortfall
from lectern.streaming.ledger import BUCKETS, IdLedger

START = dt.datetime(2024, 1, 1)


def log(spark, seed=0):
    rng = random.Random(seed)
    rows = [(i, f"t{i % 4}", "hot" if i % 3 == 0 else f"u{i % 5}", START + dt.timedelta(minutes=rng.randrange(6000))) for i in range(600)]
    # Pauses of exactly the gap, and one microsecond more.
    edge = START + dt.timedelta(days=10, seconds=7)
    gap = dt.timedelta(minutes=30)
    rows += [(1000, "t0", "edge", edge), (1001, "t1", "edge", edge + gap), (1002, "t2", "edge", edge + 2 * gap + dt.timedelta(microseconds=1))]
    return spark.createDataFrame(rows, "id long, topic string, user_id string, started_at timestamp_ntz")


def test_rollup_equals_session_window(spark):
    events = log(spark)
    windowed = events.groupBy("user_id", F.session_window("started_at", "30 minutes").alias("w")).agg(
        F.count("*").alias("entries"))
    expected = windowed.select("user_id", F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "entries")
    found = sessions.session_rollup(events, 30)
    assert tuples(found.drop("topic", "topics")) == tuples(expected)
    edge = [r for r in found.collect() if r["user_id"] == "edge"]
    assert sorted((r["topic"], r["topics"], r["entries"]) for r in edge) == [("t0", 2, 2), ("t2", 1, 1)]


def test_stream_restates_late_entries(spark, tmp_path):
    """Files in reverse order of time, one of them twice as old as any session: the table equals the batch roll-up."""
    events = log(spark, 1)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def found():
        return sessions.streamed_sessions(spark, out, 30)

    assert found().count() == 0
    late = F.col("started_at") < F.lit(START + dt.timedelta(minutes=3000)).cast("timestamp_ntz")
    for n, part in enumerate((events.filter(~late), events.filter(late & (F.col("id") % 2 == 0)), events.filter(late & (F.col("id") % 2 == 1)))):
        part.write.parquet(f"{source}/{n}")
        sessions.session_stream(ingest.read_files(spark, f"{source}/*", events.schema), out, checkpoint, 30)
    assert tuples(found().drop("closed")) == tuples(sessions.session_rollup(events, 30))
    last = max(r["started_at"] for r in events.collect())
    assert all(r["closed"] == (r["session_end"] <= last - dt.timedelta(minutes=10)) for r in found().collect())
    # A batch that is run again replaces what it wrote.
    sessions.slot_sums(events.filter(~late), 30).write.mode("overwrite").parquet(f"{out}/_batch=0")
    assert tuples(found().drop("closed")) == tuples(sessions.session_rollup(events, 30))


def test_ingest_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    events = log(spark)

    def run():
        ingest.ingest_stream(ingest.read_files(spark, source, events.schema, files_per_batch=1), out, checkpoint, "id", "started_at")
        return ingest.ingested(spark, out, events.schema).count()

    events.unionByName(events).repartition(3).write.parquet(source)
    assert run() == 603
    assert run() == 603
    more = spark.createDataFrame([(9999, "t", "x", START + dt.timedelta(days=11)), (1000, "t", "x", START)], events.schema)
    more.coalesce(1).write.mode("append").parquet(source)
    assert run() == 604


def test_shortfall_counts_across_batches(spark, tmp_path):
    schema = "topic string, expires_at timestamp_ntz"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in ([("a", None)] * 3 + [("b", START)], [("a", None)] * 4 + [("b", START + dt.timedelta(days=60))]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = ingest.read_files(spark, source, spark.createDataFrame([], schema).schema)
        shortfall.shortfall_stream(stream, out, checkpoint)
    assert tuples(shortfall.shortfalls(spark, out, "2024-02-01 00:00:00")) == [("a", 7, 0), ("b", 1, 4)]
    assert tuples(shortfall.shortfalls(spark, out, "2024-04-01 00:00:00")) == [("a", 7, 0), ("b", 0, 5)]


def test_ingest_keeps_late_rows_and_rows_without_id(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id long, started_at timestamp_ntz"
    for day, ids in ((10, [1, 2, None]), (5, [3, 4, 2, None]), (1, [5])):
        rows = [(i, START + dt.timedelta(days=day)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.read_files(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=1)
        ingest.ingest_stream(stream, out, checkpoint, "id", "started_at")
    held = ingest.ingested(spark, out, spark.createDataFrame([], schema).schema)
    assert sorted(str(r["id"]) for r in held.collect()) == ["1", "2", "3", "4", "5", "None", "None"]


def written(folder):
    return {os.path.join(at, n): os.path.getmtime(os.path.join(at, n)) for at, _, names in os.walk(folder) for n in names}


def test_ledger_opens_only_buckets_that_may_hold_an_id(spark, tmp_path):
    ledger = IdLedger(spark, str(tmp_path / "ids"), "bigint")
    ledger.add(spark.range(20_000), 0)
    assert sorted(r["id"] for r in ledger.held(spark.range(19_998, 20_002), 1).collect()) == [19_998, 19_999]
    assert 2 <= len(ledger.opened) <= 4
    # The batch itself and new ids: hardly any bucket is opened for 500 of them.
    assert ledger.held(spark.range(20_000), 0) is None
    ledger.held(spark.range(30_000, 30_500), 1)
    assert len(ledger.opened) < 6


def test_ingest_reads_no_untouched_bucket(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id long, started_at timestamp_ntz"

    def run(ids):
        spark.createDataFrame([(i, START) for i in ids], schema).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_stream(ingest.read_files(spark, source, spark.createDataFrame([], schema).schema), out, checkpoint, "id", "started_at")
        return ingest.ingested(spark, out, spark.createDataFrame([], schema).schema).count()

    assert run(range(3000)) == 3000
    touched = {r[0] for r in spark.createDataFrame([(5,), (7000,)], "id long").select(
        F.pmod(F.xxhash64("id"), F.lit(BUCKETS))).collect()}
    spoiled = 0
    for folder in ("ids", "filters"):
        for at, _, names in os.walk(f"{out}/_ids/{folder}"):
            if "bucket=" in at and int(at.rpartition("=")[2]) not in touched:
                for name in names:
                    with open(os.path.join(at, name), "w") as f:
                        f.write("not to be read")
                    spoiled += 1
    assert spoiled > 100
    assert run([5, 7000]) == 3001


def test_shortfall_writes_what_changed_and_forgets(spark, tmp_path):
    schema = "topic string, expires_at timestamp_ntz"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run(rows, **options):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        before = written(out)
        shortfall.shortfall_stream(ingest.read_files(spark, source, spark.createDataFrame([], schema).schema), out, checkpoint, **options)
        after = written(out)
        return [p for p in after if before.get(p) != after[p] and p.endswith(".parquet")], before.keys() - after.keys()

    assert shortfall.shortfalls(spark, out, "2024-01-01 00:00:00").collect() == []
    days = [START + dt.timedelta(days=n) for n in range(40)]
    fresh, gone = run([(f"t{n % 9}", day) for n, day in enumerate(days)] + [("only", days[3])])
    assert len(fresh) == 40 and not gone
    fresh, gone = run([("t1", days[20]), ("t2", None)])
    assert len(fresh) == 2 and not gone
    ask = lambda at: {r["topic"]: r["available"] for r in shortfall.shortfalls(spark, out, at).collect()}
    earlier = ask("2024-01-12 00:00:00")
    fresh, gone = run([("t1", None)], forget_before="2024-01-12 00:00:00")
    assert len({os.path.dirname(p) for p in fresh}) == 2 and len([p for p in gone if p.endswith(".parquet")]) == 11
    assert ask("2024-01-12 00:00:00") == earlier | {"t1": earlier["t1"] + 1}
    assert ask("2025-01-01 00:00:00") == {f"t{n}": int(n in (1, 2)) for n in range(9)} | {"only": 0}
    assert shortfall.forget(spark, out, "2024-01-12 00:00:00") == []
