"""Streaming jobs run to the end of the test tables, and the batch form of the session roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.plans import views as V
from lectern.plans.registry import query
from lectern.plans.views import PROBLEMS, with_sql
from lectern.session import scratch_path
from lectern.streaming import ingest, sessions, shortfall

GAP_MINUTES = 240

SESSIONS = f"""gaps AS (
  SELECT user_id, ts, event_type, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL {GAP_MINUTES} MINUTES, true)
         AS opens FROM events),
runs AS (
  SELECT user_id, ts, event_type, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run
  FROM gaps),
sessions AS (
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {GAP_MINUTES} MINUTES AS session_end, count(*) AS entries,
         first(event_type ORDER BY ts, event_type) AS topic, count(DISTINCT event_type) AS topics
  FROM runs GROUP BY user_id, run)"""


def _in_turn(t, table: str, parts: list[str], take) -> None:
    """Writes the rows of one table a part at a time (SQL conditions) and has ``take`` stream what is new each time."""
    rows, folder = getattr(t, table), scratch_path(t._spark, f"{table}-in")
    for n, condition in enumerate(parts):
        rows.filter(condition).write.parquet(f"{folder}/{n}")
        take(ingest.read_files(t._spark, f"{folder}/*", rows.schema))


@query("session_rollup", with_sql(SESSIONS, body="SELECT * FROM sessions"))
def session_rollup(t):
    return sessions.session_rollup(V.sessions(t), GAP_MINUTES)


@query("session_stream", with_sql(SESSIONS, body="""
SELECT * FROM sessions WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES"""))
def session_stream(t):
    """The later half of the log first: all of the earlier half is late, and reopens sessions."""
    out, checkpoint = scratch_path(t._spark, "sessions"), scratch_path(t._spark, "sessions-checkpoint")
    middle = t.events.agg(F.expr("timestamp_micros((unix_micros(timestamp(min(ts))) + unix_micros(timestamp(max(ts)))) div 2)")).first()[0]
    half = f"ts >= TIMESTAMP_NTZ '{middle}'"

    def take(rows):
        log = rows.select("user_id", F.col("ts").alias("started_at"), F.col("event_type").alias("topic"))
        sessions.session_stream(log, out, checkpoint, GAP_MINUTES)

    _in_turn(t, "events", [half, f"NOT {half}"], take)
    user_type = t.events.schema["user_id"].dataType.simpleString()
    return sessions.streamed_sessions(t._spark, out, GAP_MINUTES, user_type=user_type).filter("closed").drop("closed")


@query("ingest_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ingest_stream(t):
    """The later half first, then the earlier half and repeats, then a last part."""
    spark, events = t._spark, t.events
    out, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    parts = ["event_id % 3 = 0 AND event_id % 2 = 0", "event_id % 3 = 0", "event_id % 3 <> 0"]
    _in_turn(t, "events", parts, lambda rows: ingest.ingest_stream(rows, out, checkpoint, "event_id", "ts"))
    return ingest.ingested(spark, out, events.schema)


LATER, MUCH_LATER = "2024-03-01 00:00:00", "2024-06-01 00:00:00"


@query("shortfall_stream", with_sql(PROBLEMS, body=" UNION ALL ".join(f"""
SELECT '{at}' AS asked_at, topic, CAST(available AS BIGINT) AS available, greatest(300 - available, 0)::BIGINT AS to_fetch
FROM (SELECT topic, count(*) FILTER (expires_at IS NULL OR expires_at > TIMESTAMP '{at}') AS available
      FROM problems GROUP BY topic)""" for at in (LATER, MUCH_LATER))))
def shortfall_stream(t):
    """Three parts, asked at two instants; what has expired by the first has left the table."""
    spark = t._spark
    out, checkpoint = scratch_path(spark, "shortfall"), scratch_path(spark, "shortfall-checkpoint")
    _in_turn(t, "part", ["p_partkey % 3 = 0", "p_partkey % 3 = 1", "p_partkey % 3 = 2"],
             lambda rows: shortfall.shortfall_stream(V.problems_from(rows), out, checkpoint, forget_before=LATER))
    asked = [shortfall.shortfalls(spark, out, at, want=300).withColumn("asked_at", F.lit(at)) for at in (LATER, MUCH_LATER)]
    return asked[0].unionByName(asked[1])
