"""Study sessions: runs of activity of one user with no pause of ``gap`` or longer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lectern.session import path_exists


def _micros(gap_minutes: int) -> int:
    return gap_minutes * 60 * 1_000_000


def slot_sums(events: DataFrame, gap_minutes: int, user: str = "user_id", time: str = "started_at", topic: str = "topic") -> DataFrame:
    """(user, slot, topic, first_at, last_at, n): entries per user, time slot of the length of the gap, and topic.

    Entries of one slot are always in one session. Numbers only are reduced, so rows are summed before the shuffle.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    timed = events.select(F.col(user).alias("user"), at.alias("at"), F.col(topic).alias("topic")).withColumn(
        "slot", F.floor(F.col("at") / _micros(gap_minutes)))
    return timed.groupBy("user", "slot", "topic").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count("*").alias("n"))


def _chained(per_topic: DataFrame, gap_minutes: int, user: str) -> DataFrame:
    """Sessions out of slot sums: a user has at most as many slots as the log is long."""
    gap = _micros(gap_minutes)
    slots = per_topic.groupBy("user", "slot").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("n").alias("n"))
    in_order = Window.partitionBy("user").orderBy("slot")
    opens = F.coalesce(F.col("first_at") - F.lag("last_at").over(in_order) > gap, F.lit(True))
    chained = slots.withColumn("opens", opens.cast("int")).withColumn(
        "session", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))

    def moment(micros):
        return F.timestamp_micros(micros).cast("timestamp_ntz")

    sessions = chained.groupBy("user", "session").agg(
        F.min("first_at").alias("start_at"), F.max("last_at").alias("end_at"), F.sum("n").alias("entries"))
    topics = per_topic.join(chained.select("user", "slot", "session"), ["user", "slot"]).groupBy(
        "user", "session", "topic").agg(F.min("first_at").alias("topic_at"))
    opening = topics.groupBy("user", "session").agg(
        F.min(F.struct("topic_at", "topic")).alias("first"), F.count("topic").alias("topics"))
    return sessions.join(opening, ["user", "session"]).select(
        F.col("user").alias(user), moment(F.col("start_at")).alias("session_start"),
        moment(F.col("end_at") + gap).alias("session_end"), "entries", F.col("first.topic").alias("topic"), "topics")


def session_rollup(events: DataFrame, gap_minutes: int, user: str = "user_id", time: str = "started_at",
                   topic: str = "topic") -> DataFrame:
    """(user, session_start, session_end, entries, topic, topics) for a whole log.

    ``topic`` is that of the session's first entry (the smallest of several at that moment), ``topics`` how many
    different ones it has. Entries are summed per slot of the length of the gap first; sessions are chained over slots.
    """
    return _chained(slot_sums(events, gap_minutes, user, time, topic), gap_minutes, user)


def session_stream(events: DataFrame, out: str, checkpoint: str, gap_minutes: int, user: str = "user_id",
                   time: str = "started_at", topic: str = "topic") -> None:
    """Add the slot sums of each batch to ``out``, in a folder of its own that it replaces if it is run again.

    A batch writes in proportion to itself, keeps no state, and no entry is too late: ``streamed_sessions`` restates
    the sessions that a late entry extends or joins. ``gap_minutes`` belongs to the table and must stay the same.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        slot_sums(batch, gap_minutes, user, time, topic).write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    query = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(availableNow=True).start()
    query.awaitTermination()


def streamed_sessions(spark: SparkSession, out: str, gap_minutes: int, user: str = "user_id", user_type: str = "string",
                      topic_type: str = "string", delay_minutes: int = 10) -> DataFrame:
    """The sessions of everything streamed to ``out`` so far, as ``session_rollup`` gives them, and ``closed``: the
    session ended ``delay_minutes`` or more before the last entry of all. A late entry may still change it."""
    shape = f"user {user_type}, slot long, topic {topic_type}, first_at long, last_at long, n long"
    rows = (spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(out) if path_exists(spark, out)
            else spark.createDataFrame([], shape))
    merged = rows.groupBy("user", "slot", "topic").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("n").alias("n"))
    last = rows.agg((F.max("last_at") - delay_minutes * 60 * 1_000_000).alias("at")).scalar()
    ended = F.unix_micros(F.col("session_end").cast("timestamp")) <= last
    return _chained(merged, gap_minutes, user).withColumn("closed", ended)
