"""Running count of problems per topic and expiry, and what is missing at an instant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.operators.content import Instant, is_live
from lectern.session import folder_names, path_exists, remove_folder

_COUNTED = "topic string, expires_at {0}, available long, day string, batch long"
_SHAPE_OF_TIME = "timestamp_ntz"


def _counts(spark: SparkSession, out: str, time_type: str = _SHAPE_OF_TIME) -> DataFrame:
    return spark.read.schema(_COUNTED.format(time_type)).option("basePath", out).parquet(out)


def _append(rows: DataFrame, out: str) -> None:
    """Each batch has a folder of its own per day of expiry, which it replaces if it is run again."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(out)


def shortfall_stream(problems: DataFrame, out: str, checkpoint: str, forget_before: Instant | None = None) -> None:
    """Add each batch's number of problems per (topic, expiry) to ``out``, by day of expiry.

    A batch writes what it counted and nothing else, so the bytes follow its topics, and no state grows beside the
    table. Which problems are live is a question of the instant at which ``shortfalls`` is asked. Days that ended by
    ``forget_before`` leave, whole folders at a time; of their topics a row without problems stays, so a later
    question still names them. Then ``shortfalls`` can be asked for that instant and later ones.
    """
    spark = problems.sparkSession
    time_type = problems.schema["expires_at"].dataType.simpleString()

    def add(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy("topic", "expires_at").agg(F.count("*").alias("available"))
        day = F.coalesce(F.date_format("expires_at", "yyyy-MM-dd"), F.lit(V.NEVER))
        _append(counted.withColumns({"day": day, "batch": F.lit(batch_id).cast("long")}), out)
        if forget_before is not None:
            forget(spark, out, forget_before, time_type)

    query = problems.select("topic", "expires_at").writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(
        availableNow=True).start()
    query.awaitTermination()


def forget(spark: SparkSession, out: str, before: Instant, time_type: str = _SHAPE_OF_TIME) -> list[str]:
    """Drop the days of expiry that lie before the day of ``before``; returns them. Their topics are written first."""
    days = sorted(name.removeprefix("day=") for name in folder_names(spark, out) if name.startswith("day="))
    gone = [day for day in days if day < str(before)[:10] and day != V.NEVER]
    if gone:
        topics = _counts(spark, out, time_type).filter(F.col("day").isin(gone)).select("topic").distinct()
        # The folder is named by the last day that goes, so doing this again replaces it.
        mark = -int(gone[-1].replace("-", ""))
        _append(topics.select("topic", F.lit(None).cast(time_type).alias("expires_at"), F.lit(0).cast("long").alias("available"),
                              F.lit(V.NEVER).alias("day"), F.lit(mark).cast("long").alias("batch")), out)
        for day in gone:
            remove_folder(spark, f"{out}/day={day}")
    return gone


def shortfalls(spark: SparkSession, out: str, as_of: Instant, want: int = V.WANTED_PROBLEMS) -> DataFrame:
    """Live problems of each topic ever seen at ``as_of``, and how many are missing; no rows before the first batch."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], "topic string, available long, to_fetch long")
    written = _counts(spark, out)
    live = F.when(is_live(written, as_of), F.col("available")).otherwise(F.lit(0))
    counted = written.groupBy("topic").agg(F.sum(live).alias("available"))
    return counted.withColumn("to_fetch", F.greatest(F.lit(want) - F.col("available"), F.lit(0)))
