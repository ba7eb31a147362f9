"""Each new file once: incremental ingest that resumes where it stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.session import path_exists, stage
from lectern.streaming.ledger import IdLedger


def read_files(spark: SparkSession, folder: str, schema: T.StructType, name_glob: str = "*.parquet",
               files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest_stream(rows: DataFrame, out: str, checkpoint: str, id_col: str, time_col: str) -> None:
    """Append what is new to ``out`` and stop when nothing is left.

    The file source takes each file once, also after a restart with the same checkpoint, and no row is too
    late. An id that ``out`` holds already is not taken again; of a repeated id in one batch the earliest row
    is. Rows without an id are all kept. Each batch writes its own folder, so a batch that is run again after
    a failure replaces what it wrote. Ids are kept in a ledger, of which a batch opens only the buckets that may hold
    one of its ids.
    """
    spark = rows.sparkSession
    ledger = id_ledger(spark, out, rows.schema[id_col].dataType.simpleString())

    def add(batch: DataFrame, batch_id: int) -> None:
        named = batch.filter(F.col(id_col).isNotNull())
        first = stage(named.groupBy(id_col).agg(F.min(time_col).alias("_first"), F.count("*").alias("_rows")), "batch-firsts")
        ids = first.select(F.col(id_col).alias("id"))
        held = ledger.held(ids, batch_id)
        if held is not None:
            held = stage(held, "held-ids")
            ids = ids.join(held, "id", "left_anti")
            first = first.join(held.withColumnRenamed("id", id_col), id_col, "left_anti")
        once = named.join(first.filter("_rows = 1").select(id_col), id_col, "left_semi").select(*batch.columns)
        again = named.join(first.filter("_rows > 1").select(id_col, "_first"), id_col).filter(
            F.col(time_col).eqNullSafe(F.col("_first"))).dropDuplicates([id_col]).select(*batch.columns)
        kept = once.unionByName(again).unionByName(batch.filter(F.col(id_col).isNull()))
        kept.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        ledger.add(ids, batch_id)

    query = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(availableNow=True).start()
    query.awaitTermination()


def id_ledger(spark: SparkSession, out: str, id_type: str) -> IdLedger:
    """The ledger of what ``ingest_stream`` wrote to ``out``; its folder is none that a reader of ``out`` sees."""
    return IdLedger(spark, f"{out}/_ids", id_type)


def ingested(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What ``ingest_stream`` has written; empty if it never ran."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
