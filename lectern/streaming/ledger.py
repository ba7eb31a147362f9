"""Which ids were taken already: a table in hash buckets, with Bloom filters that tell which buckets to open."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import folder_names, stage

BUCKETS = 32
BITS_PER_ID = 24
_PROBES = 12


def _bits(size: int, hashes: np.ndarray) -> np.ndarray:
    """Places of each hash in a filter of ``size`` bits, one row per probe; the two halves are stepped through."""
    high, low = hashes >> np.uint64(32), hashes & np.uint64(0xFFFFFFFF)
    steps = np.arange(_PROBES, dtype=np.uint64)[:, None]
    return (high + steps * (low | np.uint64(1))) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    size = 8 * max(8, BITS_PER_ID * len(hashes) // 8)
    bits = np.zeros(size, np.uint8)
    bits[_bits(size, hashes).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(content: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(content, np.uint8))
    return bits[_bits(len(bits), hashes)].all(axis=0)


class IdLedger:
    """Ids by batch below ``path``: ``ids/bucket=B`` holds (id, batch), ``filters/bucket=B`` a filter per batch.

    Ids that a batch adds again when it is run again are harmless: a batch never looks at its own.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str, buckets: int = BUCKETS):
        self.spark, self.path, self.id_type, self.buckets = spark, path.rstrip("/"), id_type, buckets
        self.opened: list[int] = []

    def _bucketed(self, ids: DataFrame) -> DataFrame:
        """``ids`` (id) with a hash and the bucket that it names."""
        return ids.select("id", F.xxhash64("id").alias("hash")).withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int"))

    def _open(self, kind: str, buckets: list[int], columns: str) -> DataFrame | None:
        """The rows of some buckets; folders of other buckets are not looked at."""
        there = set(folder_names(self.spark, f"{self.path}/{kind}"))
        paths = [f"{self.path}/{kind}/bucket={b}" for b in buckets if f"bucket={b}" in there]
        if not paths:
            return None
        return self.spark.read.schema(f"{columns}, bucket int").option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def held(self, ids: DataFrame, batch: int) -> DataFrame | None:
        """Those of ``ids`` (id; distinct, not null) that another batch added; None if there are surely none.

        ``opened`` lists the buckets whose ids were read.
        """
        self.opened = []
        named = stage(self._bucketed(ids), "batch-ids")
        touched = [r["bucket"] for r in named.select("bucket").distinct().collect()]
        filters = self._open("filters", touched, "batch long, content binary")
        if filters is None:
            return None

        def maybe(named: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            found = np.zeros(len(named), bool)
            hashes = named["hash"].to_numpy().view(np.uint64)
            for content in filters["content"]:
                found |= may_hold(content, hashes)
            return named.loc[found, ["id", "bucket"]]

        others = filters.filter(F.col("batch") != batch)
        doubtful = stage(named.groupBy("bucket").cogroup(others.groupBy("bucket")).applyInPandas(
            maybe, f"id {self.id_type}, bucket int"), "doubtful-ids")
        self.opened = sorted(r["bucket"] for r in doubtful.select("bucket").distinct().collect())
        rows = self._open("ids", self.opened, f"id {self.id_type}, batch long") if self.opened else None
        return None if rows is None else doubtful.select("id").join(rows.filter(F.col("batch") != batch).select("id"), "id", "left_semi")

    def add(self, ids: DataFrame, batch: int) -> None:
        """Add ``ids`` (id; distinct, not null). A bucket's ids of one batch are one file."""
        named = stage(self._bucketed(ids).withColumn("batch", F.lit(batch).cast("long")), "new-ids")
        if named.isEmpty():
            return
        dealt = named.repartition("bucket")
        dealt.select("id", "batch", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/ids")

        def filter_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"batch": [batch], "content": [bloom(rows["hash"].to_numpy().view(np.uint64))], "bucket": [key[0]]})

        filters = named.select("hash", "bucket").groupBy("bucket").applyInPandas(filter_of, "batch long, content binary, bucket int")
        filters.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/filters")
