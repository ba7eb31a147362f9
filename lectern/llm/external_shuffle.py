"""Sharding by a two-pass external shuffle.

Pass one scatters the records over buckets that fit in the memory of a task: the first bits of a seeded hash of the
record's id name a cell, and a run of cells is a bucket. Pass two reads each bucket, puts it into the order of the
hashes, shuffles it by Fisher-Yates with a generator seeded by seed and bucket, and writes it. Buckets follow one
another, and the records are dealt out to the shards in turn, so the shards' row counts differ by at most one.

How many bytes and rows a cell holds is counted first (at most 2^16 rows come to the driver). From that follow the
number of buckets and the place at which each begins, so every record goes over the network once and is written once.
An id that repeats so often that its cell is too large has its records scattered one by one instead; they are written
with their new cells first, since these depend on the records' places in the input.

Other tasks, machines or file splits give the same shards: cells, buckets and draws depend on seed, ids and sizes only
(but for the records of such repeated ids).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import stored
from lectern.session import scratch_path

SHARDS = 8
BUCKET_BYTES = 32 << 20
CELL_BITS = 16
_BATCH_BYTES = 4 << 20


def _cell(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - CELL_BITS).cast("int")


def bucket_bits(total_bytes: int, bucket_bytes: int) -> int:
    """Bits of the smallest power of two of buckets that keeps each at ``bucket_bytes`` on average."""
    bits = max(0, (max(1, -(-total_bytes // bucket_bytes)) - 1).bit_length())
    if bits > CELL_BITS:
        raise ValueError(f"{total_bytes} bytes need more than {1 << CELL_BITS} buckets; raise bucket_bytes")
    return bits


def _keyed(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """Every record as one struct, so that its columns cannot clash with the others."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _scattered(docs: DataFrame, id_col: str, text_col: str, seed: int, bucket_bytes: int) -> tuple[DataFrame, np.ndarray, int]:
    """Records with their cells, the rows of each cell, and the bits of the bucket numbers."""
    keyed = _keyed(docs, id_col, text_col, seed).withColumn("cell", _cell(F.col("key")))
    counted = keyed.groupBy("cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    rows = np.zeros(1 << CELL_BITS, np.int64)
    total = sum(c["bytes"] for c in counted)
    for c in counted:
        rows[c["cell"]] = c["n"]
    bits = bucket_bits(total, bucket_bytes)
    most = max(bucket_bytes // 2, 2 * total >> CELL_BITS)
    hot = [c["cell"] for c in counted if c["bytes"] > most and c["n"] > 1]
    if hot:
        anew = F.xxhash64(F.lit(seed), F.col("key"), F.monotonically_increasing_id())
        spread = stored(keyed.filter(F.col("cell").isin(hot)).withColumn("key", anew).withColumn("cell", _cell(F.col("key"))), "hot-records")
        keyed = keyed.filter(~F.col("cell").isin(hot)).unionByName(spread)
        rows[hot] = 0
        for c in spread.groupBy("cell").agg(F.count("*").alias("n")).collect():
            rows[c["cell"]] += c["n"]
    return keyed, rows, bits


def fisher_yates(n: int, *seed: int) -> np.ndarray:
    """A permutation of 0 to n - 1: place i swaps with a place drawn from 0 to i, from the last place down."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)
    return order


def shuffle_into_shards(docs: DataFrame, out: str | None = None, shards: int = SHARDS, seed: int = 0, id_col: str = "doc_id",
                        text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes ``docs`` in random order to the folders ``shard=0`` to ``shard=N-1`` below ``out`` (a fresh path) and reads
    them back: ``slot`` (place in the shard, from 0 without gaps), ``size`` (UTF-8 bytes of the text plus 1; a null text
    has none), ``row`` (the record as it was, whatever its columns are called) and ``shard``.

    Every row is kept: null and empty texts, null ids and exact repeats too. Shards differ by at most one row. Equal
    seeds give equal shards; rows of one id may change places with each other. A bucket of about ``bucket_bytes`` of
    text is held by one task at a time. An empty table gives no rows. ``shards`` is at least 1.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    out = out or scratch_path(spark, "shards")
    keyed, rows, bits = _scattered(docs, id_col, text_col, seed, bucket_bytes)
    starts = np.concatenate(([0], np.cumsum(rows.reshape(1 << bits, -1).sum(axis=1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        bucket = pa.Table.from_batches(held)
        number = int(bucket["bucket"][0].as_py())
        in_order = np.argsort(bucket["key"].to_numpy(), kind="stable")[fisher_yates(len(bucket), seed & 0xFFFFFFFF, number)]
        at = np.arange(len(bucket)) + starts[number]
        by_shard = np.argsort(at % shards, kind="stable")
        at = at[by_shard]
        done = bucket.select(["size", "row"]).take(pa.array(in_order[by_shard]))
        step = max(1, _BATCH_BYTES * len(done) // max(1, done.nbytes))
        for n in range(0, len(done), step):
            part = done.slice(n, step).combine_chunks()
            place = at[n:n + step]
            for batch in part.to_batches():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place // shards), batch.column(0), batch.column(1), pa.array((place % shards).astype(np.int32))],
                    ["slot", "size", "row", "shard"])

    bucket = F.shiftrightunsigned("cell", CELL_BITS - bits) if bits < CELL_BITS else F.col("cell")
    dealt = keyed.select(bucket.cast("int").alias("bucket"), "key", "size", "row").repartitionById(1 << bits, F.col("bucket"))
    shape = T.StructType([T.StructField("slot", T.LongType()), T.StructField("size", T.LongType()), keyed.schema["row"],
                          T.StructField("shard", T.IntegerType())])
    dealt.mapInArrow(run, shape).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(out)
    return spark.read.schema(shape).parquet(out)
