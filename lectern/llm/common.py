"""Shared helpers: Arrow text access, words as numpy arrays, connected components."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import scratch_path, stage

CHUNK_BYTES = 2 << 20
_HASHED_AT_ONCE = 1 << 15

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: 0-9, a-z and every byte of non-ASCII characters.
WORD_BYTE = ((LOWER >= 48) & (LOWER <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (LOWER >= 128)
WORD_PATTERN = rb"[0-9a-z\x80-\xff]+"

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of a base, grown on demand; a task gets it without its values."""

    def __init__(self, base: int):
        self.base, self.have = base, np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, (self.base,)

    def upto(self, n: int) -> np.ndarray:
        if len(self.have) < n:
            fresh = np.full(max(n, CHUNK_BYTES + (1 << 16)), self.base, np.uint64)
            fresh[0] = 1
            self.have = np.multiply.accumulate(fresh)
        return self.have[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INVERSE)


class Shipped:
    """An array on its way to the tasks: packed in a broadcast, and unpacked once by each task that asks for it.

    Tables of fixed size are mostly empty, so they take little of the disks of driver and executors this way.
    """

    def __init__(self, spark: SparkSession, array: np.ndarray):
        self.kind, self.shape = array.dtype.str, array.shape
        self.sent = spark.sparkContext.broadcast(zlib.compress(array.tobytes(), 1))
        self.opened: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"opened": None}

    @property
    def value(self) -> np.ndarray:
        if self.opened is None:
            self.opened = np.frombuffer(zlib.decompress(self.sent.value), self.kind).reshape(self.shape)
        return self.opened


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back."""
    return stage(df, label)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, row count, bytes, row offsets. A null is an empty text.

    A text longer than the limit is a run of its own; texts are never cut.
    """
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        after = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        after = min(max(after, row + 1), len(column))
        yield row, after - row, data[offsets[row]:offsets[after]], offsets[row:after + 1] - offsets[row]
        row = after


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, cut at ``breaks`` (offsets at which another text or line starts)."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[breaks] = True
    cut[0] = cut[n] = True
    padded = np.zeros(n + 2, bool)
    padded[1:-1] = inside
    starts = np.flatnonzero(inside & (~padded[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~padded[2:] | cut[1:])) + 1
    return starts, ends


def span_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span that does not depend on its place."""
    n = len(lowered)
    total, up = np.empty(n + 1, np.uint64), _UP.upto(n)
    total[0] = 0
    # A block at a time, which stays in the processor's cache.
    for at in range(0, n, _HASHED_AT_ONCE):
        some = slice(at, min(n, at + _HASHED_AT_ONCE))
        part = (lowered[some].astype(np.uint64) + np.uint64(1)) * up[some]
        part[:1] += total[at:at + 1]
        np.cumsum(part, out=total[some.start + 1:some.stop + 1])
    return mixed((total[ends] - total[starts]) * _DOWN.upto(n)[starts] + (ends - starts).astype(np.uint64))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of batches that are sorted by the integer columns ``keys``, some whole groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True)):
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0))
        if len(cuts):
            end = int(cuts[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, end)])
            held, batch = [], batch.slice(end)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of the links (``a``, ``b``): columns ``node``, ``component`` (its smallest node).

    Nodes without a link do not appear. Large-star and small-star rounds, each written below
    ``spark.checkpoint.dir``; the number of rounds grows with the logarithm of the longest path. A hub's
    rows are dealt out by joins, not gathered.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, label)

    def written(df: DataFrame, n: int) -> tuple[DataFrame, tuple]:
        df.write.parquet(f"{root}/{n}")
        back = spark.read.schema("child long, parent long").parquet(f"{root}/{n}")
        return back, tuple(back.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first())

    links = edges.filter("a <> b").selectExpr("greatest(a, b) AS child", "least(a, b) AS parent").distinct()
    tree, mark = written(links, 0)
    for n in range(1, 200):
        if not mark[0]:
            break
        both = tree.unionAll(tree.selectExpr("parent AS child", "child AS parent"))
        least = both.groupBy("child").agg(F.min("parent").alias("least")).selectExpr("child", "least(child, least) AS least")
        large = (both.join(least, "child").filter("parent > child").selectExpr("parent AS child", "least AS parent")
                 .filter("child <> parent").distinct())
        lowest = large.groupBy("child").agg(F.min("parent").alias("least"))
        small = (large.join(lowest, "child").filter("parent <> least").selectExpr("parent AS child", "least AS parent")
                 .unionAll(lowest.selectExpr("child", "least AS parent")).distinct())
        tree, now = written(small, n)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components: 199 rounds were not enough")
    return tree.selectExpr("child AS node", "parent AS component").unionAll(
        tree.selectExpr("parent AS node", "parent AS component").distinct())
