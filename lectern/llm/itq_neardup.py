"""Embedding near-duplicates by iterative quantisation (ITQ) and multi-index Hamming tables.

On a bounded sample of unit vectors, principal directions are taken and rotations learned that bring the rotated vectors
close to the corners of a cube, so that their signs are balanced codes that keep angles. Every vector is then coded by
every rotation, each code is cut into pieces, and each piece is a table: vectors meet in a table if their pieces are
equal. Where two vectors meet, the Hamming distance of their whole codes is looked at, and then their original values
are compared.

Piece length grows with the logarithm of the number of vectors, so that chance meetings per vector stay constant, and
the number of rotations follows from the wanted recall of a pair just at the threshold. Equal vectors are one class. A
bucket is compared in blocks of at most ``BLOCK`` vectors and gives a count and a spanning edge per vector, not pairs; a
pair counts in the first table in which it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import components, stored, whole_groups

THRESHOLD = 0.95
RECALL = 0.97
SAMPLE_VECTORS = 10_000
ROUNDS = 25
BITS = 64
SPARE_BITS = 4
BLOCK = 1024
#: Share of the linked pairs that the distance of whole codes may rule out.
CODE_LOSS = 1e-6
_SMALL = 48
_PAIRS_AT_ONCE = 1 << 16


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component to between a half and 1, so that neither huge
    nor tiny values leave the range of doubles when squared."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def learn_rotations(sample: np.ndarray, bits: int, count: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """``count`` matrices (dimensions x bits): principal directions, then a rotation fitted by alternating between the
    nearest cube corners and the orthogonal Procrustes problem."""
    random = np.random.default_rng(seed)
    d = sample.shape[1]
    sample = scaled(sample) if len(sample) else sample
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    spread = unit.T @ unit if len(unit) else np.eye(d)
    directions = np.linalg.eigh(spread)[1][:, ::-1][:, :bits]
    projected = unit @ directions
    found = []
    for _ in range(count):
        rotation = np.linalg.qr(random.normal(size=(bits, bits)))[0]
        for _ in range(rounds if len(unit) > bits else 0):
            corners = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ corners)
            rotation = left @ right
        found.append(directions @ rotation)
    return np.stack(found)


def table_plan(vectors: int, dimensions: int, threshold: float, recall: float) -> tuple[int, int, int]:
    """Bits of a code, bits of a piece, and rotations needed for ``recall`` at the threshold."""
    bits = min(BITS, dimensions)
    piece = min(bits, max(8, math.ceil(math.log2(max(2, vectors))) + SPARE_BITS), 32)
    flip = math.acos(threshold) / math.pi
    meets = (1 - flip) ** piece
    tables = math.ceil(math.log(1 - recall) / math.log(1 - meets))
    return bits, piece, math.ceil(tables / (bits // piece))


def _usable(vector: Column) -> Column:
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _keys(classes: DataFrame, rotations: np.ndarray, piece: int) -> DataFrame:
    """``classes`` with ``keys``: one number per table."""
    sent = classes.sparkSession.sparkContext.broadcast(rotations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = sent.value
        pieces = turned.shape[2] // piece
        weights = np.int64(1) << np.arange(piece, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = scaled(_matrix(batch.column(2)))
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            keys = [((x @ r)[:, :pieces * piece].reshape(len(x), pieces, piece) >= 0) @ weights for r in turned]
            flat = np.concatenate(keys, axis=1)
            bounds = np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.ravel()))],
                ["node", "copies", "vector", "keys"])

    return classes.select("node", "copies", "vector").mapInArrow(run, "node long, copies long, vector array<double>, keys array<bigint>")


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0])
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have a cosine of at least ``threshold``; the closest calls in higher precision."""
    norms = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    cosines = (a @ b.T) / norms
    out = cosines >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosines - threshold) < 1e-13), strict=True):
        out[i, j] = _exactly(a[i], b[j], threshold)
    return out


def _exactly(u: np.ndarray, v: np.ndarray, threshold: float) -> bool:
    u, v = u.astype(np.longdouble), v.astype(np.longdouble)
    return bool((u * v).sum() >= threshold * np.sqrt((u * u).sum() * (v * v).sum()))


def bucket_links(classes: DataFrame, threshold: float, bits: int, piece: int, block: int = BLOCK) -> DataFrame:
    """Rows (``node``, ``links``, ``root``) of every block of every bucket: links found first there, and an edge."""
    entries = classes.select("node", F.posexplode("keys").alias("place", "key"))
    shared = entries.groupBy("place", "key").agg(F.count("*").alias("n")).filter("n > 1")
    split = entries.join(shared, ["place", "key"]).withColumn("blocks", F.expr(f"cast(ceil(n / {block}) as int)"))
    split = split.withColumn("own", F.pmod(F.xxhash64("node", "place"), F.col("blocks")).cast("int"))
    dealt = split.select("node", "place", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "node", "place", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = dealt.join(classes, "node")

    limit = code_limit(bits, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["place", "key", "low", "high"]):
            found = _Buckets(table, threshold, bits // piece, limit).links()
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "links", "root"])

    in_order = rows.repartition("place", "key", "low", "high").sortWithinPartitions("place", "key", "low", "high")
    return in_order.mapInArrow(run, "node long, links long, root long")


def code_limit(bits: int, threshold: float) -> int:
    """Largest distance of the codes that a linked pair passes with but for a share of ``CODE_LOSS``."""
    flip, left, k = math.acos(min(1.0, threshold)) / math.pi, 1.0, -1
    while left > CODE_LOSS and k < bits:
        k += 1
        left -= math.comb(bits, k) * flip ** k * (1 - flip) ** (bits - k)
    return k


class _Buckets:
    """Rows of whole buckets (or pairs of blocks of one), compared within each."""

    def __init__(self, table: pa.Table, threshold: float, pieces: int, limit: int):
        column = {c: table[c].to_numpy() for c in ("place", "key", "low", "high", "own", "node", "copies")}
        # The rows of the lower block come first in their bucket.
        bucket = np.concatenate(([0], np.cumsum(np.any([np.diff(column[c]) != 0 for c in ("place", "key", "low", "high")], axis=0))))
        order = np.lexsort((column["own"], bucket))
        self.bucket = bucket[order]
        self.place, self.low, self.high, self.own, self.node, self.copies = (
            column[c][order] for c in ("place", "low", "high", "own", "node", "copies"))
        merged = table.combine_chunks()
        self.vectors = scaled(_matrix(merged["vector"].chunk(0))[order])
        self.keys = _matrix(merged["keys"].chunk(0))[order]
        self.threshold, self.pieces, self.limit = threshold, pieces, limit

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes with a link found first here, how many, and one end of a spanning edge."""
        n = len(self.node)
        starts = np.searchsorted(self.bucket, self.bucket)
        ends = np.searchsorted(self.bucket, self.bucket, side="right")
        self.counts, self.root = np.zeros(n, np.int64), np.arange(n)
        for start in np.unique(starts[ends - starts > _SMALL]).tolist():
            self._large(start, int(ends[start]))
        one_block = self.low == self.high
        first_high = np.searchsorted(self.bucket * 2 + (self.own == self.high), self.bucket * 2 + 1)
        first = np.where(one_block, np.arange(n) + 1, first_high)
        count = np.where(one_block | (self.own == self.low), ends - first, 0)
        count[ends - starts > _SMALL] = 0
        total, at = np.cumsum(count), 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS_AT_ONCE, side="right")))
            some = count[at:to]
            i = np.repeat(np.arange(at, to), some)
            j = np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(first[at:to], some)
            self._take(*self._near(i, j))
            at = to
        found = self.counts > 0
        return self.node[found], self.counts[found], self.node[self.root[found]]

    def _near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose codes and then whose vectors are near enough."""
        whole = (self.place[i] // self.pieces)[:, None] * self.pieces + np.arange(self.pieces)
        unlike = np.bitwise_count(np.take_along_axis(self.keys[i], whole, 1) ^ np.take_along_axis(self.keys[j], whole, 1)).sum(axis=1)
        i, j = i[unlike <= self.limit], j[unlike <= self.limit]
        a, b = self.vectors[i], self.vectors[j]
        cosines = (a * b).sum(axis=1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
        hit = cosines >= self.threshold
        for k in np.flatnonzero(np.abs(cosines - self.threshold) < 1e-13):
            hit[k] = _exactly(a[k], b[k], self.threshold)
        return i[hit], j[hit]

    def _large(self, start: int, end: int) -> None:
        rows = np.arange(start, end)
        left, right = rows[self.own[rows] == self.low[start]], rows[self.own[rows] == self.high[start]]
        hit = _linked(self.vectors[left], self.vectors[right], self.threshold)
        if self.low[start] == self.high[start]:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        self._take(left[i], right[j])

    def _take(self, i: np.ndarray, j: np.ndarray) -> None:
        fresh = np.ones(len(i), bool)
        for earlier in range(int(self.place.max()) if len(i) else 0):
            fresh &= (self.keys[i, earlier] != self.keys[j, earlier]) | (earlier >= self.place[i])
        i, j = i[fresh], j[fresh]
        np.add.at(self.counts, i, self.copies[j])
        np.add.at(self.counts, j, self.copies[i])
        root = self.root
        while len(i):  # smallest label of each linked set, by halving paths
            least = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, root[i], least)
            np.minimum.at(root, root[j], least)
            root = root[root]
            if (root == before).all():
                break
        self.root = root


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 recall: float = RECALL, sample: int = SAMPLE_VECTORS, block: int = BLOCK) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Vectors that are null, zero, or hold nulls or non-finite numbers link with nothing; nor do vectors of different
    lengths with each other. Rows with equal vectors link whatever their ids. The smallest id of a component is its
    name; a row with a null id is never ``kept``. Other columns are not read; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"))
    good, rest = rows.filter(_usable(F.col("vector"))), rows.filter(~_usable(F.col("vector")))
    classes = stored(
        good.groupBy("vector").agg(F.count("*").alias("copies"), F.min("_id").alias("first")).select(
            F.monotonically_increasing_id().alias("node"), "copies", "first", "vector"), "vector-classes")
    sizes = [r["d"] for r in classes.select(F.size("vector").alias("d")).distinct().collect()]
    found = None
    for d in sorted(sizes):
        alike = classes.filter(F.size("vector") == d)
        bits, piece, count = table_plan(alike.count(), d, threshold, recall)
        drawn = alike.orderBy(F.xxhash64("vector")).limit(sample).select("vector").toPandas()["vector"]
        rotations = learn_rotations(np.stack(drawn.to_numpy()), bits, count)
        part = bucket_links(stored(_keys(alike, rotations, piece), "vector-keys"), threshold, bits, piece, block)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return rest.select(F.col("_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"),
                           F.col("_id").isNotNull().alias("kept"))
    found = stored(found, "vector-links")
    merged = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    per_class = named.join(smallest, "component").join(totals, "node", "left").select(
        F.xxhash64("vector").alias("_h1"), F.xxhash64(F.lit(1), "vector").alias("_h2"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    # Rows find their class by 128 bits of hash, so their vectors do not travel again.
    named = good.select("_id", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    linked = named.join(per_class, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select("_id", "n_links", "component_id")
    alone = rest.select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))
