"""SimHash near-duplicates: Golay-code fuzzy hashing of fingerprint segments.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. If two fingerprints differ in at most two bits, then
at least one segment is equal, and the next one differs in at most two bits. The segment that may differ is turned into
the indices of the Golay codewords nearest to it and to its 23 neighbours (one or six of them): two words at most two
bits apart have a neighbour in common, so they share an index. Each fingerprint thus gets 3 x (1 or 6) keys of
(equal segment, codeword index); fingerprints meet on a key and are then compared bit by bit. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.llm.common import components, stored

#: The generator polynomial of the [23, 12, 7] Golay code, and the bit places of the three segments.
GOLAY_POLYNOMIAL = 0xC75
SEGMENTS = ((0, 23), (23, 23), (46, 18))

SHINGLE_WORDS = 3
MAX_DISTANCE = 2


def fingerprint(text: str | bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: bit b is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    raw = text.encode() if isinstance(text, str) else text or b""
    words = raw.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle_words + 1
    if n < 2:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.fromiter(
        [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle_words - 1:].tolist(), strict=True)],
        np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * ones > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col`` and ``fp`` (long, the 64 bits) of every whole text."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    id_type = slim.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py(), shingle_words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["_id", "fp"])

    return slim.mapInArrow(run, f"_id {id_type}, fp long").withColumnRenamed("_id", id_col)


def _nearest_table() -> np.ndarray:
    """Syndrome -> error pattern of weight at most 3."""
    table = np.zeros(2048, np.int64)
    bits = [1 << i for i in range(23)]
    patterns = [0] + bits + [a | b for i, a in enumerate(bits) for b in bits[:i]]
    patterns += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    values = np.array(patterns, np.int64)
    table[syndromes(values)] = values
    return table


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator polynomial."""
    left = words.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GOLAY_POLYNOMIAL << (bit - 11)), left)
    return left


def codeword_keys(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each 23-bit word, the indices of the codewords nearest to it and to its 23 neighbours; -1 for repeats."""
    around = words[:, None] ^ np.concatenate(([0], 1 << np.arange(23)))[None, :]
    codewords = around ^ table[syndromes(around)]
    found = np.sort(codewords >> 11, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def segment_keys(classes: DataFrame) -> DataFrame:
    """``fp``, ``node``, ``place`` and ``key`` rows of distinct fingerprints: see the module text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _nearest_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                nodes = part.column(0).to_numpy(zero_copy_only=False)
                fps = part.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                pieces = [(fps >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
                for place in range(len(SEGMENTS)):
                    found = codeword_keys(pieces[(place + 1) % len(SEGMENTS)], table)
                    rows, cols = np.nonzero(found >= 0)
                    key = (place << 40) | (pieces[place][rows] << 12) | found[rows, cols]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[rows]), pa.array(fps[rows].view(np.int64)), pa.array(key)],
                        ["node", "fp", "key"])

    return classes.select("node", "fp").mapInArrow(run, "node long, fp long, key long")


def fingerprint_links(classes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Linked pairs (``a`` < ``b``, nodes) of distinct fingerprints at most ``max_distance`` (0 to 2) bits apart.

    A fingerprint has at most 2,080 others within two bits, so the pairs grow with the classes, whatever the groups.
    """
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError("the codeword keys guarantee links of at most two differing bits")
    keys = segment_keys(classes)
    left = keys.select("key", F.col("node").alias("a"), F.col("fp").alias("fa"))
    right = keys.select("key", F.col("node").alias("b"), F.col("fp").alias("fb"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= max_distance)
    return left.join(right, (left["key"] == right["key"]) & close).select("a", "b").distinct()


def group_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` (smallest id reachable by links, itself included) of every row.

    Null and empty texts have fingerprint zero and link like any other. Equal fingerprints form one class, so
    copies cost one row each. A null id stands in no group (null component); repeated ids come back repeated. Ids are of
    any type that can be ordered. Other columns are not read. An empty table gives an empty result.
    """
    marks = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    # Fingerprints are the nodes, so ids may be of any type that can be ordered.
    classes = stored(marks.filter(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("first")).select(
        "fp", F.col("fp").alias("node"), "first"), "classes")
    merged = components(fingerprint_links(classes, max_distance), "simhash")
    grouped = classes.join(merged, "node", "left").select("fp", "first", F.coalesce("component", "node").alias("group"))
    smallest = grouped.groupBy("group").agg(F.min("first").alias("_component"))
    named = grouped.join(smallest, "group").select(F.col("fp").alias("_fp"), "_component")
    return marks.join(named, marks["fp"] == named["_fp"], "left").select(
        id_col, "fp", F.when(F.col(id_col).isNotNull(), F.col("_component")).alias("component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows whose id is the smallest of their group; rows with a null id are kept, repeated ids once."""
    groups = group_documents(docs, id_col, **options)
    later = groups.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    kept = docs.join(later, id_col, "left_anti").select(*docs.columns)
    return _first_of_repeats(kept, id_col)


def _first_of_repeats(docs: DataFrame, id_col: str) -> DataFrame:
    """One row of each repeated id, the first by its columns as JSON; the others pass without a further shuffle."""
    twice = docs.groupBy(id_col).agg(F.count("*").alias("n")).filter(f"n > 1 AND `{id_col}` IS NOT NULL").select(id_col)
    again = stored(twice, "repeated")
    if again.isEmpty():
        return docs
    rest = docs.join(again, id_col, "left_anti").select(*docs.columns)
    packed = docs.join(again, id_col, "left_semi").select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.to_json("row")))
    firsts = packed.withColumn("place", place).filter("place = 1")
    return rest.unionAll(firsts.select("row.*"))
