"""Benchmark decontamination by winnowing.

Words are hashed, every ``GRAM`` words give one hash, and of every ``span - GRAM + 1`` consecutive hashes the smallest
(the last of equals) is kept. Two texts that share ``span`` words keep the same hash there, so no shared span is missed.
Fingerprints of the documents are looked up among those of the benchmark, and every hit is extended word by word in both
directions; only runs of ``span`` equal words (or of a whole shorter item) count, so chance hash hits do not.

The benchmark's side is cut into blocks of at most ``block_words`` words. Each block is sent to all tasks, so what is
broadcast has a fixed bound (an item longer than a block makes it that long); a benchmark of one
block needs no shuffle at all, a larger one a pass per block, each read, used and written before the next one is read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import LOWER, WORD_BYTE, WORD_PATTERN, mixed, span_hashes, stored, text_chunks, word_bounds

SPAN = 10
GRAM = 5
BLOCK_WORDS = 2_000_000
_WORDS = re.compile(WORD_PATTERN)
_FILTER_BITS = 22


def words_of(raw: bytes) -> list[bytes]:
    """Words of a text after lower-casing A-Z."""
    return _WORDS.findall(raw.lower())


def classes_of(lengths: Iterator[int], span: int) -> list[tuple[int, int]]:
    """(words per hash, hashes per window) for whole spans, and for each shorter item length there is."""
    sizes = {min(n, span) for n in lengths if n}
    return sorted((min(GRAM, n), n - min(GRAM, n) + 1) for n in sizes)


def winnowed(word_hashes: np.ndarray, firsts: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (ascending) and hashes kept by winnowing; ``firsts`` has the first word of each text, and the end."""
    n = len(word_hashes) - gram + 1
    windows = n - window + 1
    if windows < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = word_hashes[:n].copy()
    for i in range(1, gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:n + i]
    grams = mixed(grams + np.uint64(gram))
    least = grams[:windows].copy()
    where = np.arange(windows)
    for i in range(1, window):
        later = grams[i:windows + i]
        lower = later <= least
        least[lower] = later[lower]
        where[lower] = np.flatnonzero(lower) + i
    crosses = np.zeros(len(word_hashes) + 1, np.int32)
    crosses[firsts[1:-1]] = 1
    seen = np.cumsum(crosses)
    inside = seen[gram + window - 2:gram + window - 2 + windows] == seen[:windows]
    kept = where[inside]
    kept = kept[np.concatenate(([True], kept[1:] != kept[:-1]))] if len(kept) else kept
    return kept, grams[kept]


@dataclass(frozen=True)
class Block:
    """Benchmark items of one block: fingerprints sorted by hash, their item and place, and the items' words."""
    ids: list[str]
    texts: list[bytes]
    classes: list[tuple[int, int]]
    hashes: np.ndarray
    items: np.ndarray
    places: np.ndarray
    span: int

    @staticmethod
    def of(rows: list[tuple[str, bytes]], span: int) -> Block:
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        classes: set[tuple[int, int]] = set()
        for i, raw in enumerate(texts):
            lowered = LOWER[np.frombuffer(raw, np.uint8)]
            starts, ends = word_bounds(WORD_BYTE[lowered], np.zeros(0, np.int64))
            for gram, window in classes_of([len(starts)], span):
                classes.add((gram, window))
                places, hashes = winnowed(
                    span_hashes(lowered, starts, ends), np.array([0, len(starts)]), gram, window)
                found.append((hashes, np.full(len(places), i), places))
        if not found:
            return Block(ids, texts, [], np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int), span)
        hashes, items, places = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(hashes, kind="stable")
        return Block(ids, texts, sorted(classes), hashes[order], items[order], places[order], span)


def _ranges(words: list[bytes], hits: list[tuple[int, int, int]], items: dict[int, list[bytes]],
            span: int) -> tuple[list[int], set[int]]:
    """Extends hits (place in the text, item, place in the item): merged [start, end) word ranges, and the items."""
    done: dict[tuple[int, int], int] = {}
    runs, found = [], set()
    for p, item, q in sorted(hits):
        if done.get((item, p - q), -1) > p:
            continue
        other = items[item]
        a, b = p, p
        while a > 0 and a - p + q > 0 and words[a - 1] == other[a - 1 - p + q]:
            a -= 1
        while b < len(words) and b - p + q < len(other) and words[b] == other[b - p + q]:
            b += 1
        done[item, p - q] = b
        if b > p and b - a >= min(span, len(other)):
            runs.append((a, b))
            found.add(item)
    flat: list[int] = []
    for a, b in sorted(runs):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat, found


def _scan(docs: DataFrame, block: Block, key_type: str) -> DataFrame:
    """One pass over all texts: ``_key``, ``_twin``, ``n_words``, ``ranges`` and ``items`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(getattr(block, f.name) for f in fields(block)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Block(*sent.value)
        known = np.zeros(1 << _FILTER_BITS, bool)
        shift = np.uint64(64 - _FILTER_BITS)
        known[index.hashes >> shift] = True
        item_words: dict[int, list[bytes]] = {}
        for batch in batches:
            counts, all_ranges, all_items = [], [], []
            for _, rows, data, offsets in text_chunks(batch.column(2)):
                lowered = LOWER[data]
                starts, ends = word_bounds(WORD_BYTE[lowered], offsets)
                firsts = np.searchsorted(starts, offsets)
                counts.append(np.diff(firsts))
                hashes = span_hashes(lowered, starts, ends) if index.classes else None
                hits: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
                for gram, window in index.classes:
                    places, kept = winnowed(hashes, firsts, gram, window)
                    maybe = np.flatnonzero(known[kept >> shift])
                    places, kept = places[maybe], kept[maybe]
                    lo = np.searchsorted(index.hashes, kept, side="left")
                    hi = np.searchsorted(index.hashes, kept, side="right")
                    for at in np.flatnonzero(hi > lo):
                        p = int(places[at])
                        row = int(np.searchsorted(firsts, p, side="right")) - 1
                        hits[row] += [(p - int(firsts[row]), int(index.items[j]), int(index.places[j]))
                                      for j in range(lo[at], hi[at])]
                for row in range(rows):
                    if row not in hits:
                        all_ranges.append([])
                        all_items.append([])
                        continue
                    for _, item, _ in hits[row]:
                        if item not in item_words:
                            item_words[item] = words_of(index.texts[item])
                    words = words_of(lowered[offsets[row]:offsets[row + 1]].tobytes())
                    ranges, found = _ranges(words, hits[row], item_words, index.span)
                    all_ranges.append(ranges)
                    all_items.append(sorted({index.ids[i] for i in found}))
            total = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(total, pa.int64()),
                 pa.array(all_ranges, pa.list_(pa.int64())), pa.array(all_items, pa.list_(pa.string()))],
                ["_key", "_twin", "n_words", "ranges", "items"])

    return docs.mapInArrow(
        run, f"_key {key_type}, _twin long, n_words long, ranges array<bigint>, items array<string>")


def _merged_length(ranges: Column) -> Column:
    """Words covered by a flat list of [start, end) pairs that may overlap."""
    pairs = F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(ranges) - 1), lambda i: i % 2 == 0),
        lambda i: F.struct(F.get(ranges, i).alias("a"), F.get(ranges, i + 1).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    total = F.aggregate(pairs, zero, lambda s, r: F.struct(
        (s["n"] + F.greatest(F.lit(0).cast("long"), r["b"] - F.greatest(r["a"], s["upto"]))).alias("n"),
        F.greatest(s["upto"], r["b"]).alias("upto")))
    return F.when(F.size(ranges) > 0, total["n"]).otherwise(F.lit(0).cast("long"))


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, span: int, block_words: int) -> tuple[int, Iterator[Block]]:
    """How many blocks of about ``block_words`` words the benchmark makes (one if it fits), and each when it is asked for."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.coalesce(
        F.col(text_col), F.lit("")).cast("binary").alias("text")).filter("id IS NOT NULL")
    sized = items.withColumn("n", F.octet_length("text") / 4 + 1)
    total = sized.agg(F.sum("n")).first()[0] or 0
    count = max(1, -(-int(total) // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(count)))
    return count, (Block.of([(r["id"], bytes(r["text"])) for r in dealt.filter(F.col("block") == b).select("id", "text").collect()], span)
                   for b in range(count))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings) and ``contaminated``.

    A text without words, or null, has zeros and no items; so has every text if the benchmark is empty. Items with a
    null id or without words hit nothing; items that share an id count once. Repeated rows come back repeated, ids
    may be null, other columns are not read.
    """
    key_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("_key"), F.xxhash64(text_col).alias("_twin"), F.col(text_col).alias("_text"))
    count, blocks = benchmark_blocks(benchmark, item_col, item_text_col, span, block_words)
    if count == 1:
        found = _scan(slim, next(blocks), key_type)
    else:
        parts = None
        for block in blocks:
            # The first pass has a row for every text, the others for those with hits.
            part = _scan(slim, block, key_type).withColumn("_row", F.lit(int(parts is None)))
            part = stored(part if parts is None else part.filter("size(items) > 0"), "benchmark-pass")
            parts = part if parts is None else parts.unionAll(part)
        found = parts.groupBy("_key", "_twin").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("ranges")).alias("ranges"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.explode(F.sequence(F.lit(1), F.sum("_row"))).alias("_copy"),
        )
    return found.select(
        F.col("_key").alias(id_col), "n_words", _merged_length(F.col("ranges")).alias("n_hit"),
        F.array_sort("items").alias("items"), (F.size("items") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that share no span with the benchmark; repeated ids go if one of their rows does."""
    dirty = find_contamination(docs, benchmark, id_col, **options).filter("contaminated").select(id_col).distinct()
    return docs.join(dirty, id_col, "left_anti").select(*docs.columns)
