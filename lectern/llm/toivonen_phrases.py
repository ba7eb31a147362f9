"""Phrase collocations by Toivonen's method.

A sample proposes the words and word pairs that may be frequent, at a lowered threshold. A full pass then counts what
was proposed together with the negative border: every phrase whose parts (without the first and without the last word)
were all proposed. For single words that is every word. If a border phrase that was not proposed turns out frequent,
phrases built on it have not been counted; expansion passes add it to the known ones and count those, until a pass
finds nothing new. Since a phrase is never more frequent than its parts, nothing frequent can then be missing, whatever
the sample held.

Which words and pairs are known travels to the tasks as two bit tables of fixed size, filled by hash. A slot that two
phrases share only lets more phrases be counted, never fewer. The passes count by 64-bit hash, so narrow rows are
shuffled, and a shared hash can only add to a count. A last pass counts the phrases whose hash was frequent by their
text, so the counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import LOWER, Shipped, mixed, span_hashes, stored, word_bounds
from lectern.session import small_batches

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
SAMPLE = 0.25
TABLE_BITS = 26
_SLICE_BITS = 20
_BLOCK_WORDS = 1 << 17
_BLOCK_BYTES = 1 << 20
_HELD_ROWS = 1 << 20
_ROWS_AT_ONCE = 2000
_HELD_WORDS = 1 << 18
_NO_LANG = "und"

#: The characters that end a piece of text; blanks and tabs stand between its words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz" + b" " * len(PIECE_ENDS))
_IS_END = np.isin(np.arange(256), np.frombuffer(PIECE_ENDS, np.uint8))
_IN_WORD = ~_IS_END & ~np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8))
_FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class _Words(dict):
    """Numbers the words of one language from 0."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def hashed_words(lang: str, block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a block, and whether the next word is of the same piece."""
    data = np.frombuffer(block, np.uint8)
    starts, ends = word_bounds(_IN_WORD[data], np.zeros(1, np.int64))
    piece = np.searchsorted(np.flatnonzero(_IS_END[data]), starts)
    follows = np.zeros(len(starts), bool)
    follows[:-1] = piece[1:] == piece[:-1]
    return mixed(span_hashes(LOWER[data], starts, ends) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))), follows


def phrase_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of ``k`` words that start at each place but the last k - 1, from those of their words."""
    n = len(hashes) - k + 1
    if k == 1:
        return hashes
    total = np.zeros(max(0, n), np.uint64)
    for i in range(k):
        total = mixed(total + hashes[i:n + i] * _FACTORS[i] + np.uint64(k))
    return total


def _known(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _table(hashes: DataFrame) -> np.ndarray:
    """The column ``h`` as a table of 2^TABLE_BITS bits; the driver gets slices of fixed size."""
    def fill(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << _SLICE_BITS, np.uint8)
        bits[part["slot"].to_numpy() & ((1 << _SLICE_BITS) - 1)] = 1
        return pd.DataFrame({"slice": [key[0]], "content": [np.packbits(bits, bitorder="little").tobytes()]})

    slots = hashes.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).cast("int").alias("slot")).distinct()
    sliced = slots.withColumn("slice", F.shiftright("slot", _SLICE_BITS)).groupBy("slice")
    table, size = np.zeros(1 << (TABLE_BITS - 3), np.uint8), 1 << (_SLICE_BITS - 3)
    for row in sliced.applyInPandas(fill, "slice int, content binary").collect():
        table[row["slice"] * size:(row["slice"] + 1) * size] = np.frombuffer(row["content"], np.uint8)
    return table


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Texts of each language, joined to blocks of about ``_BLOCK_BYTES``; a text is never cut here."""
    open_blocks: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py()
        if not text:
            continue
        lang = _NO_LANG if lang is None else lang
        open_blocks.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] >= _BLOCK_BYTES:
            yield lang, "\n".join(open_blocks.pop(lang)).encode()
            del sizes[lang]
    for lang, texts in open_blocks.items():
        yield lang, "\n".join(texts).encode()


class _Summed:
    """Counts by key that are summed as they come in, so that only different keys are held."""

    def __init__(self):
        self.keys, self.counts, self.held, self.least = [], [], 0, 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.held += len(found)
        if self.held > 2 * self.least + _BLOCK_WORDS:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.keys, self.counts = [keys[first]], [np.add.reduceat(counts[order], first)]
        self.held = self.least = len(self.keys[0]) if self.keys else 0
        return (self.keys[0], self.counts[0]) if self.keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


Chooser = Callable[[np.ndarray, np.ndarray, np.ndarray], "list[np.ndarray]"]


def _walk(batches: Iterator[pa.RecordBatch], choose: Callable, by_text: bool) -> Iterator[pa.RecordBatch]:
    """Partial counts of the phrases that ``choose`` lets through, a language at a time.

    ``choose`` gets the hashes of the phrases of 1, 2 and 3 words at every place of a block and which places hold such
    a phrase, and narrows the latter. Rows are (k, h, n), or (lang, phrase, k, n) if ``by_text``.
    """
    words: dict[str, _Words] = {}
    sums: dict[tuple[str, int], _Summed] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, k), total in sums.items():
            keys, counts = total.merged()
            for at in range(0, len(keys), 1 << 16):
                some, n = keys[at:at + (1 << 16)], pa.array(counts[at:at + (1 << 16)].astype(np.int64))
                level = pa.array(np.full(len(some), k, np.int32))
                if not by_text:
                    yield pa.RecordBatch.from_arrays([level, pa.array(some.view(np.int64)), n], ["k", "h", "n"])
                    continue
                names = list(words[lang])
                parts = [(some >> np.uint64(21 * i) & np.uint64((1 << 21) - 1)).tolist() for i in range(k)]
                phrases = [b" ".join([names[i] for i in x]) if k else b"" for x in zip(*parts)] if k else [b""] * len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), level, n],
                    ["lang", "phrase", "k", "n"])
        sums.clear()

    for batch in batches:
        for lang, block in _blocks(batch):
            every, follows = hashed_words(lang, block)
            tokens = block.translate(_PLAIN).split() if by_text else []
            for at in range(0, len(every), _BLOCK_WORDS):
                # Two words more, for the phrases that begin at the last places.
                some = slice(at, at + _BLOCK_WORDS + MAX_WORDS - 1)
                n = min(_BLOCK_WORDS, len(every) - at)
                each, on = (np.concatenate((x[some], np.zeros(MAX_WORDS - 1, x.dtype)))[:n + MAX_WORDS - 1] for x in (every, follows))
                hashes = [phrase_hashes(each, k)[:n] for k in range(1, MAX_WORDS + 1)]
                whole = [np.ones(n, bool)]
                for k in range(1, MAX_WORDS):
                    whole.append(whole[-1] & on[k - 1:n + k - 1])
                if by_text:
                    ids = np.fromiter(map(words.setdefault(lang, _Words()).__getitem__, tokens[some]), np.int64)
                    ids = np.concatenate((ids, np.zeros(MAX_WORDS - 1, np.int64)))
                for k, chosen in enumerate(choose(each, hashes, whole), 1):
                    places = np.flatnonzero(chosen)
                    if len(places):
                        key = hashes[k - 1][places]
                        if by_text:
                            key = sum(ids[places + i].astype(np.uint64) << np.uint64(21 * i) for i in range(k))
                        sums.setdefault((lang, k), _Summed()).add(key)
                if by_text:
                    sums.setdefault((lang, 0), _Summed()).add(np.zeros(n, np.uint64))
                many_words = sum(map(len, words.values())) > _HELD_WORDS
                if many_words or sum(s.held for s in sums.values()) > _HELD_ROWS:
                    yield from flushed()
                if many_words:
                    words.clear()
    yield from flushed()


def _counted(docs: DataFrame, choose: Callable) -> DataFrame:
    """(k, h, n) of the phrases that ``choose`` lets through, summed over ``docs`` (lang, text)."""
    parts = docs.mapInArrow(lambda batches: _walk(batches, choose, False), "k int, h long, n long")
    return parts.groupBy("k", "h").agg(F.sum("n").alias("n"))


def _pairs_of(words_known: np.ndarray, pairs_known: np.ndarray | None, each: np.ndarray, hashes: list, whole: list) -> list[np.ndarray]:
    """Places of the pairs of known words, and of the triples of known pairs."""
    n = len(hashes[0])
    word = _known(words_known, each)
    pair = whole[1] & word[:n] & word[1:n + 1]
    if pairs_known is None:
        return [pair, np.zeros(n, bool)]
    known = pair & _known(pairs_known, hashes[1])
    after = np.concatenate((known[1:], [False]))
    if len(each) > n:
        last = phrase_hashes(each[n:n + 2], 2)
        after[-1] = word[n] and word[n + 1] and _known(pairs_known, last)[0]
    return [pair, whole[2] & known & after]


def _shipped(spark: SparkSession, *tables: np.ndarray) -> list[Shipped]:
    return [Shipped(spark, x) for x in tables]


def frequent_hashes(docs: DataFrame, min_count: int = MIN_COUNT, sample: float = SAMPLE, seed: int = 0) -> DataFrame:
    """(k, h) of every phrase hash of ``docs`` (lang, text) that stands at ``min_count`` places or more."""
    spark = docs.sparkSession
    lowered = max(1, int(min_count * sample * 0.8))
    with small_batches(spark, _ROWS_AT_ONCE):
        return _frequent_hashes(spark, docs, min_count, sample, seed, lowered)


def _frequent_hashes(spark: SparkSession, docs: DataFrame, min_count: int, sample: float, seed: int, lowered: int) -> DataFrame:
    proposed = stored(_counted(docs.sample(sample, seed), lambda each, hashes, whole: [whole[0], whole[1]]).filter(
        F.col("n") >= lowered).select("k", "h"), "phrase-proposals")
    words_known, pairs_known = (_table(proposed.filter(F.col("k") == k)) for k in (1, 2))
    before: tuple[np.ndarray, np.ndarray] | None = None
    found: DataFrame | None = None
    while True:
        now, earlier = _shipped(spark, words_known, pairs_known), before and _shipped(spark, *before)

        def choose(each: np.ndarray, hashes: list, whole: list, now=now, earlier=earlier) -> list[np.ndarray]:
            chosen = _pairs_of(*[x.value for x in now], each, hashes, whole)
            if earlier is None:
                return [whole[0], *chosen]
            counted = _pairs_of(*[x.value for x in earlier], each, hashes, whole)
            return [np.zeros(len(whole[0]), bool), *[c & ~old for c, old in zip(chosen, counted, strict=True)]]

        fresh = stored(_counted(docs, choose).filter(F.col("n") >= min_count).select("k", "h"), "phrase-counts")
        found = fresh if found is None else found.unionByName(fresh)
        before = words_known, pairs_known
        words_known, pairs_known = words_known | _table(fresh.filter("k = 1")), pairs_known | _table(fresh.filter("k = 2"))
        if all(np.array_equal(*x) for x in zip(before, (words_known, pairs_known), strict=True)):
            return found


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                  sample: float = SAMPLE, seed: int = 0) -> DataFrame:
    """``lang``, ``phrase`` (words joined by a space), ``k`` (its words, 1 to 3) and ``n`` of every phrase that stands at
    ``min_count`` places or more of its language, and for each language a row of k = 0 with the number of its words.

    Texts are cut at the characters ``PIECE_ENDS`` into pieces and these at blanks and tabs into words; a phrase lies in
    one piece. A null language is `und`. A null or empty text has no words; an empty table gives no rows. Repeated rows
    count as often as they stand there. Other columns are ignored, whatever their names.
    """
    slim = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    frequent = frequent_hashes(slim, min_count, sample, seed)
    tables = _shipped(slim.sparkSession, *[_table(frequent.filter(F.col("k") == k)) for k in range(1, MAX_WORDS + 1)])

    def choose(each: np.ndarray, hashes: list, whole: list) -> list[np.ndarray]:
        return [w & _known(table.value, h) for w, table, h in zip(whole, tables, hashes, strict=True)]

    parts = slim.mapInArrow(lambda batches: _walk(batches, choose, True), "lang string, phrase string, k int, n long")
    total = parts.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= min_count) | (F.col("k") == 0))


def _words(first: int, count: int, phrase: str = "phrase") -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
                 sample: float = SAMPLE, seed: int = 0) -> DataFrame:
    """The first ``top`` phrases of two and three words of each language by score: ``lang``, ``rank``, ``phrase``, ``a``
    (places), ``l`` and ``r`` (places of the two parts at the cut), ``n`` (words of the language) and ``score``.

    The score is a * a / (l * r) in millionths, rounded down, at the cut where it is least (the first of those). A
    phrase inside a longer one that stands at half its places or more is left out. Ties go by a and then by the phrase's
    bytes. Input as in ``phrase_counts``.
    """
    with small_batches(docs.sparkSession, _ROWS_AT_ONCE):
        counts = stored(phrase_counts(docs, lang_col, text_col, min_count, sample, seed), "phrases")
    longer = counts.filter("k >= 2").select("lang", "phrase", F.col("n").alias("a"), "k")
    cuts = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "k", "cut", F.expr("array_join(slice(split(phrase, ' '), 1, cut), ' ')").alias("left"),
        F.expr("array_join(slice(split(phrase, ' '), cut + 1, k - cut), ' ')").alias("right"))
    # A part is at least as frequent as the whole, so it is among the counted.
    part = counts.filter("k >= 1").select("lang", F.col("phrase").alias("part"), F.col("n").alias("places"))
    lefts, rights = (part.select(F.col("lang").alias(f"lang_{s}"), F.col("part").alias(f"part_{s}"), F.col("places").alias(s)) for s in "lr")
    scored = cuts.join(lefts, (F.col("lang") == F.col("lang_l")) & (F.col("left") == F.col("part_l"))).join(
        rights, (F.col("lang") == F.col("lang_r")) & (F.col("right") == F.col("part_r"))).withColumn(
        "score", F.expr("(1000000 * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a", "k").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    # The most frequent longer phrase around each shorter one.
    around = longer.filter("k > 2").select("lang", "a", F.explode(F.array(_words(1, 2), _words(2, 2))).alias("inner")).groupBy("lang", "inner").agg(
        F.max("a").alias("around")).withColumnRenamed("lang", "lang_i")
    kept = lowest.join(around, (F.col("lang") == F.col("lang_i")) & (F.col("phrase") == F.col("inner")), "left").filter(
        "around IS NULL OR 100 * around < 50 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "low.l", "low.r", "low.score").withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= top)
    totals = counts.filter("k = 0").select(F.col("lang").alias("lang_n"), F.col("n").alias("n"))
    return ranked.join(totals, F.col("lang") == F.col("lang_n")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
