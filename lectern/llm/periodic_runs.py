"""Periodic runs of words: descending-LCP Kruskal over the suffixes of each text.

A run is a stretch of words with smallest period q, at least ``min_length`` and ``exponent * q`` words long, that no
neighbouring word extends. Suffixes are sorted, and neighbours in that order are joined like edges of a spanning tree,
the longest common prefix (LCP) first. A class keeps the sorted positions of its suffixes; the smaller class is put
into the larger. Two positions p < p + d that become neighbours in a class at LCP l with d <= l repeat the same d words,
and no fewer, since a shorter repeat would have put a position between them before. They seed the run from p of d + l
words if the word before p differs from the one d later. The ends of every run are found so: its first position and the
one a period later meet at exactly the LCP that the run leaves.

Only words that can lie in a run are sorted: every word of a run stands in it at least ``exponent`` times, and within a
run short word sequences repeat. The rest of a text is cut away first, which is exact. All texts of a chunk share one
suffix sort, with words numbered text by text so that no two texts have one in common. Nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import mixed, text_chunks

MIN_LENGTH = 6
EXPONENT = 4

RUN_TYPE = "struct<start:bigint,length:bigint,period:bigint>"
_GRAM = 4


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _gram_length(min_length: int, exponent: int) -> int:
    """Words of a sequence such that every place of a run is covered by one that occurs twice in the run."""
    return max(1, min([_GRAM] + [max(min_length, exponent * q) - 2 * q + 1 for q in range(1, min_length + 1)]))


def _least_lcp(min_length: int, exponent: int) -> int:
    """The LCP of a run's first position and the one a period later is at least this."""
    return min(max(min_length, exponent * q) - q for q in range(1, min_length + 1))


def candidate_places(words: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Which places of ``words`` (numbers; no two texts share one) may lie in a run."""
    inside = np.bincount(words)[words] >= exponent
    gram = _gram_length(min_length, exponent)
    if gram > 1 and len(words) >= gram:
        n = len(words) - gram + 1
        whole = inside[:n].copy()
        key = words[:n].astype(np.uint64)
        for i in range(1, gram):
            whole &= inside[i:n + i]
            key = mixed(key + np.uint64(0x9E3779B97F4A7C15)) ^ words[i:n + i].astype(np.uint64)
        at = np.flatnonzero(whole)
        _, group, count = np.unique(key[at], return_inverse=True, return_counts=True)
        repeated = at[count[group] > 1]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + gram, -1)
        inside &= np.cumsum(cover)[:-1] > 0
    # Stretches shorter than a run can be.
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    for start, end in zip(edges[::2][short := np.diff(edges)[::2] < min_length], edges[1::2][short], strict=True):
        inside[start:end] = False
    return inside


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``symbols`` in order, by doubling, and the LCP of each with the one before it (0 for the first)."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    levels, width = [rank], 1
    while int(rank.max()) < n - 1:
        key = rank.astype(np.int64) * (n + 1)
        key[:max(0, n - width)] += rank[width:].astype(np.int64) + 1
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int32)
        rank[order] = fresh
        levels.append(rank)
        width *= 2
    suffixes = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, np.int64)
    a, b, reach = suffixes[:-1], suffixes[1:], np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 2, -1, -1):
        known = levels[level]
        at, to = a + reach, b + reach
        fits = (at < n) & (to < n)
        same = known[np.minimum(at, n - 1)] == known[np.minimum(to, n - 1)]
        reach += np.where(fits & same, 1 << level, 0)
    lcp[1:] = reach
    return suffixes, lcp


def runs_of(symbols: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``symbols``."""
    if len(symbols) < 2:
        return []
    suffixes, lcp = sorted_suffixes(symbols)
    edges = np.flatnonzero(lcp >= _least_lcp(min_length, exponent))
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    places: dict[int, list[int]] = {}
    before = symbols.tolist()
    found = []

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def seed(p: int, q: int, shared: int) -> None:
        period = q - p
        if period <= shared and (p == 0 or before[p - 1] != before[q - 1]) and period + shared >= max(min_length, exponent * period):
            found.append((p, period + shared, period))

    for x, y, shared in zip(suffixes[edges - 1].tolist(), suffixes[edges].tolist(), lcp[edges].tolist(), strict=True):
        a, b = root(x), root(y)
        large, small = places.pop(a, [a]), places.pop(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        # Only neighbours in the united class count, so gaps into which several small positions fall are told apart.
        gaps = [bisect_left(large, p) for p in small]
        for i, (p, gap) in enumerate(zip(small, gaps, strict=True)):
            if gap and (i == 0 or gaps[i - 1] != gap):
                seed(large[gap - 1], p, shared)
            if gap < len(large) and (i + 1 == len(small) or gaps[i + 1] != gap):
                seed(p, large[gap], shared)
        if 16 * len(small) > len(large):
            large += small
            large.sort()
        else:
            for p in small:
                insort(large, p)
        parent[b] = a
        places[a] = large
    return found


def runs_in_texts(texts: list[list[bytes]], min_length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words, by start and then period."""
    numbered, total = [], 0
    for words in texts:
        numbers = _Numbers()
        numbered.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) + total)
        total += len(numbers)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    words = np.concatenate(numbered) if numbered else np.zeros(0, np.int64)
    if not len(words):
        return found
    kept = np.flatnonzero(candidate_places(words, min_length, exponent))
    if not len(kept):
        return found
    # A symbol of its own stands before every stretch, so no repeat reaches over a cut.
    first = np.concatenate(([True], np.diff(kept) > 1))
    slots = np.arange(len(kept)) + np.cumsum(first)
    symbols = np.full(len(kept) + int(first.sum()), -1, np.int64)
    symbols[slots] = words[kept]
    gaps = np.flatnonzero(symbols < 0)
    symbols[gaps] = total + np.arange(len(gaps))
    origin = np.zeros(len(symbols), np.int64)
    origin[slots] = kept
    ends = np.cumsum([len(x) for x in texts])
    for slot, length, period in sorted(runs_of(symbols, min_length, exponent)):
        at = int(origin[slot])
        text = int(np.searchsorted(ends, at, side="right"))
        found[text].append((at - (int(ends[text - 1]) if text else 0), length, period))
    return [sorted(x, key=lambda run: (run[0], run[2])) for x in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and the first period of each run, joined by one space."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(cover)[:-1] == 0).tolist()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
              exponent: int = EXPONENT) -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed`` (the
    text with one period left of each run, its words joined by one space) of every row.

    Words are separated by ASCII white space. A null or empty text has no words, no runs and an empty collapsed text.
    Every row gives a row, also repeated ones and those without an id; other columns are left out, whatever their
    names. A text is handled whole by one task, so it must fit there; ``exponent`` is a whole number of at least 2.
    """
    if exponent < 2 or min_length < 1:
        raise ValueError("exponent must be at least 2, min_length at least 1")
    slim = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    id_type = slim.schema["_id"].dataType.simpleString()
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, count, data, offsets in text_chunks(batch.column(1)):
                whole = data.tobytes()
                texts = [whole[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                runs = runs_in_texts(texts, min_length, exponent)
                flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in runs]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, count), pa.array([len(x) for x in texts], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
                         [pa.array(flat[:, i]) for i in range(3)], fields=list(run_type))),
                     pa.array([collapsed(*x) for x in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string())],
                    ["_id", "n_words", "runs", "collapsed"])

    return slim.mapInArrow(run, f"_id {id_type}, n_words long, runs array<{RUN_TYPE}>, collapsed string").withColumnRenamed("_id", id_col)
