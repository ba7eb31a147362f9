import re
from collections import Counter

import numpy as np
import pytest

from lectern.llm import toivonen_phrases as P


def plain(rows, min_count=10, top=2000):
    """Counting everything, a phrase at a time."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in counts.items() if n >= min_count}
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        score, k = min((1000000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words)))
        inside = [n for (other, longer), n in frequent.items() if other == lang and len(longer) > len(words)
                  and any(longer[i:i + len(words)] == words for i in range(len(longer)))]
        if not any(100 * n >= 50 * a for n in inside):
            out.setdefault(lang, []).append(
                (-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total[lang], -score) for lang, found in out.items()
                  for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)] + ["Übel", "a\x1cb", "0", "w1-w2"]
    weights = 1 / np.arange(1, len(words) + 1)
    out = []
    for n in range(300):
        picked = rng.choice(words, int(rng.integers(0, 60)), p=weights / weights.sum()).tolist()
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " W1 w2 w3 "]) for w in picked)
        out.append(([None, "und", "en", "de"][n % 4], text))
    return [*out, ("en", None), (None, ""), ("xx", "only a few words"), ("long", "to be or not to be, " * 3_000)]


def test_equals_counting_everything(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    expected = plain(rows)
    assert len(expected) > 100
    assert sorted(map(tuple, P.collocations(docs).collect())) == expected


@pytest.mark.parametrize("sample", [0.0, 1.0])
def test_any_sample_gives_the_same(spark, rows, sample):
    """An empty sample proposes nothing, so every level comes from border failures and expansion passes."""
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, P.collocations(docs, sample=sample, top=50).collect())) == plain(rows, top=50)


def test_small_blocks_and_early_flushes_change_nothing(rows, monkeypatch):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[:300]]), pa.array([r[1] for r in rows[:300]])], ["lang", "text"])
    everything = lambda each, hashes, whole: whole

    def total(by_text):
        out = Counter()
        for part in P._walk(iter([batch]), everything, by_text):
            for *key, n in zip(*part.to_pydict().values()):
                out[tuple(key)] += n
        return out

    before = total(True), total(False)
    monkeypatch.setattr(P, "_BLOCK_WORDS", 7)
    monkeypatch.setattr(P, "_BLOCK_BYTES", 100)
    monkeypatch.setattr(P, "_HELD_ROWS", 40)
    assert (total(True), total(False)) == before


def test_odd_documents(spark, odd_documents, no_documents):
    docs = odd_documents.selectExpr("*", "IF(doc_id = 5, CAST(NULL AS string), 'en') AS lang", "1 AS k", "2 AS h", "3 AS phrase")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, P.collocations(docs, min_count=2).collect())) == plain(rows, min_count=2)
    assert P.collocations(no_documents.selectExpr("*", "'en' AS lang")).collect() == []


def test_words_of_a_block_are_hashed_together():
    """As many hashes as words of the plain split, equal for equal words of a language, and whether a piece goes on."""
    block = "One two,\tthree  ÉTÉ one.\nTWO;\x0b;two x\x1fy  . one".encode()
    pieces = [x.split() for x in "one two|three  ÉTÉ one||two|||two x\x1fy  | one".encode().split(b"|")]
    words = [w for piece in pieces for w in piece]
    hashes, follows = P.hashed_words("en", block)
    assert follows.tolist() == [n < len(piece) - 1 for piece in pieces for n in range(len(piece))]
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(set(words))
    assert all((hashes[i] == hashes[j]) == (v == w) for i, v in enumerate(words) for j, w in enumerate(words))
    assert not set(hashes.tolist()) & set(P.hashed_words("de", block)[0].tolist())
