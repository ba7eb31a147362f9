import random

import numpy as np
import pytest

from lectern.llm import winnow_decontaminate as W


def brute(text, items, span=10):
    words = W.words_of((text or "").encode())
    hit, found = set(), set()
    for item, other in items:
        n = min(span, len(other))
        windows = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]  # few words, so many chance hits and repeats
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 6, 9, 10, 11, 25])))) for i in range(25)]
    items += [(90, ""), (91, None), (92, "same same same same same same same same same same same"), (3, "shared id Other text")]
    docs = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            words += (rng.choice(items)[1] or "").upper().split()[rng.randrange(3):]
        docs.append((i, "  -- ".join(words)))
    docs += [(200, "same " * 300), (201, None), (202, "")]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), docs, items)


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_equals_brute_force(case, block_words):
    docs, benchmark, texts, items = case
    words = [(str(i), W.words_of((t or "").encode())) for i, t in items]
    got = {r["doc_id"]: r for r in W.find_contamination(docs, benchmark, block_words=block_words).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute(text, words), i
        assert got[i]["contaminated"] == (got[i]["n_hit"] > 0)


def test_winnowing_keeps_a_hash_in_every_window():
    random_hashes = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    places, _ = W.winnowed(random_hashes, np.array([0, 500]), 5, 6)
    assert places[0] <= 5 and places[-1] >= 490 and np.diff(places).max() <= 6


def test_odd_rows(spark, odd_documents, no_documents, case):
    rows = W.find_contamination(odd_documents, case[1]).collect()
    assert len(rows) == odd_documents.count()
    assert len(W.find_contamination(odd_documents, case[1], block_words=40).collect()) == odd_documents.count()
    assert W.find_contamination(no_documents, case[1]).count() == 0
    clean = W.find_contamination(odd_documents, case[1].limit(0)).collect()
    assert len(clean) == odd_documents.count() and not any(r["contaminated"] or r["items"] for r in clean)
    kept = W.remove_contaminated(odd_documents, spark.createDataFrame([(1, "two three four five six")], "item_id long, text string"))
    assert kept.columns == odd_documents.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["1", "2", "3", "4", "7", "8", "9", "None", "None"])
