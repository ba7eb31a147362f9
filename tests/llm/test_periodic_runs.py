import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import periodic_runs as R
from lectern.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, min_length=6, exponent=4):
    """Every period tried on its own; a stretch whose words repeat with a smaller period is left out."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q):
                part = words[i:i + length]
                if not any(all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=4), st.sampled_from([(6, 4), (1, 2), (4, 2), (5, 3)]))
def test_runs_equal_brute_force(texts, rule):
    assert R.runs_in_texts(texts, *rule) == [plain_runs(x, *rule) for x in texts]


def test_nested_and_long_runs():
    rng = random.Random(3)
    for _ in range(60):
        words = []
        while len(words) < 300:
            part = [rng.choice([b"x", b"y", b"z", b"w"]) for _ in range(rng.randint(1, 9))]
            words += part * rng.randint(1, 9)
        assert R.runs_in_texts([words], 6, 4) == [plain_runs(words)]
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(14):
        a, b = b, b + a
    assert R.runs_in_texts([b], 6, 2) == [plain_runs(b, 6, 2)]
    assert R.runs_in_texts([[b"k"] * 30_000], 6, 4) == [[(0, 30_000, 1)]]
    assert R.collapsed([b"k"] * 30_000, [(0, 30_000, 1)]) == b"k"


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in R.find_runs(odd_documents).collect()]
    assert len(rows) == odd_documents.count()
    assert sorted(r for r in rows if r[0] in (1, 2, 3, 7)) == [(i, 0, 0, "") for i in (1, 2, 3, 7)]
    assert [r for r in rows if r[0] == 5] == [(5, 6, 0, "one two three four five six")] * 2
    assert sorted((r[1], r[3]) for r in rows if r[0] is None) == [(0, ""), (7, "a text without an id at all")]
    assert R.find_runs(no_documents).collect() == []
    repeated = spark.createDataFrame([("s", "go " * 6 + "on")], "doc_id string, text string")
    assert [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.find_runs(repeated).collect()] == [
        ("s", [(0, 6, 1)], "go on")]
    with pytest.raises(ValueError):
        R.find_runs(repeated, exponent=1)


def planted(doc_id, words):
    """The contract's rule, word by word."""
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_equals_brute_force(spark):
    rows = {r["doc_id"]: r for r in Q.QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        words = planted(doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
        runs = plain_runs(words) if len(words) < 4000 else R.runs_in_texts([words], 6, 4)[0]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        with_runs += bool(runs)
        assert tuple(rows[doc_id]) == (
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(plain_collapsed(words, runs)).hexdigest())
    assert with_runs > 5
