import random

import numpy as np
import pytest
import xxhash

from lectern.llm import simhash_golay as S
from lectern.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint_equals_the_definition():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 4, 17, 200):
        text = " \t".join(rng.choices(["Alpha", "beta", "ÉTÉ", "d", "x1"], k=n))
        assert S.fingerprint(text) == plain_fingerprint(text)
    assert S.fingerprint(None) == 0 == S.fingerprint(" \n ")


def test_golay_keys_meet_within_two_bits():
    table = S._nearest_table()
    words = np.random.default_rng(3).integers(0, 1 << 23, 4000)
    keys = [set(row[row >= 0]) for row in S.codeword_keys(words, table)]
    assert {len(k) for k in keys} == {1, 6}
    for flips in (1, 2):
        moved = words.copy()
        for i in range(len(moved)):
            for b in random.Random(i + flips).sample(range(23), flips):
                moved[i] ^= 1 << b
        assert all(k & set(row[row >= 0]) for k, row in zip(keys, S.codeword_keys(moved, table), strict=True))


def test_links_equal_all_pairs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = list({f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for f in base for _ in range(12)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    expected = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 2}
    assert {(r["a"], r["b"]) for r in S.fingerprint_links(classes).collect()} == expected


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = chain + hub + [(5000, 5001), (7, 7)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}, 5000: 5000, 5001: 5000}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_odd_rows(odd_documents, no_documents):
    rows = S.group_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    named = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert named == {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 5, 6: 5, 8: 8, 9: 9}
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert S.group_documents(no_documents).count() == 0
    kept = S.keep_one_per_group(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "8", "9", "None", "None"]


def test_distance_is_bounded(spark):
    with pytest.raises(ValueError):
        S.fingerprint_links(spark.createDataFrame([], "node long, fp long"), 3)


def test_ids_of_any_type(spark):
    texts = ["one two three four five six seven", "one two three four five six seven", "quite another text that shares nothing", None, ""]
    docs = spark.createDataFrame([(f"id-{9 - i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = {r["doc_id"]: r["component_id"] for r in S.group_documents(docs).collect()}
    assert got == {"id-9": "id-8", "id-8": "id-8", "id-7": "id-7", "id-6": "id-5", "id-5": "id-5"}
    assert {r["doc_id"] for r in S.keep_one_per_group(docs).collect()} == {"id-8", "id-7", "id-5"}
