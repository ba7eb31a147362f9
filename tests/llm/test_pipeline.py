import sys

import pytest

import corpus_pipeline as P
import __spark_entry__ as entry
from lectern.llm import queries as Q
from lectern.llm.line_dedup import later_lines
from lectern.llm.simhash_golay import fingerprint
from lectern.llm.winnow_decontaminate import words_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from lectern.llm.common import stored
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in P.STAGES:
        out = stored(stage(spark, docs, FOLDER), "pipeline-test")
        seen.append((docs, out))
        docs = out
    return seen


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination",
                                       "SentencePiece encoding"]
    for before, after in stages[:-1]:
        assert before.dtypes == after.dtypes


def test_every_stage_takes_effect(spark, stages):
    texts = [{r["doc_id"]: r["text"] for r in after.collect()} for _, after in stages[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    known = [labels[i] for i in texts[0] if i in labels]
    assert sum(known) / len(known) > 0.95
    assert set(texts[0]) == set(texts[1]) and not any(r["removed"] for r in later_lines(stages[1][1]).collect())
    kept = {i: fingerprint(t) for i, t in texts[2].items()}
    assert not any((a ^ b).bit_count() <= 2 for i, a in kept.items() for j, b in kept.items() if i < j)
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        words = words_of(r["text"].encode())
        windows |= {tuple(words[k:k + 10]) for k in range(len(words) - 9)}
    for i, t in texts[3].items():
        words = words_of((t or "").encode())
        assert not any(tuple(words[k:k + 10]) in windows for k in range(len(words)))
    clean = [i for i, t in texts[2].items() if not any(
        tuple(words_of((t or "").encode())[k:k + 10]) in windows for k in range(len(words_of((t or "").encode()))))]
    assert set(clean) == set(texts[3])
    assert {r["doc_id"] for r in stages[4][1].collect()} == set(texts[3])


def test_run_equals_the_stages(spark, stages):
    assert {tuple(r) for r in map(lambda r: (r["doc_id"], tuple(r["pieces"])), P.run(spark, FOLDER).collect())} == {
        (r["doc_id"], tuple(r["pieces"])) for r in stages[-1][1].collect()}


def test_entry_lists_every_query_and_survives_without_them(monkeypatch):
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in Q.QUERIES}
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(Q.SQL) <= set(entry.oracle_sql())
    monkeypatch.setattr(entry, "corpus_queries", None)
    assert not set(Q.QUERIES) & set(entry.queries())
