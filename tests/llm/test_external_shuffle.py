import zlib

import pytest
from pyspark.sql import functions as F

from lectern.llm import external_shuffle as S
from lectern.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"


def places(records):
    return sorted((r["shard"], r["slot"], r["row"]["doc_id"]) for r in records.collect())


def test_query_keeps_its_law(spark):
    rows = Q.QUERIES["op11_external_shuffle"](spark, FOLDER).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    counts = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1


def test_same_seed_same_order_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = places(S.shuffle_into_shards(docs, seed=5, bucket_bytes=1 << 16))
    assert one == places(S.shuffle_into_shards(docs.repartition(7), seed=5, bucket_bytes=1 << 16))
    assert one != places(S.shuffle_into_shards(docs, seed=6, bucket_bytes=1 << 16))


def test_order_is_uniform(spark):
    """Records stand in every part of every shard equally often, and neighbours do not stay together."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "'same text' AS text")
    found = places(S.shuffle_into_shards(docs, shards=4, seed=3, bucket_bytes=4000))
    seen = [[0] * 10 for _ in range(10)]
    for shard, slot, doc in found:
        seen[doc // 400][(slot // 100) % 10] += 1
    # Chi-square with 81 degrees of freedom.
    assert sum((n - 40) ** 2 / 40 for row in seen for n in row) < 135
    at = {doc: (shard, slot) for shard, slot, doc in found}
    assert sum(at[i][0] == at[i + 1][0] and abs(at[i][1] - at[i + 1][1]) == 1 for i in range(3999)) < 12
    drawn = [S.fisher_yates(3, 9, n).tolist() for n in range(1200)]
    assert all(160 < drawn.count(p) < 240 for p in ([0, 1, 2], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1], [2, 1, 0]))


def test_hot_ids_are_spread(spark):
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "repeat('x', 200) AS text", "id AS other")
    keyed, rows, bits = S._scattered(docs, "doc_id", "text", 0, 1 << 14)
    per_bucket = rows.reshape(1 << bits, -1).sum(axis=1)
    assert per_bucket.sum() == 3000 and per_bucket.max() < 3 * 3000 / len(per_bucket)
    found = S.shuffle_into_shards(docs, bucket_bytes=1 << 14)
    assert found.select("row.other").distinct().count() == found.count() == 3000
    counts = [r["n"] for r in found.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sorted(counts) == [375] * 8


def test_odd_documents(spark, odd_documents, no_documents):
    wide = odd_documents.selectExpr("*", "0 AS slot", "1 AS shard", "2 AS size", "3 AS cell", "4 AS key", "5 AS bucket")
    found = S.shuffle_into_shards(wide, shards=3, bucket_bytes=1 << 10)
    rows = found.collect()
    assert sorted((tuple(r["row"]) for r in rows), key=repr) == sorted((tuple(r) for r in wide.collect()), key=repr)
    assert {r["size"] for r in rows if not r["row"]["text"]} == {1}
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((i % 3, i // 3) for i in range(len(rows)))
    assert S.shuffle_into_shards(no_documents).collect() == []
    with pytest.raises(ValueError):
        S.shuffle_into_shards(wide, shards=0)
    with pytest.raises(ValueError):
        S.bucket_bits(1 << 50, 1)
