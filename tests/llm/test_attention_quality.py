import math
import re

import numpy as np

from lectern.llm import attention_quality as A


def test_every_word_is_in_one_passage():
    texts = ["a b c " * 100, "", "single", "  ", "x" * 5000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    features, bags = A.passage_features(data, offsets, 64)
    assert np.diff(bags).tolist() == [5, 1, 1, 1, 1]
    words = np.rint(np.expm1(features[:, A._KINDS])).astype(int)
    assert words.tolist() == [64, 64, 64, 64, 44, 0, 1, 0, 1]
    assert np.isfinite(features).all()


def test_gradient_lowers_the_loss():
    random = np.random.default_rng(0)
    bags = np.arange(0, 601, 3)
    x = random.normal(size=(600, 5))
    y = (np.maximum.reduceat(x[:, 0], bags[:-1]) > 0.8).astype(float)  # one passage decides
    model = A.AttentionModel.fit(x, bags, y, steps=300)
    assert ((model.scores(x, bags) >= 0.5) == (y == 1)).mean() > 0.95


def test_held_out_accuracy_and_split(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = A.score_documents(docs, A.fit_model(docs, labels))
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").filter("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored.collect())


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame([(i, "good text " * 5 if i % 2 else "!!! ***") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", A.F.when(A.held_out("doc_id"), 1 - A.F.col("quality")).otherwise(A.F.col("quality")))
    one, two = A.fit_model(docs, labels), A.fit_model(docs, flipped)
    assert all(np.array_equal(one.w[k], two.w[k]) for k in one.w)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(5, 1), (4, 0), (None, 1), (6, None), (99, 1)], "doc_id long, quality int")
    model = A.fit_model(odd_documents, labels)
    rows = A.score_documents(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert A.score_documents(no_documents, model).count() == 0
    unlabelled = A.fit_model(odd_documents, labels.limit(0))
    assert {r["score"] for r in A.score_documents(odd_documents, unlabelled).collect()} == {0.5}
    kept = A.keep_good(odd_documents, labels.limit(0))
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()


def plain_score(text, w, size=A.PASSAGE_WORDS):
    """The score of one text, a passage and a number at a time."""
    raw = (text or "").encode()
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x09-\x0D\x20]+", raw)]
    groups = [words[i:i + size] for i in range(0, len(words), size)] or [[]]
    heads = [0] + [g[0][0] for g in groups[1:]] + [len(raw)]
    encoded, logits = [], []
    for group, begin, end in zip(groups, heads, heads[1:]):
        part = raw[begin:end]
        kinds = [0] * A._KINDS
        for byte in part:
            named = [i for i, kind in enumerate(A.CHARACTER_KINDS) if chr(byte) in kind] if byte < 128 else [len(A.CHARACTER_KINDS) + 1]
            kinds[named[0] if named else len(A.CHARACTER_KINDS)] += 1
        spelled = [raw[a:b].lower() for a, b in group]
        n = max(1, len(group))
        x = [math.sqrt(k / max(1, len(part))) for k in kinds] + [
            math.log1p(len(group)), sum(b - a for a, b in group) / n / 8, math.sqrt(sum((b - a) ** 2 for a, b in group) / n) / 8,
            sum(p == q for p, q in zip(spelled, spelled[1:])) / n, len(set(spelled)) / n, sum(b - a <= 3 for a, b in group) / n]
        x = [(v - m) / s for v, m, s in zip(x, w["mean"], w["scale"])]
        h = [math.tanh(sum(v * w["encode"][i][j] for i, v in enumerate(x)) + w["encode0"][j]) for j in range(A.ENCODED)]
        gated = [math.tanh(sum(v * w["tanh"][i][j] for i, v in enumerate(h))) / (1 + math.exp(-sum(v * w["gate"][i][j] for i, v in enumerate(h))))
                 for j in range(A.GATES)]
        encoded.append(h)
        logits.append(math.exp(sum(v * u for v, u in zip(gated, w["attend"]))))
    pooled = [sum(a * h[j] for a, h in zip(logits, encoded)) / sum(logits) for j in range(A.ENCODED)]
    return 1 / (1 + math.exp(-max(-30, min(30, sum(v * u for v, u in zip(pooled, w["out"])) + float(w["out0"])))))


def test_scores_equal_a_plain_scorer(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = A.fit_model(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = A.score_documents(docs, model).collect()
    short = [r for r in rows if len(texts[r["doc_id"]] or "") < 6000][:80]
    assert len(short) == 80 and all(abs(r["score"] - plain_score(texts[r["doc_id"]], model.w)) < 1e-4 for r in short)
