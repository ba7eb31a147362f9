"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage of the whole text is encoded from its
characters and words; gated attention weighs the encoded passages, and a logistic unit scores their weighted sum. Only
document labels are learned from. The model (some thousand numbers) is fitted on a bounded sample of labelled
documents and then sent to all tasks, which score every document without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import LOWER, span_hashes, text_chunks, word_bounds

PASSAGE_WORDS = 64
SAMPLE_DOCUMENTS = 6_000
SAMPLE_TEXT_BYTES = 100_000
STEPS = 500
BATCH_DOCUMENTS = 256
ENCODED = 16
GATES = 8

#: The character kinds that are counted; a byte that none names is of the last kind.
CHARACTER_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r", ".", ",",
                   "!", "?", "*", "&", "%", "$", "#", "|", "@", "=", "<>", "{}[]()", "-_", "\"'", ":;", "/\\", "+~^`")

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_KIND = np.full(256, len(CHARACTER_KINDS), np.int64)
for _i, _kind in enumerate(CHARACTER_KINDS):
    _KIND[[ord(c) for c in _kind]] = _i
_KIND[128:] = len(CHARACTER_KINDS) + 1
_KINDS = len(CHARACTER_KINDS) + 2
FEATURES = _KINDS + 6


def passage_features(data: np.ndarray, offsets: np.ndarray, passage_words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a run of texts, and the first passage of each text (and the end).

    A text without words is one passage; each word belongs to exactly one passage.
    """
    starts, ends = word_bounds(~_SPACE[data], offsets)
    firsts = np.searchsorted(starts, offsets)
    rows = len(offsets) - 1
    of_row = np.repeat(np.arange(rows), np.diff(firsts))
    local = (np.arange(len(starts)) - firsts[of_row]) // passage_words
    per_row = np.maximum(1, -(-np.diff(firsts) // passage_words))
    bags = np.concatenate(([0], np.cumsum(per_row)))
    of_word = bags[of_row] + local
    total = int(bags[-1])
    heads = np.zeros(total, np.int64)
    heads[bags[:-1]] = offsets[:-1]
    later = np.flatnonzero(local > 0)
    begins = later[np.concatenate(([True], of_word[later][1:] != of_word[later][:-1]))] if len(later) else later
    heads[of_word[begins]] = starts[begins]
    sizes = np.diff(np.concatenate((heads, [len(data)])))
    of_byte = np.repeat(np.arange(total), sizes)
    kinds = np.bincount(of_byte * _KINDS + _KIND[data], minlength=total * _KINDS).reshape(total, _KINDS)
    out = np.zeros((total, FEATURES), np.float32)
    out[:, :_KINDS] = np.sqrt(kinds / np.maximum(1, sizes)[:, None])
    words = np.bincount(of_word, minlength=total)
    many = np.maximum(1, words)
    lengths = ends - starts
    hashes = span_hashes(LOWER[data], starts, ends)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    keyed = np.unique(hashes ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    out[:, _KINDS] = np.log1p(words)
    out[:, _KINDS + 1] = np.bincount(of_word, lengths, total) / many / 8
    out[:, _KINDS + 2] = np.sqrt(np.bincount(of_word, lengths.astype(float) ** 2, total) / many) / 8
    out[:, _KINDS + 3] = np.bincount(of_word, same, total) / many
    out[:, _KINDS + 4] = np.bincount(of_word[keyed], minlength=total) / many
    out[:, _KINDS + 5] = np.bincount(of_word, lengths <= 3, total) / many
    return out, bags


class AttentionModel:
    """Gated attention over encoded passages; all arrays, so it travels as plain values."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def _pooled(x: np.ndarray, bags: np.ndarray, w: dict[str, np.ndarray]):
        starts, sizes = bags[:-1], np.diff(bags)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-h @ w["gate"]))
        logits = (t * g) @ w["attend"]
        e = np.exp(logits - np.repeat(np.maximum.reduceat(logits, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))
        return h, t, g, a, z, s, starts, sizes

    def scores(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Score of each bag."""
        if "constant" in self.w:
            return np.full(len(bags) - 1, float(self.w["constant"]))
        x = (x - self.w["mean"]) / self.w["scale"]
        return self._pooled(x, bags, self.w)[5]

    @staticmethod
    def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7) -> AttentionModel:
        """Adam on the cross-entropy of document labels. One class only, or no label: a constant score."""
        if not len(y) or y.min() == y.max():
            return AttentionModel({"constant": np.float64(y[0] if len(y) else 0.5)})
        random = np.random.default_rng(seed)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 0.05
        x = ((x - mean) / scale).astype(np.float64)
        f = x.shape[1]
        w = {
            "encode": random.normal(0, f ** -0.5, (f, ENCODED)), "encode0": np.zeros(ENCODED),
            "tanh": random.normal(0, 0.3, (ENCODED, GATES)), "gate": random.normal(0, 0.3, (ENCODED, GATES)),
            "attend": random.normal(0, 0.3, GATES), "out": random.normal(0, 0.3, ENCODED),
            "out0": np.log(y.mean() / (1 - y.mean())),
        }
        first = {k: np.zeros_like(v) for k, v in w.items()}
        second = {k: np.zeros_like(v) for k, v in w.items()}
        for step in range(1, steps + 1):
            chosen = random.choice(len(y), min(BATCH_DOCUMENTS, len(y)), replace=False)
            part = np.concatenate([np.arange(bags[i], bags[i + 1]) for i in chosen])
            inner = np.concatenate(([0], np.cumsum(bags[chosen + 1] - bags[chosen])))
            xb, yb = x[part], y[chosen]
            h, t, g, a, z, s, starts, sizes = AttentionModel._pooled(xb, inner, w)
            ds = (s - yb) / len(yb)
            dz = np.repeat(ds, sizes)[:, None] * w["out"][None, :]
            da = (h * dz).sum(axis=1)
            dl = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
            dt = dl[:, None] * w["attend"] * g * (1 - t ** 2)
            dg = dl[:, None] * w["attend"] * t * g * (1 - g)
            dh = (a[:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h ** 2)
            slopes = {
                "encode": xb.T @ dh + 1e-4 * w["encode"], "encode0": dh.sum(axis=0), "tanh": h.T @ dt, "gate": h.T @ dg,
                "attend": (dl[:, None] * t * g).sum(axis=0), "out": z.T @ ds + 1e-4 * w["out"], "out0": ds.sum(),
            }
            rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, d in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return AttentionModel(w | {"mean": mean, "scale": scale})


def held_out(id_col: str) -> Column:
    """True for the third of the ids that no label is learned from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    documents: int, text_bytes: int) -> DataFrame:
    """At most ``documents`` labelled texts of at most ``text_bytes`` bytes, none of them held out.

    Ids are drawn by a hash, so any order of the rows gives the same sample. An id with several labels has the
    majority's, an even split counts as 1.
    """
    drawn = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(documents)
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(drawn), "_id").filter(F.octet_length("_text") <= text_bytes)


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", documents: int = SAMPLE_DOCUMENTS,
              text_bytes: int = SAMPLE_TEXT_BYTES) -> AttentionModel:
    """Fits the model on a bounded sample (``documents`` x ``text_bytes``) of labelled documents.

    The sample's passages are encoded in the tasks; the driver gets their features only.
    """
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, documents, text_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, rows, data, offsets in text_chunks(batch.column(2)):
                x, bags = passage_features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, rows), batch.column(1).slice(row, rows),
                     pa.array([x[a:b].tobytes() for a, b in zip(bags[:-1], bags[1:], strict=True)], pa.binary())],
                    ["_key", "_label", "features"])

    rows = (sample.select(F.xxhash64("_id", "_text").alias("_key"), "_label", "_text")
            .mapInArrow(run, "_key long, _label int, features binary").toPandas())
    rows = rows.sort_values("_key", kind="stable").drop_duplicates("_key")
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["features"]]
    x = np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)
    bags = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return AttentionModel.fit(x, bags, rows["_label"].to_numpy(np.float64))


def score_documents(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row of ``docs``.

    Null and empty texts are scored as one empty passage. Ids may be null (not held out) or repeated; other columns
    are not read. A model fitted without labels scores 0.5, with labels of one class that class.
    """
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = slim.schema["_id"].dataType.simpleString()
    weights = docs.sparkSession.sparkContext.broadcast(model.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = AttentionModel(weights.value)
        for batch in batches:
            scores = [np.zeros(0)]
            for _, _, data, offsets in text_chunks(batch.column(1)):
                scores.append(fitted.scores(*passage_features(data, offsets)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], ["_id", "score"])

    return slim.mapInArrow(run, f"_id {id_type}, score double").select(
        F.col("_id").alias(id_col), F.coalesce(held_out("_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; a repeated id goes only if all its rows do."""
    scores = score_documents(docs, fit_model(docs, labels, id_col, **options), id_col)
    bad = scores.groupBy(id_col).agg(F.max("predicted").alias("_best")).filter("_best = 0").select(id_col)
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
