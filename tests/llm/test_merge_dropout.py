import random
import time

import numpy as np
import pytest
import sentencepiece

from lectern.llm import merge_dropout as M

TEXTS = ["a  b   c", "   ", "\n\n x \n", "▁x▁ ▁▁", " a", "日本語 テスト 🎉", "x" * 300 + " " + "the" * 100, " lead", "trail ", "", "é\x00z\x7f  \x85 \r\n",
         "The quick brown fox jumps over the lazy dog. " * 30]


@pytest.fixture(scope="module")
def model():
    return M.load_model()


def ids(found):
    return np.frombuffer(found, "<i4").tolist()


def test_without_dropout_equals_the_library(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=M.DEFAULT_MODEL)
    texts = [t for t in TEXTS if M.SPACE not in t]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = M.Encoder(model, dropout=0.0).encode(texts, ["d"] * len(texts))
    assert [ids(x) for x in found] == [library.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(model, dropout):
    encoder = M.Encoder(model, dropout=dropout, seed=5)
    for t, found in zip(TEXTS, encoder.encode(TEXTS, [str(i) for i in range(len(TEXTS))]), strict=True):
        assert encoder.decode(found).decode() == t


def test_agendas_together_equal_a_heap_each(model, monkeypatch):
    together = M.Encoder(model, dropout=0.3, seed=1).encode(TEXTS, ["d"] * len(TEXTS))
    monkeypatch.setattr(M, "WIDTHS", ())
    monkeypatch.setattr(M, "LONG_RUN", 1)
    assert M.Encoder(model, dropout=0.3, seed=1).encode(TEXTS, ["d"] * len(TEXTS)) == together


def test_seed_epoch_and_document_vary_the_pieces_and_nothing_else_does(model):
    text = [TEXTS[-1]]
    first = M.Encoder(model, seed=1).encode(text, ["d"])
    assert M.Encoder(model, seed=1, table_words=16).encode(TEXTS + text, ["z"] * len(TEXTS) + ["d"])[-1:] == first
    assert M.Encoder(model, seed=2).encode(text, ["d"]) != first != M.Encoder(model, seed=1, epoch=1).encode(text, ["d"])
    encoder = M.Encoder(model, seed=1)
    assert len({encoder.encode(text, [str(d)])[0] for d in range(60)}) > M.STREAMS // 2
    assert len(M.Encoder(model, dropout=0.0).encode(text, ["d"])[0]) < len(first[0])


def test_frames(spark, odd_documents, no_documents):
    encoded = M.encode_documents(odd_documents)
    assert encoded.count() == odd_documents.count() and all(r["n_pieces"] == len(r["pieces"]) for r in encoded.collect())
    decoded = sorted((str(r["doc_id"]), r["text"]) for r in M.decode_documents(encoded).collect())
    assert decoded == sorted((str(r["doc_id"]), r["text"] or "") for r in odd_documents.collect())
    digests = M.encoding_digests(odd_documents).collect()
    assert len(digests) == odd_documents.count() and all(r["lossless"] for r in digests)
    assert M.encode_documents(no_documents).count() == 0 == M.encoding_digests(no_documents).count()


def test_each_occurrence_of_a_word_draws_for_itself(model):
    encoder = M.Encoder(model, seed=3)
    pieces = ids(encoder.encode([" ".join(["extraordinary"] * 2000)], ["d"])[0])
    words = "".join(model[i][0].replace(M.SPACE, "|") + "," for i in pieces).split("|")[1:]
    assert len(words) == 2000 and len(set(words)) > M.STREAMS
    assert len(set(encoder.encode(["extraordinary"] * 2000, [str(d) for d in range(2000)]))) > M.STREAMS
    assert encoder.encode(["", "extraordinary", ""], ["a", "1", "b"])[1] == encoder.encode(["extraordinary"], ["1"])[0]


def test_long_runs_follow_the_same_agenda(monkeypatch):
    """One merge at a time gives what the arrays give, with dropout too; a long run takes time as it grows."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abcdeéß日1 ") for _ in range(rng.randrange(1, 60))) for _ in range(5)) for _ in range(100)]
    names = [str(i) for i in range(100)]
    model = M.load_model()
    arrays = M.Encoder(model).encode(texts, names)
    monkeypatch.setattr(M, "WIDTHS", (2,))
    monkeypatch.setattr(M, "LONG_RUN", 2)
    alone = M.Encoder(model)
    assert alone.encode(texts, names) == arrays
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(100_000))
    started = time.process_time()
    assert alone.decode(alone.encode([long], ["x"])[0]).decode() == long
    assert time.process_time() - started < 6
