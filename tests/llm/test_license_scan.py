import re

from lectern.llm import license_scan as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for i in range(len(words)) for phrase, label in S.BASE_PHRASES
             if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), [p for p, _ in found], ",".join(sorted({label for _, label in found}))


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by CC-BY", "the GNU General Public License, version 3", "All rights reserved. all RIGHTS-reserved",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "apache license alone is not a notice of version",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "ccé by", "K cc  by\n", "reserved all rights",
]


def test_base_phrases_equal_brute_force(spark, odd_documents):
    docs = spark.createDataFrame(list(enumerate(TEXTS, 100)), "doc_id long, text string").unionByName(odd_documents.select("doc_id", "text"))
    rows = S.scan(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is None:
            continue
        n, places, labels = base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), labels)
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))


def test_templates_need_rare_words_and_key_phrases_in_place(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    labels = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in S.scan(docs).collect()}
    assert labels[0] == {"cc-by", "cc-by-nc"} and labels[4] == {"mit"} and labels[5] == {"apache-2.0"} and labels[7] == {"mit"}
    assert labels[2] >= {"gpl"} and labels[6] == set() and labels[10] == set()


def test_scores_and_empty_table(spark, no_documents):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in S.scan(docs).collect())
    assert S.scan(no_documents).count() == 0


def test_runs_without_python(spark, odd_documents):
    plan = S.scan(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_whole_key_phrase_is_enough(spark):
    texts = ["Licensed under the Mozilla Public License 2.0", "Redistribution and use in source and binary forms, as agreed", "a creative commons attribution",
             "Boost Software License", "permission to use, copy, modify, and/or distribute this software", "mozilla public licence", "plain words, free of charge"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in S.scan(docs).collect()}
    assert [rows[i]["labels"] for i in range(len(texts))] == ["mpl-2.0", "bsd", "cc-by", "bsl-1.0", "isc", "", ""]
    assert [len(r["stands"]) for _, r in sorted(rows.items())] == [1, 1, 1, 1, 1, 0, 0] and 0 < rows[0]["score"] < 1
    assert {r["labels"] for r in S.scan(docs.filter("doc_id = 6")).collect()} == {""}


def test_notices_and_identifiers(spark):
    texts = {"this is the mit license joke": "", "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "// SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0",
             "under the GNU GPL v3": "gpl-3.0", "CC0 1.0 Universal": "cc0-1.0", "made available under the Eclipse Public License v2.0": "epl",
             "Neither the name of the Foo nor its members may be used to endorse or promote products derived from this software.": "bsd-3-clause",
             "GNU General Public License, version 2": "gpl,gpl-2.0", "spdx license": "", "SPDX-License-Identifier: MIT": "mit",
             "in no event will the authors be held liable": "zlib", "identifier mit license spdx": ""}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in S.scan(docs).collect()} == dict(enumerate(texts.values()))


def test_index_takes_the_two_rarest_words_of_the_key_phrases():
    words = S.vocabulary()
    index = S.rare_word_index({w: 5 + 90 * (w in ("the", "license")) + (w == "mozilla") for w in words})
    mpl = next(t for t in index if t.label == "mpl-2.0" and "mozilla" in t.words)
    assert mpl.anchors == [("public", mpl.words.index("public")), ("mozilla", mpl.words.index("mozilla"))]
    assert next(t for t in S.rare_word_index({w: 1 for w in words if w != "mozilla"}) if "mozilla" in t.words).anchors == []
