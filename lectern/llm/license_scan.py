"""Licence scan with a positional rare-token index.

The words of the licence templates are counted over all documents, which gives their IDF. A file's licence words are
ranked by it: of each template's key phrases, the two words of highest IDF are looked up in the file (a file that holds
the phrases holds all their words, so these are its own rarest ones of them), and their postings, shifted by the words'
places in the template, are intersected. Each relative position on which both agree proposes the template, which stands
if its mandatory key phrases stand there word for word. A key phrase with a word of no document stands nowhere. Besides,
three base phrases are found wherever their words stand consecutively.

Everything runs in DataFrame functions on one row at a time; only the document counts of the template words are
shuffled. Templates and index are constants of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE_WORDS = 2

#: Phrases and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Label, words of a notice, and the phrases that must stand in it.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission",
     ("may be used to endorse or promote products derived from this software",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0-1.0", "this work is dedicated under cc0 1 0 universal", ("cc0 1 0",)),
    ("epl", "the accompanying materials are made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("gpl", "this work is licensed under the gnu general public license", ("gnu general public license",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2.0", "licensed under the gnu gpl v2", ("gnu gpl v2",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3.0", "licensed under the gnu gpl v3", ("gnu gpl v3",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted", ("permission to use copy modify and or distribute this software",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("mit", "released under the mit license", ("under the mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files", ("permission is hereby granted free of charge",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
     ("in no event will the authors be held liable",)),
)

#: Identifiers that follow `SPDX-License-Identifier:`, as words, and their labels.
IDENTIFIERS = (
    ("agpl 3 0", "agpl"), ("apache 2 0", "apache-2.0"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd-3-clause"), ("bsl 1 0", "bsl-1.0"),
    ("cc by 4 0", "cc-by"), ("cc by nc 4 0", "cc-by-nc"), ("cc by sa 4 0", "cc-by-sa"), ("cc0 1 0", "cc0-1.0"), ("epl 2 0", "epl"),
    ("gpl 2 0", "gpl-2.0"), ("gpl 3 0", "gpl-3.0"), ("isc", "isc"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"), ("mit", "mit"),
    ("mpl 2 0", "mpl-2.0"), ("unlicense", "unlicense"), ("zlib", "zlib"),
)
NOTICES = TEMPLATES + tuple((label, f"spdx license identifier {words}", (f"spdx license identifier {words}",)) for words, label in IDENTIFIERS)

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]
    phrases: list[int]  # places that must match
    anchors: list[tuple[str, int]]  # rarest words of the phrases and a place of each; none if a word stands in no document


def vocabulary() -> list[str]:
    return sorted({w for _, words, _ in NOTICES for w in words.split()})


def words_column(text: Column) -> Column:
    """Words of a text after lower-casing; a null text has none.

    ``lower`` also maps letters beyond ASCII, which moves no word border and makes none of the words looked for.
    """
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def document_counts(words: DataFrame) -> dict[str, int]:
    """In how many documents each template word stands; ``words`` has a column ``words``. One row per template word."""
    known = F.array(*[F.lit(w) for w in vocabulary()])
    counted = words.select(F.explode(F.array_intersect("words", known)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def rare_word_index(counts: dict[str, int]) -> list[Template]:
    """Templates with the words of highest IDF (fewest documents, then alphabetical) of their key phrases."""
    found = []
    for label, text, phrases in NOTICES:
        words = text.split()
        places = set()
        for phrase in phrases:
            part = phrase.split()
            at = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
            places.update(range(at, at + len(part)))
        key_words = {words[i]: i for i in sorted(places, reverse=True)}
        rarest = sorted(key_words, key=lambda w: (counts.get(w, 0), w))[:RARE_WORDS]
        held = all(counts.get(w, 0) for w in key_words)
        found.append(Template(label, words, sorted(places), [(w, key_words[w]) for w in rarest] if held else []))
    return found


def _base_places(words: Column) -> Column:
    """(place, label) of every base phrase, in order of place."""
    def at(word: Column, i: Column) -> Column:
        found = F.lit(None).cast("struct<place:int,label:string>")
        for phrase, label in BASE_PHRASES:
            first, *rest = phrase.split()
            same = word == first
            for n, other in enumerate(rest, 1):
                same = same & F.get(words, i + n).eqNullSafe(F.lit(other))
            found = F.when(same, F.struct(i.alias("place"), F.lit(label).alias("label"))).otherwise(found)
        return found

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def _template_places(words: Column, hits: Column, t: Template) -> Column:
    """(place, label, share) of a template's stands that pass; ``hits`` has the document's anchors (place, word)."""
    def starts(word: str, place: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["place"] - place)

    # The first place of a word is enough: a stand has it in each of its places.
    (word, first), *others = t.anchors
    proposed = starts(word, first)
    for other, at in others:
        proposed = F.array_intersect(proposed, starts(other, at))

    def in_place(off: Column, place: int) -> Column:
        return F.get(words, off + place).eqNullSafe(F.lit(t.words[place]))

    def passes(off: Column) -> Column:
        ok = F.lit(True)
        for p in t.phrases:
            ok = ok & in_place(off, p)
        return ok

    def found(off: Column) -> Column:
        same = F.lit(0)
        for p in range(len(t.words)):
            same = same + in_place(off, p).cast("int")
        return F.struct(off.alias("place"), F.lit(t.label).alias("label"), (same / F.lit(len(t.words))).alias("share"))

    return F.transform(F.filter(proposed, passes), found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: words, base places, labels, template ``stands`` (place, label, share) and ``score``.

    ``score`` is the largest share of a template's words found in their places; a base phrase is whole, so it gives 1.
    Null and empty texts have no words, no places, empty labels and score 0. Repeated rows come back repeated; ids may
    be null; other columns are not read.
    """
    words = docs.select(F.col(id_col).alias("_id"), words_column(F.col(text_col)).alias("words"))
    index = [t for t in rare_word_index(document_counts(words.select("words"))) if t.anchors]
    anchors = F.array(*[F.lit(w) for w in sorted({w for t in index for w, _ in t.anchors})]).cast("array<string>")
    starts = F.array(*[F.lit(phrase.split()[-1]) for phrase, _ in BASE_PHRASES])
    place = "array<struct<place:int,label:string>>"
    hit = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word"))), lambda h: F.array_contains(anchors, h["word"]))
    looked = words.select(
        "_id", "words",
        F.when(F.arrays_overlap("words", starts), _base_places(F.col("words"))).otherwise(F.array().cast(place)).alias("base"),
        F.when(F.arrays_overlap("words", anchors), hit).otherwise(F.array().cast("array<struct<place:int,word:string>>")).alias("hits"))
    none = F.array().cast("array<struct<place:int,label:string,share:double>>")
    stands = F.flatten(F.array(none, *[_template_places(F.col("words"), F.col("hits"), t) for t in index]))
    seen = looked.select(
        "_id", F.size("words").cast("long").alias("n_words"), "base",
        F.when(F.size("hits") > 0, stands).otherwise(none).alias("stands"))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    template_labels = F.transform("stands", lambda s: s["label"])
    return seen.select(
        F.col("_id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["place"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["place"])).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: b["label"]), template_labels))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("stands", lambda s: s["share"])), F.lit(0.0))).alias("score"),
        "stands")


def duckdb_twin() -> str:
    """The same scan as SQL over ``documents``."""
    rows, phrases = [], []
    for n, t in enumerate(rare_word_index({})):
        rows.append(f"({n}, '{t.label}', {t.words!r}, {t.phrases!r}::BIGINT[])")
    for phrase, label in BASE_PHRASES:
        words = phrase.split()
        same = " AND ".join(f"ws[p + {i + 1}] = '{w}'" for i, w in enumerate(words))
        phrases.append(f"SELECT doc_id, p, '{label}' AS label FROM word WHERE {same}")
    return rf"""
WITH template(t, label, tw, need) AS (VALUES {', '.join(rows)}),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
word AS (SELECT doc_id, ws, unnest(range(0, len(ws))) AS p FROM doc),
place AS (SELECT t, unnest(tw) AS w, unnest(range(0, len(tw))) AS k FROM template),
proposed AS (
  SELECT doc_id, ws, t, p - need[1] AS off FROM word JOIN template ON ws[p + 1] = tw[need[1] + 1]),
checked AS (
  SELECT doc_id, t, off, k, place.w, off + k >= 0 AND coalesce(ws[CASE WHEN off + k >= 0 THEN off + k + 1 END] = place.w, false) AS same
  FROM proposed JOIN place USING (t)),
stand AS (
  SELECT doc_id, label, avg(CAST(same AS INT)) AS share
  FROM checked JOIN template USING (t)
  GROUP BY doc_id, t, off, label, need
  HAVING bool_and(same OR NOT list_contains(need, k))),
base AS ({' UNION ALL '.join(phrases)}),
based AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
                 array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels FROM base GROUP BY doc_id),
labelled AS (SELECT doc_id, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
             FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM stand) GROUP BY doc_id),
scored AS (SELECT doc_id, max(share) AS share FROM stand GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM doc LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id) LEFT JOIN scored USING (doc_id)"""
