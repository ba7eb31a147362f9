"""Personal data by pattern, and information-theoretic sanitisation of the terms that reveal it.

E-mail and IP addresses, card and phone numbers are protected entities, and so are the groups to which they belong: the
mail domain, the first half of an IP address, the issuer digits of a card, the first digits of a phone number. Over the
corpus, documents are counted that hold an entity or group e, a word t, and both, the word outside all spans. A word
discloses e by the share of e's information that it carries: PMI(e, t) / IC(e), with PMI = log(n(e,t) N / (n(e) n(t)))
and IC = log(N / n(e)) over N documents. Wherever it stands in a document of e, a word above ``REMOVE`` is removed and
one above ``GENERALISE`` is replaced by its kind. An entity of one text alone is judged through its groups: beside it
every rare word of that text would look like a disclosure.

Everything runs in DataFrame functions. Patterns are written with possessive repeats, which find the same matches as
the plain ones, so that no text makes the matcher recurse or search a run of characters again and again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import stored

#: Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

SUPPORT = 2
GENERALISE = 0.7
REMOVE = 0.9

_LOCAL = r"[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of fewer digits are never cards, and no part of one is: matches of 14 digits or more are the plain ones.
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What names the group of an entity, as a pattern on its normal form.
_GROUPS = (r"^email:.*(@.*)$", r"^ip:([0-9]+[.][0-9]+)[.]", r"^card:([0-9]{6})", r"^phone:([0-9]{4})")
_PLACED = "array<struct<start:int,end:int,value:string>>"
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,entity:string>>"


def placed_matches(text: Column, pattern: str, offset: Column | int = 0) -> Column:
    """Matches of a pattern with their places in code points: the text between matches gives the distances."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.lit(offset) if isinstance(offset, int) else offset
    zero = F.struct(start.cast("int").alias("at"), F.array().cast(_PLACED).alias("out"))

    def add(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["value"])
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), pair["value"].alias("value")))).alias("out"))

    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(g.alias("gap"), m.alias("value")))
    return F.aggregate(pairs, zero, add, lambda done: done["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15)


def base_spans(text: Column) -> Column:
    """All valid matches, by start and kind: start, end, rank of the kind, kind and the entity's normal form."""
    def spans(kind: str) -> Column:
        name = F.lower if kind == "email" else (lambda v: v) if kind == "ip" else _digits
        valid = F.filter(placed_matches(text, _PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        return F.transform(valid, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            F.concat(F.lit(f"{kind}:"), name(m["value"])).alias("entity")))

    none = F.array().cast(_SPANS)
    address = F.when(text.contains("@"), spans("email")).otherwise(none)
    numbers = F.when(text.rlike(r"[0-9][\x20().0-9-]+[0-9]"), F.concat(spans("ip"), spans("card"), spans("phone"))).otherwise(none)
    return F.array_sort(F.concat(address, numbers))


def _span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _protected(spans: Column) -> Column:
    """The entities of the spans, their groups and kinds, each once."""
    def of(span: Column) -> Column:
        groups = [F.concat(F.lit(f"{kind}s "), F.regexp_extract(span["entity"], pattern, 1)) for kind, pattern in zip(KINDS, _GROUPS, strict=True)]
        group = F.coalesce(*[F.when(span["kind"] == kind, g) for kind, g in zip(KINDS, groups, strict=True)])
        return F.array(span["entity"], group, span["kind"])

    return F.array_distinct(F.flatten(F.transform(spans, of)))


def _free_words(held: DataFrame) -> DataFrame:
    """``row``, ``term``, ``places`` (start, end) of the words outside the spans; places are summed over rows, so a long
    text costs no more a word than a short one."""
    words, gaps = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), F.split("text", _WORD, -1)
    each = held.select("row", "base", F.posexplode(
        F.zip_with(words, F.slice(gaps, 1, F.size(words)), lambda w, g: F.struct(w.alias("word"), F.length(g).alias("gap")))).alias("at", "w"))
    so_far = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.select("row", "base", "at", "w.word", (F.col("w.gap") + F.length("w.word")).alias("step")).withColumn(
        "end", F.sum("step").over(so_far).cast("int")).withColumn("start", F.col("end") - F.length("word"))
    free = ~F.exists("base", lambda s: (F.col("start") < s["end"]) & (s["start"] < F.col("end")))
    # Rows of a document are together already, so this shuffles nothing more.
    return placed.filter(free).groupBy("row", F.lower("word").alias("term")).agg(F.collect_list(F.struct("start", "end")).alias("places"))


def disclosing_terms(docs: DataFrame, held: DataFrame, text_col: str, support: int, generalise: float) -> DataFrame:
    """``row``, ``start``, ``end`` and ``share`` of the words that disclose an entity or group of their document.

    ``held`` are the documents with an entity. A word stands beside an entity at most as often as there is the entity,
    so its share is at most log(N / n(t)) / IC(e). Only words that may reach ``generalise`` by that, and stand in
    ``support`` documents with an entity, meet the entities of their documents.
    """
    near = stored(_free_words(held), "free-words")
    groups = held.select("row", F.xxhash64("text").alias("copy_of"), F.explode(_protected(F.col("base"))).alias("group"))
    documents = docs.count()
    sizes = groups.groupBy("group").agg(F.count("*").alias("n_e")).filter((F.col("n_e") >= support) & (F.col("n_e") < documents))
    largest = sizes.agg(F.max("n_e")).first()[0] or support
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(_WORD), F.lit(0)))
    everywhere = docs.select(F.explode(words).alias("term"), F.lit(1).alias("in_all"), F.lit(0).alias("in_held"))

    def content(n: Column) -> Column:
        return F.log(F.lit(float(documents)) / n)

    def may_reach(n_e: Column) -> Column:
        return content(F.col("n_t")) >= (generalise - 1e-9) * content(n_e)

    terms = everywhere.unionAll(near.select("term", F.lit(0), F.lit(1))).groupBy("term").agg(
        F.sum("in_all").alias("n_t"), F.sum("in_held").alias("n_held")).filter(
        (F.col("n_held") >= support) & (F.col("n_t") > 0) & may_reach(F.lit(largest))).select("term", "n_t")
    beside = stored(near.select("row", "term").join(terms, "term").join(groups.join(sizes, "group"), "row").filter(
        may_reach(F.col("n_e"))), "words-beside")
    texts = beside.groupBy("group", "n_e", "term", "n_t", "copy_of").agg(F.count("*").alias("n"))
    together = texts.groupBy("group", "n_e", "term", "n_t").agg(F.sum("n").alias("n_et"), F.count("*").alias("n_texts")).filter(
        F.col("n_texts") >= support)
    pmi = F.log(F.col("n_et") * F.lit(float(documents)) / (F.col("n_e") * F.col("n_t")))
    judged = together.withColumn("share", pmi / content(F.col("n_e"))).filter(
        F.col("share") >= generalise).select("group", "term", "share")
    disclosed = beside.select("row", "group", "term").join(judged, ["group", "term"]).groupBy("row", "term").agg(F.max("share").alias("share"))
    return near.join(disclosed, ["row", "term"]).select("row", F.explode("places").alias("place"), "share").select(
        "row", "place.start", "place.end", "share")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                       generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per row of ``docs``: counts of each kind, ``base`` spans, ``terms`` (start, end, share) and the sanitised text.

    Null and empty texts have no spans; a null text stays null. A word counts with an entity or group only if it stands
    in ``support`` different texts of it, so that copies alone show nothing; one of all documents is disclosed by none. Repeated rows count as documents and come back repeated; ids may be null;
    other columns are not read. An empty table gives an empty result.
    """
    # Only documents with an entity are written; the others keep their text, and are read again.
    base, empty = base_spans(F.coalesce(F.col(text_col), F.lit(""))), F.array().cast(_SPANS)
    held = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("_id"), F.col(text_col).alias("text"),
        base.alias("base")).filter("size(base) > 0"), "personal-data")
    terms = disclosing_terms(docs, held, text_col, support, generalise).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    both = held.join(terms, "row", "left").select("_id", "text", "base", F.coalesce("terms", none).alias("terms")).unionAll(
        docs.filter(F.size(base) == 0).select(F.col(id_col), F.col(text_col), empty, none))
    counts = [F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    added = F.transform("terms", lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit(TERM).alias("kind"),
        F.when(t["share"] >= remove, F.lit("")).otherwise(F.lit("<word>")).alias("entity")))
    masks = F.transform("base", lambda s: F.struct(
        s["start"], s["rank"], s["end"], s["kind"], F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("entity")))
    everything = both.withColumn("spans", F.array_sort(F.concat(masks, added)))
    return everything.select(
        F.col("_id").alias(id_col), *counts, F.col("base"), F.col("terms"), _span_list(F.col("base")).alias("base_list"),
        _span_list(F.col("spans")).alias("span_list"), sanitised(F.col("text"), F.col("spans")).alias("sanitised"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span's ``entity`` in its place; a span that starts inside an earlier one extends that."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        piece = F.substring(text, done["at"] + 1, F.greatest(F.lit(0), s["start"] - done["at"]))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(done["out"], piece, s["entity"])).otherwise(done["out"]).alias("out"))

    rest = F.aggregate(spans, zero, add, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def duckdb_twin() -> str:
    """Counts, digest of the base spans and all spans as SQL over ``documents``, by the plain patterns."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    hits = " UNION ALL ".join(
        f"SELECT doc_id, t, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(t, '{plain[kind]}') AS ms, "
        f"string_split_regex(t, '{plain[kind]}') AS gs FROM doc" for rank, kind in enumerate(KINDS))
    digit = "CAST(substr(d, CAST(length(d) - i AS INTEGER), 1) AS INTEGER)"
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{kind}') AS BIGINT) AS n_{kind}" for kind in KINDS)
    return rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hit AS ({hits}),
listed AS (SELECT doc_id, t, kind, rank, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(range(len(ms))) AS i FROM hit),
placed AS (
  SELECT doc_id, t, kind, rank, m, regexp_replace(m, '[^0-9]', '', 'g') AS d,
         CAST(sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e
  FROM listed),
span AS (
  SELECT doc_id, t, kind, rank, e - length(m) AS s, e,
         kind || ':' || CASE kind WHEN 'email' THEN lower(m) WHEN 'ip' THEN m ELSE d END AS entity
  FROM placed
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: coalesce(try_cast(x AS BIGINT), 256) > 255)) = 0
    WHEN 'card' THEN length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(length(d)), lambda i:
         CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0
    ELSE length(d) BETWEEN 10 AND 15 END),
worded AS (
  SELECT doc_id, t, unnest(ws) AS w, unnest(gs[1:len(ws)]) AS g, unnest(range(len(ws))) AS i
  FROM (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS ws, string_split_regex(t, '{word}') AS gs FROM doc
        WHERE doc_id IN (SELECT doc_id FROM span))),
ended AS (
  SELECT doc_id, t, lower(w) AS term, length(w) AS n, CAST(sum(length(g) + length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS e
  FROM worded),
near AS (
  SELECT doc_id, t, term, e - n AS s, e FROM ended
  WHERE NOT EXISTS (SELECT 1 FROM span WHERE span.doc_id = ended.doc_id AND ended.e - n < span.e AND span.s < ended.e)),
protected AS (
  SELECT DISTINCT doc_id, t, unnest([entity, kind || 's ' || CASE kind
    WHEN 'email' THEN regexp_extract(entity, '{_GROUPS[0]}', 1) WHEN 'ip' THEN regexp_extract(entity, '{_GROUPS[1]}', 1)
    WHEN 'card' THEN regexp_extract(entity, '{_GROUPS[2]}', 1) ELSE regexp_extract(entity, '{_GROUPS[3]}', 1) END, kind]) AS entity
  FROM span),
together AS (
  SELECT entity, term, sum(n) AS n_et FROM (
    SELECT entity, term, near.t AS t, count(DISTINCT near.doc_id) AS n FROM near JOIN protected USING (doc_id) GROUP BY entity, term, near.t)
  GROUP BY entity, term HAVING count(*) >= {SUPPORT}),
entities AS (SELECT entity, count(DISTINCT doc_id) AS n_e FROM protected GROUP BY entity HAVING count(DISTINCT doc_id) >= {SUPPORT}),
terms AS (SELECT term, count(DISTINCT doc_id) AS n_t
          FROM (SELECT doc_id, unnest(regexp_extract_all(lower(t), '{word}')) AS term FROM doc) GROUP BY term),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM doc),
judged AS (
  SELECT entity, term FROM together JOIN entities USING (entity) JOIN terms USING (term), total
  WHERE n_e < n AND ln(n_et * n / (n_e * n_t)) / ln(n / n_e) >= {GENERALISE}),
every AS (
  SELECT doc_id, kind, rank, s, e FROM span
  UNION ALL SELECT DISTINCT doc_id, '{TERM}', {len(KINDS)}, s, e FROM near JOIN protected USING (doc_id) JOIN judged USING (entity, term)),
per_doc AS (
  SELECT doc_id, {counts},
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (kind <> '{TERM}'), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans
  FROM every GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{kind}, 0) AS n_{kind}' for kind in KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM doc LEFT JOIN per_doc USING (doc_id)"""
