"""Registered queries of the training-data operators over the test tables, and their DuckDB twins.

Every query reads its whole table through its operator with the operator's production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    attention_quality, consensus_extract, disclosure_sanitise, external_shuffle, itq_neardup, license_scan, line_dedup, merge_dropout,
    periodic_runs, simhash_golay, toivonen_phrases, warc_segments, winnow_decontaminate,
)
from lectern.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (session, folder) under ``name``."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op1_attention_quality")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return attention_quality.score_documents(docs, attention_quality.fit_model(docs, labels))


@query("op2_license_scan", license_scan.duckdb_twin())
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).drop("stands")


@query("op3_disclosure_sanitise", disclosure_sanitise.duckdb_twin())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = disclosure_sanitise.find_personal_data(table(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_list", 256).alias("base_sha256"),
                        F.col("span_list").alias("spans"))


@query("op4_winnow_decontaminate", f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS ws FROM benchmark),
gram AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS words
  FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
        FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents),
place AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT n FROM gram) WHERE len(ws) >= n)),
hit AS (SELECT doc_id, item, i, n FROM place JOIN gram USING (n, words)),
word AS (SELECT doc_id, count(DISTINCT w) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = winnow_decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_BASE32 = " || ".join(
    f"lpad(to_base(CAST('0x' || substr(h, {10 * i + 1}, 10) AS BIGINT), 32), 8, '0')" for i in range(4))


@query("op5_warc_segments", f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
keyed AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
         translate({_BASE32}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS last
  FROM page)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM keyed""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    pages, archives = table(spark, folder, "pages"), scratch_path(spark, "warc")
    warc_segments.write_archives(pages, archives)
    records = warc_segments.read_records(spark, archives, payloads=False)
    return warc_segments.page_records(records, pages.schema["page_id"].dataType.simpleString())


@query("op6_line_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return docs.select("doc_id", F.coalesce(lines, F.lit(0)).cast("long").alias("n_lines")).join(
        line_dedup.removed_by_document(docs), "doc_id", "left").select(
        "doc_id", "n_lines", F.coalesce("n_compared", F.lit(0)).cast("long").alias("n_compared"),
        F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed_lines", ","), F.lit("")).alias("removed_lines"))


@query("op7_consensus_extract")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return consensus_extract.extract_pages(table(spark, folder, "pages"))


@query("op8_itq_neardup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return itq_neardup.link_vectors(table(spark, folder, "embeddings"))


@query("op9_merge_dropout")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return merge_dropout.encoding_digests(table(spark, folder, "documents"))


@query("op10_golay_simhash")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_golay.group_documents(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op11_external_shuffle")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    records = external_shuffle.shuffle_into_shards(table(spark, folder, "documents"))
    return records.select(
        F.col("row.doc_id").alias("doc_id"), "size", F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``: a tenth of the texts, by the checksum of their id, repeat a stretch of theirs to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    planted = (h % 10 == 0) & (F.size("w") > 0)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", F.coalesce(words, F.array().cast("array<string>")).alias("w")).withColumn(
        "g", F.floor(h / 10)).withColumn("n", F.size("w").cast("long")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("slice(concat(slice(w, 1, int(a)), flatten(array_repeat(slice(w, int(a) + 1, int(p)), int((n - a + p - 1) div p)))), 1, int(n))")
    return cut.select("doc_id", F.when(planted, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(with_repeats(table(spark, folder, "documents")))
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS shortness, r.start AS start, r.period AS period)))")
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.shortness")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.shortness div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op13_toivonen_phrases", r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split CROSS JOIN (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)),
total AS (SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS a FROM gram GROUP BY lang, k, phrase HAVING count(*) >= 10),
cut AS (
  SELECT lang, k, phrase, a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS x, array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (
  SELECT cut.lang, cut.k, cut.phrase, cut.a, c, fx.a AS l, fy.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * cut.a * cut.a) // (CAST(fx.a AS HUGEINT) * fy.a) AS BIGINT) AS score
  FROM cut JOIN f AS fx ON fx.lang = cut.lang AND fx.phrase = cut.x JOIN f AS fy ON fy.lang = cut.lang AND fy.phrase = cut.y),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored),
around AS (
  SELECT lang, part, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS part
        FROM f WHERE k = 3) GROUP BY lang, part),
kept AS (
  SELECT low.* FROM low LEFT JOIN around ON around.lang = low.lang AND around.part = low.phrase
  WHERE place = 1 AND (around.a IS NULL OR 100 * around.a < 50 * low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return toivonen_phrases.collocations(table(spark, folder, "documents"))
