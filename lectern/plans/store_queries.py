"""Queries over the content and problem store."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import content as C
from lectern.operators.lookup import lookup_many
from lectern.operators.numbering import assign_ids
from lectern.plans import views as V
from lectern.plans.registry import query
from lectern.plans.views import AS_OF, CONTENT, PROBLEMS, with_sql
from lectern.session import scratch_path
from lectern.sources.store import StudyStore

LIVE = f"(expires_at IS NULL OR expires_at > TIMESTAMP '{AS_OF}')"
FOLD = "translate(topic, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ENTRY = "entry_id, topic, subject, url, md5(body) AS body_md5, source_type, fetched_at, expires_at"
PROBLEM = "problem_id, topic, subject, difficulty, source, problem, solution, fetched_at, expires_at"


def _entry(df):
    return df.select("entry_id", "topic", "subject", "url", F.md5("body").alias("body_md5"), "source_type",
                     "fetched_at", "expires_at")


def _problem(df):
    return df.select("problem_id", "topic", "subject", "difficulty", "source", "problem", "solution", "fetched_at", "expires_at")


# --- append -----------------------------------------------------------------------------------

#: Above every id that the store has issued.
HIGH_WATER = 10**12


def _incoming_content(t):
    """Whole raw pages with blanks around them; of every fifth page only the blanks."""
    html = F.when(F.expr("page_id % 5 = 0"), F.lit("")).otherwise(F.col("html"))
    return t.pages.select(
        F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1).alias("topic"), "url",
        F.concat(F.lit(" \n\t"), html, F.lit("\xa0\n\u3000")).alias("body"),
        "page_id",
    )


INCOMING = r"""accepted AS (
  SELECT row_number() OVER (ORDER BY page_id) AS n, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS topic, url,
         trim(html, E' \t\n\r') AS body
  FROM pages WHERE page_id % 5 <> 0 AND trim(html, E' \t\n\r') <> '')"""


@query("append_content", with_sql(CONTENT, INCOMING, body=f"""
SELECT {ENTRY} FROM content UNION ALL
SELECT n + {HIGH_WATER}, topic, NULL, url, md5(body), 'web', TIMESTAMP '{AS_OF}',
       TIMESTAMP '{AS_OF}' + to_days(30) FROM accepted"""))
def append_content(t):
    return _entry(C.append_content(V.content(t), _incoming_content(t), AS_OF, HIGH_WATER + 1, ["page_id"]))


@query("append_problems", with_sql(PROBLEMS, body=f"""
SELECT {PROBLEM} FROM problems UNION ALL
SELECT {HIGH_WATER} + row_number() OVER (ORDER BY item_id), 'benchmark', NULL, NULL, 'benchmark ' || item_id, '  ' || text || ' ', NULL,
       TIMESTAMP '{AS_OF}', TIMESTAMP '{AS_OF}' + to_days(30) FROM benchmark"""))
def append_problems(t):
    incoming = t.benchmark.select(
        F.lit("benchmark").alias("topic"), F.concat(F.lit("benchmark "), F.col("item_id").cast("string")).alias("source"),
        F.concat(F.lit("  "), F.col("text"), F.lit(" ")).alias("problem"),
        "item_id")
    return _problem(C.append_problems(V.problems(t), incoming, AS_OF, HIGH_WATER + 1, ["item_id"]))


@query("assign_ids", """
SELECT doc_id, source, 1000 + row_number() OVER (ORDER BY source, doc_id) AS new_id FROM documents""")
def renumber_documents(t):
    return assign_ids(t.documents.select("doc_id", "source"), "new_id", 1001, ["source", "doc_id"])


# --- filters ----------------------------------------------------------------------------------

@query("live_entries", with_sql(CONTENT, body=f"SELECT {ENTRY} FROM content WHERE {LIVE}"))
def live_entries(t):
    return _entry(C.live(V.content(t), AS_OF))


@query("expired_entries", with_sql(CONTENT, body=f"SELECT {ENTRY} FROM content WHERE NOT {LIVE}"))
def expired_entries(t):
    return _entry(C.expired(V.content(t), AS_OF))


@query("match_topics", with_sql(CONTENT, body=f"""
SELECT entry_id, topic FROM content WHERE {FOLD} LIKE '%rc1%'"""))
def match_topics(t):
    return C.matching(V.content(t), "RC1").select("entry_id", "topic")


@query("match_topics_wildcard", with_sql(CONTENT, body=f"""
SELECT entry_id, topic FROM content WHERE {FOLD} LIKE '%src_%5%'"""))
def match_topics_wildcard(t):
    return C.matching(V.content(t), "SRC_%5").select("entry_id", "topic")


@query("problems_by_difficulty", with_sql(PROBLEMS, body=f"""
SELECT {PROBLEM} FROM problems WHERE difficulty = 'Hard' AND {LIVE}"""))
def problems_by_difficulty(t):
    return _problem(C.with_difficulty(C.live(V.problems(t), AS_OF), "Hard"))


@query("present_entries", with_sql(CONTENT, body="""
SELECT entry_id, topic, coalesce(nullif(subject, ''), 'N/A') AS subject, coalesce(nullif(url, ''), 'N/A') AS url,
       fetched_at, coalesce(strftime(expires_at, '%Y-%m-%d %H:%M:%S'), 'never') AS expires, md5(body) AS body_md5
FROM content"""))
def present_entries(t):
    return C.present_content(V.content(t)).withColumn("body_md5", F.md5("body")).drop("body")


@query("present_problems", with_sql(PROBLEMS, body="""
SELECT problem_id, topic, coalesce(difficulty, 'N/A') AS difficulty, coalesce(source, 'N/A') AS source, problem,
       solution FROM problems"""))
def present_problems(t):
    return C.present_problems(V.problems(t))


# --- look up ----------------------------------------------------------------------------------

@query("latest_entries", with_sql(CONTENT, body=f"""
SELECT {ENTRY} FROM content WHERE {LIVE} AND {FOLD} LIKE '%src1%'
ORDER BY fetched_at DESC, entry_id DESC LIMIT 3"""))
def latest_entries(t):
    return _entry(C.latest(V.content(t), "src1", AS_OF))


@query("sample_problems", with_sql(PROBLEMS, body=f"""
SELECT {PROBLEM} FROM problems WHERE {LIVE} AND difficulty = 'Medium' AND {FOLD} LIKE '%red%'
ORDER BY md5('7:' || problem_id), problem_id LIMIT 5"""))
def sample_problems(t):
    return _problem(C.sample_problems(V.problems(t), "Red", AS_OF, "Medium", seed=7))


@query("sample_problems_unlimited", with_sql(PROBLEMS, body=f"""
SELECT {PROBLEM} FROM problems WHERE {LIVE} AND {FOLD} LIKE '%bolt%'"""))
def sample_problems_unlimited(t):
    return _problem(C.sample_problems(V.problems(t), "bolt", AS_OF, n=-1))


def _lookup_texts(t):
    """Search texts: topics in capitals, ends of topics, wildcards, and texts that match nothing."""
    source = F.col("source")
    variants = F.array(
        F.upper(source), F.substring(source, 3, 9), F.concat(F.lit("s_c"), F.substring(source, 4, 9)),
        F.concat(F.substring(source, 1, 1), F.lit("%"), F.substring(source, -1, 1)),
        F.concat(source, F.lit("-"), F.col("lang")), F.lit(""), F.lit("_____"), F.lit("\\"),
    )
    return t.documents.select(F.explode(variants).alias("query")).distinct()


LOOKUPS = """texts AS (
  SELECT DISTINCT unnest([upper(source), substr(source, 3, 9), 's_c' || substr(source, 4, 9),
         substr(source, 1, 1) || '%' || right(source, 1), source || '-' || lang, '', '_____', chr(92)]) AS query
  FROM documents)"""


@query("bulk_lookup", with_sql(CONTENT, LOOKUPS, body=f"""
, pairs AS (
  SELECT query, entry_id, topic, fetched_at,
         row_number() OVER (PARTITION BY query ORDER BY fetched_at DESC, entry_id DESC) AS place
  FROM texts JOIN content ON {LIVE} AND {FOLD} LIKE
       '%' || translate(query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '%')
SELECT t.query, place, entry_id, topic, fetched_at, entry_id IS NOT NULL AS hit
FROM texts t LEFT JOIN (SELECT * FROM pairs WHERE place <= 3) p ON p.query = t.query"""))
def bulk_lookup(t):
    found = lookup_many(V.content(t), _lookup_texts(t), AS_OF)
    return found.select("query", "place", "entry_id", "topic", "fetched_at", "hit")


# --- list and count ---------------------------------------------------------------------------

@query("list_topics", with_sql(CONTENT, body=f"""
SELECT topic, arg_max_null(subject, fetched_at::VARCHAR || lpad(entry_id::VARCHAR, 20, '0')) AS subject,
       count(*) AS entries, max(fetched_at) AS last_updated
FROM content WHERE {LIVE} GROUP BY topic"""))
def list_topics(t):
    return C.list_topics(V.content(t), AS_OF)


@query("present_topics", with_sql(CONTENT, body=f"""
SELECT topic, coalesce(nullif(arg_max_null(subject, fetched_at::VARCHAR || lpad(entry_id::VARCHAR, 20, '0')), ''), '?') AS subject,
       count(*) AS entries, max(fetched_at) AS last_updated
FROM content WHERE {LIVE} GROUP BY topic"""))
def present_topics(t):
    return C.present_topics(C.list_topics(V.content(t), AS_OF))


@query("list_problem_topics", with_sql(PROBLEMS, body=f"""
SELECT topic, min(subject) AS subject, count(*) AS problems FROM problems WHERE {LIVE} GROUP BY topic"""))
def list_problem_topics(t):
    return C.list_problem_topics(V.problems(t), AS_OF)


@query("store_stats", with_sql(CONTENT, PROBLEMS, body=f"""
SELECT (SELECT count(*) FROM content) AS total_entries, (SELECT count(*) FROM content WHERE {LIVE}) AS active_entries,
       (SELECT count(*) FROM problems WHERE {LIVE}) AS active_problems"""))
def store_stats(t):
    return C.store_stats(V.content(t), V.problems(t), AS_OF)


# --- remove -----------------------------------------------------------------------------------

@query("purge_survivors", with_sql(CONTENT, body=f"SELECT {ENTRY} FROM content WHERE NOT {FOLD} LIKE '%src1%'"))
def purge_survivors(t):
    return _entry(C.purge(V.content(t), V.problems(t), "Src1")[0])


@query("purge_counts", with_sql(CONTENT, PROBLEMS, body=f"""
SELECT 'content' AS table_name, count(*) FILTER ({FOLD} LIKE '%r%1%') AS removed FROM content UNION ALL
SELECT 'problems', count(*) FILTER ({FOLD} LIKE '%r%1%') FROM problems"""))
def purge_counts(t):
    return C.purge(V.content(t), V.problems(t), "R%1")[2]


@query("clear_expired_survivors", with_sql(PROBLEMS, body=f"SELECT {PROBLEM} FROM problems WHERE {LIVE}"))
def clear_expired_survivors(t):
    return _problem(C.clear_expired(V.content(t), V.problems(t), AS_OF)[1])


@query("clear_expired_counts", with_sql(CONTENT, PROBLEMS, body=f"""
SELECT 'content' AS table_name, count(*) FILTER (NOT {LIVE}) AS removed FROM content UNION ALL
SELECT 'problems', count(*) FILTER (NOT {LIVE}) FROM problems"""))
def clear_expired_counts(t):
    return C.clear_expired(V.content(t), V.problems(t), AS_OF)[2]


@query("store_commands", f"""
WITH docs AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS n, count(*) OVER () AS total FROM documents)
SELECT n AS entry_id, source AS topic, md5(text) AS body_md5, TIMESTAMP '{AS_OF}' AS fetched_at
FROM docs WHERE NOT source LIKE '%src1%' UNION ALL
SELECT total + row_number() OVER (ORDER BY doc_id), 'again ' || source, md5(text), TIMESTAMP '{AS_OF}' FROM docs""")
def store_commands(t):
    """Store all documents, purge one topic, store them again: ids go on above all that were issued."""
    spark = t.documents.sparkSession
    store = StudyStore(spark, scratch_path(spark, "store"))

    def incoming(prefix):
        return t.documents.select(
            F.concat(F.lit(prefix), "source").alias("topic"), F.col("text").alias("body"),
            "doc_id")

    store.store_content(incoming(""), AS_OF, order_cols=["doc_id"])
    store.purge("src1")
    store.store_content(incoming("again "), AS_OF, order_cols=["doc_id"])
    return store.read("content").select("entry_id", "topic", F.md5("body").alias("body_md5"), "fetched_at")


@query("clear_all_keeps_counting", """
SELECT (SELECT count(*) FROM part) + row_number() OVER (ORDER BY p_partkey) AS problem_id, p_name AS topic,
       p_brand AS source, CAST(NULL AS VARCHAR) AS solution FROM part""")
def clear_all_keeps_counting(t):
    spark = t.part.sparkSession
    store = StudyStore(spark, scratch_path(spark, "store"))
    bank = V.problems(t).withColumn("place", F.col("problem_id")).drop("solution")
    store.store_problems(bank, AS_OF, order_cols=["place"])
    store.clear_all()
    store.store_problems(bank, AS_OF, order_cols=["place"])
    return store.read("problems").select("problem_id", "topic", "source", "solution")
