"""The test tables bound to the library's table shapes, once in Spark and once in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.paths import slide_markdown
from lectern.operators import decks as D

AS_OF = "2024-02-15 00:00:00"
DAY_ZERO = "2024-01-01 00:00:00"


class Tables:
    """``Tables(spark, folder).documents`` and so on, each read from its Parquet file."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._read = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._read[name]


def _dates(id_col: str) -> list[str]:
    fetched = f"TIMESTAMP_NTZ '{DAY_ZERO}' + make_dt_interval(CAST({id_col} % 60 AS INT))"
    return [
        f"{fetched} AS fetched_at",
        f"CASE WHEN {id_col} % 11 <> 0 THEN {fetched} + INTERVAL 30 DAYS END AS expires_at",
    ]


def _dates_sql(id_col: str) -> str:
    fetched = f"TIMESTAMP '{DAY_ZERO}' + to_days(CAST({id_col} % 60 AS INTEGER))"
    return f"{fetched} AS fetched_at, CASE WHEN {id_col} % 11 <> 0 THEN {fetched} + to_days(30) END AS expires_at"


# --- store tables -----------------------------------------------------------------------------

def content(t: Tables) -> DataFrame:
    return t.documents.selectExpr(
        "doc_id AS entry_id", "source AS topic", "CASE WHEN doc_id % 7 <> 0 THEN lang END AS subject",
        "'https://example.org/d/' || doc_id AS url", "text AS body", "'web' AS source_type", *_dates("doc_id"),
        "CAST(NULL AS STRING) AS tags",
    )


CONTENT = f"""content AS (
  SELECT doc_id AS entry_id, source AS topic, CASE WHEN doc_id % 7 <> 0 THEN lang END AS subject,
         'https://example.org/d/' || doc_id AS url, text AS body, 'web' AS source_type,
         {_dates_sql('doc_id')}, CAST(NULL AS VARCHAR) AS tags
  FROM documents)"""


def problems_from(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS problem_id", "p_name AS topic", "p_type AS subject",
        "CASE WHEN p_size <= 17 THEN 'Easy' WHEN p_size <= 34 THEN 'Medium' ELSE 'Hard' END AS difficulty",
        "p_brand AS source", "p_name || ' #' || p_partkey AS problem", "CAST(NULL AS STRING) AS solution",
        "CAST(NULL AS STRING) AS url", *_dates("p_partkey"),
    )


def problems(t: Tables) -> DataFrame:
    return problems_from(t.part)


PROBLEMS = f"""problems AS (
  SELECT p_partkey AS problem_id, p_name AS topic, p_type AS subject,
         CASE WHEN p_size <= 17 THEN 'Easy' WHEN p_size <= 34 THEN 'Medium' ELSE 'Hard' END AS difficulty,
         p_brand AS source, p_name || ' #' || p_partkey AS problem, CAST(NULL AS VARCHAR) AS solution,
         CAST(NULL AS VARCHAR) AS url, {_dates_sql('p_partkey')}
  FROM part)"""


def sessions(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "event_id AS session_id", "event_type AS topic", "user_id", "ts AS started_at", "0 AS checkpoint")


# --- curriculum -------------------------------------------------------------------------------

def syllabus(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_type AS subject", "p_brand AS section", "'topic ' || p_partkey AS topic",
        "CAST(p_size % 6 + 1 AS INT) AS weight_pct",
        "element_at(array('Low', 'Medium', 'High', 'Very High'), p_size % 4 + 1) AS advanced",
        "element_at(array('CRITICAL', 'HIGH', 'MEDIUM', 'LOW'), CAST(p_partkey % 4 AS INT) + 1) AS tier",
        "p_name AS notes",
    )


SYLLABUS = """syllabus AS (
  SELECT p_type AS subject, p_brand AS section, 'topic ' || p_partkey AS topic,
         CAST(p_size % 6 + 1 AS INTEGER) AS weight_pct,
         ['Low', 'Medium', 'High', 'Very High'][p_size % 4 + 1] AS advanced,
         ['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'][CAST(p_partkey % 4 AS INTEGER) + 1] AS tier, p_name AS notes
  FROM part)"""


def section_totals(t: Tables) -> DataFrame:
    """Declared ranges around the real sums; sections of the brand with number 25 are declared too low."""
    sums = syllabus(t).groupBy("subject", "section").agg(F.sum("weight_pct").alias("s"))
    return sums.selectExpr(
        "subject", "section", "CAST(greatest(s - 2, 0) AS INT) AS lo_pct",
        "CAST(s + IF(section = 'Brand#25', -1, 2) AS INT) AS hi_pct")


SECTION_TOTALS = """section_totals AS (
  SELECT subject, section, CAST(greatest(sum(weight_pct) - 2, 0) AS INTEGER) AS lo_pct,
         CAST(sum(weight_pct) + CASE WHEN section = 'Brand#25' THEN -1 ELSE 2 END AS INTEGER) AS hi_pct
  FROM syllabus GROUP BY subject, section)"""


# --- decks ------------------------------------------------------------------------------------

def slides(t: Tables) -> DataFrame:
    return t.conversations.selectExpr("conv_id AS deck", "CAST(turn + 1 AS INT) AS slide_no", "text", "role")


SLIDES = """slides AS (
  SELECT conv_id AS deck, CAST(turn + 1 AS INTEGER) AS slide_no, text, role FROM conversations)"""


def large_decks(t: Tables) -> DataFrame:
    """One deck per nation with one page per customer."""
    return t.customer.groupBy(F.col("c_nationkey").alias("deck")).agg(F.count("*").alias("total_pages"))


LARGE_DECKS = """decks AS (
  SELECT c_nationkey AS deck, count(*) AS total_pages FROM customer GROUP BY c_nationkey)"""


def small_decks(t: Tables) -> DataFrame:
    """One deck per customer with one page per order."""
    return t.orders.groupBy(F.col("o_custkey").alias("deck")).agg(F.count("*").alias("total_pages"))


SMALL_DECKS = """decks AS (
  SELECT o_custkey AS deck, count(*) AS total_pages FROM orders GROUP BY o_custkey)"""


def written_large_pages(t: Tables) -> DataFrame:
    """Pages said to be written already: one per customer balance."""
    return t.customer.selectExpr("c_nationkey AS deck", "CAST(floor(abs(c_acctbal)) % 1000 + 1 AS INT) AS page")


WRITTEN_LARGE = """written AS (
  SELECT c_nationkey AS deck, CAST(floor(abs(c_acctbal)) AS BIGINT) % 1000 + 1 AS page FROM customer)"""

PAGES = """pages_of AS (
  SELECT deck, CAST(unnest(generate_series(1, total_pages)) AS INTEGER) AS page FROM decks)"""

REMAINING_LARGE = ",\n".join([LARGE_DECKS, PAGES, WRITTEN_LARGE]) + """, todo AS (
  SELECT * FROM pages_of p WHERE NOT EXISTS (SELECT 1 FROM written w WHERE w.deck = p.deck AND w.page = p.page))"""


def chunks_sql(pages: str) -> str:
    """CTEs ``numbered`` and ``chunks`` for a relation (deck, page)."""
    return f"""sized AS (
  SELECT deck, page, row_number() OVER (PARTITION BY deck ORDER BY page) AS pos,
         count(*) OVER (PARTITION BY deck) AS n FROM {pages}),
numbered AS (
  SELECT deck, page, CAST((pos - 1) // CAST(ceil(n / least(greatest(4, ceil(n / 20.0)), n)) AS BIGINT) + 1 AS INTEGER)
         AS chunk FROM sized),
chunks AS (
  SELECT deck, chunk, list(page ORDER BY page) AS pages, CAST(count(*) AS INTEGER) AS n_pages
  FROM numbered GROUP BY deck, chunk)"""


def remaining_large(t: Tables) -> DataFrame:
    return D.remaining_pages(D.select_pages(large_decks(t)), written_large_pages(t))


def large_chunks(t: Tables) -> DataFrame:
    return D.plan_chunks(remaining_large(t))


def small_chunks(t: Tables) -> DataFrame:
    return D.plan_chunks(D.select_pages(small_decks(t)))


# --- responses --------------------------------------------------------------------------------

def responses(t: Tables, flawed: bool) -> DataFrame:
    """One response per chunk of a conversation's pages. Flawed ones title the pages of the role
    ``system`` and leave out pages of under 100 characters."""
    pages = slides(t)
    chunked = D.plan_chunks(pages.select("deck", F.col("slide_no").alias("page"))).select(
        "deck", "chunk", F.explode("pages").alias("slide_no"))
    section = slide_markdown(F.col("slide_no"), F.col("text"))
    if flawed:
        titled = F.concat(F.lit("## Slide "), F.col("slide_no").cast("string"), F.lit(": Setup\n\n"), F.col("text"))
        section = F.when(F.length("text") >= 100, F.when(F.col("role") == "system", titled).otherwise(section))
    parts = F.sort_array(F.collect_list(F.struct("slide_no", section.alias("part"))))  # at most 20 per chunk
    return chunked.join(pages, ["deck", "slide_no"]).groupBy("deck", "chunk").agg(parts.alias("p")).select(
        "deck", "chunk", F.col("p.slide_no").alias("pages"),
        F.array_join(F.filter(F.col("p.part"), lambda s: s.isNotNull()), "\n\n").alias("raw_text"))


SLIDE_CHUNKS = SLIDES + ", todo AS (SELECT deck, slide_no AS page FROM slides),\n" + chunks_sql("todo")


# --- relevance --------------------------------------------------------------------------------

INCLUDE = ["anat", "ones", "oure", "anth", "ener"]
SKIP = ["annt", "enst", "reed", "reor", "reat", "anor"]


def pages_with_module(t: Tables) -> DataFrame:
    return t.documents.selectExpr("source AS module", "source || '-' || lang AS deck", "doc_id AS slide_no", "text")


def _list_sql(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TAGGED = f"""worded AS (
  SELECT doc_id AS slide_no, source AS module, source || '-' || lang AS deck, text,
         string_split_regex(lower(text), '[^a-z]+') AS words FROM documents),
tagged AS (
  SELECT *, CASE WHEN list_has_any(words, {_list_sql(INCLUDE)}) THEN 'include term'
                 WHEN list_has_any(words, {_list_sql(SKIP)}) THEN 'skip term' ELSE 'default' END AS reason,
         CASE WHEN NOT list_has_any(words, {_list_sql(INCLUDE)}) AND list_has_any(words, {_list_sql(SKIP)})
              THEN 'skip' ELSE 'include' END AS verdict
  FROM worded)"""


def with_sql(*views: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(views) + "\n" + body
