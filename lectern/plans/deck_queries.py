"""Queries of the extraction work: files, pages, chunks, responses, indexes."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lectern import fixed_values as K
from lectern.functions import paths as P
from lectern.functions import text as X
from lectern.operators import apply as A
from lectern.operators import content as C
from lectern.operators import decks as D
from lectern.plans import views as V
from lectern.plans.registry import query
from lectern.plans.views import (
    LARGE_DECKS, PAGES, REMAINING_LARGE, SLIDE_CHUNKS, SLIDES, SMALL_DECKS, chunks_sql, with_sql,
)
from lectern.session import scratch_path
from lectern.sources import files as S

SQL_STRIP = r"E' \t\n\r\f'"


def _text(col: str) -> str:
    return f"array_to_string({col}, ',')"


# --- files ------------------------------------------------------------------------------------

def _input_files(t):
    """Deck files named after the raw pages: the suffix depends on the host, some have none."""
    path = F.regexp_replace("url", r"^https?:/|/?[?#].*$|/$", "")
    ending = (
        F.when(F.col("url").contains(".org/"), ".PPTX").when(F.col("url").contains(".net/"), ".odp").otherwise(""))
    return t.pages.select("page_id", F.concat(path, ending).alias("path"))


INPUT_FILES = r"""input_files AS (
  SELECT page_id, regexp_replace(url, '^https?:/|/?[?#].*$|/$', '', 'g') ||
         CASE WHEN contains(url, '.org/') THEN '.PPTX' WHEN contains(url, '.net/') THEN '.odp' ELSE '' END AS path
  FROM pages),
parts AS (
  SELECT *, regexp_extract(path, '[^/](\.[^./]+)$', 1) AS ext, regexp_extract(path, '([^/]*)$', 1) AS name,
         regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM input_files),
named AS (
  SELECT *, left(name, length(name) - length(ext)) AS stem FROM parts)"""


@query("classify_inputs", with_sql(INPUT_FILES, body="""
SELECT page_id, path, CASE WHEN lower(ext) IN ('.ppt', '.pptx', '.pps', '.ppsx', '.odp') THEN 'accepted' ELSE 'skipped' END
       AS status,
       CASE WHEN lower(ext) NOT IN ('.ppt', '.pptx', '.pps', '.ppsx', '.odp')
            THEN 'Unsupported format ''' || ext || '''' END AS reason
FROM named"""))
def classify_inputs(t):
    return D.classify_inputs(_input_files(t))


@query("path_parts", with_sql(INPUT_FILES, body="""
SELECT page_id, stem, lower(ext) AS suffix, folder || '/' || stem || '.pdf' AS converted,
       '/out/' || stem || '.pdf' AS converted_elsewhere, folder || '/' || stem || '_extracted' AS extracted,
       replace(replace(path, '/', chr(92)), chr(92), '/') AS forward
FROM named"""))
def path_parts(t):
    path = F.col("path")
    return _input_files(t).select(
        "page_id", P.stem(path).alias("stem"), P.lower_suffix(path).alias("suffix"),
        P.converted_path(path).alias("converted"), P.converted_path(path, "/out").alias("converted_elsewhere"),
        P.extraction_dir(path).alias("extracted"),
        X.forward_slashes(F.translate(path, "/", "\\")).alias("forward"),
    )


@query("pending_conversions", with_sql(INPUT_FILES, body="""
, planned AS (SELECT page_id, path, '/out/' || stem || '.pdf' AS output FROM named),
outputs AS (SELECT DISTINCT '/out/' || l_partkey || '.pdf' AS path FROM lineitem WHERE l_shipdate >= DATE '2001-11-01')
SELECT page_id, p.path, output, (SELECT count(*) FROM planned q WHERE q.output = p.output) > 1 AS collides
FROM planned p WHERE output NOT IN (SELECT path FROM outputs)"""))
def pending_conversions(t):
    done = t.lineitem.filter(F.col("l_shipdate") >= F.lit("2001-11-01").cast("timestamp_ntz"))
    outputs = done.select(F.concat(F.lit("/out/"), F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("path"))
    return D.pending_conversions(_input_files(t), outputs, "/out").select("page_id", "path", "output", "collides")


@query("existing_slides", """
WITH named AS (
  SELECT conv_id AS deck, CASE role WHEN 'user' THEN 'slide_' || lpad(CAST(turn + 1 AS VARCHAR), CAST(greatest(4, length(CAST(turn + 1 AS VARCHAR))) AS INTEGER), '0') || '.md'
         WHEN 'assistant' THEN 'slide_' || (turn + 1) || '.md' ELSE 'slide_' || role || '.md' END AS name FROM conversations)
SELECT DISTINCT deck, CAST(regexp_extract(name, '^slide_(\\d+)\\.md$', 1) AS INTEGER) AS page
FROM named WHERE regexp_matches(name, '^slide_(\\d+)\\.md$')""")
def existing_slides(t):
    number = (F.col("turn") + 1).cast("string")
    name = (
        F.when(F.col("role") == "user", P.slide_file(F.col("turn") + 1))
        .when(F.col("role") == "assistant", F.concat(F.lit("slide_"), number, F.lit(".md")))
        .otherwise(F.concat(F.lit("slide_"), "role", F.lit(".md")))
    )
    return S.existing_slides(t.conversations.select(F.col("conv_id").alias("deck"), name.alias("name")))


@query("write_slides", with_sql(SLIDES, body="""
SELECT deck, slide_no, 'slide_' || lpad(CAST(slide_no AS VARCHAR), CAST(greatest(4, length(CAST(slide_no AS VARCHAR))) AS INTEGER), '0') || '.md' AS file_name,
       '## Slide ' || slide_no || chr(10) || chr(10) || text AS markdown FROM slides"""))
def write_slides(t):
    spark = t.conversations.sparkSession
    path = scratch_path(spark, "slides")
    S.write_slides(V.slides(t), path)
    return S.read_slides(spark, path).select("deck", "slide_no", "file_name", "markdown")


# --- pages and chunks -------------------------------------------------------------------------

@query("select_pages", with_sql(LARGE_DECKS, PAGES, body="SELECT deck, page FROM pages_of"))
def select_pages(t):
    return D.select_pages(V.large_decks(t))


@query("select_page_range", with_sql(SMALL_DECKS, PAGES, body="""
SELECT deck, page FROM pages_of WHERE page BETWEEN 3 AND 11"""))
def select_page_range(t):
    return D.select_pages(V.small_decks(t), 3, 11)


@query("remaining_pages", with_sql(REMAINING_LARGE, body="SELECT deck, page FROM todo"))
def remaining_pages(t):
    return V.remaining_large(t)


@query("unlabelled_documents", """
SELECT source AS deck, doc_id AS page FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unlabelled_documents(t):
    pages = t.documents.select(F.col("source").alias("deck"), F.col("doc_id").alias("page"))
    # A label names the page only; its deck is that of the document.
    labelled = pages.join(t.labels.select(F.col("doc_id").alias("page")).distinct(), "page", "left_semi")
    return D.remaining_pages(pages, labelled)


@query("chunk_plan_resumed", with_sql(REMAINING_LARGE, chunks_sql("todo"), body=f"""
SELECT deck, chunk, {_text('pages')} AS pages, n_pages, greatest(180, least(900, n_pages * 30)) AS budget_seconds
FROM chunks"""))
def chunk_plan_resumed(t):
    return V.large_chunks(t).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


@query("chunk_plan", with_sql(SMALL_DECKS, PAGES, chunks_sql("pages_of"), body=f"""
SELECT deck, chunk, {_text('pages')} AS pages, n_pages, greatest(180, least(900, n_pages * 30)) AS budget_seconds
FROM chunks"""))
def chunk_plan(t):
    return V.small_chunks(t).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


_REF = "'slide_' || CASE WHEN x < 10000 THEN lpad(CAST(x AS VARCHAR), 4, '0') ELSE CAST(x AS VARCHAR) END || '.png'"
_NUMBERS = "array_to_string(pages, ', ')"


def _filled_sql(template: str, **values: str) -> str:
    """SQL for a template with each ``{name}`` replaced by an expression."""
    parts = re.split(r"\{(\w+)\}", template)
    quoted = ["'" + part.replace("'", "''") + "'" if i % 2 == 0 else f"({values[part]})" for i, part in enumerate(parts)]
    return " || ".join(quoted)


_RULES = _filled_sql(K.EXTRACTION_RULES, numbers=_NUMBERS)
_INLINE = _filled_sql(
    K.INLINE_PROMPT + "{rules}", count="n_pages", numbers=_NUMBERS,
    files=f"array_to_string([('@' || {_REF}) FOR x IN pages], ' ')", rules=_RULES)
_LISTED = _filled_sql(
    K.LISTED_PROMPT + "{rules}", rules=_RULES,
    files=f"array_to_string([('- ' || {_REF} || '  (this is Slide ' || x || ')') FOR x IN pages], chr(10))")


@query("prompts", with_sql(REMAINING_LARGE, chunks_sql("todo"), body=f"""
SELECT deck, chunk, {_INLINE} AS inline_prompt, {_LISTED} AS listed_prompt FROM chunks"""))
def prompts(t):
    return D.with_prompts(V.large_chunks(t)).select("deck", "chunk", "inline_prompt", "listed_prompt")


_PIECES = """pieces(deck, chunk, path, pages, depth) AS (
  SELECT deck, chunk, '', pages, 0 FROM chunks UNION ALL
  SELECT deck, chunk, CASE WHEN len(pages) > 1 THEN path || side ELSE path END,
         CASE WHEN len(pages) <= 1 THEN pages WHEN side = 'L' THEN pages[1:len(pages) // 2]
              ELSE pages[len(pages) // 2 + 1:] END, depth + 1
  FROM pieces, (VALUES ('L'), ('R')) s(side)
  WHERE depth < 3 AND (len(pages) > 1 OR side = 'L'))"""


@query("split_plan", with_sql(REMAINING_LARGE, chunks_sql("todo"), _PIECES, body=f"""
SELECT deck, chunk, path, {_text('pages')} AS pages FROM pieces WHERE depth = 3"""))
def split_plan(t):
    return A.split_plan(V.large_chunks(t)).select(
        "deck", "chunk", "path", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"))


# --- responses --------------------------------------------------------------------------------

@query("parse_sections", with_sql(SLIDES, body=f"""
SELECT deck, slide_no AS page, trim(text, {SQL_STRIP}) AS text FROM slides"""))
def parse_sections(t):
    return D.parse_sections(V.responses(t, flawed=False)).select("deck", "page", "text")


# Section texts are stripped, parts of a raw response are not. A titled page is no section, and its text
# is lost because its heading ends the page before.
_FLAWED = SLIDE_CHUNKS + f""", parts AS (
  SELECT n.deck, n.chunk, s.slide_no, s.text, s.role, length(s.text) >= 100 AS kept,
         '## Slide ' || s.slide_no || CASE WHEN s.role = 'system' THEN ': Setup' ELSE '' END ||
         chr(10) || chr(10) || s.text AS part
  FROM numbered n JOIN slides s ON s.deck = n.deck AND s.slide_no = n.page),
raw AS (
  SELECT deck, chunk, min(slide_no) AS first_no, max(slide_no) AS last_no,
         coalesce(string_agg(part, chr(10) || chr(10) ORDER BY slide_no) FILTER (kept), '') AS raw_text
  FROM parts GROUP BY deck, chunk),
filled AS (
  SELECT deck, slide_no,
         CASE WHEN kept AND role <> 'system' THEN trim(text, {SQL_STRIP})
              WHEN slide_no = first_no THEN trim(raw_text, {SQL_STRIP})
              ELSE {_filled_sql(K.PLACEHOLDER, first="first_no", last="last_no")} END AS text,
         CASE WHEN kept AND role <> 'system' THEN 'section' WHEN slide_no = first_no THEN 'whole' ELSE 'placeholder' END
         AS origin, chunk
  FROM parts JOIN raw USING (deck, chunk))"""


@query("fill_gaps", with_sql(_FLAWED, body="SELECT * FROM filled"))
def fill_gaps(t):
    return D.fill_gaps(V.responses(t, flawed=True))


# --- indexes ----------------------------------------------------------------------------------

def _meta(t):
    """Every deck asked for from page 1 to page 5, whatever its length."""
    return V.slides(t).groupBy("deck").agg(F.count("*").alias("total_pages")).select(
        "deck", "total_pages", F.lit(1).alias("start_page"), F.lit(5).cast("long").alias("end_page"),
        F.lit(K.RENDER_DPI).alias("dpi"))


_INDEX = SLIDES + """, meta AS (SELECT deck, count(*) AS total_pages FROM slides GROUP BY deck),
done AS (SELECT DISTINCT deck, slide_no FROM slides WHERE length(text) >= 100),
index_rows AS (
  SELECT m.deck, total_pages, 1 AS start_page, CAST(5 AS BIGINT) AS end_page, least(5, total_pages) AS actual_end,
         150 AS dpi, count(slide_no) AS n_extracted, min(slide_no) AS first_slide, max(slide_no) AS last_slide,
         count(slide_no) = total_pages AS complete
  FROM meta m LEFT JOIN done d ON d.deck = m.deck GROUP BY m.deck, total_pages)"""


def _written(t):
    return V.slides(t).filter(F.length("text") >= 100)


@query("deck_index", with_sql(_INDEX, body="SELECT * FROM index_rows"))
def deck_index(t):
    return D.build_index(_written(t), _meta(t))


@query("deck_index_pages", with_sql(REMAINING_LARGE, body=f"""
SELECT deck, block, {_text('list(page ORDER BY page)')} AS slide_nos
FROM (SELECT deck, page, CAST(page // 1000 AS INTEGER) AS block FROM todo) GROUP BY deck, block"""))
def deck_index_pages(t):
    pages = V.remaining_large(t).select("deck", F.col("page").alias("slide_no"))
    return D.index_blocks(pages).withColumn("slide_nos", F.array_join(F.col("slide_nos").cast("array<string>"), ","))


@query("deck_index_lines", with_sql(_INDEX, body="""
SELECT deck, i AS line_no, ['# Extracted: ' || deck, '- Total pages: ' || total_pages,
       '- Extracted range: ' || start_page || ' to ' || end_page, '- DPI: ' || dpi,
       '- Slides extracted: ' || n_extracted, '', '## Slide Index'][i] AS line
FROM index_rows, (SELECT unnest(generate_series(1, 7)) AS i) UNION ALL
SELECT deck, 7 + row_number() OVER (PARTITION BY deck ORDER BY slide_no),
       '- slide_' || lpad(CAST(slide_no AS VARCHAR), CAST(greatest(4, length(CAST(slide_no AS VARCHAR))) AS INTEGER), '0') || '.md — Slide ' || slide_no FROM done"""))
def deck_index_lines(t):
    return D.index_lines(_written(t), D.build_index(_written(t), _meta(t)))


@query("merge_pages", with_sql(SLIDES, body="""
SELECT deck, slide_no AS page FROM slides WHERE role <> 'assistant' UNION
SELECT deck, slide_no FROM slides WHERE length(text) >= 100"""))
def merge_pages(t):
    pages = V.slides(t).withColumn("page", F.col("slide_no"))
    return D.merge_pages(pages.filter(F.col("role") != "assistant"), pages.filter(F.length("text") >= 100))


@query("drop_decks", with_sql(SLIDES, body="""
SELECT deck, slide_no, md5(text) AS text_md5 FROM slides
WHERE deck NOT IN (SELECT deck FROM slides WHERE role = 'system')"""))
def drop_decks(t):
    pages = V.slides(t)
    kept = D.drop_decks(pages, pages.filter(F.col("role") == "system"))
    return kept.select("deck", "slide_no", F.md5("text").alias("text_md5"))


# --- runs -------------------------------------------------------------------------------------

def _results(t):
    bad = F.col("event_type") == "error"
    key = F.col("event_id").cast("string")
    return t.events.select(
        F.col("event_id").alias("item"), F.when(bad, "failed").otherwise("converted").alias("status"),
        F.when(~bad, F.concat(F.lit("/out/"), key, F.lit(".pdf"))).alias("output"),
        F.when(bad, F.concat(F.lit("bad props "), "props")).alias("error"),
    )


@query("run_counts", """
SELECT count(*) FILTER (event_type <> 'error') AS converted, count(*) FILTER (event_type = 'error') AS failed FROM events""")
def run_counts(t):
    return D.run_counts(_results(t))


@query("run_listing", """
SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'converted' END AS section,
       CASE WHEN event_type = 'error' THEN event_id || ': bad props ' || props ELSE '/out/' || event_id || '.pdf' END AS line
FROM events""")
def run_listing(t):
    return D.run_listing(_results(t))


@query("rate_limited_errors", """
WITH messages AS (
  SELECT event_id, CASE event_type WHEN 'signup' THEN 'Too Many Requests' WHEN 'view' THEN 'daily QUOTA used up'
         WHEN 'click' THEN 'Resource_Exhausted' WHEN 'purchase' THEN 'rate  limit' ELSE 'code ' || event_id END || ' ' || props
         AS message FROM events)
SELECT event_id, contains(lower(message), '429') OR contains(lower(message), 'rate limit')
       OR contains(lower(message), 'quota') OR contains(lower(message), 'resource_exhausted')
       OR contains(lower(message), 'resource exhausted') OR contains(lower(message), 'too many requests') AS rate_limited,
       left(message, 12) AS message FROM messages""")
def rate_limited_errors(t):
    kind = F.col("event_type")
    opening = (
        F.when(kind == "signup", "Too Many Requests").when(kind == "view", "daily QUOTA used up")
        .when(kind == "click", "Resource_Exhausted").when(kind == "purchase", "rate  limit")
        .otherwise(F.concat(F.lit("code "), F.col("event_id").cast("string")))
    )
    message = F.concat_ws(" ", opening, "props")
    return t.events.select(
        "event_id", X.is_rate_limited(message).alias("rate_limited"), X.truncated(message, 12).alias("message"))


@query("strip_texts", f"""
SELECT doc_id, md5(trim(text, {SQL_STRIP})) AS text_md5 FROM documents""")
def strip_texts(t):
    padded = F.concat(F.lit("\n\t\xa0\u001c  "), "text", F.lit("\u3000 \r\n"))
    return t.documents.select("doc_id", F.md5(X.strip(padded)).alias("text_md5"))


# Stand-ins for real extractors: fixed rules on the page numbers decide what fails and how. They answer at once, so a
# task may take many pieces.
AT_ONCE = 200

def _first_extractor(pages, refs, prompt, budget):
    if len(pages) > 8:
        raise TimeoutError
    if pages[0] % 3 == 0:
        raise RuntimeError("429 slow down")
    return "\n\n".join(f"## Slide {p}\n\n{r}" for p, r in zip(pages, refs))


def _second_extractor(pages, refs, prompt, budget):
    if pages[0] % 5 == 0:
        raise ValueError("unreadable page " + str(pages[0]))
    return "second\n" + "\n".join(refs)


@query("apply_with_fallback", with_sql(REMAINING_LARGE, chunks_sql("todo"), f"""pieces(deck, chunk, path, pages, depth) AS (
  SELECT deck, chunk, '', pages, 0 FROM chunks UNION ALL
  SELECT deck, chunk, path || side, CASE WHEN side = 'L' THEN pages[1:len(pages) // 2] ELSE pages[len(pages) // 2 + 1:] END,
         depth + 1
  FROM pieces, (VALUES ('L'), ('R')) s(side) WHERE depth < 3 AND len(pages) > 8)""", body=f"""
, settled AS (
  SELECT deck, chunk, path, CASE WHEN pages[1] % 3 <> 0 THEN 'first' WHEN pages[1] % 5 <> 0 THEN 'second' END AS extractor,
         CASE WHEN pages[1] % 3 <> 0 THEN
              array_to_string([('## Slide ' || x || chr(10) || chr(10) || 'image ' || x) FOR x IN pages], chr(10) || chr(10))
              ELSE 'second' || chr(10) || array_to_string([('image ' || x) FOR x IN pages], chr(10)) END AS text,
         'unreadable page ' || pages[1] AS error
  FROM pieces WHERE len(pages) <= 8)
SELECT deck, chunk, CASE WHEN count(*) = count(extractor) THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN count(*) = count(extractor) THEN string_agg(text, chr(10) || chr(10) ORDER BY path) END AS raw_text,
       CASE WHEN count(*) = count(extractor) THEN CASE WHEN count(DISTINCT extractor) = 1 THEN min(extractor)
            ELSE arg_min(extractor, path) || ',' || CASE arg_min(extractor, path) WHEN 'first' THEN 'second' ELSE 'first' END
            END END AS extractor,
       arg_min(error, path) FILTER (extractor IS NULL) AS error, CAST(count(*) AS INTEGER) AS pieces
FROM settled GROUP BY deck, chunk"""))
def apply_with_fallback(t):
    chunks = V.large_chunks(t).withColumn(
        "refs", F.transform("pages", lambda p: F.concat(F.lit("image "), p.cast("string"))))
    return A.apply_with_fallback(
        chunks, [A.Extractor("first", _first_extractor), A.Extractor("second", _second_extractor, retry="any")], pieces_per_task=AT_ONCE)


def _budget_extractor(pages, refs, prompt, budget):
    """Stand-in that says what it was given: the time, and the pages that the prompt asks for."""
    if len(pages) > 8:
        raise TimeoutError
    return f"{budget}: " + re.search(r"sections for slides: ([0-9, ]*)\.", prompt).group(1)


@query("extraction_budgets", with_sql(REMAINING_LARGE, chunks_sql("todo"), """pieces(deck, chunk, path, pages, depth) AS (
  SELECT deck, chunk, '', pages, 0 FROM chunks UNION ALL
  SELECT deck, chunk, path || side, CASE WHEN side = 'L' THEN pages[1:len(pages) // 2] ELSE pages[len(pages) // 2 + 1:] END,
         depth + 1
  FROM pieces, (VALUES ('L'), ('R')) s(side) WHERE depth < 3 AND len(pages) > 8)""", body="""
SELECT deck, chunk, string_agg(greatest(180, least(900, 30 * len(pages))) || ': ' || array_to_string(pages, ', '),
                               chr(10) || chr(10) ORDER BY path) AS raw_text
FROM pieces WHERE len(pages) <= 8 GROUP BY deck, chunk"""))
def extraction_budgets(t):
    chunks = V.large_chunks(t).withColumn("refs", F.transform("pages", lambda p: F.concat(F.lit("image "), p.cast("string"))))
    tried = A.apply_with_fallback(chunks, [A.Extractor("only", _budget_extractor, prompt="listed")], pieces_per_task=AT_ONCE)
    return tried.select("deck", "chunk", "raw_text")


def _check_word(row):
    """Fails on a text without a capital O, otherwise says where the first one is."""
    return f"{row['lang']}:{row['text'].index('O')}"


@query("apply_isolated", """
SELECT doc_id AS item, CASE WHEN contains(text, 'O') THEN 'converted' ELSE 'failed' END AS status,
       CASE WHEN contains(text, 'O') THEN lang || ':' || (instr(text, 'O') - 1) END AS output,
       CASE WHEN NOT contains(text, 'O') THEN 'substring not found' END AS error FROM documents""")
def apply_isolated(t):
    return A.apply_isolated(t.documents.select(F.col("doc_id").alias("item"), "lang", "text"), _check_word)


# --- files ------------------------------------------------------------------------------------

@query("discover_files", """
SELECT DISTINCT source || '/' || lang AS folder, CAST(1 AS BIGINT) AS files FROM documents""")
def discover_files(t):
    """Files that the query writes, one per source and language, found by a suffix in another case."""
    root = scratch_path(t._spark, "found-files")
    folders = t.documents.groupBy("source", "lang").agg(F.count("*").alias("texts"))
    folders.repartition("source", "lang").write.partitionBy("source", "lang").parquet(root)
    found = S.discover_files(t._spark, root, [".PARQUET"])
    folder = F.regexp_replace(F.regexp_extract("path", "/(source=[^/]*/lang=[^/]*)/[^/]*$", 1), "source=|lang=", "")
    return found.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"))


@query("size_kb", """
SELECT round(sum(strlen(text) + 1) / 1024, 1) AS size_kb FROM documents""")
def size_kb(t):
    root = scratch_path(t._spark, "sized-files")
    t.documents.select("text").write.text(root)
    return C.size_kb(S.discover_files(t._spark, root, [".txt"]))
