"""Queries over syllabus, quizzes, courses and prerequisites."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern import fixed_values as K
from lectern.functions import curriculum as G
from lectern.operators import curriculum as U
from lectern.operators import quiz as Q
from lectern.operators import relevance as R
from lectern.operators.numbering import positions
from lectern.operators.prerequisites import prerequisite_levels
from lectern.plans import views as V
from lectern.plans.registry import query
from lectern.plans.store_queries import LIVE
from lectern.plans.views import AS_OF, CONTENT, PROBLEMS, SECTION_TOTALS, SLIDES, SYLLABUS, TAGGED, with_sql
from lectern.session import scratch_path
from lectern.sources import guide

TIER_RANK = "list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'], tier)"


# --- syllabus ---------------------------------------------------------------------------------

def _guide_lines(t):
    """A topic guide in Markdown, one file per subject, written out of the syllabus."""
    rows = V.syllabus(t)
    heads = V.section_totals(t)
    marks = {name: mark for mark, name in K.TIERS.items()}
    mark = F.lit("")
    for name, sign in marks.items():
        mark = F.when(F.col("tier") == name, F.lit(sign)).otherwise(mark)
    row = F.concat_ws(
        " | ", F.lit("|"), "topic", F.concat(F.lit("~"), F.col("weight_pct").cast("string"), F.lit("%")), "advanced",
        mark, "notes", F.lit("|"))
    row = F.regexp_replace(F.regexp_replace(row, r"^\| \| ", "| "), r" \| \|$", " |")
    title = F.concat(
        F.lit("### "), "section", F.lit(" (Total: ~"), F.col("lo_pct").cast("string"), F.lit("–"),
        F.col("hi_pct").cast("string"), F.lit("% of Mains, ~25% of Advanced)"))
    opening = heads.select("subject", "section", F.posexplode(F.array(
        title, F.lit(""), F.lit("| Topic | Mains Weightage | Advanced | Priority | Notes |"),
        F.lit("|---|---|---|---|---|"), F.lit("| not | a | topic |"))).alias("i", "line"))
    number = F.regexp_extract("topic", r"(\d+)", 1).cast("long")
    body = rows.select("subject", "section", (number + 5).alias("i"), row.alias("line"))
    top = rows.select("subject").distinct().select(
        "subject", F.lit("").alias("section"), F.posexplode(F.array(
            F.lit("# Guide"), F.concat(F.lit("## "), F.upper("subject")))).alias("i", "line"))
    placed = top.unionByName(opening).unionByName(body)
    # Line numbers only have to rise within a file: section number, then row.
    section_no = F.coalesce(F.regexp_extract("section", r"(\d+)$", 1).try_cast("long"), F.lit(0))
    return placed.select(
        F.col("subject").alias("file"), (section_no * 100_000_000 + F.col("i")).alias("pos"), "line")


def _guide_files(lines):
    """The lines (file, pos, line) as text files, each written by one task."""
    folder = scratch_path(lines.sparkSession, "guide")
    in_order = lines.repartition("file").sortWithinPartitions("file", "pos")
    in_order.select("file", F.col("line").alias("value")).write.partitionBy("file").text(folder)
    return f"{folder}/*"


@query("load_guide_topics", with_sql(SYLLABUS, body="""
SELECT left(subject, 1) || lower(substr(subject, 2)) AS subject, section, topic, weight_pct, advanced, tier, notes
FROM syllabus"""))
def load_guide_topics(t):
    return guide.load_syllabus(t._spark, _guide_files(_guide_lines(t)))


@query("load_guide_totals", with_sql(SYLLABUS, SECTION_TOTALS, body="""
SELECT left(subject, 1) || lower(substr(subject, 2)) AS subject, section, lo_pct, hi_pct FROM section_totals"""))
def load_guide_totals(t):
    return guide.load_section_totals(t._spark, _guide_files(_guide_lines(t)))


@query("load_guide_order", """
SELECT CAST(n_nationkey % 4 + 1 AS INTEGER) AS phase, c_mktsegment AS subject, i AS pos,
       [c_name, 'Part (' || n_name || ' → ' || c_custkey || ')', n_name][i] AS label
FROM customer JOIN nation ON n_nationkey = c_nationkey, (SELECT unnest([1, 2, 3]) AS i)""")
def load_guide_order(t):
    """Files of a thousand customers of a market segment, with four lines per customer, one of them a list with a
    sub-list."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    listed = F.concat(
        F.lit("**"), "c_mktsegment", F.lit(":** "), "c_name", F.lit(" → Part ("), "n_name", F.lit(" → "), key,
        F.lit(") → "), "n_name")
    phase = F.concat(F.lit("### Phase "), (F.col("n_nationkey") % 4 + 1).cast("string"), F.lit(" — part"))
    lines = rows.select("c_mktsegment", "c_custkey", F.posexplode(F.array(F.lit("## Order"), phase, listed, F.lit(""))).alias("i", "line"))
    name = F.concat_ws("-", F.lower("c_mktsegment"), F.expr("c_custkey div 1000").cast("string"))
    return guide.load_study_order(t._spark, _guide_files(lines.select(
        name.alias("file"), (F.col("c_custkey") * 4 + F.col("i")).alias("pos"), "line")))


@query("arrow_lists", """
SELECT p_partkey, i - 1 AS pos, [p_name, p_type || ' (' || p_brand || ' → ' || p_size || ' → x)', p_brand][i] AS label
FROM part, (SELECT unnest([1, 2, 3]) AS i)""")
def arrow_lists(t):
    text = F.concat(
        "p_name", F.lit(" → "), "p_type", F.lit(" ("), "p_brand", F.lit(" → "), F.col("p_size").cast("string"),
        F.lit(" → x) → "), "p_brand")
    return t.part.select("p_partkey", F.posexplode(G.arrow_items(text)).alias("pos", "label"))


@query("weights_and_tiers", """
SELECT p_partkey, p_size AS weight_pct, p_size AS lo_pct, CASE WHEN p_size % 2 = 0 THEN p_size + 4 ELSE p_size END AS hi_pct,
       ['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', NULL][p_size % 5 + 1] AS tier,
       [1, 2, 3, 4, 5][p_size % 5 + 1] AS tier_rank FROM part""")
def weights_and_tiers(t):
    size = F.col("p_size")
    digits = size.cast("string")
    span = F.when(size % 2 == 0, F.concat(digits, F.lit("–"), (size + 4).cast("string"))).otherwise(digits)
    heading = F.concat(F.lit("Part (Total: ~"), span, F.lit("% of Mains, ~"), digits, F.lit("–99% of Advanced)"))
    cell = F.element_at(F.array(*[F.lit(m + " ") for m in K.TIERS], F.lit("none")), size % 5 + 1)
    named = t.part.select(
        "p_partkey", G.weight(F.concat(F.lit("~"), digits, F.lit("%"))).alias("weight_pct"),
        G.weight_range(heading).alias("r"), G.tier(cell).alias("tier"))
    return named.select("p_partkey", "weight_pct", "r.*", "tier", G.tier_rank(F.col("tier")).alias("tier_rank"))


@query("topic_importance", with_sql(SYLLABUS, body="""
SELECT l_orderkey, l_linenumber, 'topic ' || l_orderkey AS topic, subject, weight_pct, advanced, tier,
       coalesce(tier = 'LOW', false) AS low_yield
FROM lineitem LEFT JOIN syllabus ON topic = 'topic ' || l_orderkey"""))
def topic_importance(t):
    asked = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("topic "), F.col("l_orderkey").cast("string")).alias("topic"))
    return U.with_importance(asked, V.syllabus(t))


@query("check_sections", with_sql(SYLLABUS, SECTION_TOTALS, body="""
SELECT t.subject, t.section, lo_pct, hi_pct, CAST(s AS BIGINT) AS total_pct, s BETWEEN lo_pct AND hi_pct AS within
FROM section_totals t JOIN (SELECT subject, section, sum(weight_pct) AS s FROM syllabus GROUP BY ALL) x
  ON x.subject = t.subject AND x.section = t.section"""))
def check_sections(t):
    return U.check_sections(V.syllabus(t), V.section_totals(t))


@query("problem_shortfall", with_sql(PROBLEMS, body=f"""
SELECT topic, subject, available, 5 - available AS to_fetch
FROM (SELECT topic, subject, count(*) FILTER ({LIVE}) AS available FROM problems GROUP BY topic, subject)
WHERE available < 5"""))
def problem_shortfall(t):
    bank = V.problems(t)
    return U.problem_shortfall(bank, bank, AS_OF, keys=("topic", "subject"))


@query("top_topics", with_sql(SYLLABUS, body="""
SELECT subject, topic, weight_pct, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY subject ORDER BY weight_pct DESC, topic) AS pos FROM syllabus) WHERE pos <= 3"""))
def top_topics(t):
    return U.top_topics(V.syllabus(t)).select("subject", "topic", "weight_pct", "pos")


@query("study_order", with_sql(SYLLABUS, body=f"""
SELECT subject, topic, tier, row_number() OVER (PARTITION BY subject ORDER BY {TIER_RANK}, weight_pct DESC, topic) AS pos
FROM syllabus"""))
def study_order(t):
    return U.study_order(V.syllabus(t)).select("subject", "topic", "tier", "pos")


LISTED = """listed AS (
  SELECT subject, topic, topic AS label, tier, weight_pct,
         CASE WHEN CAST(substr(topic, 7) AS BIGINT) % 5 = 0 THEN CAST(substr(topic, 7) AS BIGINT) % 3 + 1 END AS phase,
         CASE WHEN CAST(substr(topic, 7) AS BIGINT) % 5 = 0 THEN -CAST(substr(topic, 7) AS BIGINT) END AS phase_pos
  FROM syllabus)"""


@query("study_order_listed", with_sql(SYLLABUS, LISTED, body=f"""
SELECT subject, topic, tier, phase, row_number() OVER (
         PARTITION BY subject ORDER BY phase NULLS LAST, phase_pos, {TIER_RANK}, weight_pct DESC, topic) AS pos
FROM listed"""))
def study_order_listed(t):
    """Every fifth topic stands in a phase list, under a short subject name and a short label."""
    topics = V.syllabus(t)
    number = F.expr("CAST(substr(topic, 7) AS BIGINT)")
    lists = topics.filter(number % 5 == 0).select(
        (number % 3 + 1).alias("phase"), F.md5("subject").alias("subject"), (-number).alias("pos"), F.md5("topic").alias("label"))
    aliases = topics.select("subject", F.md5("topic").alias("label"), "topic")
    subjects = topics.select(F.md5("subject").alias("listed"), "subject").distinct()
    return U.study_order(topics, U.named_order(lists, aliases, subjects)).select("subject", "topic", "tier", "phase", "pos")


@query("revision_block", with_sql(SYLLABUS, body="""
SELECT 5 AS block_no, 'Week 13-14' AS block, subject, count(*) FILTER (tier IN ('CRITICAL', 'HIGH')) AS topics
FROM syllabus GROUP BY subject"""))
def revision_block(t):
    return U.revision_block(V.syllabus(t))


def _roadmap_sql(order: str, blocks: list[str]) -> str:
    return with_sql(SYLLABUS, body=f"""
SELECT CAST({TIER_RANK} AS INTEGER) AS block_no, {blocks}[{TIER_RANK}] AS block, subject,
       row_number() OVER (PARTITION BY tier, subject ORDER BY {order}) AS pos, topic, tier, weight_pct, advanced
FROM syllabus""")


@query("roadmap_mains", _roadmap_sql(
    "weight_pct DESC, topic", ["Week 1-4", "Week 5-8", "Week 9-12", "If time allows"]))
def roadmap_mains(t):
    return U.roadmap(V.syllabus(t), "mains", 3.5)


@query("roadmap_both", _roadmap_sql(
    "list_position(['Very High', 'High', 'Medium', 'Low'], advanced), weight_pct DESC, topic",
    ["Week 1-7", "Week 8-14", "Week 15-21", "If time allows"]))
def roadmap_both(t):
    return U.roadmap(V.syllabus(t), "both", 6)


HOSTED = r"""hosted AS (
  SELECT page_id AS entry_id, url, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS topic,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]+)', 1) AS host FROM pages)"""


def _page_entries(t):
    return t.pages.select(
        F.col("page_id").alias("entry_id"), "url",
        F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1).alias("topic"),
        F.lit(V.DAY_ZERO).cast("timestamp_ntz").alias("fetched_at"))


@query("best_source", with_sql(HOSTED, body="""
SELECT topic, host, source_rank, entry_id FROM (
  SELECT *, CASE WHEN host LIKE '%.org' THEN 1 WHEN host LIKE '%.com' THEN 2 ELSE 2147483647 END AS source_rank,
         row_number() OVER (PARTITION BY topic ORDER BY CASE WHEN host LIKE '%.org' THEN 1 WHEN host LIKE '%.com' THEN 2
           ELSE 2147483647 END, entry_id DESC) AS n FROM hosted) WHERE n = 1"""))
def best_source(t):
    entries = _page_entries(t)
    host = U.url_host(F.col("url"))
    rank = F.when(F.col("host").endswith(".org"), 1).when(F.col("host").endswith(".com"), 2)
    ranks = entries.select(host.alias("host")).distinct().select("host", rank.alias("rank")).filter("rank IS NOT NULL")
    return U.best_source(entries, ranks).select("topic", "host", "source_rank", "entry_id")


_SEARCHES = ", ".join("'" + text + "'" for text in K.SEARCH_TEMPLATES)


@query("search_queries", with_sql(PROBLEMS, body=f"""
SELECT topic, i - 1 AS template_no, replace([{_SEARCHES}][i], '{{topic}}', topic) AS search_text
FROM (SELECT DISTINCT topic FROM problems), (SELECT unnest([1, 2, 3]) AS i)"""))
def search_queries(t):
    return U.search_queries(V.problems(t).select("topic").distinct())


_PROBLEM_SEARCHES = ", ".join("'" + s.replace("'", "''") + "'" for s in K.PROBLEM_SEARCH_TEMPLATES)


@query("problem_search_queries", with_sql(PROBLEMS, body=f"""
SELECT topic, i - 1 AS template_no, replace([{_PROBLEM_SEARCHES}][i], '{{topic}}', topic) AS search_text
FROM (SELECT DISTINCT topic FROM problems), (SELECT unnest([1, 2]) AS i)"""))
def problem_search_queries(t):
    return U.search_queries(V.problems(t).select("topic").distinct(), K.PROBLEM_SEARCH_TEMPLATES)


# --- quizzes ----------------------------------------------------------------------------------

@query("checkpoints", """
WITH concepts AS (
  SELECT o_custkey AS deck, o_orderkey AS slide_no, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT deck, slide_no, CAST((pos - 1) // 3 + 1 - CASE WHEN n % 3 = 1 AND n > 1 AND pos = n THEN 1 ELSE 0 END AS INTEGER)
       AS checkpoint FROM concepts""")
def checkpoints(t):
    return Q.checkpoints(t.orders.select(F.col("o_custkey").alias("deck"), F.col("o_orderkey").alias("slide_no")))


@query("answer_slots", with_sql(PROBLEMS, body="""
SELECT topic AS quiz, problem_id AS question, question_no,
       ['A', 'B', 'C', 'D'][CAST((instr('0123456789abcdef', left(md5(topic), 1)) - 1 + question_no - 1) % 4 AS INTEGER) + 1]
       AS answer_slot
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY problem_id) AS question_no FROM problems)"""))
def answer_slots(t):
    return Q.assign_slots(V.problems(t).select(F.col("topic").alias("quiz"), F.col("problem_id").alias("question")))


def _quiz_table_sql() -> str:
    nth = [1, 1, 1, 2, 2]
    rows = [f"({i}, '{d}', '{label}', {n})" for i, ((d, label), n) in enumerate(zip(K.QUIZ_SLOTS, nth), start=1)]
    return "(VALUES " + ", ".join(rows) + ") s(slot, difficulty, label, nth)"


@query("assemble_quiz", with_sql(PROBLEMS, body=f"""
, bank AS (SELECT subject || ' ' || topic AS topic, difficulty, problem_id FROM problems WHERE {LIVE}),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY topic, difficulty ORDER BY md5('3:' || problem_id), problem_id) AS nth FROM bank)
SELECT b.topic, s.slot, s.difficulty, s.label, d.problem_id, d.problem_id IS NULL AS short
FROM (SELECT DISTINCT topic FROM bank) b CROSS JOIN {_quiz_table_sql()}
LEFT JOIN drawn d ON d.topic = b.topic AND d.difficulty = s.difficulty AND d.nth = s.nth"""))
def assemble_quiz(t):
    bank = V.problems(t).withColumn("topic", F.concat_ws(" ", "subject", "topic"))
    return Q.assemble_quiz(bank, AS_OF, seed=3)


_ANSWERS = """answers AS (
  SELECT 'toxic ' || toxic AS quiz, l.doc_id AS question, quality AS answer,
         CASE WHEN list_has_any(words, ['anat', 'ones', 'oure', 'anth', 'ener']) THEN 1
              WHEN list_has_any(words, ['annt', 'enst', 'reed', 'reor', 'reat', 'anor']) THEN 0 END AS given
  FROM labels l LEFT JOIN (SELECT doc_id, string_split_regex(lower(text), '[^a-z]+') AS words FROM documents) d
    ON d.doc_id = l.doc_id)"""


def _graded(t):
    """Labels as the key; the relevance verdict of a document as the answer, none where no term occurs."""
    key = t.labels.select(
        F.concat(F.lit("toxic "), F.col("toxic").cast("string")).alias("quiz"), F.col("doc_id").alias("question"),
        F.col("quality").alias("answer"))
    tagged = R.tag_relevance(t.documents.select(F.col("doc_id").alias("question"), "text"), V.INCLUDE, V.SKIP)
    verdicts = tagged.filter(F.col("reason") != "default").select(
        "question", (F.col("verdict") == "include").cast("int").alias("given"))
    responses = key.select("quiz", "question").join(verdicts, "question").select("quiz", "question", "given")
    return Q.grade(responses, key)


@query("grade_answers", with_sql(_ANSWERS, body="""
SELECT quiz, question, answer, given, coalesce(answer = given, false) AS correct FROM answers"""))
def grade_answers(t):
    return _graded(t)


@query("quiz_scores", with_sql(_ANSWERS, body="""
SELECT quiz, count(*) AS questions, count(given) AS answered, count(*) FILTER (answer = given) AS correct
FROM answers GROUP BY quiz"""))
def quiz_scores(t):
    return Q.quiz_scores(_graded(t))


@query("diagnose_topics", with_sql(PROBLEMS, body=f"""
, drawn AS (
  SELECT topic, problem_id, row_number() OVER (PARTITION BY topic ORDER BY md5('0:' || problem_id), problem_id) AS n
  FROM problems WHERE {LIVE}),
marks AS (
  SELECT l_partkey AS problem_id, count(*) AS tries, count(*) FILTER (l_returnflag = 'N') AS hits
  FROM lineitem GROUP BY l_partkey),
scored AS (
  SELECT topic, count(*) AS asked, CAST(coalesce(sum(tries), 0) AS BIGINT) AS answers,
         CAST(coalesce(sum(hits), 0) AS BIGINT) AS correct,
         coalesce(sum(hits)::DOUBLE / sum(tries)::DOUBLE, 0.0) AS score
  FROM drawn LEFT JOIN marks USING (problem_id) WHERE n <= 3 GROUP BY topic)
SELECT *, row_number() OVER (ORDER BY score, topic) AS study_place FROM scored"""))
def diagnose_topics(t):
    results = t.lineitem.select(F.col("l_partkey").alias("problem_id"), (F.col("l_returnflag") == "N").alias("correct"))
    return Q.diagnose(V.problems(t), results, AS_OF)


# --- courses ----------------------------------------------------------------------------------

def _tagged(t):
    return R.tag_relevance(V.pages_with_module(t), V.INCLUDE, V.SKIP)


@query("tag_relevance", with_sql(TAGGED, body="SELECT module, deck, slide_no, reason, verdict FROM tagged"))
def tag_relevance(t):
    return _tagged(t).select("module", "deck", "slide_no", "reason", "verdict")


@query("course_map", with_sql(TAGGED, body="""
, modules AS (
  SELECT module, count(DISTINCT deck) AS files, count(*) FILTER (verdict = 'include') AS included,
         count(*) FILTER (verdict = 'skip') AS skipped FROM tagged GROUP BY module)
SELECT *, row_number() OVER (ORDER BY included DESC, module) AS place,
       ['deep', 'medium', 'light'][ntile(3) OVER (ORDER BY included DESC, module)] AS depth FROM modules"""))
def course_map(t):
    return R.course_map(_tagged(t))


@query("module_files", with_sql(TAGGED, body="SELECT DISTINCT module, deck FROM tagged"))
def module_files(t):
    return R.module_files(V.pages_with_module(t))


@query("module_key_topics", with_sql(TAGGED, body=f"""
SELECT module, key_topic, count(*) AS pages FROM (
  SELECT module, unnest(list_intersect(list_distinct(words), {V._list_sql(V.INCLUDE)})) AS key_topic
  FROM tagged WHERE verdict = 'include') GROUP BY module, key_topic"""))
def module_key_topics(t):
    return R.module_key_topics(_tagged(t), V.INCLUDE)


@query("skipped_pages", with_sql(TAGGED, body="""
SELECT module, deck, slide_no, reason FROM tagged WHERE verdict = 'skip'"""))
def skipped_pages(t):
    return R.skipped_pages(_tagged(t))


@query("head_per_deck", with_sql(SLIDES, body="""
SELECT deck, slide_no, md5(text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY deck ORDER BY slide_no) AS n FROM slides) WHERE n <= 5"""))
def head_per_deck(t):
    return R.head_per_deck(V.slides(t)).select("deck", "slide_no", F.md5("text").alias("text_md5"))


@query("first_uses", """
WITH tokens AS (
  SELECT lang AS course, source AS deck, doc_id AS slide_no, unnest(string_split_regex(text, '[^A-Za-z]+')) AS token,
         generate_subscripts(string_split_regex(text, '[^A-Za-z]+'), 1) - 1 AS position FROM documents)
SELECT course, token, f.deck AS deck, f.slide_no AS slide_no, CAST(f.position AS INTEGER) AS position FROM (
  SELECT course, token, min({'deck': deck, 'slide_no': slide_no, 'position': position}) AS f
  FROM tokens WHERE regexp_matches(token, '^[A-Z]{2,}$') AND token NOT IN ('CPU', 'URL', 'PDF') GROUP BY course, token)""")
def first_uses(t):
    return R.first_uses(t.documents.select(
        F.col("lang").alias("course"), F.col("source").alias("deck"), F.col("doc_id").alias("slide_no"), "text"))


@query("uncovered_items", """
SELECT o_custkey AS deck, o_orderkey AS item FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def uncovered_items(t):
    inventory = t.orders.select(F.col("o_custkey").alias("deck"), F.col("o_orderkey").alias("item"))
    return U.uncovered(inventory, t.lineitem.select(F.col("l_orderkey").alias("item")), keys=("item",)).select("deck", "item")


@query("uncovered_counts", """
SELECT o_custkey AS deck, count(*) AS open_items FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_custkey""")
def uncovered_counts(t):
    inventory = t.orders.select(F.col("o_custkey").alias("deck"), F.col("o_orderkey").alias("item"))
    return U.uncovered_counts(inventory, t.lineitem.select(F.col("l_orderkey").alias("item")), keys=("item",))


# --- prerequisites ----------------------------------------------------------------------------

@query("prerequisite_levels", """
WITH RECURSIVE levels(topic, level) AS (
  SELECT p_partkey, 0 FROM part WHERE p_partkey = 0 UNION ALL
  SELECT p_partkey, level + 1 FROM levels JOIN part ON p_partkey // 2 = topic AND p_partkey > 0)
SELECT topic, CAST(level AS INTEGER) AS level, 'ordered' AS status FROM levels""")
def prerequisite_levels_of_parts(t):
    """Part n needs part n // 2; part 0 needs none."""
    return prerequisite_levels(_halving(t))


def _halving(t):
    return t.part.filter("p_partkey > 0").selectExpr("p_partkey div 2 AS prerequisite", "p_partkey AS topic")


@query("prerequisite_cycles", """
WITH RECURSIVE below(topic) AS (
  SELECT CAST(2 AS BIGINT) UNION
  SELECT p_partkey FROM below JOIN part ON p_partkey // 2 = topic AND p_partkey > 0)
SELECT p_partkey AS topic,
       CASE WHEN p_partkey IN (SELECT topic FROM below) THEN NULL WHEN p_partkey = 0 THEN 0
            ELSE CAST(floor(log2(greatest(p_partkey, 1))) AS INTEGER) + 1 END AS level,
       CASE WHEN p_partkey IN (2, 4, 9) THEN 'cycle' WHEN p_partkey IN (SELECT topic FROM below) THEN 'blocked'
            ELSE 'ordered' END AS status
FROM part""")
def prerequisite_cycles(t):
    """The same with part 2 also needing part 9, which closes the loop 2, 4, 9."""
    back = t.part.filter("p_partkey = 2").selectExpr("CAST(9 AS BIGINT) AS prerequisite", "p_partkey AS topic")
    return prerequisite_levels(_halving(t).unionByName(back))


@query("prerequisite_chain", """
SELECT s_suppkey AS topic, CAST(CASE WHEN s_suppkey % 10 = 7 THEN 0 ELSE place END AS INTEGER) AS level, 'ordered' AS status
FROM (SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey % 10 = 7 ORDER BY s_suppkey) - 1 AS place FROM supplier)
UNION ALL
SELECT 1000000000 + c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INTEGER), 'ordered' FROM customer""")
def prerequisite_chain(t):
    """Two chains, as long as the tables, of suppliers and of customers; every tenth supplier needs nothing."""
    suppliers = t.supplier.select(F.col("s_suppkey").alias("topic"))
    linked = suppliers.filter("topic % 10 <> 7")
    customers = t.customer.select((F.col("c_custkey") + 1_000_000_000).alias("topic"))
    chains = linked.unionByName(customers).withColumn("chain", F.col("topic") >= 1_000_000_000)
    placed = positions(chains, ["chain"], ["topic"])
    before = placed.select(F.col("chain").alias("_chain"), (F.col("pos") + 1).alias("_next"), F.col("topic").alias("prerequisite"))
    links = placed.join(before.hint("merge"), (F.col("chain") == F.col("_chain")) & (F.col("pos") == F.col("_next")), "left")
    return prerequisite_levels(links.select("prerequisite", "topic"), suppliers)


@query("prerequisite_ladder", """
SELECT p_partkey AS topic, CAST((p_partkey - (SELECT min(p_partkey) FROM part)) // 2 AS INTEGER) AS level, 'ordered' AS status FROM part""")
def prerequisite_ladder(t):
    """Every pair of parts, by key, needs both parts of the pair before: as many levels as half the parts."""
    parts = t.part.select("p_partkey", (F.col("p_partkey") - t.part.agg(F.min("p_partkey")).scalar()).alias("n"))
    up = parts.select(F.col("p_partkey").alias("prerequisite"), F.explode(F.array(F.col("n") + 2, F.col("n") + 3 - 2 * (F.col("n") % 2))).alias("to"))
    return prerequisite_levels(up.join(parts.hint("merge"), F.col("to") == F.col("n")).select("prerequisite", F.col("p_partkey").alias("topic")))
