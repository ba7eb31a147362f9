"""Many substring lookups in one job, without comparing every topic with every pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.text import fold, match_pattern
from lectern.operators.content import Instant, live
from lectern.operators.numbering import in_first
from lectern.session import stage

GRAM = 3


def _grams(text: str, width: int) -> str:
    """SQL for all substrings of ``width`` characters; a shorter text has none."""
    starts = f"sequence(1, greatest(length({text}) - {width - 1}, 1))"
    return f"filter(transform({starts}, i -> substring({text}, i, {width})), g -> length(g) = {width})"


def all_grams(text: str) -> str:
    """SQL for all grams of a text up to the widest, each once."""
    return f"array_distinct(concat({', '.join(_grams(text, w) for w in range(1, GRAM + 1))}))"


def pattern_grams(pattern: str) -> str:
    """SQL for the grams that every match must hold: those of the widest width found in a literal run; none for a
    pattern of wildcards."""
    runs = f"split({pattern}, '[%_]')"
    longest = f"array_max(transform({runs}, r -> length(r)))"
    cases = " ".join(
        f"WHEN {longest} >= {w} THEN array_distinct(flatten(transform({runs}, r -> {_grams('r', w)})))"
        for w in range(GRAM, 0, -1)
    )
    return f"CASE {cases} END"


def lookup_many(content: DataFrame, queries: DataFrame, as_of: Instant, k: int = V.LATEST_ENTRIES) -> DataFrame:
    """For each query text the newest ``k`` live entries whose topic contains it, or one row with
    ``hit`` false.

    Only the newest ``k`` rows of a topic can be among a query's newest ``k``, so each topic is cut
    down first, by its keys alone. Distinct topics and distinct patterns then meet on the pattern's rarest
    n-gram, and the LIKE test runs on those candidates. A pattern that is a gram itself is answered from the gram's
    newest ``k`` rows, and one of wildcards only, which asks for a least length, from those of each topic length; so
    neither meets every topic that it matches. The other columns are fetched last.
    """
    newest = [F.col("fetched_at").desc(), F.col("entry_id").desc()]
    keys = live(content, as_of).select("topic", "fetched_at", "entry_id")
    heads = stage(in_first(keys, ["topic"], newest, k, "_place").drop("_place"), "topic-heads")
    topics = heads.select("topic").distinct().withColumn("_folded", fold(F.col("topic")))
    topic_grams = topics.select(
        "topic", "_folded",
        F.explode(F.expr(all_grams("_folded"))).alias("_gram"),
    )
    patterns = queries.select("query").distinct().select(
        "query",
        F.regexp_replace(fold(F.col("query")), "%+", "%").alias("_text"),
    )
    distinct = patterns.select("_text").distinct()
    is_gram = (F.length("_text").between(1, GRAM)) & ~F.col("_text").rlike("[%_]")
    frequency = topic_grams.groupBy("_gram").agg(F.count("*").alias("_topics"))
    rarest = (
        distinct.filter(~is_gram).select("_text", F.explode(F.expr(pattern_grams("_text"))).alias("_gram"))
        .join(frequency, "_gram")
        .groupBy("_text").agg(F.min_by("_gram", F.struct("_topics", "_gram")).alias("_gram"))
    )
    pairs = (
        topic_grams.join(rarest, "_gram")
        .filter(F.like(F.col("_folded"), match_pattern(F.col("_text"))))
        .select("_text", "topic")
    )
    found = pairs.join(heads, "topic").select("_text", "fetched_at", "entry_id").unionByName(
        _by_length(distinct, heads, newest, k)).unionByName(_by_gram(distinct.filter(is_gram), heads, newest, k))
    best = in_first(found, ["_text"], newest, k, "place").select("_text", "place", "entry_id")
    entries = content.join(best.select("entry_id").distinct(), "entry_id", "left_semi").select(*content.columns)
    answered = patterns.join(best.join(entries, "entry_id"), "_text", "left").drop("_text")
    return queries.join(answered, "query", "left").withColumn("hit", F.col("entry_id").isNotNull())


def _by_gram(grams: DataFrame, heads: DataFrame, newest: list[Column], k: int) -> DataFrame:
    """Newest rows for the patterns that are grams: (_text, fetched_at, entry_id). Each map task keeps at most ``k`` rows
    of a gram."""
    held = heads.select("fetched_at", "entry_id", fold(F.col("topic")).alias("_folded")).select(
        "fetched_at", "entry_id", F.explode(F.expr(all_grams("_folded"))).alias("_gram"))
    postings = in_first(held, ["_gram"], newest, k, "_place")
    return grams.join(postings, F.col("_text") == F.col("_gram")).select("_text", "fetched_at", "entry_id")


def _by_length(distinct: DataFrame, heads: DataFrame, newest: list[Column], k: int) -> DataFrame:
    """Newest rows for the patterns of wildcards: (_text, fetched_at, entry_id)."""
    wild = distinct.filter(F.regexp_replace("_text", "[%_]", "") == "").select(
        "_text", F.length(F.regexp_replace("_text", "%", "")).alias("_least"))
    per_length = in_first(heads.withColumn("_length", F.length("topic")), ["_length"], newest, k, "_place")
    reached = per_length.select("fetched_at", "entry_id", F.explode(F.sequence(F.lit(0), F.col("_length"))).alias("_least"))
    top = in_first(reached, ["_least"], newest, k, "_place").drop("_place")
    return wild.join(top, "_least").select("_text", "fetched_at", "entry_id")
