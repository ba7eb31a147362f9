"""Syllabus work: importance, totals, shortfalls, roadmaps, orders, sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.curriculum import filled, rank_in, tier_rank
from lectern.operators.content import Instant, live
from lectern.operators.numbering import in_first, positions

YIELD_ORDER = ("weight_pct", "topic")


def with_importance(topics: DataFrame, syllabus: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Add subject, weight, advanced level, tier and a low-yield flag; unknown topics keep NULLs.

    Topics are looked up by (subject, topic) if they come with a subject, else by topic; then a topic of several
    subjects takes its place in the one where it weighs most (of equals the first by name), so no row multiplies.
    Left to Catalyst to broadcast: it does so only if the syllabus is known to be small.
    """
    keys = list(keys) if keys else (["subject", "topic"] if "subject" in topics.columns else ["topic"])
    best = [F.col("weight_pct").desc_nulls_last(), F.col("subject").asc(), F.col("advanced").asc(), F.col("tier").asc()]
    looked_up = in_first(syllabus.select("topic", "subject", "weight_pct", "advanced", "tier"), keys, best, 1, "_place").drop("_place")
    return topics.join(looked_up, keys, "left").withColumn("low_yield", F.col("tier").eqNullSafe(F.lit("LOW")))


def check_sections(syllabus: DataFrame, totals: DataFrame) -> DataFrame:
    """Sum of topic weights per section against the declared range."""
    sums = syllabus.groupBy("subject", "section").agg(F.sum("weight_pct").alias("total_pct"))
    return totals.join(sums, ["subject", "section"], "left").withColumn(
        "within", F.coalesce(F.col("total_pct").between(F.col("lo_pct"), F.col("hi_pct")), F.lit(False)))


def problem_shortfall(
    topics: DataFrame, problems: DataFrame, as_of: Instant, want: int = V.WANTED_PROBLEMS,
    keys: Sequence[str] = ("topic",),
) -> DataFrame:
    """Topics with fewer than ``want`` live problems, and how many to fetch."""
    have = live(problems, as_of).groupBy(*keys).agg(F.count("*").alias("available"))
    counted = topics.select(*keys).distinct().join(have, list(keys), "left").withColumn(
        "available", F.coalesce(F.col("available"), F.lit(0)))
    return counted.filter(F.col("available") < want).withColumn("to_fetch", F.lit(want) - F.col("available"))


def top_topics(syllabus: DataFrame, k: int = V.TOP_TOPICS) -> DataFrame:
    """Topics with the highest weight of each subject."""
    return in_first(syllabus, ["subject"], [F.col("weight_pct").desc(), F.col("topic").asc()], k)


def named_order(order: DataFrame, aliases: DataFrame, subjects: DataFrame | None = None) -> DataFrame:
    """A guide's phase lists (phase, subject, pos, label) as topics. Labels are short names, so they are
    looked up in ``aliases`` (subject, label, topic); a label may stand for several topics. Where the lists
    shorten subject names, ``subjects`` (listed, subject) tells what they stand for; others stay as they are."""
    if subjects is not None:
        named = subjects.select(F.col("listed").alias("_listed"), F.col("subject").alias("_subject"))
        order = order.join(named, F.col("subject") == F.col("_listed"), "left").withColumn(
            "subject", F.coalesce("_subject", "subject")).drop("_listed", "_subject")
    return order.join(aliases, ["subject", "label"]).select("subject", "topic", "phase", F.col("pos").alias("phase_pos"))


def study_order(syllabus: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """Place of each topic within its subject: tier, then weight, then name. Topics of an explicit order
    (see ``named_order``) come first, as listed."""
    order = [tier_rank(F.col("tier")).asc(), F.col("weight_pct").desc(), F.col("topic").asc()]
    if explicit is None:
        return positions(syllabus, ["subject"], order)
    first = explicit.groupBy("subject", "topic").agg(F.min(F.struct("phase", "phase_pos")).alias("_listed"))
    listed = syllabus.join(first, ["subject", "topic"], "left")
    ranked = positions(listed, ["subject"], [F.col("_listed").asc_nulls_last(), *order])
    return ranked.withColumn("phase", F.col("_listed.phase")).drop("_listed")


def _block(weeks: int) -> Column:
    length = max(1, (weeks - V.REVISION_WEEKS) // 3)
    bounds = F.lit(None)
    for i, name in enumerate(V.TIER_ORDER[:3]):
        bounds = F.when(F.col("tier") == name, F.lit(f"Week {i * length + 1}-{(i + 1) * length}")).otherwise(bounds)
    return F.when(F.col("tier") == "LOW", "If time allows").otherwise(bounds)


def roadmap(syllabus: DataFrame, exam: str = "mains", months: float = 3.5) -> DataFrame:
    """Topics of each (block, subject) in order, one row per topic.

    ``mains`` orders by weight, ``both`` by advanced level and then weight. The last weeks are for
    revision and hold no topics.
    """
    if exam not in ("mains", "both"):
        raise ValueError("exam is 'mains' or 'both'")
    by_weight = [F.col("weight_pct").desc(), F.col("topic").asc()]
    order = by_weight if exam == "mains" else [rank_in(F.col("advanced"), V.ADVANCED_ORDER).asc(), *by_weight]
    weeks = int(months * V.WEEKS_PER_MONTH)
    planned = syllabus.withColumn("block", _block(weeks)).withColumn("block_no", tier_rank(F.col("tier")))
    return positions(planned, ["block_no", "subject"], order).select(
        "block_no", "block", "subject", "pos", "topic", "tier", "weight_pct", "advanced")


def revision_block(syllabus: DataFrame, months: float = 3.5) -> DataFrame:
    """The last weeks of a roadmap, one row per subject: revision of what the subject's critical and high topics are."""
    weeks = int(months * V.WEEKS_PER_MONTH)
    first = max(1, weeks - V.REVISION_WEEKS + 1)
    important = F.count_if(F.col("tier").isin(V.TIER_ORDER[:2]))
    return syllabus.groupBy("subject").agg(important.alias("topics")).select(
        F.lit(len(V.TIER_ORDER) + 1).alias("block_no"), F.lit(f"Week {first}-{max(first, weeks)}").alias("block"), "subject", "topics")


def ranked_sources(hosts: Sequence[str] = V.SOURCE_ORDER) -> Column:
    """Rank of a ``host`` column in the fixed order; subdomains count, other hosts come last."""
    rank = F.lit(len(hosts) + 1)
    for i, name in reversed(list(enumerate(hosts, start=1))):
        rank = F.when((F.col("host") == name) | F.col("host").endswith("." + name), F.lit(i)).otherwise(rank)
    return rank


def url_host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1)


def best_source(content: DataFrame, source_rank: Column | DataFrame | None = None) -> DataFrame:
    """The entry of each topic from the best-ranked host; then the newest, then the highest id.

    ``source_rank`` is a table (host, rank), a column over ``host``, or the fixed order.
    """
    hosted = content.withColumn("host", url_host(F.col("url")))
    newest = [F.col("fetched_at").desc(), F.col("entry_id").desc()]
    if isinstance(source_rank, DataFrame):
        # One entry per (topic, host) can win, so a busy host is cut down before the join.
        candidates = in_first(hosted, ["topic", "host"], newest, 1, "_place").drop("_place")
        ranks = source_rank.select("host", F.col("rank").cast("int").alias("source_rank"))
        ranked = candidates.join(ranks, "host", "left").withColumn(
            "source_rank", F.coalesce(F.col("source_rank"), F.lit(2**31 - 1)))
    else:
        ranked = hosted.withColumn("source_rank", ranked_sources() if source_rank is None else source_rank)
    return in_first(ranked, ["topic"], [F.col("source_rank").asc(), *newest], 1, "_place").drop("_place")


def search_queries(topics: DataFrame, templates: Sequence[str] = V.SEARCH_TEMPLATES) -> DataFrame:
    """Search texts per topic, in template order."""
    texts = F.array(*[filled(t, topic=F.col("topic")) for t in templates])
    return topics.select("topic", F.posexplode(texts).alias("template_no", "search_text"))


def uncovered(inventory: DataFrame, taught: DataFrame, keys: Sequence[str] = ("deck", "item")) -> DataFrame:
    """Inventory items nothing covers yet."""
    return inventory.join(taught.select(*keys).distinct(), list(keys), "left_anti")


def uncovered_counts(inventory: DataFrame, taught: DataFrame, keys: Sequence[str] = ("deck", "item")) -> DataFrame:
    """Open items per deck; a deck without a row is done."""
    return uncovered(inventory, taught, keys).groupBy("deck").agg(F.count("*").alias("open_items"))
