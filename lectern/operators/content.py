"""The content and problem store: append, filter, look up, list, count, purge."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.text import or_default, strip, topic_matches
from lectern.operators.numbering import assign_ids

Instant = str | datetime


def instant(df: DataFrame, as_of: Instant, col: str = "expires_at") -> Column:
    """``as_of`` as a literal of the type of the column it is compared with."""
    return F.lit(str(as_of)).cast(df.schema[col].dataType)


def is_live(df: DataFrame, as_of: Instant) -> Column:
    return F.col("expires_at").isNull() | (F.col("expires_at") > instant(df, as_of))


def live(df: DataFrame, as_of: Instant) -> DataFrame:
    """Rows without expiry, or with one after ``as_of``."""
    return df.filter(is_live(df, as_of))


def expired(df: DataFrame, as_of: Instant) -> DataFrame:
    """Rows whose expiry is at or before ``as_of``."""
    return df.filter(F.col("expires_at").isNotNull() & (F.col("expires_at") <= instant(df, as_of)))


def matching(df: DataFrame, text: str) -> DataFrame:
    return df.filter(topic_matches(F.col("topic"), text))


def with_difficulty(df: DataFrame, difficulty: str | None) -> DataFrame:
    """Exact match; no difficulty means no filter."""
    return df.filter(F.col("difficulty") == difficulty) if difficulty else df


# --- append -----------------------------------------------------------------------------------

def _stamped(df: DataFrame, schema_of: DataFrame, as_of: Instant, ttl_days: int, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Set both dates and line the columns up with the table, missing ones as NULL; ``keep`` stays besides."""
    when = F.lit(str(as_of)).cast(schema_of.schema["fetched_at"].dataType)
    dated = df.withColumns({"fetched_at": when, "expires_at": when + F.make_dt_interval(F.lit(ttl_days))})
    return dated.select(*[
        (F.col(f.name) if f.name in dated.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema_of.schema
    ], *[c for c in keep if isinstance(c, str) and c not in schema_of.columns])


def new_content(content: DataFrame, incoming: DataFrame, as_of: Instant, ttl_days: int = V.TTL_DAYS,
                keep: Sequence[str | Column] = ()) -> DataFrame:
    """Incoming rows as they would be stored: body stripped, empty bodies rejected, expiry set."""
    rows = incoming.withColumn("body", strip(F.col("body"))).filter(F.col("body") != "")
    if "source_type" not in rows.columns:
        rows = rows.withColumn("source_type", F.lit(V.DEFAULT_SOURCE_TYPE))
    return _stamped(rows, content, as_of, ttl_days, keep)


def append_content(content: DataFrame, incoming: DataFrame, as_of: Instant, start_id: int,
                   order_cols: Sequence[str | Column] | None = None, ttl_days: int = V.TTL_DAYS) -> DataFrame:
    """Pure append; duplicates are allowed. New rows are numbered from ``start_id`` on in the order of ``order_cols``,
    which need not be columns of the table. ``start_id`` must lie above every id ever issued (the largest one present is
    not enough after a purge); a ``StudyStore`` keeps that mark itself."""
    new = new_content(content, incoming, as_of, ttl_days, order_cols or ())
    return content.unionByName(assign_ids(new, "entry_id", start_id, order_cols).select(*content.columns))


def new_problems(problems: DataFrame, incoming: DataFrame, as_of: Instant, ttl_days: int = V.TTL_DAYS,
                 keep: Sequence[str | Column] = ()) -> DataFrame:
    """Incoming problems as stored: the text is taken as it is."""
    return _stamped(incoming, problems, as_of, ttl_days, keep)


def append_problems(problems: DataFrame, incoming: DataFrame, as_of: Instant, start_id: int,
                    order_cols: Sequence[str | Column] | None = None, ttl_days: int = V.TTL_DAYS) -> DataFrame:
    """As ``append_content``, for problems."""
    new = new_problems(problems, incoming, as_of, ttl_days, order_cols or ())
    return problems.unionByName(assign_ids(new, "problem_id", start_id, order_cols).select(*problems.columns))


# --- look up ----------------------------------------------------------------------------------

def latest(content: DataFrame, text: str, as_of: Instant, k: int = V.LATEST_ENTRIES) -> DataFrame:
    """Newest ``k`` live entries whose topic contains ``text``; no row is a miss."""
    hits = matching(live(content, as_of), text)
    return hits.orderBy(F.col("fetched_at").desc(), F.col("entry_id").desc()).limit(k)


def draw_order(id_col: str, seed: int) -> list[Column]:
    """A reproducible shuffle: the digest of seed and id, then the id."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), F.col(id_col)]


def sample_problems(
    problems: DataFrame, text: str, as_of: Instant, difficulty: str | None = None,
    n: int = V.PROBLEMS_PER_LOOKUP, seed: int = 0,
) -> DataFrame:
    """``n`` live problems of a topic drawn without replacement; a negative ``n`` means all."""
    hits = with_difficulty(matching(live(problems, as_of), text), difficulty)
    drawn = hits.orderBy(*draw_order("problem_id", seed))
    return drawn if n < 0 else drawn.limit(n)


def present_content(df: DataFrame) -> DataFrame:
    """Columns as shown to a reader."""
    return df.select(
        "entry_id", "topic",
        or_default(F.col("subject"), V.MISSING).alias("subject"),
        or_default(F.col("url"), V.MISSING).alias("url"),
        "fetched_at",
        or_default(F.col("expires_at"), V.NEVER).alias("expires"),
        "body",
    )


def present_problems(df: DataFrame) -> DataFrame:
    return df.select(
        "problem_id", "topic",
        or_default(F.col("difficulty"), V.MISSING).alias("difficulty"),
        or_default(F.col("source"), V.MISSING).alias("source"),
        "problem",
        F.nullif(F.col("solution"), F.lit("")).alias("solution"),
    )


# --- list and count ---------------------------------------------------------------------------

def list_topics(content: DataFrame, as_of: Instant) -> DataFrame:
    """Per live topic: entries, last update, and the subject of the newest entry (even if NULL).

    Entries are first counted per (topic, subject) with their newest (date, id) as one number, all by hash; only
    those few rows are then compared as structs.
    """
    at = F.unix_micros(F.col("fetched_at").cast("timestamp")).cast("decimal(18,0)") * F.expr(f"{2**63}BD")
    newest = F.coalesce((at + F.col("entry_id")).cast("decimal(38,0)"), F.expr(f"-{10**37}BD").cast("decimal(38,0)"))
    per_subject = live(content, as_of).groupBy("topic", "subject").agg(
        F.count("*").alias("n"), F.max("fetched_at").alias("last"), F.max(newest).alias("newest"))
    return (
        per_subject.groupBy("topic")
        .agg(
            F.max_by("subject", F.struct("newest")).alias("subject"),
            F.sum("n").alias("entries"),
            F.max("last").alias("last_updated"),
        )
        .select("topic", "subject", "entries", "last_updated")
        .orderBy(F.col("subject").asc_nulls_first(), "topic")
    )


def list_problem_topics(problems: DataFrame, as_of: Instant) -> DataFrame:
    per_subject = live(problems, as_of).groupBy("topic", "subject").agg(F.count("*").alias("n"))
    return (
        per_subject.groupBy("topic")
        .agg(F.min("subject").alias("subject"), F.sum("n").alias("problems"))
        .orderBy("topic")
    )


def present_topics(topics: DataFrame) -> DataFrame:
    """A topic list as shown to a reader; a topic without a subject has a question mark."""
    return topics.withColumn("subject", or_default(F.col("subject"), V.UNKNOWN_SUBJECT))


def store_stats(content: DataFrame, problems: DataFrame, as_of: Instant) -> DataFrame:
    """All entries, live entries, live problems: one row, one pass over each expiry column."""
    entries = content.select(F.lit(1).alias("entry"), is_live(content, as_of).alias("live"))
    bank = problems.select(F.lit(0).alias("entry"), is_live(problems, as_of).alias("live"))
    return entries.unionByName(bank).agg(
        F.count_if(F.col("entry") == 1).alias("total_entries"),
        F.count_if((F.col("entry") == 1) & F.col("live")).alias("active_entries"),
        F.count_if((F.col("entry") == 0) & F.col("live")).alias("active_problems"),
    )


def size_kb(files: DataFrame) -> DataFrame:
    """Stored size from a file listing."""
    return files.agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1024, 1).alias("size_kb"))


# --- remove -----------------------------------------------------------------------------------

def without_topic(df: DataFrame, text: str) -> DataFrame:
    """What a purge leaves: every row whose topic does not contain ``text``, live or expired."""
    return df.filter(~topic_matches(F.col("topic"), text))


def removal_counts(content: DataFrame, problems: DataFrame, removed) -> DataFrame:
    """Rows per table for which ``removed(df)`` holds."""
    parts = [
        df.select(F.lit(name).alias("table_name"), removed(df).alias("gone"))
        for name, df in (("content", content), ("problems", problems))
    ]
    return parts[0].unionByName(parts[1]).groupBy("table_name").agg(F.count_if("gone").alias("removed"))


def purge_counts(content: DataFrame, problems: DataFrame, text: str) -> DataFrame:
    return removal_counts(content, problems, lambda df: topic_matches(F.col("topic"), text))


def expiry_counts(content: DataFrame, problems: DataFrame, as_of: Instant) -> DataFrame:
    return removal_counts(content, problems, lambda df: ~is_live(df, as_of))


def purge(content: DataFrame, problems: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Surviving content, surviving problems, and the counts removed from each."""
    return without_topic(content, text), without_topic(problems, text), purge_counts(content, problems, text)


def clear_expired(content: DataFrame, problems: DataFrame, as_of: Instant) -> tuple[DataFrame, DataFrame, DataFrame]:
    return live(content, as_of), live(problems, as_of), expiry_counts(content, problems, as_of)
