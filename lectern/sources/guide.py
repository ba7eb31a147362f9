"""Reading a topic guide: Markdown headings and tables to dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lectern.functions.curriculum import arrow_items, tier, weight, weight_range
from lectern.functions.text import strip
from lectern.session import stage

LINES_PER_BLOCK = 4096


def guide_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of one or many guide files, read by as many tasks as they have splits.

    ``pos`` rises with the line's place in its file: a split's offset plus the line's number in it. A line has a byte at
    least, so the numbers of a split end before those of the next begin. They are written once, since they are looked at
    from several sides.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").alias("line"))
    held = stage(read, "guide-lines")
    firsts = held.groupBy("file", "_start").agg(F.min("_row").alias("_first"))
    inner = (F.col("_start") > 0).cast("long")
    return held.join(firsts, ["file", "_start"]).select("file", (F.col("_start") + inner + F.col("_row") - F.col("_first")).alias("pos"), "line")


def _headed(lines: DataFrame) -> DataFrame:
    """Add the subject (``##``) and section (``###``) heading each line stands under.

    A file is worked on in blocks of lines; what a block inherits comes from one row per block.
    """
    clean = F.regexp_replace("line", "\r$", "")
    marked = lines.withColumn("line", clean).withColumns({
        "_block": F.floor(F.col("pos") / LINES_PER_BLOCK),
        "_top": F.when(F.col("line").rlike(r"^##\s"), F.struct("pos", strip(F.substr("line", F.lit(3))).alias("text"))),
        "_sub": F.when(F.col("line").rlike(r"^###\s"), F.struct("pos", strip(F.substr("line", F.lit(4))).alias("text"))),
    })
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = marked.groupBy("file", "_block").agg(
        F.max("_top").alias("_top_last"), F.max("_sub").alias("_sub_last"),
    ).select(
        "file", "_block",
        F.max("_top_last").over(before).alias("_top_from"), F.max("_sub_last").over(before).alias("_sub_from"),
    )
    inside = Window.partitionBy("file", "_block").orderBy("pos")
    local = marked.withColumn("_top", F.last("_top", True).over(inside)).withColumn(
        "_sub", F.last("_sub", True).over(inside))
    both = local.join(inherited, ["file", "_block"]).withColumns({
        "_top": F.coalesce("_top", "_top_from"), "_sub": F.coalesce("_sub", "_sub_from"),
    })
    current = F.col("_sub.pos") > F.col("_top.pos")
    return both.select(
        "file", "pos", "line", F.col("_top.text").alias("subject"),
        F.when(current, F.col("_sub.text")).alias("heading"),
    )


def _section_name(heading):
    return strip(F.regexp_replace(heading, r"\(Total:.*$", ""))


def _title(subject):
    return F.initcap(subject)


def _cell(i: int) -> Column:
    """Cell of a split row, NULL past its end."""
    return F.get("c", F.lit(i))


def parse_syllabus(lines: DataFrame) -> DataFrame:
    """Five-cell table rows below a section heading, without header and separator rows."""
    cells = F.transform(F.split("line", r"\|"), lambda c: strip(c))
    rows = _headed(lines).filter(F.col("line").startswith("|") & F.col("heading").isNotNull()).withColumn("c", cells)
    data = rows.filter(
        (F.size("c") == 7) & ~_cell(1).rlike("^:?-+:?$") & (_cell(1) != "Topic"))
    return data.select(
        "file", _title(F.col("subject")).alias("subject"), _section_name(F.col("heading")).alias("section"),
        _cell(1).alias("topic"), weight(_cell(2)).alias("weight_pct"), _cell(3).alias("advanced"),
        tier(_cell(4)).alias("tier"), _cell(5).alias("notes"),
    )


def parse_section_totals(lines: DataFrame) -> DataFrame:
    """Declared range of each section, from its heading."""
    heads = _headed(lines).filter(F.col("line").rlike(r"^###\s") & F.col("line").contains("(Total:"))
    return heads.select(
        "file", _title(F.col("subject")).alias("subject"), _section_name(F.col("heading")).alias("section"),
        weight_range(F.col("heading")).alias("r"),
    ).select("file", "subject", "section", "r.*")


def parse_study_order(lines: DataFrame) -> DataFrame:
    """(phase, subject, pos, label) from ``**Subject:** A → B`` lines below phase headings."""
    listed = _headed(lines).filter(
        F.col("heading").rlike(r"^Phase\s+\d+") & F.col("line").rlike(r"^\*\*[^*]+:\*\*"))
    return listed.select(
        "file", F.regexp_extract("heading", r"^Phase\s+(\d+)", 1).cast("int").alias("phase"),
        F.regexp_extract("line", r"^\*\*([^*]+):\*\*", 1).alias("subject"),
        F.posexplode(arrow_items(strip(F.regexp_replace("line", r"^\*\*[^*]+:\*\*", "")))).alias("i", "label"),
    ).select("file", "phase", "subject", (F.col("i") + 1).alias("pos"), "label")


def load_syllabus(spark: SparkSession, path: str) -> DataFrame:
    return parse_syllabus(guide_lines(spark, path)).drop("file")


def load_section_totals(spark: SparkSession, path: str) -> DataFrame:
    return parse_section_totals(guide_lines(spark, path)).drop("file")


def load_study_order(spark: SparkSession, path: str) -> DataFrame:
    return parse_study_order(guide_lines(spark, path)).drop("file")
