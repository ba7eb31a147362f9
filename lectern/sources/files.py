"""File listings and the written form of slides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions import paths as P
from lectern.session import path_exists

SLIDE_BUCKETS = 64


def _any_case(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def discover_files(spark: SparkSession, root: str, exts: Sequence[str] = V.DECK_EXTENSIONS) -> DataFrame:
    """Files below ``root`` with one of the suffixes in any case: path, length, modified, sorted.

    The suffixes are a listing pattern and the content column is never asked for, so no file is opened.
    """
    glob = "*{" + ",".join(_any_case(e) for e in exts) + "}"
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
        .orderBy("path")
    )


def existing_slides(files: DataFrame) -> DataFrame:
    """(deck, page) of the slide files in a listing with deck and name; other names are ignored."""
    return (
        files.select("deck", P.slide_number(F.col("name")).alias("page"))
        .filter(F.col("page").isNotNull()).distinct()
    )


def render_slides(slides: DataFrame) -> DataFrame:
    """File name, text and Markdown of each slide, made when slides are read; only the texts are stored."""
    return slides.select(
        "deck", "slide_no", P.slide_file(F.col("slide_no")).alias("file_name"), "text",
        P.slide_markdown(F.col("slide_no"), F.col("text")).alias("markdown"),
    )


def write_slides(slides: DataFrame, path: str, mode: str = "append") -> None:
    """Write slides (deck, slide_no, text) in deck buckets. Rebalancing splits a bucket that holds a very long deck."""
    (
        slides.select("deck", "slide_no", "text")
        .withColumn("bucket", F.pmod(F.hash("deck"), F.lit(SLIDE_BUCKETS)))
        .hint("rebalance", "bucket")
        .write.mode(mode).partitionBy("bucket").parquet(path)
    )


def read_slides(spark: SparkSession, path: str) -> DataFrame:
    return render_slides(spark.read.parquet(path))


def has_slides(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written to ``path``."""
    return path_exists(spark, path)


def written_pages(spark: SparkSession, path: str) -> DataFrame:
    """(deck, page) of written slides; reads the two key columns only."""
    return spark.read.parquet(path).select("deck", F.col("slide_no").alias("page")).distinct()
