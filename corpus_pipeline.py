"""A training-data pipeline over ``documents``: each stage takes what its predecessor kept and calls one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import attention_quality, line_dedup, merge_dropout, simhash_golay, winnow_decontaminate
from lectern.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return attention_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one matches; ``n_chars`` follows the text."""
    return line_dedup.remove_later_lines(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of linked fingerprints."""
    return simhash_golay.keep_one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return winnow_decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every remaining document."""
    return merge_dropout.encode_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", tokens),
]

#: The classifier is trained and the pieces come from a model file, so SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{n}")
    return docs
