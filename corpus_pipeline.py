"""A corpus pipeline: each stage takes the documents its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import mixing, pii, quality_bayes, sentencepieces, simhash
from meterline.llm.common import table
from meterline.llm.queries import PIECE_BPE
from meterline.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_bayes.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.representatives(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the spans of personal data replaced."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the decoded text of every row of the mix."""
    encoded = sentencepieces.encode(docs, PIECE_BPE, keep=("doc_id", "source"))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("private_data", private_data), ("mixture", mixture), ("pieces", pieces),
]
# No stage but the mix has an SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
