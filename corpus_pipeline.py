"""A corpus from raw documents to token files, stage by stage.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All stages but the last return the columns of documents; the
last returns what reading the token files back gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitflow.llm import mixing, near, quality, tiling, tokens
from hitflow.sources.staging import stage

#: Words of a shingle and similarity (``near.PERCENT``) of near copies in the pipeline.
SHINGLE = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a proven cutoff of their stratum rejects."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.drop_near_duplicates(docs, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return tiling.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files, as read back from them."""
    return tokens.round_trip(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]

#: SQL cannot express the thresholds, the coder and the tokeniser together; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").replace("/", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
