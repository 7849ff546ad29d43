"""The text operators as named queries over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hitflow.llm import byterepeats, chat, extract, licenses, mixing, near, periods, quality, secrets, substrings, tiling, tokens, trie
from hitflow.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    LLM_QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation as one text."""
    return chat.collapse(table(spark, sf_dir, "conversations"))


@query
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files, as read back from them."""
    return tokens.round_trip(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, with the items and how far they are covered."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    # The counts are a few numbers for each document: written once, read by the thresholds and by the verdict.
    measured = stage(quality.measure_table(table(spark, sf_dir, "documents")), "quality")
    cuts = quality.cutoffs(measured, table(spark, sf_dir, "labels"))
    judged = quality.judge(measured, cuts)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("expressions")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start in a smaller doc_id."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document that look like secrets."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of each document, and whether it stays."""
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else."""
    return byterepeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, with the sums of its subtree."""
    return trie.trie(table(spark, sf_dir, "conversations"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal periodic runs of words of every document, and what is left without their repetitions."""
    return periods.digests(periods.find_runs(table(spark, sf_dir, "documents"), plant=True))


LLM_ORACLES: dict[str, str] = {
    "op2_chat_formatting": chat.COLLAPSE_SQL,
    "op7_substring_dedup": substrings.REPEATS_SQL,
    "op12_prefix_trie": trie.TRIE_SQL,
}
