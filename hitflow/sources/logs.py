"""Log files as tables of numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.session import pin_file_splits
from hitflow.sources.staging import stage

# Bytes of file blocks (names and numbers) up to which their table is sent to all tasks.
MAX_BROADCAST_BYTES = 64 << 20


def host_of_path(path: Column) -> Column:
    """Host named by a ``host=...`` folder of a path, else the name of the folder of the file."""
    named = F.nullif(F.regexp_extract(path, r"/host=([^/]+)/", 1), F.lit(""))
    return F.coalesce(named, F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1))


def file_of_path(path: Column) -> Column:
    """File named by a ``file=...`` folder of a path, else the last part of the path."""
    named = F.nullif(F.regexp_extract(path, r"/file=([^/]+)/", 1), F.lit(""))
    return F.coalesce(named, F.regexp_extract(path, r"([^/]+)$", 1))


_BLOCK = ["_path", "_block", "_task"]


def text_blocks(text: DataFrame) -> DataFrame:
    """Rows of a text source, batch or stream, with the file block they come from."""
    return text.select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def located_text(text: DataFrame) -> DataFrame:
    """Rows of a text source with the file block they come from and their place: raw, _path, _block, _task, _pos."""
    return placed(text_blocks(text))


def placed(rows: DataFrame) -> DataFrame:
    """Rows of ``text_blocks`` with their place in the scan. Within a block places rise by one a line."""
    return rows.withColumns({"_task": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})


def count_blocks(located: DataFrame) -> DataFrame:
    """A written table of the file blocks of ``located_text``: first place and number of lines of each."""
    counted = located.groupBy(*_BLOCK).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    return stage(counted, "log-blocks")


def number_lines(located: DataFrame, blocks: DataFrame) -> DataFrame:
    """_path, line_num (1-based within the file) and raw of rows of ``located_text``.

    Files are read twice and text is not copied. ``count_blocks`` reads them for the first time and keeps a small
    table. A running sum over the blocks of a file tells how far the places of a block are from its line numbers; the
    second pass adds that. Both passes must cut files into the same tasks (``pin_file_splits``); were it otherwise, a
    row would find no block of its task, which is an error and no wrong number.
    """
    earlier = W.partitionBy("_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = blocks.select(*_BLOCK, (before - F.col("_first") + 1).alias("_shift"))
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("_path") + 64), F.lit(0))).first()[0]
    if size <= MAX_BROADCAST_BYTES:
        shifts = F.broadcast(shifts)
    moved = F.coalesce("_shift", F.raise_error(F.lit("files changed while they were read")).cast("bigint"))
    numbered = located.join(shifts, _BLOCK, "left")
    return numbered.select("_path", (F.col("_pos") + moved).alias("line_num"), "raw")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Closed log files as host, file, line_num (1-based within the file) and raw."""
    pin_file_splits(spark)
    located = located_text(spark.read.text(path))
    return number_lines(located, count_blocks(located)).select(
        host_of_path(F.col("_path")).alias("host"), file_of_path(F.col("_path")).alias("file"), "line_num", "raw"
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: host, path, mtime. File contents are not read."""
    listed = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    return listed.select(
        host_of_path(F.col("path")).alias("host"),
        "path",
        F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
    )
