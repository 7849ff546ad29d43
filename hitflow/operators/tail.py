"""Resumable reading of growing log files: rotation, resume points, line numbers, saved state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.operators import skew
from hitflow.operators.upsert import upsert

# A saved-state table has one row per host; above this many rows it is joined by shuffle.
MAX_BROADCAST_HOSTS = 100_000


def rotation_events(polls: DataFrame) -> DataFrame:
    """Polls at which the first line of a host's log differs from the one seen before."""
    order = W.partitionBy("host").orderBy("poll_ts")
    previous = F.lag("first_line_hash").over(order)
    return (
        polls.withColumn("previous_hash", previous)
        .where(F.col("previous_hash").isNotNull() & (F.col("previous_hash") != F.col("first_line_hash")))
        .select("host", "poll_ts", "previous_hash", "first_line_hash")
    )


def latest_rotated_file(files: DataFrame, marker: str = ".log-") -> DataFrame:
    """Newest rotated file of every host."""
    rotated = files.where(F.contains("path", F.lit(marker)))
    order = W.partitionBy("host").orderBy(F.desc("mtime"), F.desc("path"))
    return rotated.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("host", "path", "mtime")


def fetch_lines(lines: DataFrame, host: str, file: str, start: int, end: int | None = None) -> DataFrame:
    """Lines ``start..end`` of one file."""
    rows = lines.where((F.col("host") == host) & (F.col("file") == file) & (F.col("line_num") >= start))
    return rows if end is None else rows.where(F.col("line_num") <= end)


def resume_tail(lines: DataFrame, state: DataFrame, max_hosts: int = MAX_BROADCAST_HOSTS) -> DataFrame:
    """Lines not read yet: the rest of the saved file and all of every later file of the host.

    File names of a host sort by age. A host without saved state is read from the start.
    """
    saved = state.select("host", F.col("file").alias("_file"), F.col("last_line_num").alias("_last"))
    if saved.limit(max_hosts + 1).count() <= max_hosts:
        located = lines.join(F.broadcast(saved), "host", "left")
    else:
        heavy = skew.find_heavy_keys(lines, ["host"])
        located = skew.join_spread(lines, saved, ["host"], "left", heavy, F.col("line_num"))
    file = F.col("file")
    unread = (
        F.col("_file").isNull()
        | (file > F.col("_file"))
        | ((file == F.col("_file")) & (F.col("line_num") > F.col("_last")))
    )
    return located.where(unread).select(*lines.columns)


def tail_state(lines: DataFrame, first_lines: DataFrame) -> DataFrame:
    """Where reading stands per host: file, last line, and fingerprint of that file's first line.

    ``first_lines`` has host, file and first_line_hash, one row per file.
    """
    # Lines are reduced to one number per file in a hash table; only files are ordered by name.
    ends = lines.groupBy("host", "file").agg(F.max("line_num").alias("last_line_num"))
    newest = W.partitionBy("host").orderBy(F.desc("file"))
    reached = ends.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    return reached.join(first_lines, ["host", "file"], "left").select(
        "host", "file", "last_line_num", "first_line_hash"
    )


def save_tail_state(state: DataFrame, reached: DataFrame) -> DataFrame:
    return upsert(state, reached, ["host"])


def first_lines(lines: DataFrame) -> DataFrame:
    """Fingerprint of the first line of every file; of lines with one number, of the smallest text.

    The number is found without the text, which is then read for the first lines alone.
    """
    starts = lines.groupBy("host", "file").agg(F.min("line_num").alias("line_num"))
    first = lines.select("host", "file", "line_num", "raw").join(starts, ["host", "file", "line_num"])
    order = W.partitionBy("host", "file").orderBy("raw")
    single = first.withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return single.select("host", "file", F.sha2("raw", 256).alias("first_line_hash"))
