"""Tailing log files across rotation, as a stream over polled folders.

A poll leaves copies of a host's log files in a new folder (``.../poll=7/host=edge1/access.log``). Files are known by
what they hold, not by name: a host's file is the one whose first line has a certain hash. A file that was renamed since
the last poll therefore goes on where reading stopped, and a new file under the old name starts at its first line.

Of files of one host with the same first line (a copy and its original, or two polls in one micro-batch) the longest
is read. A file that became shorter has no new lines. Empty files have no identity yet. Polls end with whole lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitflow.sources.logs import count_blocks, file_of_path, host_of_path, number_lines, placed, text_blocks
from hitflow.sources.staging import remove, scratch, stage
from hitflow.streaming.queues import run

_IDENTITY = ["host", "first_line_hash"]
LINES = "host string, file string, line_num bigint, raw string, batch_id bigint"
STATE = "host string, first_line_hash string, file string, last_line_num bigint, seen_in bigint, batch_id bigint"


@dataclass(frozen=True)
class TailTables:
    """New lines and the reading positions below ``root``, each written by batch.

    A file that is in no poll of the last ``remembered`` batches is forgotten; should it come back it is read anew.
    """

    root: str
    remembered: int = 1000

    def lines(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LINES).parquet(f"{self.root}/lines")

    def state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Positions after a batch: one row per file that is remembered."""
        return spark.read.schema(STATE).parquet(f"{self.root}/state").where(F.col("batch_id") == batch_id).drop("batch_id")

    def poll(self, rows: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of ``text_blocks``. Taking it in again replaces what it wrote."""
        spark = rows.sparkSession
        with scratch(spark):
            located = placed(rows)
            blocks = count_blocks(located)
            numbered = number_lines(located, blocks)
            path = F.col("_path")
            starts = numbered.where("line_num = 1").select(
                "_path", host_of_path(path).alias("host"), file_of_path(path).alias("file"), F.sha2("raw", 256).alias("first_line_hash")
            )
            files = starts.join(blocks.groupBy("_path").agg(F.sum("_n").alias("_lines")), "_path")
            longest = W.partitionBy(*_IDENTITY).orderBy(F.desc("_lines"), F.desc("_path"))
            files = files.withColumn("_n", F.row_number().over(longest)).where("_n = 1").drop("_n")
            if batch_id:
                known = self.state(spark, batch_id - 1)
            else:
                known = spark.createDataFrame([], STATE).drop("batch_id")
            before = known.select(*_IDENTITY, F.col("last_line_num").alias("_after"))
            # One row a file; read by the lines and by the new state.
            files = stage(files.join(before, _IDENTITY, "left").fillna(0, ["_after"]), "tail-files")
            unread = numbered.join(files, "_path").where(F.col("line_num") > F.col("_after"))
            unread.select("host", "file", "line_num", "raw").write.mode("overwrite").parquet(f"{self.root}/lines/batch_id={batch_id}")
            reached = files.select(
                *_IDENTITY, "file", F.greatest("_lines", "_after").alias("last_line_num"), F.lit(batch_id).cast("bigint").alias("seen_in")
            )
            kept = known.join(files, _IDENTITY, "left_anti").where(F.col("seen_in") > batch_id - self.remembered)
            reached.unionByName(kept).write.mode("overwrite").parquet(f"{self.root}/state/batch_id={batch_id}")
        # The batch before this one may have to be read again, none earlier.
        if batch_id > 1:
            remove(spark, f"{self.root}/state/batch_id={batch_id - 2}")


def polled_text(spark: SparkSession, path: str) -> DataFrame:
    """The text files of all polls below ``path`` as a stream of lines with their file blocks."""
    return text_blocks(spark.readStream.text(path))


def tail_stream(
    polled: DataFrame, tables: TailTables, checkpoint: str, once: bool = True, interval: str = "300 seconds"
) -> StreamingQuery:
    """New lines of every poll to the given tables."""
    writer = polled.writeStream.foreachBatch(tables.poll).option("checkpointLocation", checkpoint)
    return run(writer, once, interval)
