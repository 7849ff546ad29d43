"""Consumers of the routed queues: messages to stored impressions, accepted hits, unattributed hits and rejects.

Both queue folders are one stream. Of impressions every micro-batch takes all that wait, of hits at most a number of
files, so that hits never overtake impressions that were queued before them. Messages are read once: a batch is
written as typed rows, one folder per kind, and everything else reads those.

Queues deliver at least once. A message that comes again has the same id, replaces nothing and is accepted no second time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitflow.functions.messages import read_message
from hitflow.operators.classify import ALIASES, has_all, with_typed_columns
from hitflow.plans.pipeline import Routed
from hitflow.schemas import ENTRY
from hitflow.sources.queues import stream_queue
from hitflow.sources.staging import scratch, stage
from hitflow.streaming.attribution import AttributionTables
from hitflow.streaming.queues import IMPRESSION_QUEUE, WEBHIT_QUEUE, run

CATEGORIES = {IMPRESSION_QUEUE: "impression", WEBHIT_QUEUE: "webhit"}
REJECTS = T.StructType([
    T.StructField("queue", T.StringType()), T.StructField("id", T.LongType()), T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def queued_messages(spark: SparkSession, root: str, hit_files_per_batch: int | None = None) -> DataFrame:
    """Messages (queue, value) of the impression and the webhit folder below ``root`` as one stream."""
    limits = {IMPRESSION_QUEUE: None, WEBHIT_QUEUE: hit_files_per_batch}
    # As patterns the paths may name folders that do not exist yet.
    sides = [
        stream_queue(spark, f"{root}/queue={queue[:-1]}[{queue[-1]}]", limit).select(F.lit(queue).alias("queue"), "value")
        for queue, limit in limits.items()
    ]
    return sides[0].unionByName(sides[1])


def opened_messages(messages: DataFrame, carried: T.StructType = T.StructType()) -> DataFrame:
    """Typed columns, category and ``reject_reason`` of every message.

    ``carried`` are fields that messages have beside those of an entry. Without an ``id`` among them, the id is a hash
    of the message; without an ``ingest_time``, it is the time of reading.
    """
    record = read_message(F.col("value"), T.StructType([*ENTRY.fields, *carried.fields]))
    df = messages.withColumn("_record", record).select(*messages.columns, F.col("_record").isNotNull().alias("_readable"), "_record.*")
    if "id" not in carried.names:
        df = df.withColumn("id", F.xxhash64("value"))
    if "ingest_time" not in carried.names:
        df = df.withColumn("ingest_time", F.current_timestamp().cast("timestamp_ntz"))
    category = F.create_map(*(F.lit(x) for pair in CATEGORIES.items() for x in pair))[F.col("queue")]
    df = df.withColumns({"category": category, **{name: F.col("query")[name] for name in ALIASES}})
    complete = F.when(F.col("category") == "impression", has_all("impression")).otherwise(has_all("webhit"))
    typed = with_typed_columns(df.withColumn("is_valid", F.col("path").isNotNull() & complete))
    return typed.withColumn("reject_reason", F.when(F.col("_readable"), F.col("reject_reason")).otherwise("bad_json"))


@dataclass(frozen=True)
class ConsumedTables(AttributionTables):
    """The tables of an attribution and, beside them, the rejected messages."""

    carried: T.StructType = T.StructType()

    def rejects(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(REJECTS).parquet(f"{self.root}/rejects")

    def consume(self, messages: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of messages (queue, value)."""
        with scratch(messages.sparkSession):
            opened = opened_messages(messages, self.carried)
            kind = F.when(F.col("reject_reason").isNotNull(), "reject").otherwise(F.col("category"))
            rows = stage(
                opened.select(
                    kind.alias("kind"), "id", "event_time", "client_id", "booking_id", "creative_id", "site_id", "ip", "queue",
                    F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value"), F.col("reject_reason").alias("reason"),
                ),
                "queue-batch",
                ["kind"],
            )
            rejected = rows.where(F.col("kind") == "reject").select(*REJECTS.names)
            rejected.write.mode("overwrite").parquet(f"{self.root}/rejects/batch_id={batch_id}")
            impressions = rows.where(F.col("kind") == "impression").drop("kind", "site_id", "queue", "value", "reason")
            webhits = rows.where(F.col("kind") == "webhit").drop("kind", "booking_id", "creative_id", "queue", "value", "reason")
            self.credit(Routed(impressions, webhits), batch_id)


def consume_stream(
    messages: DataFrame, tables: ConsumedTables, checkpoint: str, once: bool = True, interval: str = "15 seconds"
) -> StreamingQuery:
    """Messages of ``queued_messages`` to the given tables."""
    writer = messages.writeStream.foreachBatch(tables.consume).option("checkpointLocation", checkpoint)
    return run(writer, once, interval)
