"""Stateless streams: routing raw envelopes to queues, and moving messages between queues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitflow.functions.messages import read_message
from hitflow.operators.classify import LENIENT, classify, query_message
from hitflow.operators.parse import open_envelopes, parse_lines

# Queue a category is published to.
IMPRESSION_QUEUE, WEBHIT_QUEUE, REJECT_QUEUE = "impressions_queue", "webhits_queue", "rejects"


def run(writer, once: bool, interval: str) -> StreamingQuery:
    """Start a stream that drains what is there and stops, or that goes on at an interval."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def routed_messages(envelopes: DataFrame, mode: str = LENIENT, also: Sequence[str] = ()) -> DataFrame:
    """Envelopes as classified JSON messages with the queue each belongs to.

    Lines that are unreadable, too short or not routed go to the reject queue as they came. Messages carry the
    columns ``also`` of the envelopes as further fields.
    """
    df = classify(parse_lines(open_envelopes(envelopes)), mode)
    queue = (
        F.when(F.col("category") == "impression", IMPRESSION_QUEUE)
        .when(F.col("category") == "webhit", WEBHIT_QUEUE)
        .otherwise(REJECT_QUEUE)
    )
    entry = F.to_json(
        F.struct(
            "timestamp", "edge_ip", "method", "path", "query_string", "status", "user_agent", "referer",
            "client_ip", "host", "line_num", query_message().alias("query"), *also,
        )
    )
    message = F.when(F.col("category").isNotNull(), entry).otherwise(F.col("value"))
    return df.select(message.alias("value"), queue.alias("queue"))


def route_stream(
    envelopes: DataFrame, out: str, checkpoint: str, once: bool = True, interval: str = "1 second",
    also: Sequence[str] = (),
) -> StreamingQuery:
    """Raw envelopes to one folder of JSON messages per queue, in a single pass and exactly once."""
    writer = (
        routed_messages(envelopes, also=also)
        .writeStream.format("text")
        .partitionBy("queue")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
    )
    return run(writer, once, interval)


def bridged(messages: DataFrame, schema) -> DataFrame:
    """Messages unchanged, marked with whether they are readable."""
    readable = read_message(F.col("value"), schema).isNotNull()
    return messages.select("value", F.when(readable, "messages").otherwise(REJECT_QUEUE).alias("queue"))


def bridge_stream(
    messages: DataFrame, schema, out: str, checkpoint: str, once: bool = True, interval: str = "30 seconds"
) -> StreamingQuery:
    """Move messages of one queue to another; unreadable ones end up beside them."""
    writer = (
        bridged(messages, schema)
        .writeStream.format("text")
        .partitionBy("queue")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
    )
    return run(writer, once, interval)
