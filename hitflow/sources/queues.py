"""Message queues as folders of JSON lines, or as Kafka topics where the connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitflow.functions.messages import read_message


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a queue folder as text in ``value``."""
    return spark.read.text(path)


def stream_queue(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages of a queue folder as they arrive; only closed files may be placed there."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, records_per_batch: int | None = None
) -> DataFrame:
    """Messages of a Kafka topic as text in ``value``. Needs the Spark Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, schema, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Readable messages as columns, and unreadable ones as text with a reason."""
    df = messages.withColumn("_record", read_message(F.col(value), schema))
    good = df.where(F.col("_record").isNotNull()).select("_record.*")
    bad = df.where(F.col("_record").isNull()).select(value, F.lit("bad_json").alias("reason"))
    return good, bad
