"""Continuous attribution with stored tables: every micro-batch loads impressions, then credits hits.

All writes are keyed by batch, so a batch that is run again after a failure replaces its own rows. Batches that are done are
merged from time to time, so that a stream that runs for months does not leave folders for every few seconds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitflow.operators.attribute import KEY, LOOKBACK_DAYS, attribute_last_touch
from hitflow.operators.dedupe import dedupe_against_store, dedupe_first
from hitflow.plans.pipeline import Routed, route_once
from hitflow.sources.staging import scratch, stage
from hitflow.sources.tables import merge_batches, read_batches, write_batch
from hitflow.streaming.queues import run

_IMPRESSIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("client_id", T.IntegerType()),
    T.StructField("booking_id", T.IntegerType()),
    T.StructField("creative_id", T.IntegerType()),
    T.StructField("ip", T.StringType()),
])
_HITS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("client_id", T.IntegerType()),
    T.StructField("site_id", T.IntegerType()),
    T.StructField("ip", T.StringType()),
])
_ACCEPTED = T.StructType([
    *_HITS.fields,
    T.StructField("impression_id", T.LongType()),
    T.StructField("impression_time", T.TimestampNTZType()),
])


def _around(hit_days: list[date], before: int, after: int) -> list[date]:
    """The days from ``before`` days ahead of to ``after`` days behind any of the days."""
    return sorted({day + timedelta(days=n) for day in hit_days for n in range(-before, after + 1)})


@dataclass(frozen=True)
class AttributionTables:
    """Folder that holds the tables of impressions, of accepted hits and of hits without an impression.

    Every ``merge_every`` batches those before are merged. A day then has at most twice as many folders of single
    batches, and one more for each merge.
    """

    root: str
    merge_every: int = field(default=240, kw_only=True)

    def impressions(self, spark: SparkSession, days: list[date] | None = None) -> DataFrame:
        return read_batches(spark, f"{self.root}/impressions", _IMPRESSIONS, days)

    def accepted(self, spark: SparkSession, days: list[date] | None = None) -> DataFrame:
        return read_batches(spark, f"{self.root}/webhits", _ACCEPTED, days)

    def unattributed(self, spark: SparkSession, days: list[date] | None = None) -> DataFrame:
        return read_batches(spark, f"{self.root}/unattributed", _HITS, days)

    def merge(self, spark: SparkSession, upto: int) -> None:
        """Merge all batches up to one that will not run again."""
        for name, schema in (("impressions", _IMPRESSIONS), ("webhits", _ACCEPTED), ("unattributed", _HITS)):
            merge_batches(spark, f"{self.root}/{name}", schema, upto)

    def apply(self, lines: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of lines (id, host, line_num, raw, ingest_time)."""
        with scratch(lines.sparkSession):
            self.credit(route_once(lines), batch_id)

    def credit(self, routed: Routed, batch_id: int) -> None:
        """Store the impressions of one micro-batch, then credit its hits to these and all earlier ones."""
        spark = routed.webhits.sparkSession
        if batch_id and batch_id % self.merge_every == 0:
            self.merge(spark, batch_id - 1)
        write_batch(routed.impressions.select(*_IMPRESSIONS.fieldNames()), f"{self.root}/impressions", batch_id)
        hit_days = [r[0] for r in routed.webhits.select(F.to_date("event_time")).distinct().collect()]
        if not hit_days:
            return
        # Only days within reach of a hit of this batch are read, and of those only keys it contains. An impression
        # lies at most a look-back before its hit; another hit of that impression lies as far before or after.
        keys = routed.webhits.select(*KEY).distinct()
        known = stage(
            self.impressions(spark, _around(hit_days, LOOKBACK_DAYS, 0))
            .where(F.col("batch_id") <= batch_id)
            .join(keys, list(KEY), "left_semi"),
            "known-impressions",
        )
        # Read by the hits without an impression, by the search for heavy pairs, and by the comparison with the store.
        hits = stage(attribute_last_touch(routed.webhits, known, keep_unmatched=True), "attributed")
        unmatched = hits.where(F.col("impression_id").isNull())
        write_batch(unmatched.select(*_HITS.fieldNames()), f"{self.root}/unattributed", batch_id)
        stored = self.accepted(spark, _around(hit_days, LOOKBACK_DAYS, LOOKBACK_DAYS)).where(F.col("batch_id") < batch_id)
        fresh = dedupe_first(dedupe_against_store(hits.where(F.col("impression_id").isNotNull()), stored))
        write_batch(fresh.select(*_ACCEPTED.fieldNames()), f"{self.root}/webhits", batch_id)


def attribution_stream(
    lines: DataFrame, root: str | AttributionTables, checkpoint: str, once: bool = True, interval: str = "15 seconds"
) -> StreamingQuery:
    """Lines to the impression table and the table of accepted hits, given as tables or as the folder below which they lie."""
    tables = AttributionTables(root) if isinstance(root, str) else root
    writer = lines.writeStream.foreachBatch(tables.apply).option("checkpointLocation", checkpoint)
    return run(writer, once, interval)
