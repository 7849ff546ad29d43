"""Deduplication of attributed hits: one per (impression, site) within a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.functions.times import days, wall_seconds
from hitflow.operators import skew
from hitflow.operators.attribute import DAY, KEY, LOOKBACK_DAYS
from hitflow.sources.staging import stage

PAIR = ("impression_id", "site_id")


def dedupe_first(hits: DataFrame) -> DataFrame:
    """First hit of every (impression, site).

    Exact for causal attribution, where all hits of an impression lie within one look-back. Spark keeps
    only the first row of a pair on the map side, so a heavy pair shuffles one row per task. An impression
    belongs to one client and address; with them in front, where the hits have them, rows that attribution has
    dealt by these stay put.
    """
    group = [*(c for c in KEY if c in hits.columns), *PAIR]
    order = W.partitionBy(*group).orderBy("event_time", "id")
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n")


def dedupe_against_store(
    hits: DataFrame,
    stored: DataFrame,
    gap_days: int = LOOKBACK_DAYS,
    heavy_rows: int = skew.MIN_ROWS,
) -> DataFrame:
    """Drop hits for which a stored hit of the same pair is newer than the hit minus the gap.

    Such a hit exists exactly when the newest stored one qualifies, so the store is reduced to one row
    per pair and no range join is needed.
    """
    newest = stored.groupBy(*PAIR).agg(F.max("event_time").alias("_stored"))
    heavy = skew.find_heavy_keys(hits, PAIR, heavy_rows)
    joined = skew.join_spread(hits, newest, PAIR, "left", heavy, F.col("id"), heavy_rows)
    fresh = F.col("_stored").isNull() | (F.col("_stored") <= F.col("event_time") - days(gap_days))
    return joined.where(fresh).select(*hits.columns)


def seen_sites(accepted: DataFrame) -> DataFrame:
    """Sorted distinct sites of every (client, address)."""
    return accepted.groupBy(*KEY).agg(F.sort_array(F.collect_set("site_id")).alias("sites"))


def drop_seen(
    hits: DataFrame, accepted: DataFrame, heavy_rows: int = skew.MIN_ROWS
) -> DataFrame:
    """Drop hits whose site was already accepted for their (client, address)."""
    key = (*KEY, "site_id")
    heavy = skew.find_heavy_keys(hits, key, heavy_rows)
    seen = accepted.select(*key).distinct()
    left = skew.join_spread(hits, seen, key, "left_anti", heavy, F.col("id"), heavy_rows)
    return left.select(*hits.columns)


def dedupe_greedy(hits: DataFrame, gap_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Keep a hit unless a kept one of the same pair lies within the gap before it.

    Kept hits of a pair form a chain: its first hit, then always the next one at or beyond the gap. Every stamp of a
    pair gets a pointer to that next stamp, pointers are doubled, and the chain grows from its head to twice its
    length in every step, so the number of steps is the logarithm of the time span in gaps. Pairs that last
    less than a gap (all of them, under causal attribution) need no pointers.

    Stamps are reduced to one row before they are sorted, and sorted within an hour of a pair, so that no task
    holds a whole pair, however heavy. Hits must have a time; the smallest id is kept where stamps tie.
    """
    seconds = gap_days * DAY
    hits = stage(hits, "greedy-hits")
    stamps = stage(hits.groupBy(*PAIR, "event_time").agg(F.min("id").alias("id")), "greedy-stamps")
    spans = stamps.groupBy(*PAIR).agg(F.min("event_time").alias("_head"), F.max("event_time").alias("_tail"))
    spans = stage(spans, "greedy-spans")
    long_lived = F.col("_tail") >= F.col("_head") + days(gap_days)
    heads = spans.select(*PAIR, F.col("_head").alias("event_time"))
    reach = F.max(wall_seconds(F.col("_tail")) - wall_seconds(F.col("_head")))
    longest = spans.where(long_lived).agg(reach).head()[0]
    if longest is None:
        chain = heads
    else:
        lasting = spans.where(long_lived)
        own = stamps.join(lasting.select(*PAIR), list(PAIR), "left_semi")
        pointers = stage(_next_beyond(own, gap_days), "greedy-pointers")
        chain = stage(lasting.select(*PAIR, F.col("_head").alias("event_time")), "greedy-chain")
        covered = 1
        while covered <= longest // seconds:
            chain = stage(chain.unionByName(_followed(chain, pointers)), "greedy-chain")
            covered *= 2
            if covered <= longest // seconds:
                further = pointers.select(*PAIR, F.col("event_time").alias("_next"), F.col("_next").alias("_then"))
                pointers = stage(
                    pointers.join(further, [*PAIR, "_next"]).select(*PAIR, "event_time", F.col("_then").alias("_next")),
                    "greedy-pointers",
                )
        chain = chain.unionByName(heads.join(lasting.select(*PAIR), list(PAIR), "left_anti"))
    kept = stamps.join(chain, [*PAIR, "event_time"], "left_semi").select(*PAIR, "event_time", "id")
    # Rows of one pair, stamp and id are equal in what decides; one of them stays.
    chosen = hits.join(kept, [*PAIR, "event_time", "id"], "left_semi")
    return chosen.dropDuplicates([*PAIR, "event_time", "id"]).select(*hits.columns)


def _next_beyond(stamps: DataFrame, gap_days: int) -> DataFrame:
    """For every stamp of a pair the first one at least the gap later, as ``_next``, where there is one.

    A copy of each stamp, moved by the gap, is sorted in among the stamps of the hour it falls into. If none there is
    at or behind it, the next hour of the pair that has any gives its first.
    """
    hour = F.floor(wall_seconds(F.col("event_time")) / skew.HOUR)
    real = stamps.select(*PAIR, hour.alias("_hour"), "event_time", F.lit(None).cast("timestamp_ntz").alias("_from"))
    moved = stamps.select(*PAIR, "event_time").select(
        *PAIR, (F.col("event_time") + days(gap_days)).alias("event_time"), F.col("event_time").alias("_from")
    )
    rows = real.unionByName(moved.withColumn("_hour", hour))
    # At one time the stamp comes behind the copy, which therefore finds it.
    order = W.partitionBy(*PAIR, "_hour").orderBy("event_time", F.col("_from").isNull())
    stamp = F.when(F.col("_from").isNull(), F.col("event_time"))
    within = F.first(stamp, ignorenulls=True).over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    hours = rows.groupBy(*PAIR, "_hour").agg(F.min(stamp).alias("_first"))
    later = W.partitionBy(*PAIR).orderBy("_hour").rowsBetween(1, W.unboundedFollowing)
    hours = hours.select(*PAIR, "_hour", F.first("_first", ignorenulls=True).over(later).alias("_behind"))
    found = rows.withColumn("_within", within).where(F.col("_from").isNotNull()).join(hours, [*PAIR, "_hour"])
    pointed = found.select(*PAIR, F.col("_from").alias("event_time"), F.coalesce("_within", "_behind").alias("_next"))
    return pointed.where(F.col("_next").isNotNull())


def _followed(chain: DataFrame, pointers: DataFrame) -> DataFrame:
    return chain.join(pointers, [*PAIR, "event_time"]).select(*PAIR, F.col("_next").alias("event_time"))
