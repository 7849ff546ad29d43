"""Counts per category and per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitflow.operators.classify import where_computed


def _hits() -> Column:
    return F.count("*").alias("hits")


def daily_site_hits(webhits: DataFrame) -> DataFrame:
    """Hits per day, client and site."""
    return webhits.groupBy(
        F.to_date("event_time").alias("date"), "client_id", F.col("site_id").alias("sitetag_id")
    ).agg(_hits())


def daily_impression_hits(impressions: DataFrame) -> DataFrame:
    """Views per day, client, booking and creative."""
    return impressions.groupBy(
        F.to_date("event_time").alias("date"), "client_id", "booking_id", "creative_id"
    ).agg(_hits())


def stage_counts(touches: DataFrame) -> DataFrame:
    """Lines per category: routed, accepted and rejected."""
    return touches.groupBy("category").agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def rejects_by_reason(touches: DataFrame) -> DataFrame:
    return touches.groupBy("reject_reason").agg(F.count("*").alias("lines"))


def backlog(entries: DataFrame, after: int, order: str = "id") -> DataFrame:
    """Routed entries per category not yet consumed."""
    waiting = entries.where(F.col(order) > after).select("category")
    routed = where_computed(waiting, F.col("category").isNotNull())
    return routed.groupBy("category").agg(F.count("*").alias("waiting"))


def peek(entries: DataFrame, n: int = 1, order: str = "id") -> DataFrame:
    """The oldest n entries."""
    return entries.orderBy(order).limit(n)
