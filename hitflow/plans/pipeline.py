"""The batch pipeline: raw lines to accepted, attributed hits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.operators.attribute import attribute_last_touch
from hitflow.operators.classify import (
    LENIENT,
    accepted_of,
    classify,
    with_typed_columns,
)
from hitflow.operators.dedupe import dedupe_against_store, dedupe_first
from hitflow.operators.parse import parse_lines
from hitflow.sources.staging import stage

def touches_of(lines: DataFrame, mode: str = LENIENT) -> DataFrame:
    """Lines (id, host, line_num, raw, ingest_time) with parsed, classified and typed columns."""
    return with_typed_columns(classify(parse_lines(lines), mode, required_only=True))


@dataclass(frozen=True)
class Routed:
    """The two streams a routing pass writes."""

    impressions: DataFrame
    webhits: DataFrame


def route_once(lines: DataFrame, mode: str = LENIENT) -> Routed:
    """Parse raw text in a single pass and write slim accepted rows, one folder per category.

    Everything downstream reads that narrow columnar table, so the wide text is scanned only once, and
    each reader touches one category's folder.
    """
    accepted = accepted_of(
        touches_of(lines, mode),
        "id", "event_time", "client_id", "booking_id", "creative_id", "site_id", "ip",
    )
    rows = stage(accepted, "touches", ["category"])
    impressions = rows.where(F.col("category") == "impression").drop("category", "site_id")
    webhits = rows.where(F.col("category") == "webhit").drop("category", "booking_id", "creative_id")
    return Routed(impressions, webhits)


def accepted_hits(
    routed: Routed, archive: DataFrame | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """Attributed hits, one per (impression, site); those already in the store are left out."""
    hits = attribute_last_touch(routed.webhits, routed.impressions, archive=archive)
    if stored is not None:
        # Read twice below (to find heavy pairs, then to join), so attribution is written down first.
        hits = dedupe_against_store(stage(hits, "attributed"), stored)
    return dedupe_first(hits)
