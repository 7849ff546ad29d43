"""Routing of parsed lines, typed columns, validity and reject reasons.

Two readings of the query string exist. ``lenient`` routes by path alone, accepts the short parameter
names and keeps leading digits only. ``strict`` also wants the long names and keeps their text as is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitflow.functions.netaddr import first_hop, with_address
from hitflow.functions.text import (
    leading_digits,
    leading_int,
    percent_decode,
    query_value,
    raw_query_value,
)
from hitflow.functions.times import instant, wall_clock

# Paths of each category.
IMPRESSION_PATHS = ("/impression", "/viewer")
WEBHIT_PATHS = ("/client", "/response")

# Accepted parameter names per normalised name, the preferred one first.
ALIASES = {
    "client": ("client", "c"),
    "booking": ("booking", "campaign", "b"),
    "creative": ("creative", "r"),
    "site": ("site", "s"),
}

# Normalised names each category needs.
REQUIRED = {
    "impression": ("client", "booking", "creative"),
    "webhit": ("client", "site"),
}

LENIENT, STRICT = "lenient", "strict"


def category_of_path(path: Column) -> Column:
    return F.when(path.isin(*IMPRESSION_PATHS), "impression").when(path.isin(*WEBHIT_PATHS), "webhit")


def has_all(category: str) -> Column:
    """True when every normalised name the category needs is present."""
    present = F.lit(True)
    for name in REQUIRED[category]:
        present = present & F.col(name).isNotNull()
    return present


def with_parameters(
    parsed: DataFrame, mode: str = LENIENT, query: str = "query_string", required_only: bool = False
) -> DataFrame:
    """Add client, booking, creative and site as text."""

    def searched(name: str) -> Column:
        if not required_only:
            return F.col(query)
        users = [category for category, names in REQUIRED.items() if name in names]
        return F.when(F.col("category").isin(*users), F.col(query))

    if mode == STRICT:
        return parsed.withColumns({name: query_value(searched(name), name) for name in ALIASES})
    spellings = [alias for names in ALIASES.values() for alias in names]
    # Written values first, as columns of their own: each is used several times below.
    df = parsed.withColumns({
        f"_raw_{alias}": raw_query_value(searched(name), alias)
        for name, names in ALIASES.items()
        for alias in names
    })
    digits = {alias: leading_digits(percent_decode(F.col(f"_raw_{alias}"))) for alias in spellings}
    df = df.withColumns({
        name: F.coalesce(*[digits[alias] for alias in names]) for name, names in ALIASES.items()
    })
    return df.drop(*[f"_raw_{alias}" for alias in spellings])


def classify(parsed: DataFrame, mode: str = LENIENT, required_only: bool = False) -> DataFrame:
    """Add parameters, ``category`` (null when the line is not routed) and ``is_valid``.

    With ``required_only`` a line gets only the parameters its category needs, which saves searching
    its query string for the others.
    """
    df = parsed.withColumn("category", category_of_path(F.col("path")))
    routed = F.col("category").isNotNull()
    # Query strings of unrouted lines are never searched.
    df = df.withColumn("_query", F.when(routed, F.col("query_string")))
    df = with_parameters(df, mode, "_query", required_only).drop("_query")
    valid = F.when(F.col("category") == "impression", has_all("impression")).otherwise(has_all("webhit"))
    df = df.withColumn("is_valid", routed & valid)
    if mode == STRICT:
        df = df.withColumn("category", F.when(F.col("is_valid"), F.col("category")))
    return df


def query_message() -> Column:
    """Normalised parameters as a map, absent ones left out."""
    names = list(ALIASES)
    whole = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.col, names)))
    return F.map_filter(whole, lambda _, v: v.isNotNull())


def with_typed_columns(classified: DataFrame, ingest_time: str = "ingest_time") -> DataFrame:
    """Add typed ids, canonical address, times, and ``reject_reason`` (null on accepted rows).

    A missing time falls back to the ingest time; a bad one does so for webhits only.
    """
    # A site may carry text after its digits; the other ids must be whole numbers.
    df = classified.withColumns({
        "client_id": F.col("client").try_cast("int"),
        "booking_id": F.col("booking").try_cast("int"),
        "creative_id": F.col("creative").try_cast("int"),
        "site_id": leading_int(F.col("site")),
        "_hop": F.when(F.col("is_valid"), first_hop(F.col("client_ip"))),
        "_wall": wall_clock(F.col("timestamp")),
        "event_instant": instant(F.col("timestamp")),
        "user_agent": F.coalesce("user_agent", F.lit("")),
    })
    df = with_address(df, "_hop", text="ip")
    is_hit = F.col("category") == "webhit"
    no_stamp = F.coalesce(F.col("timestamp"), F.lit("")) == ""
    fallback = F.when(is_hit | no_stamp, F.col(ingest_time))
    df = df.withColumn("event_time", F.coalesce("_wall", fallback))
    bad_id = F.col("client_id").isNull() | (
        ~is_hit & (F.col("booking_id").isNull() | F.col("creative_id").isNull())
    )
    reason = (
        F.when(F.col("path").isNull(), "malformed")
        .when(F.col("category").isNull(), "unrouted")
        .when(~F.col("is_valid"), "missing_key")
        .when(bad_id, "bad_id")
        .when(is_hit & F.col("site_id").isNull(), "bad_site")
        .when(F.col("ip").isNull(), "bad_ip")
        .when(F.col("event_time").isNull(), "bad_timestamp")
    )
    return df.withColumn("reject_reason", reason).drop("_hop", "_wall")


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that were costly to compute, without computing them twice.

    Catalyst would copy their expressions into a filter below the projections that compute them. A
    column that is not deterministic keeps the filter above.
    """
    marked = df.withColumn("_mark", F.spark_partition_id())
    return marked.where(condition & (F.col("_mark") >= 0)).drop("_mark")


def accepted_of(touches: DataFrame, *columns: str) -> DataFrame:
    """Accepted rows of both categories, reduced to the given columns."""
    kept = touches.select("category", "reject_reason", *columns)
    return where_computed(kept, F.col("reject_reason").isNull()).drop("reject_reason")


def _accepted(touches: DataFrame, category: str, *columns: str) -> DataFrame:
    rows = touches.select("category", "reject_reason", *columns)
    wanted = F.col("reject_reason").isNull() & (F.col("category") == category)
    return where_computed(rows, wanted).select(*columns)


def impressions_of(touches: DataFrame) -> DataFrame:
    """Accepted ad views in the layout the attribution operators read."""
    return _accepted(
        touches, "impression",
        "id", "event_time", "client_id", "booking_id", "creative_id", "ip", "user_agent",
    )


def webhits_of(touches: DataFrame) -> DataFrame:
    """Accepted site visits in the layout the attribution operators read."""
    return _accepted(touches, "webhit", "id", "event_time", "client_id", "site_id", "ip")


def rejects_of(touches: DataFrame) -> DataFrame:
    """Every row that was not accepted, with its reason."""
    rows = touches.select("host", "line_num", "raw", F.col("reject_reason").alias("reason"))
    return where_computed(rows, F.col("reason").isNotNull())
