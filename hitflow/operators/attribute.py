"""Last-touch attribution: the impression a site visit is credited to.

Inputs are the layouts of ``classify.impressions_of`` and ``classify.webhits_of``. A visit and an
impression belong together when client and address agree and the impression is less than the look-back
older than the visit (the bound is strict).

* ``causal=True``: the newest impression at or before the visit.
* ``causal=False``: the newest impression of all, even one after the visit.

An archive tier may be given; it counts only for visits the first tier leaves without a match, even if
its impression is newer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.functions.sortkey import id_of, pair_key, pair_of, time_of
from hitflow.functions.times import days, wall_seconds
from hitflow.operators import skew

KEY = ("client_id", "ip")
LOOKBACK_DAYS = 7
DAY = 86_400


def latest_impression_per_key(impressions: DataFrame) -> DataFrame:
    """Newest impression of every (client, address); ties go to the higher id."""
    newest = impressions.groupBy(*KEY).agg(F.max(pair_key(F.col("event_time"), F.col("id"))).alias("m"))
    return newest.select(
        *KEY, id_of(F.col("m")).alias("impression_id"), time_of(F.col("m")).alias("impression_time")
    )


def latest_impression(
    impressions: DataFrame, client_id: int, ip: str, as_of, lookback_days: int = 30
) -> DataFrame:
    """Newest impression of one client and address within the days before ``as_of``."""
    bound = F.lit(as_of).cast("timestamp_ntz") - days(lookback_days)
    return (
        impressions.where((F.col("client_id") == client_id) & (F.col("ip") == ip))
        .where(F.col("event_time") > bound)
        .orderBy(F.desc("event_time"), F.desc("id"))
        .select(F.col("id").alias("impression_id"), F.col("event_time").alias("impression_time"))
        .limit(1)
    )


def attribute_last_touch(
    hits: DataFrame,
    impressions: DataFrame,
    archive: DataFrame | None = None,
    causal: bool = True,
    lookback_days: int = LOOKBACK_DAYS,
    keep_unmatched: bool = False,
    heavy_rows: int = skew.MIN_ROWS,
) -> DataFrame:
    """Hits with ``impression_id`` and ``impression_time``; unmatched hits are dropped unless asked for."""
    touches = _tiers(impressions, archive)
    if causal:
        matched = _newest_before(hits, touches, lookback_days, heavy_rows)
    else:
        matched = _newest_overall(hits, touches, heavy_rows)
    bound = F.col("event_time") - days(lookback_days)
    chosen = F.coalesce(
        F.when(F.col("_hot.event_time") > bound, F.col("_hot")),
        F.when(F.col("_old.event_time") > bound, F.col("_old")),
    )
    out = matched.withColumn("_m", chosen).select(
        *hits.columns,
        F.col("_m.id").alias("impression_id"),
        F.col("_m.event_time").alias("impression_time"),
    )
    return out if keep_unmatched else out.where(F.col("impression_id").isNotNull())


def unattributed(hits: DataFrame, impressions: DataFrame, **options) -> DataFrame:
    """Hits without a matching impression in any tier."""
    kept = attribute_last_touch(hits, impressions, keep_unmatched=True, **options)
    return kept.where(F.col("impression_id").isNull()).select(*hits.columns)


def attribute_by_arrival(
    hits: DataFrame,
    impressions: DataFrame,
    archive: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    heavy_rows: int = skew.MIN_ROWS,
) -> DataFrame:
    """Hits credited to the impression of their key that was processed last.

    Both sides carry ``arrival`` (processing order) and ``arrived_at`` (processing time). An impression
    is remembered for the look-back after it was processed; a hit whose key has none falls back to the
    stored tables by event time.
    """
    touches = _tiers(impressions, archive, ["arrival", "arrived_at"])
    processed = F.struct("arrival", "arrived_at", "event_time", "id")
    known = touches.groupBy(*KEY).agg(
        F.max(F.when(F.col("_is_hot"), processed)).alias("_last"), *_newest_keys()
    )
    known = _with_pairs(known)
    heavy = skew.find_heavy_keys(hits, KEY, heavy_rows)
    joined = skew.join_spread(hits, known, KEY, "inner", heavy, F.col("id"), heavy_rows)
    alive = F.col("_last.arrived_at") > F.col("arrived_at") - days(lookback_days)
    bound = F.col("event_time") - days(lookback_days)
    picked = F.coalesce(
        F.when(alive, F.struct("_last.event_time", "_last.id")),
        F.when(F.col("_hot.event_time") > bound, F.col("_hot")),
        F.when(F.col("_old.event_time") > bound, F.col("_old")),
    )
    return (
        joined.withColumn("_m", picked)
        .where(F.col("_m").isNotNull())
        .select(
            *hits.columns,
            F.col("_m.id").alias("impression_id"),
            F.col("_m.event_time").alias("impression_time"),
        )
    )


def _tiers(
    impressions: DataFrame, archive: DataFrame | None, also: Sequence[str] = ()
) -> DataFrame:
    columns = [*KEY, "event_time", "id"]
    touches = impressions.select(*columns, *also, F.lit(True).alias("_is_hot"))
    if archive is not None:
        old = archive.select(*columns, F.lit(False).alias("_is_hot"))
        touches = touches.unionByName(old, allowMissingColumns=True)
    return touches


def _in_tier(hot: bool) -> Column:
    """(time, id) of a row that is an impression of the tier, else null."""
    return F.when(F.col("_is_hot") == hot, F.struct("event_time", "id"))


def _newest_keys() -> list[Column]:
    """Newest (time, id) of either tier as numbers, which a hash table aggregates in place."""
    key = pair_key(F.col("event_time"), F.col("id"))
    return [F.max(F.when(F.col("_is_hot") == hot, key)).alias(name) for name, hot in (("_hot", True), ("_old", False))]


def _with_pairs(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: pair_of(F.col(name)) for name in ("_hot", "_old")})


def _newest_overall(hits: DataFrame, touches: DataFrame, heavy_rows: int) -> DataFrame:
    # No range join: if the newest impression misses the bound, every other one does too.
    newest = _with_pairs(touches.groupBy(*KEY).agg(*_newest_keys()))
    heavy = skew.find_heavy_keys(hits, KEY, heavy_rows)
    return skew.join_spread(hits, newest, KEY, "left", heavy, F.col("id"), heavy_rows)


def _newest_before(
    hits: DataFrame, touches: DataFrame, lookback_days: int, heavy_rows: int
) -> DataFrame:
    """Running newest impression over each key, in one shuffle of both sides.

    For heavy keys it is a prefix scan in two levels: within time slices, and over one summary row per slice,
    from which each slice learns the newest impression before it. No task holds a whole heavy key.
    """
    timed = touches.select(*KEY, "event_time").unionByName(hits.select(*KEY, "event_time"))
    heavy = skew.find_heavy_keys(timed, KEY, heavy_rows)
    if heavy is None:
        key, visits = list(KEY), hits
    else:
        key = [*KEY, "_slice", "_part"]
        widths = skew.slice_widths(timed, "event_time", heavy, lookback_days * DAY, heavy_rows)
        visits, touches = _in_slices(_sliced(hits, widths), _sliced(touches, widths), heavy_rows)
    rows = touches.unionByName(visits.withColumn("_is_hot", F.lit(None).cast("boolean")), allowMissingColumns=True)
    order = W.partitionBy(*key).orderBy("event_time", F.col("_is_hot").isNull(), "id")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({
        "_hot": F.last(_in_tier(True), ignorenulls=True).over(so_far),
        "_old": F.last(_in_tier(False), ignorenulls=True).over(so_far),
    })
    return rows.where(F.col("_is_hot").isNull())


def _sliced(rows: DataFrame, widths: DataFrame) -> DataFrame:
    """Rows with ``_slice``; rows of keys that are not heavy have no width and are in slice 0."""
    number = F.floor(wall_seconds(F.col("event_time")) / F.col("_width"))
    return rows.join(widths, list(KEY), "left").withColumn("_slice", F.coalesce(number, F.lit(0)))


def _in_slices(hits: DataFrame, touches: DataFrame, heavy_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt over slices and parts, with what each slice of a heavy key must know of earlier ones.

    Impressions of one stamp are reduced to the one that counts. A slice cannot be shorter than a second, so one that
    still holds many hits (all on one stamp, say) deals them over parts, each with the slice's impressions.
    """
    cut, place = F.col("_width").isNotNull(), [*KEY, "_slice"]
    light = touches.where(~cut).select(*place, "event_time", "id", "_is_hot")
    stamps = touches.where(cut).groupBy(*place, "event_time", "_is_hot").agg(F.max("id").alias("id"))
    summaries = touches.where(cut).groupBy(*place).agg(*_newest_keys())
    visited = hits.where(cut).select(*place).distinct().withColumn("_visited", F.lit(True))
    earlier = W.partitionBy(*KEY).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    known = summaries.join(visited, place, "full").select(
        *place, "_visited", *(F.last(tier, ignorenulls=True).over(earlier).alias(tier) for tier in ("_hot", "_old"))
    )
    tiers = F.array(*(F.struct(F.lit(hot).alias("_is_hot"), F.col(name).alias("_m")) for name, hot in (("_hot", True), ("_old", False))))
    carried = (
        known.where("_visited")
        .select(*place, F.inline(tiers))
        .where(F.col("_m").isNotNull())
        .select(*place, time_of(F.col("_m")).alias("event_time"), id_of(F.col("_m")).alias("id"), "_is_hot")
    )
    crowded = skew.find_heavy_keys(hits.where(cut), place, heavy_rows)
    shared = light.unionByName(stamps).unionByName(carried)
    return skew.spread(hits, shared, crowded, F.col("id"), heavy_rows)
