"""Incremental extraction with high-water marks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hitflow.operators.upsert import upsert

# Tracked entities, the margin of a first start, and the first look-back for dates.
ENTITIES = ("impression", "webhit")
START_MARGIN = 1000
FIRST_DAYS = 10


def incremental_extract(
    source: DataFrame, column: str, after, inclusive: bool = False, limit: int | None = None
) -> DataFrame:
    """Rows beyond a high-water mark. The mark is a literal, so the scan can skip files and row groups.

    With ``limit`` it returns one page in column order.
    """
    c = F.col(column)
    mark = F.lit(after)
    rows = source.where(c >= mark if inclusive else c > mark)
    return rows if limit is None else rows.orderBy(column).limit(limit)


def high_water_mark(extracted: DataFrame, column: str, previous):
    """New mark after an extract: the largest value seen, never below the previous mark."""
    top = extracted.agg(F.max(column)).first()[0]
    return previous if top is None else max(previous, top)


@dataclass(frozen=True)
class Extract:
    """Written rows of one extract, their number, and the mark to start the next one from."""

    rows: DataFrame
    count: int
    mark: int


def write_extract(source: DataFrame, column: str, after, path: str) -> Extract:
    """Write the rows beyond a mark. The job that writes them also observes their number and the new mark.

    The mark is pushed into the scan, and nothing is read a second time to learn how far the extract came.
    """
    seen = Observation()
    new = incremental_extract(source, column, after)
    new.observe(seen, F.count("*").alias("count"), F.max(column).alias("top")).write.mode("errorifexists").parquet(path)
    found = seen.get
    mark = after if found["top"] is None else max(after, found["top"])
    return Extract(source.sparkSession.read.schema(source.schema).parquet(path), found["count"], mark)


def source_maxima(sources: dict[str, DataFrame], column: str = "id") -> DataFrame:
    """Largest id per entity, one row each."""
    rows = None
    for entity, df in sources.items():
        row = df.agg(F.max(column).cast("bigint").alias("max_id")).select(
            F.lit(entity).alias("entity_type"), "max_id"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def load_cursors(state: DataFrame, maxima: DataFrame, margin: int = START_MARGIN) -> DataFrame:
    """Cursor per entity.

    If any state is stored it decides, an entity without a row starting from 0. Only with no state at
    all do cursors start a margin before the largest id.
    """
    entities = list(ENTITIES)
    stored = state.where(F.col("entity_type").isin(*entities)).select("entity_type", "last_id")
    # Both inputs have one row per entity, so the constant key below groups two rows.
    known = stored.agg((F.count("*") > 0).alias("_known")).withColumn("_k", F.lit(1))
    start = F.greatest(F.lit(0), F.coalesce("max_id", F.lit(0)) - margin).cast("bigint")
    resumed = F.coalesce("last_id", F.lit(0)).cast("bigint")
    return (
        maxima.join(stored, "entity_type", "left")
        .withColumn("_k", F.lit(1))
        .join(F.broadcast(known), "_k")
        .select("entity_type", F.when(F.col("_known"), resumed).otherwise(start).alias("last_id"))
    )


def resumed_cursors(state: DataFrame, sources: dict[str, DataFrame], margin: int = START_MARGIN) -> dict[str, int]:
    """The cursors of ``load_cursors`` as driver values; the sources are only looked at where no state is stored."""
    stored = {r[0]: r[1] for r in state.where(F.col("entity_type").isin(*ENTITIES)).select("entity_type", "last_id").collect()}
    if not stored:
        return cursor_values(load_cursors(state, source_maxima(sources), margin))
    return {entity: stored.get(entity) or 0 for entity in sources}


def cursor_values(cursors: DataFrame) -> dict[str, int]:
    """The cursors as driver values (two rows), to use as pushed-down literals."""
    return {r["entity_type"]: r["last_id"] for r in cursors.collect()}


def save_cursors(state: DataFrame, cursors: DataFrame, updated_at) -> DataFrame:
    """State table with new cursor values."""
    fresh = cursors.select(
        "entity_type", "last_id", F.lit(updated_at).cast("timestamp_ntz").alias("updated_at")
    )
    return upsert(state, fresh, ["entity_type"], order_by="updated_at")


def first_date_bound(now):
    """Lower date bound of a first run."""
    return F.to_date(F.date_sub(F.to_date(F.lit(now)), FIRST_DAYS))
