"""Layout of heavy keys.

Behind carrier gateways one (client, address) key can hold a large share of all rows. The helpers here
find such keys and spread each over several tasks. They change where rows are processed, never which
rows: results are the same with any threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitflow.functions.times import wall_seconds
from hitflow.sources.staging import stage

# A key below this many rows is left in one task.
MIN_ROWS = 2_000_000
# A list of up to this many keys is sent to all tasks; a longer one is a written table, joined as any other.
LISTED_KEYS = 50_000

HOUR = 3600


@dataclass(frozen=True)
class HeavyKeys:
    """All heavy keys with the number of rows each holds."""

    keys: tuple[str, ...]
    table: DataFrame
    listed: bool

    def beside(self, table: DataFrame) -> DataFrame:
        """A table with one row per heavy key, marked for sending to all tasks where the list is short."""
        return F.broadcast(table) if self.listed else table

    def split_into(self, rows_per_part: int) -> DataFrame:
        parts = F.ceil(F.col("_rows") / F.lit(rows_per_part)).cast("int")
        return self.beside(self.table.select(*self.keys, parts.alias("_parts")))


def find_heavy_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS, listed_keys: int = LISTED_KEYS
) -> HeavyKeys | None:
    """All keys holding more than ``min_rows`` rows, or None. Runs one aggregation over the key columns.

    A longer list than ``listed_keys`` never reaches the driver.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > min_rows)
    rows = counts.limit(listed_keys + 1).collect()
    if not rows:
        return None
    if len(rows) <= listed_keys:
        return HeavyKeys(tuple(keys), df.sparkSession.createDataFrame(rows, counts.schema), True)
    return HeavyKeys(tuple(keys), stage(counts, "heavy-keys"), False)


def spread(
    many: DataFrame, few: DataFrame, heavy: HeavyKeys | None, spread_by: Column, rows_per_part: int = MIN_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_part``: rows of a heavy key on the first side are dealt over its parts by
    ``spread_by``, those on the second are repeated in each. A row of any other key is in part 0."""
    if heavy is None:
        return many.withColumn("_part", F.lit(0)), few.withColumn("_part", F.lit(0))
    parts, keys = heavy.split_into(rows_per_part), list(heavy.keys)
    count = F.coalesce("_parts", F.lit(1))
    dealt = many.join(parts, keys, "left").withColumn("_part", F.pmod(F.xxhash64(spread_by), count).cast("int"))
    repeated = few.join(parts, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), count - 1)))
    return dealt.drop("_parts"), repeated.drop("_parts")


def join_spread(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    heavy: HeavyKeys | None,
    spread_by: Column,
    rows_per_part: int = MIN_ROWS,
) -> DataFrame:
    """Equi-join of a table with a lookup side that has one row per key.

    Rows of a heavy key on the left are spread over several parts by ``spread_by``; the single row on
    the right is repeated once per part.
    """
    if heavy is None:
        return left.join(right, list(keys), how)
    dealt, repeated = spread(left, right, heavy, spread_by, rows_per_part)
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")


def slice_widths(
    rows: DataFrame, time: str, heavy: HeavyKeys, longest: int, rows_per_slice: int = MIN_ROWS
) -> DataFrame:
    """Seconds per time slice for each heavy key, so its busiest hour yields slices of the wanted size."""
    hourly = (
        rows.join(heavy.beside(heavy.table.select(*heavy.keys)), list(heavy.keys), "left_semi")
        .groupBy(*heavy.keys, F.floor(wall_seconds(F.col(time)) / HOUR).alias("_hour"))
        .agg(F.count("*").alias("_n"))
    )
    width = F.floor(F.lit(HOUR * rows_per_slice) / F.max("_n"))
    widths = hourly.groupBy(*heavy.keys).agg(
        F.greatest(F.lit(1), F.least(width, F.lit(longest))).cast("bigint").alias("_width")
    )
    return heavy.beside(stage(widths, "slice-widths"))
