"""Row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.sources.staging import stage

# Positions of monotonically_increasing_id() within a partition take its lower 33 bits.
_POSITION_BITS = 33


def assign_ids(df: DataFrame, order: Sequence[str], start: int = 0, column: str = "id") -> DataFrame:
    """Number rows ``start+1, start+2, ...`` in the given order, without gaps.

    Rows are range-partitioned and sorted, each remembers its position in its partition, and the sizes
    of the earlier partitions are added. The order should be total for a repeatable numbering.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_pos": position})
    )
    rows = stage(placed, "numbered-rows")
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition: an ungrouped window and a broadcast are bounded by the partition count.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(column, F.lit(start) + F.col("_before") + F.col("_pos") + 1).drop(
        "_part", "_pos", "_before"
    )


def hashed_ids(df: DataFrame, identity: Sequence[str], column: str = "id") -> DataFrame:
    """Id computed from the columns that identify an event, so a replay gets the same one.

    64 bits: with n rows about n*n/2^65 pairs collide, so number large tables with ``assign_ids``.
    """
    return df.withColumn(column, F.xxhash64(*identity))


def drop_replays(df: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One row per event, whichever copy comes first."""
    return df.dropDuplicates(list(identity))
