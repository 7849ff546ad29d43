"""Insert-or-overwrite by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.sources.staging import scratch, stage
from hitflow.sources.tables import read_table


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | Column | None = None
) -> DataFrame:
    """Target with every source key overwritten or added; the last source row of a key wins.

    One shuffle of both sides by key. Spark keeps the winning row per key on the map side first, so
    repeated source rows of a heavy key are cut down before they travel. The order must be total within
    a key of the source for a repeatable result.
    """
    order = F.lit(0) if order_by is None else order_by
    old = target.withColumns({"_new": F.lit(0), "_order": F.lit(None)})
    new = source.select(*target.columns, F.lit(1).alias("_new"), _as_column(order).alias("_order"))
    both = new.unionByName(old)
    rank = W.partitionBy(*keys).orderBy(F.desc("_new"), F.desc_nulls_last("_order"))
    first = both.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") == 1)
    return first.select(*target.columns)


def _as_column(order: str | Column) -> Column:
    return F.col(order) if isinstance(order, str) else order


def touched_partitions(target: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """Rows of the target in partitions the source touches; the rest need not be read or rewritten."""
    values = source.select(F.col(partition).alias("_touched")).distinct()
    return target.join(values, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")


def upsert_table(
    source: DataFrame, path: str, keys: Sequence[str], partition: str, order_by: str | None = None
) -> None:
    """Upsert into a Parquet table of the source's columns, partitioned by one of the keys.

    Only partitions the source has rows for are read and written; files of all others stay as they are. The table is
    made if there is none. Doing it again with the same source changes nothing.
    """
    if partition not in keys:
        raise ValueError("a row must not change its partition, so the partition column must be one of the keys")
    spark = source.sparkSession
    with scratch(spark):
        fresh = stage(source, "upsert-source")
        target = read_table(spark, path, fresh.schema)
        # Written down before the table it was read from changes. Rows of a partition then meet in few files.
        merged = stage(upsert(touched_partitions(target, fresh, partition), fresh, keys, order_by), "upserted")
        (
            merged.hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
