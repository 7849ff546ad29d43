"""Stored tables: files and databases."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitflow.sources.staging import remove


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored Parquet table; empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer partitions than the cluster has cores; a large scan is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column and bounds the table is read by parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A database table. Filters such as ``id > mark`` are sent to the database by Spark itself."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def write_batch(df: DataFrame, path: str, batch_id: int, time: str = "event_time") -> None:
    """Append one batch, partitioned by day and batch. Writing a batch again replaces its own rows only.

    The rows of a day are brought together first, or each task would write a file for each day.
    """
    stamped = df.withColumns({"event_date": F.to_date(time), "batch_id": F.lit(batch_id).cast("bigint")})
    (
        stamped.hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id")
        .parquet(path)
    )


def read_batches(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    """A table written with ``write_batch``, with event_date and batch_id; empty before the first batch.

    With ``days`` the folders of these days are named one by one, so that no other folder is listed. Merged batches
    bear the number of the last batch merged with them.
    """
    merges = finished_merges(spark, path)
    rows = _days(spark, path, schema, "batch_id", days)
    if not merges:
        return rows
    merged = _days(spark, _merged(path), schema, "upto", days).where(F.col("upto").isin(merges))
    return rows.where(F.col("batch_id") > max(merges)).unionByName(merged.withColumnRenamed("upto", "batch_id"))


def merge_batches(spark: SparkSession, path: str, schema: T.StructType, upto: int) -> None:
    """Put the batches up to a number, which must all be complete, into one folder for each day.

    A merge counts from the moment its empty log file exists. Until then readers see the batches; from then on they see
    the merged rows. A merge that failed is written again. The folders of the batches stay until the next merge, for
    readers that started before.
    """
    last = max(finished_merges(spark, path), default=-1)
    if upto <= last:
        return
    for folder, batch_id in _batch_folders(spark, path):
        if batch_id <= last:
            remove(spark, folder)
    rows = _days(spark, path, schema, "batch_id", None).where(F.col("batch_id").between(last + 1, upto))
    (
        rows.drop("batch_id")
        .withColumn("upto", F.lit(upto).cast("bigint"))
        .hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "upto")
        .parquet(_merged(path))
    )
    log, files = _file_system(spark, f"{_merged(path)}-log/{upto}")
    files.create(log, True).close()


def finished_merges(spark: SparkSession, path: str) -> list[int]:
    """The last batch of every merge that is complete."""
    return sorted(int(found.getName()) for found in _matches(spark, f"{_merged(path)}-log/[0-9]*"))


def _merged(path: str) -> str:
    return f"{path.rstrip('/')}-merged"


def _days(spark: SparkSession, path: str, schema: T.StructType, counter: str, days: Sequence[date] | None) -> DataFrame:
    """Rows of a table partitioned by day and by a counter, of all days or of some."""
    whole = T.StructType([*schema.fields, T.StructField("event_date", T.DateType()), T.StructField(counter, T.LongType())])
    if days is None:
        return read_table(spark, path, whole)
    folders = [f"{path}/event_date={day.isoformat()}" for day in days]
    there = [folder for folder in folders if (place := _file_system(spark, folder))[1].exists(place[0])]
    if not there:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*there)


def _batch_folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    found = _matches(spark, f"{path}/event_date=*/batch_id=*")
    return [(folder.toString(), int(folder.getName().partition("=")[2])) for folder in found]


def _file_system(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _matches(spark: SparkSession, pattern: str) -> list:
    path, files = _file_system(spark, pattern)
    return [status.getPath() for status in files.globStatus(path) or ()]
