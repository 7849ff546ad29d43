"""Written intermediate tables in the shared folder.

A table cuts lineage, survives the loss of executors, and lets several readers share one pass over
expensive input (such as raw text) while each reads only the columns it needs.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hitflow.session import shared_dir


def new_location(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/hitflow/{name}-{uuid.uuid4().hex}"


_scopes = threading.local()

#: Removes the shuffle files of a query as it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stage`` writes inside are removed at the end; nothing read later may depend on them."""
    open_scopes = _scopes.__dict__.setdefault("open", [])
    open_scopes.append([])
    try:
        yield
    finally:
        for location in open_scopes.pop():
            remove(spark, location)


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; only for those whose frame is planned anew when it is used again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def remove(spark: SparkSession, location: str) -> None:
    """Delete a folder or file on whatever file system holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(
    df: DataFrame, name: str, partition_by: list[str] | None = None, keep: bool = False, outer: int = 0
) -> DataFrame:
    """Write a table once and read it back. It outlives the ``outer`` innermost scratches, with ``keep`` all of them."""
    spark = df.sparkSession
    location = new_location(spark, name)
    open_scopes = _scopes.__dict__.get("open", [])
    if not keep and len(open_scopes) > outer:
        open_scopes[-1 - outer].append(location)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _own_shuffles(spark):
        writer.parquet(location)
    return spark.read.schema(df.schema).parquet(location)
