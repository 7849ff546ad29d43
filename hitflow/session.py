"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small shuffle partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the partitions present in the new data are replaced, which makes batch rewrites repeatable.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # The JIT compiler skips methods above 8000 bytes of bytecode. Parsing makes large whole-stage
    # methods; below this limit Spark generates smaller ones per operator, which run about twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    name: str = "hitflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    shared: str | None = None,
) -> SparkSession:
    """A session with the settings above; on a cluster the submit command names master and sizes.

    ``shared`` is the folder for intermediate tables, for a cluster that does not preset ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings above on a session someone else built; all of them may change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def pin_file_splits(spark: SparkSession) -> None:
    """Keep scans of the same files cut alike while executors come and go.

    Where ``spark.sql.files.minPartitionNum`` is unset, Spark cuts small inputs by the number of cores it sees at the time.
    """
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))


@contextmanager
def state_store(spark: SparkSession, drain: bool = False):
    """Streams started inside keep their state in RocksDB, as keyed state with expiry requires.

    With ``drain`` they stop once the input is used up, instead of going on with empty batches that only
    advance processing time.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if drain:
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only where it is unset and driver and executors are one process (``local[...]``) does a temporary folder
    stand in; on a cluster an unset folder is an error, because executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all executors share, "
            "for instance with build_session(shared='hdfs:///tmp/hitflow')"
        )
    return _LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="hitflow-"))
