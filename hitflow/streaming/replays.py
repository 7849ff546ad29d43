"""Replayed input: lines that are read again, from a file that was delivered twice or a tail that was set back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What tells lines apart.
IDENTITY = ("host", "file", "line_num")


def once_only(
    lines: DataFrame, identity: Sequence[str] = IDENTITY, arrived: str = "ingest_time", horizon: str = "1 day"
) -> DataFrame:
    """The first delivery of every streamed line, as long as the next one comes within the horizon.

    The state holds the identity of the lines that arrived within the horizon, and forgets older ones. ``arrived`` is the
    time a line came in, which does not run backwards by more than the horizon; a line older than that is late and
    is left out, as Spark does with all rows behind a watermark.
    """
    timed = lines.withColumn("_arrived", F.col(arrived).cast("timestamp"))
    return timed.withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(list(identity)).drop("_arrived")
