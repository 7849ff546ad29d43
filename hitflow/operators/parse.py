"""Raw lines and envelopes to structured fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.functions.messages import read_message
from hitflow.functions.text import strip, url_path
from hitflow.schemas import ENVELOPE, LOG_FIELDS


def parse_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the nine log fields; all are null on a line with fewer than nine.

    The line is stripped before it is split, so an empty last field makes a line too short. Fields
    past the ninth are ignored. ``url`` is reduced to its path.
    """
    width = len(LOG_FIELDS)
    df = lines.withColumn("_parts", F.split(strip(F.col(raw)), "\t", width + 1))
    parts = F.col("_parts")
    complete = F.size(parts) >= width
    fields = {}
    for i, name in enumerate(LOG_FIELDS):
        value = F.get(parts, F.lit(i))
        if name == "url":
            name, value = "path", url_path(value)
        fields[name] = F.when(complete, value)
    return df.withColumns(fields).drop("_parts")


def is_malformed() -> F.Column:
    """True for a line that had fewer than nine fields."""
    return F.col("timestamp").isNull()


def open_envelopes(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """JSON envelopes to host, line_num and raw; all null when an envelope cannot be read."""
    record = read_message(F.col(value), ENVELOPE)
    df = envelopes.withColumn("_record", record)
    whole = F.col("_record.raw").isNotNull() & F.col("_record.host").isNotNull() & F.col("_record.line_num").isNotNull()
    fields = {f.name: F.when(whole, F.col(f"_record.{f.name}")) for f in ENVELOPE.fields}
    return df.withColumns(fields).drop("_record")


def make_envelopes(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw lines wrapped as JSON envelopes."""
    return lines.withColumn(value, F.to_json(F.struct("host", "line_num", "raw")))
