"""JSON messages: rows to text and tolerant reading back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitflow.functions.times import iso_text


def to_message(df: DataFrame, columns: Sequence[str]) -> Column:
    """One JSON object per row in the given column order; wall-clock times as ISO text, nulls kept."""
    fields = []
    for name in columns:
        kind = df.schema[name].dataType
        is_time = isinstance(kind, (T.TimestampNTZType, T.TimestampType))
        value = iso_text(F.col(name)) if is_time else F.col(name)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def read_message(text: Column, schema: T.StructType) -> Column:
    """Struct read from JSON text; null as a whole when the text is not a JSON object."""
    guarded = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    record = F.from_json(text, guarded, options)
    kept = F.struct(*[record[f.name].alias(f.name) for f in schema.fields])
    return F.when(record.isNotNull() & record["_bad"].isNull(), kept)
