"""A (time, id) pair as one number of fixed width that sorts like the pair.

Aggregating such a number needs no sort: a hash table updates it in place, where a struct of time and id would make
Spark sort all rows by group first. It takes 64 bits for the wall-clock microseconds and 64 for the id, kept in a
decimal of 38 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IDS, _FIRST_ID = 1 << 64, 1 << 63


def _whole(number: int) -> Column:
    return F.expr(f"{number}BD")


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the wall clock, free of any session time zone."""
    minutes = (F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def pair_key(ts: Column, id_: Column) -> Column:
    """Key of a (timestamp_ntz, bigint) pair; null where the time is."""
    shifted = id_.cast("decimal(19,0)") + _whole(_FIRST_ID)
    return (wall_micros(ts).cast("decimal(18,0)") * _whole(_IDS) + shifted).cast("decimal(38,0)")


def id_of(key: Column) -> Column:
    return (F.pmod(key, _whole(_IDS)) - _whole(_FIRST_ID)).cast("bigint")


def time_of(key: Column) -> Column:
    micros = F.call_function("div", key - F.pmod(key, _whole(_IDS)), _whole(_IDS))
    seconds = (micros.cast("decimal(18,0)") / _whole(1_000_000)).cast("decimal(18,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def pair_of(key: Column) -> Column:
    """Struct of event_time and id, null for a null key."""
    return F.when(key.isNotNull(), F.struct(time_of(key).alias("event_time"), id_of(key).alias("id")))
