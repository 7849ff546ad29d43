"""Network addresses: first hop, canonical text, packed bytes.

IPv4 is one expression. IPv6 needs several steps that each use the previous one more than once, so it
comes as a DataFrame step (``with_address``) whose stages Catalyst keeps apart. No Python worker runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitflow.functions.text import WHITE_SPACE

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = r"[0-9a-f]{1,4}"
_GROUPS = rf"{_GROUP}(?::{_GROUP})*"
_MAPPED_HEX = "00000000000000000000ffff"


def first_hop(forwarded_for: Column) -> Column:
    """Address nearest the client in a forwarded-for list."""
    return F.btrim(F.split_part(forwarded_for, F.lit(","), F.lit(1)), F.lit(WHITE_SPACE))


def is_ipv4(address: Column) -> Column:
    return address.rlike(rf"\A{_QUAD}\z")


def mapped_ipv4(address: Column) -> Column:
    """IPv4 address as IPv6-mapped text; null for anything else."""
    return F.when(is_ipv4(address), F.concat(F.lit("::ffff:"), address))


def _pinned(result: Column) -> Column:
    """The same value, marked as not deterministic.

    It keeps Catalyst from copying the long chain of expressions behind an address into every filter on
    it, where the copies would multiply.
    """
    return F.when(F.spark_partition_id() >= 0, result)


def _hex_of_quad(quad: Column) -> Column:
    octets = [F.split_part(quad, F.lit("."), F.lit(i)).try_cast("int") for i in range(1, 5)]
    return F.lower(F.concat(*[F.lpad(F.hex(o), 2, "0") for o in octets]))


def _quad_of_hex(eight: Column) -> Column:
    octets = [F.conv(F.substring(eight, i, 2), 16, 10) for i in (1, 3, 5, 7)]
    return F.concat_ws(".", *octets)


def _group_count(groups: Column) -> Column:
    colons = F.length(groups) - F.length(F.replace(groups, F.lit(":"), F.lit("")))
    return F.when(groups == "", 0).otherwise(colons + 1)


def _compressed(groups: Column) -> Column:
    """Replace the longest run of at least two zero groups, leftmost on ties, with '::'."""
    text = groups
    for run in range(2, 9):
        zeros = f"0(?::0){{{run - 1}}}"
        text = F.when(
            groups.rlike(rf"(?:\A|:){zeros}(?:\z|:)"),
            F.regexp_replace(groups, rf"\A(.*?)(?:\A|:){zeros}(?:\z|:)(.*)\z", "$1::$2"),
        ).otherwise(text)
    return text


def _text_of_hex(df: DataFrame, hex_col: str, out: str) -> DataFrame:
    """Canonical text of 32 hex digits held in a column."""
    h = F.col(hex_col)
    colons = F.regexp_replace(h, "([0-9a-f]{4})", ":$1")
    groups = F.substring(F.regexp_replace(colons, ":0{1,3}([0-9a-f])", ":$1"), 2, 40)
    df = df.withColumn("_groups", F.when(~F.startswith(h, F.lit(_MAPPED_HEX)), groups))
    mapped = F.concat(F.lit("::ffff:"), _quad_of_hex(F.substring(h, 25, 8)))
    text = F.when(F.startswith(h, F.lit(_MAPPED_HEX)), mapped).otherwise(_compressed(F.col("_groups")))
    return df.withColumn(out, text).drop("_groups")


def _with_hex(df: DataFrame, address: str, out: str, with_ipv4: bool) -> DataFrame:
    """32 lower-case hex digits of an address; null when it is invalid, or IPv4 and not asked for."""
    a = F.col(address)
    df = df.withColumn(
        "_v6", F.when(F.contains(a, F.lit(":")), F.lower(F.regexp_replace(a, r"%[^%]+\z", "")))
    )
    v6 = F.col("_v6")
    tail = F.regexp_extract(v6, rf":({_QUAD})\z", 1)
    df = df.withColumn("_quad", F.nullif(tail, F.lit("")))
    quad_hex = _hex_of_quad(F.col("_quad"))
    head = F.substr(v6, F.lit(1), F.length(v6) - F.length("_quad"))
    unquaded = F.concat(head, F.substring(quad_hex, 1, 4), F.lit(":"), F.substring(quad_hex, 5, 4))
    df = df.withColumn("_v6", F.when(F.col("_quad").isNull(), v6).otherwise(unquaded))
    df = df.withColumn("_left", F.substring_index("_v6", "::", 1))
    df = df.withColumn("_right", F.substring_index("_v6", "::", -1))
    left, right = F.col("_left"), F.col("_right")
    missing = 8 - _group_count(left) - _group_count(right)
    filled = F.concat(
        left,
        F.when(left == "", "").otherwise(":"),
        F.repeat(F.lit("0:"), missing),
        right,
    )
    whole = v6.rlike(rf"\A{_GROUP}(?::{_GROUP}){{7}}\z")
    gapped = v6.rlike(rf"\A(?:{_GROUPS})?::(?:{_GROUPS})?\z") & (missing >= 1)
    df = df.withColumn("_full", F.when(whole, v6).when(gapped, F.regexp_replace(filled, r":\z", "")))
    padded = F.regexp_replace(F.concat(F.lit(":"), "_full"), ":", ":000")
    v6_hex = F.regexp_replace(padded, ":0*([0-9a-f]{4})(?=:|$)", "$1")
    if with_ipv4:
        v4_hex = F.concat(F.lit(_MAPPED_HEX), _hex_of_quad(a))
        v6_hex = F.when(is_ipv4(a), v4_hex).otherwise(v6_hex)
    return df.withColumn(out, v6_hex).drop("_v6", "_quad", "_left", "_right", "_full")


def with_address(df: DataFrame, address: str, text: str | None = None, packed: str | None = None) -> DataFrame:
    """Add canonical IPv6 text and/or the 16 packed bytes of the address held in a column.

    IPv4 becomes IPv6-mapped in both forms. Both are null for an invalid address.
    """
    df = _with_hex(df, address, "_hex", with_ipv4=packed is not None)
    if packed:
        df = df.withColumn(packed, _pinned(F.unhex("_hex")))
    if text:
        scope = F.regexp_extract(address, r"(%[^%]+)\z", 1)
        df = _text_of_hex(df, "_hex", "_text")
        canonical = F.coalesce(mapped_ipv4(F.col(address)), F.concat("_text", scope))
        df = df.withColumn(text, _pinned(canonical)).drop("_text")
    return df.drop("_hex")


def with_text_of_packed(df: DataFrame, packed: str, text: str) -> DataFrame:
    """Canonical text of packed bytes: 16 bytes as IPv6, 4 bytes as plain IPv4."""
    df = df.withColumn("_hex", F.when(F.length(packed) == 16, F.lower(F.hex(packed))))
    df = _text_of_hex(df, "_hex", "_text")
    quad = F.when(F.length(packed) == 4, _quad_of_hex(F.hex(packed)))
    return df.withColumn(text, _pinned(F.coalesce(quad, "_text"))).drop("_hex", "_text")
