"""Column expressions over raw log text: trimming, URL paths, query-string values, leading digits.

Everything here is a composition of built-in Spark expressions, so it stays on the JVM side and
inside generated code. Regular expressions are literals, compiled once per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space when a line or an address is trimmed.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# URL schemes whose last path segment may carry ";parameters", as may a URL without one.
PARAMETER_SCHEMES = (
    "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "sip", "sips", "mms", "sftp", "tel",
)


def strip(text: Column) -> Column:
    """Remove white space from both ends."""
    # Trimming with a character set walks the whole text, so look at the two end characters first.
    spaces = F.lit(WHITE_SPACE)
    loose = F.contains(spaces, F.left(text, F.lit(1))) | F.contains(spaces, F.right(text, F.lit(1)))
    return F.when(loose, F.btrim(text, spaces)).otherwise(text)


_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*:"
_AUTHORITY = r"(?://[^/?#]*)?"
_URL = (
    r"(?s)\A[\x00-\x20]*(?:"
    rf"(?!(?i:{'|'.join(PARAMETER_SCHEMES)}):){_SCHEME}{_AUTHORITY}([^?#]*)"
    rf"|(?:{_SCHEME})?{_AUTHORITY}([^?#;]*+(?:;(?=[^?#]*/)[^?#;]*+)*+)"
    r").*\z"
)


def url_path(url: Column) -> Column:
    """Path of a URL reference without scheme, authority, query, fragment or last-segment parameters.

    One regular expression, because ``parse_url`` refuses raw spaces and pipes, which real log lines
    contain.
    """
    return F.regexp_replace(url, _URL, "$1$2")


def percent_decode(text: Column) -> Column:
    """Undo URL encoding, leaving malformed escapes as they are."""
    repaired = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    encoded = F.contains(text, F.lit("%")) | F.contains(text, F.lit("+"))
    return F.when(encoded, F.url_decode(repaired)).otherwise(text)


def _name_pattern(name: str) -> str:
    """Pattern for a parameter name in which any character may be percent-encoded."""
    spelled = []
    for ch in name:
        code = "".join(f"[{d.upper()}{d}]" if d.isalpha() else d for d in f"{ord(ch):02x}")
        spelled.append(f"(?:{ch}|%{code})")
    return "".join(spelled)


def raw_query_value(query: Column, name: str) -> Column:
    """First non-blank value of one query parameter as written; empty when there is none."""
    return F.regexp_extract(query, rf"(?:^|&){_name_pattern(name)}=([^&]+)", 1)


def query_value(query: Column, name: str) -> Column:
    """First non-blank value of one query parameter, decoded; null when there is none."""
    found = raw_query_value(query, name)
    return F.when(found != "", percent_decode(found))


def query_map(query: Column) -> Column:
    """All non-blank parameters of a query string as a map; the first value of a name wins."""
    pieces = F.filter(F.split(query, "&"), lambda p: p.rlike(r"(?s)^[^=]*=."))
    names = F.transform(pieces, lambda p: percent_decode(F.regexp_extract(p, r"^([^=]*)=", 1)))
    values = F.transform(pieces, lambda p: percent_decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)))
    distinct = F.array_distinct(names)
    first = F.transform(distinct, lambda k: F.get(values, (F.array_position(names, k) - 1).cast("int")))
    return F.map_from_arrays(distinct, first)


def leading_digits(text: Column) -> Column:
    """Digits a value starts with, as text; null when it starts with anything else."""
    return F.when(text.rlike("^[0-9]"), F.regexp_extract(text, "^[0-9]+", 0))


def leading_int(text: Column) -> Column:
    """Leading digits as an integer; null when absent or out of range."""
    return leading_digits(text).try_cast("int")


def line_hash(line: Column) -> Column:
    """Fingerprint of a line, used to recognise a rotated file by its first line."""
    return F.sha2(line, 256)
