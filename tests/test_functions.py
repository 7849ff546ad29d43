"""Text, time and address functions against the Python standard library and the fixture rows."""

import ipaddress
import random
from datetime import datetime
from urllib.parse import parse_qs, urlparse

from pyspark.sql import functions as F

from hitflow.functions import netaddr, text, times

URLS = [
    "http://h.example/client?x", "//h/client", "/client#f", "/client;x=2?q", "/a;p=1/client;x=2",
    "/cl|ient x?y", "", "ws://h/a;b", "mailto:a;b", "  /x", "1http://a/b", "HTTP://h/a;b", "a;b/c",
    "/a?b#c", "/a#b?c", "http:a/b;c", "x:/client;2", ";a", "/a;", "//h;x/a", "//h", "/a;b;c/d;e;f",
    "ftp://h/a;b", "/health_check", "/" + ";x" * 3000, "tel:1;2",
]

QUERIES = [
    "c=5&s=7", "client=x&c=5", "client=&client=5", "client=3&client=9", "client=0&site=1", "a=b=c", "=5",
    "site=257%27%20style=%27w", "client=%32%35", "client=%zz1", "client=1;site=2", "%63lient=8", "cl%69ent=8",
    "CLIENT=4", "client", "client=+5", "x=1&&client=7", "xclient=4&client=6", "client=%", "", "-",
    "a=1&a=2&b=%41%c3%a9+x", "c%3D=1", "a=&a=3", "client=%2", "s=%c3",
]

STAMPS = [
    "20240101", "20250511T000018+1200", "2025-05-11T00:00:18+12", "2025-05-11T00:00:18,5", "20250511T0000", "20250511T00",
    "20250511 000018.25Z", "2025-05-11T000018-0330", "2025051", "20251301", "2025-05-1100",
    "2025-05-11T00:00:18+12:00", "now", "2025", "2025-05", "epoch", "2025-05-11", "2025-05-11T00", "2025-02-30",
    "2025-05-11 01:02", "0000-01-01", "2025-05-11T25:00:00", "2025-05-11T00:00:18.5Z", "2025-05-11T00:00:18+99:00",
    "2025-05-11T00:00:18\n", "2025-05-11T00:00:18 Europe/Paris", "",
]


def _addresses():
    rng = random.Random(7)
    pieces = ["0", "0", "0", "1", "AB", "00f0", "ffff", "FFFF", "12345", ""]
    made = []
    for _ in range(1500):
        a = ":".join(rng.choice(pieces) for _ in range(rng.choice([8, 8, 8, 7, 9, 6, 3])))
        shape = rng.random()
        if shape < 0.3:
            a = a.replace("0:0", "", 1)
        if shape < 0.1:
            a += ":" + ".".join(str(rng.randint(0, 300)) for _ in range(4))
        if shape > 0.9:
            a = "::" + a
        made.append(a)
    for _ in range(1500):
        groups = [rng.choice([0, 0, 0, 1, 0xFFFF, 0xAB]) for _ in range(8)]
        made.append(":".join(rng.choice(["%x", "%04X"]) % g for g in groups))
    return made + [
        "::", "::1", "1::", "2001:DB8:0:0:0:0:0:1", "::ffff:198.18.0.46", "64:ff9b::1.2.3.4", "fe80::1%eth0",
        "fe80::1%", "1.2.3.4", "1.2.3.04", "1.2.3", "-", "", "::ffff:1.2.3.256", "1:2:3:4:5:6:7::",
        "1:2:3:4:5:6:7:8::", "::1.2.3.4", "1.2.3.4\n", ":::", "1:2:3:4:5:6:1.2.3.4", "::FFFF:1:2%x", "1:::2",
        "1::2::3", "255.255.255.255", "::%a%b", "256.1.1.1",
    ]


def _expected_address(a):
    try:
        parsed = ipaddress.ip_address(a)
    except ValueError:
        return None, None
    if parsed.version == 4:
        return f"::ffff:{parsed}", ipaddress.ip_address(f"::ffff:{a}").packed
    return str(parsed), parsed.packed


def test_url_paths(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for row in df.select("u", text.url_path(F.col("u")).alias("p")).collect():
        assert row.p == urlparse(row.u).path, row.u


def test_query_strings(spark):
    names = ("client", "site", "c", "s", "a")
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    values = [text.query_value(F.col("q"), n).alias(n) for n in names]
    for row in df.select("q", text.query_map(F.col("q")).alias("m"), *values).collect():
        expected = {k: v[0] for k, v in parse_qs(row.q).items()}
        assert row.m == expected, row.q
        assert [row[n] for n in names] == [expected.get(n) for n in names], row.q


def test_leading_digits(spark):
    df = spark.createDataFrame([("257' x",), ("x1",), ("",), ("99999999999",), (None,), ("007",)], "v string")
    rows = df.select(text.leading_digits(F.col("v")).alias("d"), text.leading_int(F.col("v")).alias("i")).collect()
    assert [tuple(r) for r in rows] == [
        ("257", 257), (None, None), (None, None), ("99999999999", None), (None, None), ("007", 7),
    ]


def test_strip(spark):
    samples = [" a\t", "\u3000x y\u00a0\x1c", "", "\t\t", "a", "a\tb\t", "\x85"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(text.strip(F.col("s"))).collect()] == [s.strip() for s in samples]


def test_stamps(spark):
    df = spark.createDataFrame([(t,) for t in STAMPS], "t string")
    for row in df.select("t", times.wall_clock(F.col("t")).alias("w")).collect():
        try:
            expected = datetime.fromisoformat(row.t).replace(tzinfo=None)
        except ValueError:
            expected = None
        assert row.w == expected, row.t


def test_iso_text_and_seconds(spark):
    moments = [datetime(2025, 5, 11, 0, 0, 18), datetime(1969, 12, 31, 23, 59, 59, 5), datetime(2025, 3, 30, 2, 30)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    rows = df.select("t", times.iso_text(F.col("t")).alias("s"), times.wall_seconds(F.col("t")).alias("n")).collect()
    for row in rows:
        assert row.s == row.t.isoformat()
        assert row.n == (row.t - datetime(1970, 1, 1)).total_seconds() // 1


def test_addresses(spark):
    df = spark.createDataFrame([(a,) for a in _addresses()], "a string")
    df = netaddr.with_address(df, "a", text="t", packed="p")
    df = netaddr.with_text_of_packed(df, "p", "back")
    for row in df.collect():
        expected, packed = _expected_address(row.a)
        assert row.t == expected, row.a
        assert (bytes(row.p) if row.p is not None else None) == packed, row.a
        assert row.back == (str(ipaddress.ip_address(packed)) if packed else None), row.a


def test_text_alone_equals_text_with_bytes(spark):
    df = spark.createDataFrame([(a,) for a in _addresses()], "a string")
    both = netaddr.with_address(netaddr.with_address(df, "a", text="t"), "a", text="u", packed="p")
    assert both.where(~F.col("t").eqNullSafe(F.col("u"))).count() == 0


def test_packed_ipv4_reads_back(spark):
    df = spark.createDataFrame([(bytearray([10, 0, 2, 255]),)], "p binary")
    assert netaddr.with_text_of_packed(df, "p", "t").first().t == "10.0.2.255"


def test_first_hop(spark):
    df = spark.createDataFrame([("198.18.0.46, 203.0.113.9",), (" 1.2.3.4 ",), ("-",), ("",)], "a string")
    assert [r[0] for r in df.select(netaddr.first_hop(F.col("a"))).collect()] == ["198.18.0.46", "1.2.3.4", "-", ""]
