"""Parsing, routing and reject reasons on the fixture rows."""

from datetime import datetime

import pytest

from hitflow.operators import classify, parse
from hitflow.plans.pipeline import touches_of

STAMP = "2025-05-11T00:00:18+12:00"
INGEST = datetime(2025, 5, 12)


def _line(url, stamp=STAMP, ip="198.18.0.46, 203.0.113.9", query=None, referer="-", tail=""):
    query = query if query is not None else url.partition("?")[2]
    return "\t".join([stamp, "192.0.2.1", "GET", url, query, "200", "ua", referer, ip]) + tail


def _touch(spark, raw, mode="lenient"):
    df = spark.createDataFrame(
        [(1, "h", 1, raw, INGEST)], "id bigint, host string, line_num bigint, raw string, ingest_time timestamp_ntz"
    )
    return touches_of(df, mode).first()


CASES = [
    ("\t".join("12345678"), None, "malformed"),
    (_line("/client?client=5&site=7", ip=""), None, "malformed"),
    (_line("/client?client=5&site=7", tail="\textra"), "webhit", None),
    (_line("/client?client=5&site=7", referer=""), "webhit", None),
    (_line("/health_check?-"), None, "unrouted"),
    (_line("/client?c=5&s=7"), "webhit", None),
    (_line("/client?client=1;site=2"), "webhit", "missing_key"),
    (_line("/client?client=%zz1&site=2"), "webhit", "missing_key"),
    (_line("/client?client=99999999999&site=2"), "webhit", "bad_id"),
    (_line("/impression?client=1&booking=2"), "impression", "missing_key"),
    (_line("/viewer?c=1&b=2&r=3"), "impression", None),
    (_line("/client?c=1&s=2", ip="-"), "webhit", "bad_ip"),
    (_line("/client?c=1&s=2", ip="1.2.3.04"), "webhit", "bad_ip"),
    (_line("/viewer?c=1&b=2&r=3", stamp="now"), "impression", "bad_timestamp"),
    (_line("/client?c=1&s=2", stamp="now"), "webhit", None),
]


@pytest.mark.parametrize("raw, category, reason", CASES)
def test_lenient(spark, raw, category, reason):
    row = _touch(spark, raw)
    assert (row.category, row.reject_reason) == (category, reason)


def test_values(spark):
    row = _touch(spark, _line("/client?client=x&c=%32%35&site=257%27%20style"))
    assert (row.client_id, row.site_id, row.ip) == (25, 257, "::ffff:198.18.0.46")
    assert row.event_time == datetime(2025, 5, 11, 0, 0, 18)
    assert _touch(spark, _line("/client?client=0&site=1")).client_id == 0
    assert _touch(spark, _line("/impression?c=1&campaign=4&r=2")).booking_id == 4


def test_bad_hit_time_falls_back_to_ingest(spark):
    assert _touch(spark, _line("/client?c=1&s=2", stamp="2025")).event_time == INGEST


@pytest.mark.parametrize(
    "url, category, reason",
    [
        ("/client?c=5&s=7", None, "unrouted"),
        ("/impression?client=1&booking=2", None, "unrouted"),
        ("/client?client=5&site=abc", "webhit", "bad_site"),
        ("/client?client=5x&site=1", "webhit", "bad_id"),
        ("/viewer?client=1&booking=2&creative=3", "impression", None),
    ],
)
def test_strict(spark, url, category, reason):
    row = _touch(spark, _line(url), classify.STRICT)
    assert (row.category, row.reject_reason) == (category, reason)


def test_every_line_is_accepted_or_rejected_once(spark):
    rows = [(i, "h", i, raw, INGEST) for i, (raw, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "id bigint, host string, line_num bigint, raw string, ingest_time timestamp_ntz"
    )
    t = touches_of(df)
    parts = classify.impressions_of(t).count() + classify.webhits_of(t).count() + classify.rejects_of(t).count()
    assert parts == len(CASES)


def test_envelopes(spark):
    texts = ['{"host":"h","line_num":3,"raw":"a\\tb"}', '{"host":"h","raw":"x"}', "not json", '{"host":', "null", "[]"]
    df = parse.open_envelopes(spark.createDataFrame([(t,) for t in texts], "value string"))
    rows = [(r.host, r.line_num, r.raw) for r in df.select("host", "line_num", "raw").collect()]
    assert rows == [("h", 3, "a\tb")] + [(None, None, None)] * 5
