"""Attribution and deduplication against brute force, with and without heavy keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hitflow.functions import sortkey
from hitflow.operators import attribute, dedupe, skew, tail

WEEK = timedelta(days=7)
START = datetime(2024, 1, 1)
IMPRESSIONS = "id bigint, event_time timestamp_ntz, client_id int, ip string"
HITS = "id bigint, event_time timestamp_ntz, client_id int, site_id int, ip string"


def _rows(seed):
    """A third of all rows fall on one key; stamps are whole seconds and often tie."""
    rng = random.Random(seed)

    def moment():
        return START + timedelta(seconds=rng.randrange(0, 40 * 86400, 1800))

    def key():
        return (1, "hot") if rng.random() < 0.34 else (rng.randrange(3), f"ip{rng.randrange(12)}")

    impressions = [(i, moment(), *key()) for i in range(250)]
    archive = [(1000 + i, moment(), *key()) for i in range(120)]
    hits = []
    for i in range(400):
        client, ip = key()
        hits.append((5000 + i, moment(), client, rng.randrange(3), ip))
    return impressions, archive, hits


def _best(hit, impressions, causal):
    _, t, client, _, ip = hit
    fits = [
        (m[1], m[0]) for m in impressions
        if (m[2], m[3]) == (client, ip) and m[1] > t - WEEK and (not causal or m[1] <= t)
    ]
    return max(fits) if fits else None


def _expected(impressions, archive, hits, causal):
    out = {}
    for hit in hits:
        best = _best(hit, impressions, causal) or _best(hit, archive, causal)
        if best:
            out[hit[0]] = best[1]
    return out


@pytest.mark.parametrize("heavy_rows", [10**9, 40, 7])
@pytest.mark.parametrize("causal", [True, False])
@pytest.mark.parametrize("tiered", [False, True])
def test_last_touch_equals_brute_force(spark, heavy_rows, causal, tiered):
    impressions, archive, hits = _rows(3)
    if not tiered:
        archive = []
    got = attribute.attribute_last_touch(
        spark.createDataFrame(hits, HITS),
        spark.createDataFrame(impressions, IMPRESSIONS),
        archive=spark.createDataFrame(archive, IMPRESSIONS) if tiered else None,
        causal=causal,
        heavy_rows=heavy_rows,
    ).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.impression_id for r in got} == _expected(impressions, archive, hits, causal)


def test_bounds(spark):
    t = datetime(2024, 1, 8)
    hits = spark.createDataFrame([(9, t, 1, 1, "a")], HITS)

    def match(moment, causal):
        imp = spark.createDataFrame([(1, moment, 1, "a")], IMPRESSIONS)
        return attribute.attribute_last_touch(hits, imp, causal=causal).count()

    second = timedelta(seconds=1)
    assert [match(t - WEEK, c) for c in (True, False)] == [0, 0]
    assert [match(t - WEEK + second, c) for c in (True, False)] == [1, 1]
    assert [match(t, c) for c in (True, False)] == [1, 1]
    assert [match(t + second, c) for c in (True, False)] == [0, 1]


def test_unattributed_is_the_rest(spark):
    impressions, _, hits = _rows(5)
    h, i = spark.createDataFrame(hits, HITS), spark.createDataFrame(impressions, IMPRESSIONS)
    rest = {r.id for r in attribute.unattributed(h, i).collect()}
    assert rest == {x[0] for x in hits} - set(_expected(impressions, [], hits, True))


def _attributed(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(500):
        pair = (1, 1) if rng.random() < 0.34 else (rng.randrange(6), rng.randrange(3))
        rows.append((i, START + timedelta(seconds=rng.randrange(0, 60 * 86400, 3600)), *pair))
    return rows, spark.createDataFrame(rows, "id bigint, event_time timestamp_ntz, impression_id bigint, site_id int")


def _greedy(rows):
    kept, last = set(), {}
    for i, t, imp, site in sorted(rows, key=lambda r: (r[1], r[0])):
        if (imp, site) not in last or last[imp, site] <= t - WEEK:
            last[imp, site] = t
            kept.add(i)
    return kept


@pytest.mark.parametrize("seed", [11, 12])
def test_greedy_equals_a_sequential_pass(spark, seed):
    rows, df = _attributed(spark, seed)
    assert {r.id for r in dedupe.dedupe_greedy(df).collect()} == _greedy(rows)


def test_greedy_runs_a_logarithmic_number_of_steps(spark, monkeypatch):
    """Two years of one pair, a hit every hour or less: as many chains as weeks, in seven steps."""
    rng = random.Random(2)
    moments, t = [], START
    while t < START + timedelta(days=730):
        moments.append(t)
        t += timedelta(seconds=rng.choice([0, 1800, 3600, 4 * 3600, 9 * 86400 if rng.random() < 0.01 else 60]))
    rows = [(i, m, 1, 1) for i, m in enumerate(moments)]
    df = spark.createDataFrame(rows, "id bigint, event_time timestamp_ntz, impression_id bigint, site_id int")
    written, plain = [], dedupe.stage
    monkeypatch.setattr(dedupe, "stage", lambda frame, name: written.append(name) or plain(frame, name))
    assert {r.id for r in dedupe.dedupe_greedy(df).collect()} == _greedy(rows)
    assert written.count("greedy-chain") <= 9


def test_greedy_of_nothing(spark):
    _, df = _attributed(spark, 11)
    assert dedupe.dedupe_greedy(df.limit(0)).count() == 0


@pytest.mark.parametrize("heavy_rows", [10**9, 20])
def test_store_rules_out_later_hits(spark, heavy_rows):
    rows, df = _attributed(spark, 13)
    stored, new = rows[:100], rows[100:]
    got = dedupe.dedupe_against_store(
        df.where("id >= 100"), df.where("id < 100"), heavy_rows=heavy_rows
    ).collect()
    expected = {
        r[0] for r in new
        if not any(s[2:] == r[2:] and s[1] > r[1] - WEEK for s in stored)
    }
    assert {r.id for r in got} == expected


@pytest.mark.parametrize("heavy_rows", [10**9, 10])
def test_seen_sites_are_dropped(spark, heavy_rows):
    _, _, hits = _rows(17)
    df = spark.createDataFrame(hits, HITS)
    got = dedupe.drop_seen(df.where("id >= 5200"), df.where("id < 5200"), heavy_rows).collect()
    seen = {h[2:] for h in hits if h[0] < 5200}
    assert {r.id for r in got} == {h[0] for h in hits if h[0] >= 5200 and h[2:] not in seen}


def test_new_impression_opens_a_site_again(spark):
    hits = [(10, START + timedelta(hours=1), 1, 4, "a"), (11, START + timedelta(hours=2), 1, 4, "a"),
            (12, START + timedelta(hours=4), 1, 4, "a")]
    imps = [(1, START, 1, "a"), (2, START + timedelta(hours=3), 1, "a")]
    out = dedupe.dedupe_first(
        attribute.attribute_last_touch(spark.createDataFrame(hits, HITS), spark.createDataFrame(imps, IMPRESSIONS))
    )
    assert {(r.id, r.impression_id) for r in out.collect()} == {(10, 1), (12, 2)}


@pytest.mark.parametrize("listed_keys", [100, 3])
def test_all_heavy_keys_are_found(spark, listed_keys):
    df = spark.createDataFrame([(k,) for k in range(20) for _ in range(k)], "k int")
    heavy = skew.find_heavy_keys(df, ["k"], min_rows=5, listed_keys=listed_keys)
    assert {r.k for r in heavy.table.collect()} == set(range(6, 20))
    assert heavy.listed == (listed_keys == 100)
    assert skew.find_heavy_keys(df, ["k"], min_rows=50) is None


def test_hits_on_one_stamp_are_dealt_over_parts(spark):
    """A thousand hits of one key on one stamp, fifty wanted for each part."""
    stamp = START + timedelta(days=3)
    impressions = [(i, START + timedelta(hours=i % 70), 1, "hot") for i in range(140)] + [(900, stamp, 1, "hot"), (901, stamp, 1, "hot")]
    hits = [(5000 + i, stamp, 1, 0, "hot") for i in range(1000)] + [(9000 + i, stamp + timedelta(hours=i), 1, 0, "hot") for i in range(200)]
    h, m = spark.createDataFrame(hits, HITS), spark.createDataFrame(impressions, IMPRESSIONS)
    got = attribute.attribute_last_touch(h, m, heavy_rows=50).collect()
    assert {r.id: r.impression_id for r in got} == _expected(impressions, [], hits, True)
    timed = h.select(*attribute.KEY, "event_time")
    heavy = skew.find_heavy_keys(timed, attribute.KEY, 50)
    widths = skew.slice_widths(timed, "event_time", heavy, 7 * attribute.DAY, 50)
    touches = attribute._sliced(m.withColumn("_is_hot", F.lit(True)), widths)
    dealt, shared = attribute._in_slices(attribute._sliced(h, widths), touches, 50)
    sizes = [r["count"] for r in dealt.groupBy("_slice", "_part").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 100
    # Impressions of a stamp are one, and a slice learns one from all slices before it.
    assert shared.groupBy("_slice", "_part", "event_time").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("listed_keys", [0, 2])
def test_long_lists_of_heavy_keys_give_the_same_rows(spark, monkeypatch, listed_keys):
    plain = skew.find_heavy_keys
    monkeypatch.setattr(skew, "find_heavy_keys", lambda df, keys, rows=5: plain(df, keys, rows, listed_keys))
    impressions, archive, hits = _rows(23)
    for causal in (True, False):
        got = attribute.attribute_last_touch(
            spark.createDataFrame(hits, HITS), spark.createDataFrame(impressions, IMPRESSIONS),
            archive=spark.createDataFrame(archive, IMPRESSIONS), causal=causal, heavy_rows=5,
        ).collect()
        assert {r.id: r.impression_id for r in got} == _expected(impressions, archive, hits, causal)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_and_first_need_no_sorted_aggregation(spark):
    impressions, archive, hits = _rows(3)
    h, m = spark.createDataFrame(hits, HITS), spark.createDataFrame(impressions, IMPRESSIONS)
    lines = spark.createDataFrame([("h", "f", 1, "x")], "host string, file string, line_num bigint, raw string")
    first = tail.first_lines(lines)
    for df in (
        attribute.latest_impression_per_key(m), attribute.attribute_last_touch(h, m, causal=False),
        first, tail.tail_state(lines, first),
    ):
        plan = _plan(df)
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_pair_keys_keep_order_and_value(spark):
    rng = random.Random(4)
    rows = [(datetime(1, 1, 1), -(2**63)), (datetime(9999, 12, 31, 23, 59, 59, 999999), 2**63 - 1), (datetime(1969, 12, 31, 23, 59, 59, 999999), -1), (None, 3)]
    rows += [(START + timedelta(microseconds=rng.randrange(3)), rng.randrange(-2, 3)) for _ in range(40)]
    df = spark.createDataFrame(rows, "event_time timestamp_ntz, id bigint")
    df = df.withColumn("k", sortkey.pair_key(F.col("event_time"), F.col("id"))).withColumn("p", sortkey.pair_of(F.col("k")))
    got = df.collect()
    assert all((r.p is None) == (r.event_time is None) and (r.p is None or tuple(r.p) == (r.event_time, r.id)) for r in got)
    known = [r for r in got if r.event_time]
    assert [(r.event_time, r.id) for r in sorted(known, key=lambda r: r.k)] == sorted((r.event_time, r.id) for r in known)
