"""Keyed state over several micro-batches: expiry, renewal, clearing, chunks of a key."""

import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Row

from hitflow.session import state_store
from hitflow.streaming import stateful

START = datetime(2024, 3, 1)
SCHEMA = "client_id int, ip string, id bigint, event_time timestamp_ntz, is_hit boolean, site_id int"


def _impression(id_, minute, client=1):
    return (client, "a", id_, START + timedelta(minutes=minute), False, -1)


def _hit(id_, minute, site=4, client=1):
    return (client, "a", id_, START + timedelta(minutes=minute), True, site)


class _Stream:
    def __init__(self, spark, root, processor):
        self.spark, self.root, self.processor = spark, str(root), processor

    def batch(self, *rows):
        """Accepted (id, impression) of all batches so far, after one more."""
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        hits = stateful.attribute_stateful(self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in"), self.processor)
        with state_store(self.spark, drain=True):
            writer = hits.writeStream.format("parquet").option("path", f"{self.root}/out")
            writer.option("checkpointLocation", f"{self.root}/c").trigger(availableNow=True).start().awaitTermination()
        got = self.spark.read.schema(hits.schema).parquet(f"{self.root}/out")
        return sorted((r.id, r.impression_id) for r in got.collect())

    def state(self):
        return {r.client_id: r for r in stateful.last_touches(self.spark, f"{self.root}/c").collect()}


@pytest.mark.parametrize("order", [stateful.EVENT_ORDER, stateful.PHASES])
def test_state_is_carried_renewed_and_cleared(spark, tmp_path, order):
    stream = _Stream(spark, tmp_path, stateful.LastTouch(order))
    assert stream.batch(_impression(1, 0), _hit(2, 1), _hit(3, 2), _hit(4, 3, site=5, client=2)) == [(2, 1)]
    before = stream.state()
    assert set(before) == {1} and list(before[1].sites) == [4]
    # A site seen before renews nothing; a new one renews the whole set, not the impression.
    assert stream.batch(_hit(5, 5)) == [(2, 1)]
    same = stream.state()[1]
    assert (same.sites_expires, same.impression_expires) == (before[1].sites_expires, before[1].impression_expires)
    assert stream.batch(_hit(6, 6, site=9)) == [(2, 1), (6, 1)]
    grown = stream.state()[1]
    assert list(grown.sites) == [4, 9] and grown.sites_expires > same.sites_expires
    assert grown.impression_expires == same.impression_expires
    # A new impression clears the set, so that a site counts again.
    assert stream.batch(_impression(7, 8)) == [(2, 1), (6, 1)]
    cleared = stream.state()[1]
    assert (cleared.impression_id, list(cleared.sites), cleared.sites_expires) == (7, [], None)
    assert cleared.impression_expires > grown.impression_expires
    assert stream.batch(_hit(8, 9)) == [(2, 1), (6, 1), (8, 7)]


def test_impressions_and_sites_expire(spark, tmp_path):
    # Sites are forgotten at once, the impression is not: the same site counts again.
    stream = _Stream(spark, tmp_path / "sites", stateful.LastTouch(sites_ttl_ms=1))
    stream.batch(_impression(1, 0), _hit(2, 1))
    time.sleep(0.1)
    assert stream.batch(_hit(3, 2), _hit(4, 3)) == [(2, 1), (3, 1)]
    # The impression is forgotten, so that a hit of the next batch has none.
    stream = _Stream(spark, tmp_path / "last", stateful.LastTouch(impression_ttl_ms=1))
    stream.batch(_impression(1, 0), _hit(2, 1))
    time.sleep(0.1)
    assert stream.batch(_hit(3, 2, site=8)) == [(2, 1)]


def test_orders_differ_where_a_hit_precedes_its_impression(spark, tmp_path):
    rows = [_hit(1, 0), _impression(2, 5), _hit(3, 6), _impression(4, 9)]
    by_time = _Stream(spark, tmp_path / "a", stateful.LastTouch(stateful.EVENT_ORDER))
    phases = _Stream(spark, tmp_path / "b", stateful.LastTouch(stateful.PHASES))
    assert by_time.batch(*rows) == [(3, 2)]
    assert phases.batch(*rows) == [(1, 4)]
    with pytest.raises(ValueError):
        stateful.LastTouch("other")


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_of_a_key_are_reduced_alike(size):
    """Phases over chunks of any size: the newest impression and the first hit of each site, and no more rows."""
    rng = random.Random(size)
    rows = [_hit(n, rng.randrange(50), rng.randrange(6)) if rng.random() < 0.8 else _impression(n, rng.randrange(50)) for n in range(300)]
    frame = pd.DataFrame(rows, columns=["client_id", "ip", "id", "event_time", "is_hit", "site_id"])
    chunks = (stateful._packed(frame[at : at + size]) for at in range(0, len(frame), size))
    got = stateful.LastTouch._in_phases(chunks)
    impressions = [r for r in rows if not r[4]]
    newest = max(impressions, key=lambda r: (r[3], r[2]))
    firsts = [min((r for r in rows if r[4] and r[5] == site), key=lambda r: (r[3], r[2])) for site in range(6)]
    assert [int(r["id"]) for r in got[:1]] == [newest[2]]
    assert [int(r["id"]) for r in got[1:]] == [r[2] for r in sorted(firsts, key=lambda r: (r[3], r[2]))]


class _Counted:
    """A state variable that counts the calls it gets."""

    def __init__(self, value=None):
        self.value, self.calls = value, 0

    def get(self):
        self.calls += 1
        return self.value

    def exists(self):
        self.calls += 1
        return self.value is not None

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None


@pytest.mark.parametrize("order", [stateful.EVENT_ORDER, stateful.PHASES])
@pytest.mark.parametrize("chunk", [1, 2, 4096])
def test_store_is_asked_only_for_what_decides(order, chunk, monkeypatch):
    """Rows in, rows out; a batch that begins with an impression reads nothing, a first hit reads each variable once."""
    monkeypatch.setattr(stateful, "CHUNK", chunk)
    row = Row("client_id", "ip", "id", "event_time", "is_hit", "site_id")

    def run(last, sites, *rows):
        processor = stateful.LastTouch(order)
        processor._last, processor._sites = _Counted(last), _Counted(sites)
        out = list(processor.handleInputRows((1, "a"), iter([row(*r) for r in rows]), None))
        return [(r.id, r.impression_id) for r in out], processor._last, processor._sites

    got, last, sites = run((9, START), ([4],), _impression(1, 0), _hit(2, 1), _hit(3, 2, site=5), _hit(4, 3))
    assert got == [(2, 1), (3, 1)] and (last.calls, sites.calls) == (1, 1)
    assert last.value == (1, START) and sites.value == ([4, 5],)
    got, last, sites = run((9, START), ([4],), _hit(2, 1), _hit(3, 2, site=5))
    assert got == [(3, 9)] and (last.calls, sites.calls) == (1, 2) and sites.value == ([4, 5],)
    got, last, sites = run((9, START), None, _hit(2, 1))
    assert got == [(2, 9)] and sites.value == ([4],)
    got, last, sites = run(None, None, _hit(2, 1), _hit(3, 2))
    assert got == [] and (last.calls, sites.calls) == (1, 0)
    got, last, sites = run((9, START), ([4],), _impression(1, 0))
    assert got == [] and last.value == (1, START) and sites.value is None
