"""Attribution by arrival, with keyed state instead of tables.

Per (client, address) the state holds the impression processed last and the sites already accepted for
it. A new impression replaces the first and clears the second. Both expire in processing time: the
impression after seven days, the whole set of sites one day after it last grew.

Two orders of processing within a micro-batch:

* ``EVENT_ORDER``: by event time, impressions before hits of one stamp. A task keeps the rows of a key as packed
  numbers (25 bytes a row) until it has seen all of them.
* ``PHASES``: all impressions first, the newest of them stays; then the hits, of each site the first by event time.
  Every chunk of rows is reduced as it comes, to one impression and one hit a site, so that no key outgrows a task.

One key is handled by one task per micro-batch; ``maxFilesPerTrigger`` bounds how much that can be. Use
``attribution.attribution_stream`` where single keys outgrow a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hitflow.operators.attribute import KEY

DAY_MS = 24 * 3600 * 1000
IMPRESSION_TTL_MS = 7 * DAY_MS
SITES_TTL_MS = DAY_MS
EVENT_ORDER, PHASES = "event_order", "phases"

OUTPUT = (
    "id bigint, event_time timestamp_ntz, client_id int, site_id int, ip string, "
    "impression_id bigint, impression_time timestamp_ntz"
)
_ACCEPTED = Row("id", "event_time", "client_id", "site_id", "ip", "impression_id", "impression_time")
# Rows of a key that are packed at a time.
CHUNK = 4096

# Workers get this module with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROW = np.dtype([("time", "<i8"), ("is_hit", "?"), ("id", "<i8"), ("site", "<i8")])


def _packed(chunk: pd.DataFrame) -> np.ndarray:
    """Rows as numbers; times in microseconds."""
    rows = np.empty(len(chunk), _ROW)
    rows["time"] = chunk["event_time"].to_numpy().astype("datetime64[us]").astype(np.int64)
    rows["is_hit"], rows["id"], rows["site"] = chunk["is_hit"], chunk["id"], chunk["site_id"]
    return rows


def _chunks(rows: Iterator[Row]) -> Iterator[np.ndarray]:
    """Rows of one key as packed chunks."""
    while chunk := list(islice(rows, CHUNK)):
        packed = np.empty(len(chunk), _ROW)
        packed["time"] = np.array([r.event_time for r in chunk], "datetime64[us]").astype(np.int64)
        packed["is_hit"], packed["id"] = [r.is_hit for r in chunk], [r.id for r in chunk]
        packed["site"] = [r.site_id for r in chunk]
        yield packed


def _stamp(time: int):
    return np.datetime64(int(time), "us").astype(object)


class LastTouch(StatefulProcessor):
    """Credits hits to the last processed impression, once per site."""

    def __init__(self, order: str = EVENT_ORDER, impression_ttl_ms: int = IMPRESSION_TTL_MS, sites_ttl_ms: int = SITES_TTL_MS):
        if order not in (EVENT_ORDER, PHASES):
            raise ValueError(f"order is {EVENT_ORDER} or {PHASES}")
        self._order, self._impression_ttl_ms, self._sites_ttl_ms = order, impression_ttl_ms, sites_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState(
            "last", "id bigint, event_time timestamp_ntz", ttlDurationMs=self._impression_ttl_ms
        )
        # One value for the whole set: its expiry is renewed for all sites together.
        self._sites = handle.getValueState("sites", "sites array<int>", ttlDurationMs=self._sites_ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        chunks = _chunks(rows)
        ordered = self._in_phases(chunks) if self._order == PHASES else self._by_time(chunks)
        # Every call to the store is a message to the JVM. What it holds is asked for by the first hit that no
        # impression of this batch precedes, and is None where there is nothing.
        last, sites, asked = None, set(), False
        fresh, grown, cleared = None, False, False
        accepted = []
        for time, is_hit, id_, site in ordered.tolist():
            if not is_hit:
                last = fresh = (id_, _stamp(time))
                sites, grown, cleared, asked = set(), False, True, True
                continue
            if not asked:
                last, asked = self._last.get(), True
                if last is not None:
                    sites = set((self._sites.get() or ((),))[0])
            if last is not None and site not in sites:
                sites.add(site)
                grown = True
                accepted.append(_ACCEPTED(id_, _stamp(time), key[0], site, key[1], last[0], last[1]))
        # Only what changed is written, because a write renews the expiry.
        if fresh is not None:
            self._last.update(fresh)
        if grown:
            self._sites.update((sorted(sites),))
        elif cleared:
            self._sites.clear()
        return iter(accepted)

    @staticmethod
    def _by_time(chunks: Iterator[np.ndarray]) -> np.ndarray:
        held = np.concatenate([np.empty(0, _ROW), *chunks])
        return held[np.lexsort((held["id"], held["is_hit"], held["time"]))]

    @staticmethod
    def _in_phases(chunks: Iterator[np.ndarray]) -> np.ndarray:
        held = np.empty(0, _ROW)
        for chunk in chunks:
            both = np.concatenate([held, chunk])
            both = both[np.lexsort((both["id"], both["time"]))]
            hits = both[both["is_hit"]]
            _, first = np.unique(hits["site"], return_index=True)
            held = np.concatenate([both[~both["is_hit"]][-1:], hits[np.sort(first)]])
        return held

    def close(self) -> None:
        pass


def tagged(accepted_rows: DataFrame) -> DataFrame:
    """Accepted rows of both categories reduced to what the processor reads."""
    return accepted_rows.select(
        *KEY, "id", "event_time", (F.col("category") == "webhit").alias("is_hit"),
        F.coalesce("site_id", F.lit(-1)).alias("site_id"),
    )


def attribute_stateful(rows: DataFrame, processor: LastTouch | None = None) -> DataFrame:
    """Streaming rows of ``tagged`` to accepted hits. Needs the RocksDB state store."""
    # Rows, not frames: a frame for each key costs more than all of its rows where keys are many and small.
    return rows.groupBy(*KEY).transformWithState(
        statefulProcessor=processor or LastTouch(), outputStructType=OUTPUT, outputMode="append", timeMode="ProcessingTime"
    )


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()


def last_touches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stream has in its state after its last batch, one row per key.

    Columns: client_id, ip, impression_id, impression_time, impression_expires, sites (sorted; empty where none was
    accepted), sites_expires. Expiry is in milliseconds of processing time. Rows that have expired but were not
    swept up yet are still there.
    """
    last = _state(spark, checkpoint, "last")
    sites = _state(spark, checkpoint, "sites")
    key = [F.col(f"key.{name}").alias(name) for name in KEY]
    # Both variables are partitioned by key in the store, but the reader does not say so: one shuffle each.
    return (
        last.select(
            *key, F.col("value.value.id").alias("impression_id"), F.col("value.value.event_time").alias("impression_time"),
            F.col("value.ttlExpirationMs").alias("impression_expires"),
        )
        .join(
            sites.select(*key, F.col("value.value.sites").alias("sites"), F.col("value.ttlExpirationMs").alias("sites_expires")),
            list(KEY), "left",
        )
        .withColumn("sites", F.coalesce("sites", F.array().cast("array<int>")))
    )
