"""Removal of bytes that repeat anywhere, by run-length indexes over the places where texts can agree.

A byte goes if it lies in a string of 200 bytes that also starts at another place, of the same document or of any other.

1. The smallest hash of 64 bytes within a string is its anchor, the same one in equal strings. Strings of one place that
   share an anchor are its context (bytes first .. last + 200). Equal strings have equal anchors, so only contexts of one
   anchor key need comparing.
2. Equal contexts are one: (key, digest) is counted, partially before the shuffle. A context counted twice repeats
   as a whole, and one copy stands for it from here on.
3. Keys with several different contexts are indexed: keys are hashed to tasks, sorted and packed into batches of bounded
   size. A batch becomes a run-compressed Burrows-Wheeler transform with sampled run ends (``runindex``); the contexts are
   streamed against it and their matching statistics mark the strings that stand twice.
4. A key with more than ``GROUP`` contexts is too long a text for one index: its key grows to the whole 200 bytes, so
   that its strings spread over all tasks, and those counted twice repeat.
5. The marked spans meet the texts. Texts are shuffled once, used for the contexts and for the result.

Defined cases: a null text is empty; texts below 200 bytes have no strings and stay whole; documents with a null doc_id
take part like others; repeated rows repeat each other; matches never cross documents; an empty table gives an empty one;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.llm.runindex import RunIndex
from hitflow.llm.words import mix
from hitflow.sources.staging import stage

LENGTH, GRAM = 200, 64
# Contexts of one key that one index holds, and bytes of one index.
GROUP = 8_000
BATCH_BYTES = 2_000_000
# Bytes of a text hashed at once; a bound on memory only.
CHUNK = 1 << 22

_PLACE = np.uint64((1 << 23) - 1)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = [np.uint64(f) for f in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _places(data: np.ndarray) -> np.ndarray:
    """Anchor place of every string of ``data``: the first of the smallest hashes of 64 bytes in it."""
    hashes, width = _BYTES[data], 1
    with np.errstate(over="ignore"):
        for factor in _FACTORS:
            hashes = hashes[:-width] * factor + hashes[width:]
            width *= 2
    smallest = (mix(hashes) & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, span = 1, LENGTH - GRAM + 1
    while 2 * width <= span:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    rest = span - width
    if rest:
        smallest = np.minimum(smallest[:-rest], smallest[rest:])
    return (smallest & _PLACE).astype(np.int64)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor place, first and last string of every context of a text."""
    strings = len(text) - LENGTH + 1
    if strings <= 0:
        return (np.empty(0, np.int64),) * 3
    data = np.frombuffer(text, np.uint8)
    parts = [_places(data[s : s + CHUNK + LENGTH - 1]) + s for s in range(0, strings, CHUNK)]
    place = np.concatenate(parts)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], first, np.append(first[1:], strings) - 1


MARKS = "id bigint, row bigint, contexts array<struct<key:bigint,digest:bigint,first:int,last:int>>"
_CONTEXT = pa.struct([("key", pa.int64()), ("digest", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _encoded(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _marks(texts: DataFrame) -> DataFrame:
    """Contexts of every row of ``texts`` (id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, digests, firsts, lasts, ends = [], [], [], [], [0]
            for value in batch.column(2):
                text = _encoded(value)
                place, first, last = anchors(text)
                keys += [digest(text[p : p + GRAM]) for p in place.tolist()]
                digests += [digest(text[a : b + LENGTH], 1) for a, b in zip(first.tolist(), last.tolist())]
                firsts.append(first)
                lasts.append(last)
                ends.append(ends[-1] + len(first))
            values = pa.StructArray.from_arrays(
                [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64)),
                 *(pa.array(np.concatenate(c).astype(np.int32) if c else np.empty(0, np.int32)) for c in (firsts, lasts))],
                fields=list(_CONTEXT),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["id", "row", "contexts"]
            )

    return texts.select("id", "row", "text").mapInArrow(run, MARKS)


CONTEXTS = "key bigint, id bigint, row bigint, first int, repeats boolean, bytes binary"
_CONTEXT_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]


def _contexts(placed: DataFrame) -> DataFrame:
    """Bytes of the contexts listed in ``spots`` of (id, row, text, spots, ...)."""
    names = ["key", "id", "row", "first", "repeats", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, row, value, spots in zip(*(batch.column(k) for k in range(4))):
                text, id_, row = _encoded(value), id_.as_py(), row.as_py()
                rows += [(s["key"], id_, row, s["first"], s["repeats"], text[s["first"] : s["last"] + LENGTH]) for s in spots.as_py()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _CONTEXT_KINDS)], names)

    return placed.mapInArrow(run, CONTEXTS)


STRINGS = "d1 bigint, d2 bigint, id bigint, row bigint, first int, repeats boolean"


def _strings(contexts: DataFrame) -> DataFrame:
    """All strings of contexts, each with a digest of its 200 bytes."""
    names = ["d1", "d2", "id", "row", "first", "repeats"]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(s, 500) for s in range(0, batch.num_rows, 500)):
                rows = []
                for _, id_, row, first, repeats, text in zip(*(part.column(k).to_pylist() for k in range(6))):
                    for at in range(len(text) - LENGTH + 1):
                        digest = xxhash.xxh3_128_digest(text[at : at + LENGTH])
                        rows.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True),
                                     id_, row, first + at, repeats))
                columns = list(zip(*rows)) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return contexts.mapInArrow(run, STRINGS)


SPANS = "id bigint, row bigint, first int, end int"


def _indexed(contexts: DataFrame, partitions: int) -> DataFrame:
    """Spans of strings that stand twice in the contexts of their key, for contexts that do not repeat as a whole."""
    names = ["id", "row", "first", "end"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        index = RunIndex([r[5] for r in rows])
        found = index.repeated(LENGTH)
        out: list[tuple] = []
        for (_, id_, row, first, repeats, _), start, end in zip(rows, index.starts.tolist(), index.ends.tolist()):
            own = found[start:end]
            if not repeats and own.any():
                edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).reshape(-1, 2).tolist()
                out += [(id_, row, first + a, first + b - 1 + LENGTH) for a, b in edges]
        columns = list(zip(*out)) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, key = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                # A batch ends between two keys.
                if row[0] != key and held >= BATCH_BYTES:
                    yield solve(rows)
                    rows, held = [], 0
                key = row[0]
                rows.append(row)
                held += len(row[5])
        if rows:
            yield solve(rows)

    return contexts.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(run, SPANS)


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(rows: DataFrame, with_bytes: bool) -> DataFrame:
    """Applies ``spans`` to (doc_id, text, spans). ``kept`` is null unless the bytes are asked for."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, value, spans in zip(*(batch.column(k) for k in range(3))):
                text = _encoded(value)
                kept, at, count = [], 0, 0
                for span in sorted((s["first"], s["end"]) for s in (spans.as_py() or [])):
                    # Spans that touch or overlap the last one go on with it.
                    if count == 0 or span[0] > at:
                        kept.append(text[at : span[0]])
                        count += 1
                    at = max(at, span[1])
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((doc_id.as_py(), len(text), len(text) - len(left), count, hashlib.sha256(left).hexdigest(), left if with_bytes else None))
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(run, REMOVED)


def remove_repeats(docs: DataFrame, group: int = GROUP, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept bytes of every row of ``docs``."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # (id, row) tells rows apart unless they are equal; a null doc_id is an id of its own by the row's hash.
    known = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("row"), "text"
    )
    each = stage(_marks(known), "byte-marks").select("id", "row", F.inline("contexts"))
    leaves = stage(each.groupBy("key", "digest").agg(F.count("*").alias("copies")), "byte-leaves")
    keys = leaves.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    busy = leaves.join(keys, "key", "left").where("size is not null or copies > 1").select("key", "digest", "copies", "size")
    members = stage(each.join(busy, ["key", "digest"]), "byte-members")
    whole = members.where("copies > 1").select("id", "row", "first", F.expr(f"last + {LENGTH}").alias("end"))
    one_each = (
        members.where("size is not null")
        .groupBy("key", "digest")
        .agg(F.min(F.struct("id", "row", "first", "last")).alias("_spot"), F.max("size").alias("size"), F.max("copies").alias("_copies"))
    )
    spots = one_each.groupBy(F.col("_spot.id").alias("id"), F.col("_spot.row").alias("row")).agg(
        F.collect_list(
            F.struct("key", F.col("_spot.first").alias("first"), F.col("_spot.last").alias("last"), "size", F.expr("_copies > 1").alias("repeats"))
        ).alias("all_spots")
    )
    texts = known.repartition(partitions, "id", "row")
    placed = texts.join(spots, ["id", "row"])
    # All columns of ``texts`` are kept, so that its one shuffle serves here and below.
    few = placed.select("id", "row", "text", F.filter("all_spots", lambda s: s["size"] <= group).alias("spots"), "doc_id")
    spans = whole.unionByName(_indexed(_contexts(few), partitions))
    if not members.where(F.col("size") > group).isEmpty():
        # Not written: as part of one query, both uses of it share the one shuffle of the texts.
        many = placed.select("id", "row", "text", F.filter("all_spots", lambda s: s["size"] > group).alias("spots"), "doc_id")
        strings = _strings(_contexts(many.where("size(spots) > 0")))
        twice = strings.groupBy("d1", "d2").agg(F.count("*").alias("_times")).where("_times > 1")
        again = strings.where("not repeats").join(twice, ["d1", "d2"])
        spans = spans.unionByName(again.select("id", "row", "first", F.expr(f"first + {LENGTH}").alias("end")))
    by_row = spans.groupBy("id", "row").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    return _cut(texts.join(by_row, ["id", "row"], "left").select("doc_id", "text", "spans"), with_bytes)
