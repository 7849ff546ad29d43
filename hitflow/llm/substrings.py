"""Substring deduplication by prefix-partitioned suffix trees, cut at the depth that matters.

A word goes if it lies in a window of 50 words whose sequence also starts in a document with a smaller doc_id. Only
windows are asked for, so suffix trees need no more than 50 words of depth, and equal windows must meet.

1. Sparse suffixes. In every window the smallest 8-word hash is its anchor, the same one in equal windows, so
   only suffixes around anchors (about one in 22) need partitioning. The 8 words of an anchor are the
   prefix that partitions them. An anchor stands for a run of neighbouring windows, its context.
2. Equal contexts are one leaf: (prefix, digest of the context) is aggregated to its smallest doc_id, partially
   before the shuffle. A member of a larger doc_id is a repeat as a whole; one member goes on.
3. Prefixes shared by different contexts make a subtree. A subtree of at most ``SUBTREE`` contexts goes to one task.
   A larger one is split by a longer prefix, the whole 50 words of each of its windows, whose smallest doc_id is
   again an aggregation. Subtrees are packed into batches of bounded memory.
4. A batch is built level by level: nodes of depth 1, 2, 4, ... 32 and 50 get numbers, where a node of twice the
   depth is a pair of nodes. A node of depth 50 with two leaves or more is a repeat; leaves whose doc_id is
   above the smallest one of the node are marked.
5. The marked spans are joined to the texts.

Texts are shuffled once and that shuffle is used twice. Defined cases: a null or short text has no windows and is
kept; rows that share a doc_id are told apart by their text, and do not count as repeats of each other; rows
with a null doc_id neither mark nor are marked; equal texts under different ids leave the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.llm import words
from hitflow.sources.staging import stage

WINDOW, GRAM = 50, 8
# Contexts of one subtree that one task builds in memory, and words of one batch of subtrees.
SUBTREE = 8_000
BATCH_WORDS = 400_000

_INVERSE = np.uint64(pow(int(words._BASE), -1, 1 << 64))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(count, base))))


class Ranges:
    """Hashes of any range of words of a text, from running sums."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * _powers(words._BASE, n)[:n], dtype=np.uint64)))
            self.back = _powers(_INVERSE, n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return words.mix((self.sums[end] - self.sums[start]) * self.back[start])


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a text's word hashes: prefix, context digest, first and last window of each anchor."""
    n = len(hashes)
    if n < WINDOW:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    ranges = Ranges(hashes)
    at = np.arange(n - GRAM + 1)
    grams = ranges.of(at, at + GRAM)
    span = WINDOW - GRAM + 1
    smallest = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n - WINDOW + 1)
    first = np.flatnonzero(np.diff(smallest, prepend=-1))
    last = np.append(first[1:], len(smallest)) - 1
    anchor = smallest[first]
    with np.errstate(over="ignore"):
        shape = ((anchor - first) * 64 + (last - first)).astype(np.uint64)
        digest = words.mix(ranges.of(first, last + WINDOW) + shape * words._STEP)
    return grams[anchor], digest, first, last


MARKS = "doc_id bigint, row bigint, anchors array<struct<prefix:bigint,context:bigint,first:int,last:int>>"
_ANCHOR = pa.struct([("prefix", pa.int64()), ("context", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _marks(texts: DataFrame) -> DataFrame:
    """Anchors of every row of ``texts`` (doc_id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = words.WordHashes()
        for batch in batches:
            found = []
            for text in batch.column(2):
                tokens = words.split(text.as_py())
                found.append(anchors(cache.of(tokens, len(tokens))))
            ends = np.cumsum([0, *(len(f[0]) for f in found)])
            columns = [np.concatenate([f[k] for f in found]) for k in range(4)] if found else [np.empty(0, np.int64)] * 4
            values = pa.StructArray.from_arrays(
                [pa.array(words.signed(columns[0])), pa.array(words.signed(columns[1])),
                 pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))],
                fields=list(_ANCHOR),
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "row", "anchors"])

    return texts.select("doc_id", "row", "text").mapInArrow(run, MARKS)


CONTEXTS = "prefix bigint, doc_id bigint, row bigint, starts array<int>, windows int, words binary"
WINDOWS = "d1 bigint, d2 bigint, doc_id bigint, row bigint, start int"


def _contexts(wanted: DataFrame) -> DataFrame:
    """Words of the contexts listed in ``spots`` of (doc_id, row, text, spots), equal ones of a text once."""
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int32()), pa.int32(), pa.binary()]
    names = ["prefix", "doc_id", "row", "starts", "windows", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, row, text, spots in zip(*(batch.column(k) for k in range(4))):
                tokens = words.split(text.as_py())
                own: dict[tuple, list] = {}
                for spot in spots.as_py():
                    own.setdefault((spot["prefix"], spot["context"]), []).append((spot["first"], spot["last"]))
                for (prefix, _), places in own.items():
                    first, last = places[0]
                    rows.append((prefix, doc_id.as_py(), row.as_py(), [p[0] for p in places], last - first + 1,
                                 b" ".join(tokens[first : last + WINDOW])))
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return wanted.mapInArrow(run, CONTEXTS)


def _windows(contexts: DataFrame) -> DataFrame:
    """All windows of contexts, each with a digest of its 50 words."""
    names = ["d1", "d2", "doc_id", "row", "start"]
    kinds = [pa.int64()] * 4 + [pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, doc_id, row, starts, count, text in zip(*(batch.column(k).to_pylist() for k in range(6))):
                tokens = text.split(b" ")
                for offset in range(count):
                    digest = xxhash.xxh3_128_digest(b" ".join(tokens[offset : offset + WINDOW]))
                    halves = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                    rows += [(*halves, doc_id, row, start + offset) for start in starts]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return contexts.mapInArrow(run, WINDOWS)


def deep_nodes(texts: list[list[int]], windows: list[int]) -> np.ndarray:
    """Node of depth 50 of every window of every text, one text after the other.

    Level by level: the node of depth 2d at a place is the pair of the nodes of depth d there and d further on. Places
    behind the end of a text are nodes of their own and equal to none.
    """
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    node = np.concatenate([np.asarray(t, np.int64) for t in texts])
    n = len(node)
    end_of = np.repeat(ends, lengths)
    place = np.arange(n)
    depth = 1
    while depth < WINDOW:
        step = min(depth, WINDOW - depth)
        there = place + step
        inside = there + depth <= end_of
        second = np.where(inside, node[np.minimum(there, n - 1)], -1 - place)
        order = np.lexsort((second, node))
        changed = (np.diff(node[order], prepend=-1) != 0) | (np.diff(second[order], prepend=n) != 0)
        changed[0] = True
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(changed) - 1
        node, depth = fresh, depth + step
    starts = ends - lengths
    return np.concatenate([node[s : s + w] for s, w in zip(starts, windows)])


SPANS = "doc_id bigint, row bigint, first int, end int"


def _subtrees(contexts: DataFrame, partitions: int) -> DataFrame:
    """Spans of windows that also start in a smaller doc_id, from contexts that share prefixes."""
    names = ["doc_id", "row", "first", "end"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        texts = [[numbers.setdefault(w, len(numbers)) for w in r[5].split(b" ")] for r in rows]
        windows = [r[4] for r in rows]
        nodes = deep_nodes(texts, windows)
        owner = np.repeat(np.arange(len(rows)), windows)
        docs = np.array([r[1] for r in rows], np.int64)[owner]
        smallest = np.full(int(nodes.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, nodes, docs)
        marked = docs > smallest[nodes]
        out: list[tuple] = []
        base = 0
        for (_, doc_id, row, starts, count, _), size in zip(rows, windows):
            own = marked[base : base + size]
            base += size
            if own.any():
                edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).reshape(-1, 2).tolist()
                out += [(doc_id, row, start + a, start + b - 1 + WINDOW) for start in starts for a, b in edges]
        columns = list(zip(*out)) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, prefix = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                # A batch ends between two subtrees.
                if row[0] != prefix and held >= BATCH_WORDS:
                    yield solve(rows)
                    rows, held = [], 0
                prefix = row[0]
                rows.append(row)
                held += row[4] + WINDOW - 1
        if rows:
            yield solve(rows)

    return contexts.repartition(partitions, "prefix").sortWithinPartitions("prefix").mapInArrow(run, SPANS)


REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _cut(rows: DataFrame, with_text: bool) -> DataFrame:
    """Applies ``spans`` to (doc_id, text, spans). ``kept`` is null unless the text is asked for."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    kinds = [pa.int64()] * 3 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(batch.column(k) for k in range(3))):
                tokens = words.split(text.as_py())
                n = len(tokens)
                if spans.is_valid and len(spans):
                    gone = np.zeros(n + 1, np.int64)
                    for span in spans.as_py():
                        gone[span["first"]] += 1
                        gone[span["end"]] -= 1
                    tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(gone[:n]) == 0).tolist()]
                kept = b" ".join(tokens)
                out.append((doc_id.as_py(), n, n - len(tokens), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(run, REMOVED)


def remove_repeats(docs: DataFrame, subtree: int = SUBTREE, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept text of every row of ``docs``."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("row"), "text")
    marks = stage(_marks(known), "substring-marks")
    each = marks.select("doc_id", "row", F.inline("anchors"))
    leaves = each.groupBy("prefix", "context").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    leaves = stage(leaves, "substring-leaves")
    trees = (
        leaves.groupBy("prefix")
        .agg(F.count("*").alias("size"), F.min("low").alias("_low"), F.max("low").alias("_high"))
        .where("_low < _high")
        .select("prefix", "size")
    )
    # Leaves that repeat, or that stand in a subtree with others; nothing else can mark a word.
    busy = leaves.join(trees, "prefix", "left").where("size is not null or low < high").select("prefix", "context", "low", "size")
    members = stage(each.join(busy, ["prefix", "context"]), "substring-members")
    whole = members.where("doc_id > low").select("doc_id", "row", "first", F.expr(f"last + {WINDOW}").alias("end"))
    texts = known.repartition(partitions, "doc_id", "row")
    spots = (
        members.where("doc_id = low and size is not null")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("prefix", "context", "first", "last", "size")).alias("all_spots"))
    )
    placed = texts.join(spots, ["doc_id", "row"])
    small = F.filter("all_spots", lambda s: s["size"] <= subtree)
    large = F.filter("all_spots", lambda s: s["size"] > subtree)
    spans = whole.unionByName(
        _subtrees(_contexts(placed.select("doc_id", "row", "text", small.alias("spots"))), partitions)
    )
    if not members.where(F.col("size") > subtree).isEmpty():
        # Not written: as part of one query, both uses of it share the one shuffle of the texts.
        windows = _windows(_contexts(placed.select("doc_id", "row", "text", large.alias("spots")).where("size(spots) > 0")))
        lowest = windows.groupBy("d1", "d2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("_high")).where("low < _high")
        again = windows.join(lowest, ["d1", "d2"]).where("doc_id > low")
        spans = spans.unionByName(again.select("doc_id", "row", F.col("start").alias("first"), F.expr(f"start + {WINDOW}").alias("end")))
    by_row = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    found = _cut(texts.join(by_row, ["doc_id", "row"], "left").select("doc_id", "text", "spans"), with_text)
    nameless = docs.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<struct<first:int,end:int>>").alias("spans")
    )
    return found.unionByName(_cut(nameless, with_text))


#: The query's rows by grouping the digests of all windows; texts of ``documents`` have distinct ids.
REPEATS_SQL = """
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS start,
    unnest(list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' ')))) AS digest
  FROM split
), firsts AS (
  SELECT digest, min(doc_id) AS low FROM windows GROUP BY digest
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS place FROM windows JOIN firsts USING (digest) WHERE doc_id > low
), placed AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM split
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""
