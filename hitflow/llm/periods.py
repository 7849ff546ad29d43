"""Maximal runs of repeated words, from tiles that cover every octave of periods.

A run is a stretch of words with smallest period q and length of at least ``max(12, 2 q)`` that cannot be extended. Words
``i`` and ``i + q`` are equal for all its words but the last q, so a run is a stretch of ``max(q, 12 - q)`` or more such
matches, and that stretch covers a whole block of the grid of its octave (periods 1 to 7: every 3 words, 8 to 15:
every 4, then twice as many from octave to octave).

1. Documents are exploded into overlapping tiles for each octave: a range of grid blocks with the words up to the longest
   period behind it. An octave without any recurring block has no tiles, and neither have the ones above it.
2. A tile is solved by itself: names of its words double up to the length of a block, equal names one period apart are
   the candidates, chains of neighbouring blocks merge, and the Z-functions at both boundaries of a chain (read off by
   descending the names) give its ends. Stretches too short are dropped unless the next tile may carry them on.
3. Fragments, not words, are shuffled by (document, period) and stitched where they touch.
4. Of stretches with the same ends the smallest period stays: a longer one is a multiple of it.
5. Documents without fragments are finished where they were read. The words of the others meet their runs in one shuffle.

Defined cases: a null or empty text has no words and no runs; repeated rows are rows of their own; an empty table gives an
empty one; other columns are not read. Long texts are solved in tiles of ``TILE`` words, one after the other. For
``planted`` (the query) a null doc_id plants nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.llm import words
from hitflow.sources.staging import stage

# Words that the grid blocks of one tile cover, or eight longest periods of its octave if that is more.
TILE = 1 << 16
LEAST = 12


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """Smallest period, end of periods and length of a block, for a text of ``n`` words."""
    low, end, block = 1, 8, 3
    while low <= n // 2:
        yield low, end, block
        low, end, block = end, 2 * end, end // 2


def least_matches(period: np.ndarray) -> np.ndarray:
    return np.maximum(period, LEAST - period)


def _names(numbers: np.ndarray, block: int) -> list[tuple[int, np.ndarray]]:
    """(length, names) with equal names at equal runs of that many words; lengths double, the last one is ``block``."""
    names, length = [(1, numbers)], 1
    while length < block:
        step = min(length, block - length)
        last = names[-1][1]
        pairs = last[:-step].astype(np.int64) * (int(last.max()) + 1) + last[step:]
        names.append((length + step, np.unique(pairs, return_inverse=True)[1]))
        length += step
    return names


def _z(names: list[tuple[int, np.ndarray]], x: np.ndarray, y: np.ndarray, most: int, forward: bool) -> np.ndarray:
    """Z-function at boundary ``x`` of the words from ``y`` on (before both, if not ``forward``), up to ``most``."""
    n = len(names[0][1])
    out = np.zeros(len(x), np.int64)
    for length, name in reversed(names):
        while True:
            a, b = (x + out, y + out) if forward else (x - out - length, y - out - length)
            inside = (b + length <= n) if forward else (a >= 0)
            inside &= out + length <= most
            at = np.flatnonzero(inside)
            at = at[name[a[at]] == name[b[at]]]
            out[at] += length
            # Only the longest names fit more than once.
            if not len(at) or length != names[-1][0]:
                break
    return out


def solve_tile(numbers: np.ndarray, first: int, start: int, end: int, octave: tuple[int, int, int]) -> list[np.ndarray]:
    """Period, first and end of matches of one tile, in words of the document.

    ``numbers`` are the words of the tile, the first of which is word ``first``; its blocks are those of the octave's
    grid that start in ``start`` .. ``end``.
    """
    low, high, block = octave
    n = len(numbers)
    if n < block + low:
        return [np.empty(0, np.int64)] * 3
    names = _names(numbers, block)
    name = names[-1][1]
    blocks = np.arange(start, end, block) - first
    blocks = blocks[blocks + low < len(name)]
    # Places ordered by name, then place: those of one name a period on are neighbours.
    order = np.argsort(name, kind="stable")
    keys = name[order].astype(np.int64) * (n + 1) + order
    own = name[blocks].astype(np.int64) * (n + 1)
    begin = np.searchsorted(keys, own + np.minimum(blocks + low, n))
    count = np.searchsorted(keys, own + np.minimum(blocks + high, n)) - begin
    total = int(count.sum())
    if not total:
        return [np.empty(0, np.int64)] * 3
    at = np.repeat(blocks, count)
    other = order[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(total)]
    period = other - at
    # Chains of neighbouring blocks with one period.
    sequence = np.lexsort((at, period))
    at, period = at[sequence], period[sequence]
    head = np.concatenate(([True], (period[1:] != period[:-1]) | (at[1:] != at[:-1] + block)))
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], total) - 1
    period, begin, finish = period[heads], at[heads], at[tails] + block
    begin = begin - _z(names, begin, begin + period, block, False)
    finish = finish + _z(names, finish, finish + period, block, True)
    # A stretch that leaves the blocks of the tile may go on in the next one.
    open_ends = (begin < start - first) | (finish > end - first)
    keep = open_ends | (finish - begin >= least_matches(period))
    return [period[keep], begin[keep] + first, finish[keep] + first]


def fragments(numbers: np.ndarray, tile: int = TILE) -> list[np.ndarray]:
    """Period, first and end of the match fragments of all tiles of a text of numbered words."""
    n, found = len(numbers), []
    hashes, width = words.mix(numbers.astype(np.uint64) + np.uint64(1)), 1
    for low, high, block in octaves(n):
        while width < block:
            step = min(width, block - width)
            with np.errstate(over="ignore"):
                hashes = words.mix(hashes[:-step] + words.mix(hashes[step:] + np.uint64(width)))
            width += step
        # Equal blocks have equal hashes; where all differ, no block recurs, here or in a longer octave.
        if len(np.unique(hashes)) == len(hashes):
            break
        size = max(tile, 8 * high) // block * block
        for start in range(0, n, size):
            end = min(start + size, n)
            left = max(start - block, 0)
            found.append(solve_tile(numbers[left : end + high + 2 * block], left, start, end, (low, high, block)))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3


def planted(doc_id: int | None, tokens: list[bytes]) -> list[bytes]:
    """The words of a document, every tenth one's made periodic from some word on (the query's rule)."""
    n = len(tokens)
    if doc_id is None or not n:
        return tokens
    drawn = zlib.crc32(str(doc_id).encode())
    if drawn % 10:
        return tokens
    g = drawn // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = tokens[a : a + p]
    return tokens[:a] + (part * ((n - a) // p + 1))[: n - a]


READ = "doc_id bigint, words binary, kept_sha256 string, fragments array<struct<period:int,first:int,end:int>>"
_FRAGMENT = pa.struct([("period", pa.int32()), ("first", pa.int32()), ("end", pa.int32())])


def _read(docs: DataFrame, plant: bool, tile: int) -> DataFrame:
    """Fragments of every document; its words only if it has any, else the hash of them all."""
    names = ["doc_id", "words", "kept_sha256", "fragments"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(s, 500) for b in batches for s in range(0, b.num_rows, 500)):
            held, hashes, parts, ends = [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = words.split(text)
                if plant:
                    tokens = planted(doc_id, tokens)
                numbers: dict[bytes, int] = {}
                own = fragments(np.array([numbers.setdefault(w, len(numbers)) for w in tokens], np.int64), tile)
                joined = b" ".join(tokens)
                held.append(joined if len(own[0]) else None)
                hashes.append(None if len(own[0]) else hashlib.sha256(joined).hexdigest())
                parts.append(own)
                ends.append(ends[-1] + len(own[0]))
            columns = [np.concatenate([p[k] for p in parts]).astype(np.int32) for k in range(3)]
            values = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_FRAGMENT))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held, pa.binary()), pa.array(hashes, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, READ)


def _stitched(pieces: DataFrame) -> DataFrame:
    """start, length and period of every run, from (node, period, first, end) fragments of matches."""
    own = W.partitionBy("node", "period").orderBy("first", "end")
    reach = F.max("end").over(own.rowsBetween(W.unboundedPreceding, -1))
    parts = pieces.withColumn("_new", (reach.isNull() | (F.col("first") > reach)).cast("int"))
    parts = parts.withColumn("_part", F.sum("_new").over(own.rowsBetween(W.unboundedPreceding, 0)))
    stretches = parts.groupBy("node", "period", "_part").agg(F.min("first").alias("start"), F.max("end").alias("_matched"))
    long_enough = stretches.where(F.expr(f"_matched - start >= greatest(period, {LEAST} - period)"))
    ended = long_enough.select("node", "start", (F.col("_matched") + F.col("period")).alias("_end"), "period")
    # Equal ends: only the smallest period is that of the run.
    return ended.groupBy("node", "start", "_end").agg(F.min("period").alias("period")).select(
        "node", "start", (F.col("_end") - F.col("start")).alias("length"), "period"
    )


_RUNS = "array<struct<start:int,length:int,period:int>>"
CUT = f"doc_id bigint, runs {_RUNS}, collapsed_sha256 string, kept binary"


def _cut(rows: DataFrame, with_words: bool) -> DataFrame:
    """Words of (doc_id, words, runs) without those behind the first period of a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, kept = [], []
            for joined, runs in zip(batch.column(1).to_pylist(), batch.column(2)):
                if len(runs):
                    start, length, period = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in ("start", "length", "period"))
                    tokens = joined.split(b" ")
                    gone = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(gone, start + period, 1)
                    np.add.at(gone, start + length, -1)
                    joined = b" ".join([tokens[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])
                hashes.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined if with_words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(hashes, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "runs", "collapsed_sha256", "kept"],
            )

    return rows.mapInArrow(run, CUT)


def find_runs(docs: DataFrame, plant: bool = False, tile: int = TILE, with_words: bool = False) -> DataFrame:
    """doc_id, runs (array of start, length, period by start, then period), collapsed_sha256 and, if asked for, the kept
    words (of rows that have fragments) of every row of ``docs``."""
    read = stage(_read(docs, plant, tile).withColumn("node", F.monotonically_increasing_id()), "period-fragments")
    runs = _stitched(read.select("node", F.inline("fragments"))).groupBy(F.col("node").alias("_node")).agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("_runs")
    )
    some = read.where("words is not null").join(runs, F.col("node") == F.col("_node"), "left")
    ordered = F.transform(
        "_runs",
        lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")),
    )
    none = F.array().cast(_RUNS)
    some = some.select("doc_id", "words", F.when(F.col("_runs").isNull(), none).otherwise(ordered.cast(_RUNS)).alias("runs"))
    whole = read.where("words is null").select(
        "doc_id", none.alias("runs"), F.col("kept_sha256").alias("collapsed_sha256"), F.lit(None).cast("binary").alias("kept")
    )
    return whole.unionByName(_cut(some, with_words))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one and a hash of all, of the rows that ``find_runs`` returns."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ordered = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    longest = found.withColumn("_best", F.array_min(ordered)).select(
        "*",
        F.col("_best.s").cast("bigint").alias("start"),
        (-F.col("_best.l")).cast("bigint").alias("length"),
        F.col("_best.p").cast("bigint").alias("period"),
    )
    return longest.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
