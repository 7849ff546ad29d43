"""Benchmark decontamination by greedy string tiling.

Shared seeds (running Karp-Rabin hashes of five consecutive words) join documents with benchmark items. For each
pair that shares one, the longest common run is marked again and again, without overlaps, until no run of five
words is left; the marked words of the item over all its words are its coverage. Passages whose sentences
were reordered are covered piece by piece. An item counts as leaked from a coverage of one half.

The benchmark is the stated query set. It is held in blocks of a bounded number of words, every block against all
documents, each in one pass without a shuffle; documents never meet each other.

Words are runs of letters, digits and underscores, lower-cased, so punctuation and line breaks do not matter.
Defined cases: null or empty texts have no words; items of fewer than five words cannot be told from chance
and are not tested; an item_id that is null is reported as null; repeated items are reported each; documents
with a null or repeated doc_id are judged row by row, and all their columns are kept.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.llm import words
from hitflow.sources.staging import stage

SEED = 5
COVERAGE = 0.5
# Bytes of benchmark text in one block; the block travels to every task.
BLOCK_BYTES = 16_000_000

_WORD = re.compile(r"\w+")

HITS = "doc_id bigint, item_id bigint, n_tiles bigint, covered bigint, item_words bigint, coverage double"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def tiles(item: np.ndarray, doc: np.ndarray, pairs, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiling of ``item`` by ``doc`` as (item start, doc start, length), longest first.

    ``pairs`` are places (item, doc) at which equal seeds of ``least`` words start: all of them, or at least the first and
    the last of every run on a diagonal. The longest run is marked; a run that has lost words to marked ones returns
    with what is left of it. Ties go to the earlier place in the document, then in the item.
    """
    p, q = np.asarray(pairs, np.int64).reshape(-1, 2).T
    n, m = len(item), len(doc)
    # Hashes only propose; words decide.
    for k in range(least):
        same = item[p + k] == doc[q + k]
        p, q = p[same], q[same]
    if not len(p):
        return []
    first = (p == 0) | (q == 0) | (item[p - 1] != doc[q - 1])
    ends = (p + least == n) | (q + least == m)
    last = ends | (item[np.minimum(p + least, n - 1)] != doc[np.minimum(q + least, m - 1)])
    # In order of diagonals, and of places on them, first and last pairs take turns.
    at = (q - p) * n + p
    starts, stops = np.unique(at[first]), np.unique(at[last])
    p = starts % n
    runs = np.column_stack((starts - stops - least, starts // n + p, p))
    rows = _rows(runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))])
    in_item, in_doc = np.zeros(n, bool), np.zeros(m, bool)
    made, rest, left, ahead = [], [], n, next(rows, None)
    while left >= least and (rest or ahead):
        if rest and (ahead is None or rest[0] < ahead):
            size, q, p = heapq.heappop(rest)
        else:
            (size, q, p), ahead = ahead, next(rows, None)
        size = -size
        free = ~(in_item[p : p + size] | in_doc[q : q + size])
        if free.all():
            in_item[p : p + size] = in_doc[q : q + size] = True
            made.append((p, q, size))
            left -= size
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= least:
                heapq.heappush(rest, (start - end, q + start, p + start))
    return made


def _rows(table: np.ndarray, step: int = 4096) -> Iterator[tuple[int, ...]]:
    for k in range(0, len(table), step):
        yield from map(tuple, table[k : k + step].tolist())


class Block:
    """Items of one block, with the places of their seeds.

    The places of a seed are ordered by the word before it, and once more by the word behind it. A run on a diagonal
    begins where the words before differ and ends where the words behind differ, so its two ends are found by bisection
    and the pairs between them are never listed.
    """

    def __init__(self, items: list[tuple[int | None, str | None, int]]):
        self.vocabulary: dict[str, int] = {}
        # item_id, words, how often the row occurs
        self.items: list[tuple[int | None, np.ndarray, int]] = []
        numbers, places, seeds = [], [], []
        neighbours: tuple[list, list] = [], []
        for item_id, text, times in items:
            found = tokens(text)
            if len(found) < SEED:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found], np.int64)
            own = self._hashes(ids)
            seeds.append(own)
            numbers.append(np.full(len(own), len(self.items)))
            places.append(np.arange(len(own)))
            neighbours[0].append(np.concatenate(([self.EDGE], ids[:-SEED] + self.KNOWN)))
            neighbours[1].append(np.concatenate((ids[SEED:] + self.KNOWN, [self.EDGE])))
            self.items.append((item_id, ids, times))
        self.base = len(self.vocabulary) + self.KNOWN
        self.seeds, rank = np.unique(np.concatenate([np.empty(0, np.uint64), *seeds]), return_inverse=True)
        self.sides = []
        for side in neighbours if self.items else ():
            key = rank * self.base + np.concatenate(side)
            order = np.argsort(key, kind="stable")
            self.sides.append((key[order], np.concatenate(numbers)[order], np.concatenate(places)[order]))

    #: Codes of a neighbouring word: an item's edge, a document's edge or unknown word (never equal), then words.
    EDGE, OTHER, KNOWN = 0, 1, 2

    @staticmethod
    def _hashes(ids: np.ndarray) -> np.ndarray:
        return words.windows(words.mix(ids.astype(np.uint64)), SEED)

    def _ends(self, side: int, rank: np.ndarray, code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Item numbers, item places and document places of the pairs whose words on one side differ."""
        key, numbers, places = self.sides[side]
        own = rank * self.base
        low = np.concatenate((np.searchsorted(key, own), np.searchsorted(key, own + code, "right")))
        high = np.concatenate((np.searchsorted(key, own + code), np.searchsorted(key, own + self.base)))
        size = high - low
        index = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        return numbers[index], places[index], np.repeat(np.concatenate((at, at)), size)

    def leaks(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """Items that a text covers far enough: item_id, tiles, words covered, words."""
        if not text or not len(self.seeds):
            return []
        found = tokens(text)
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in found), np.int64, len(found))
        if len(ids) < SEED:
            return []
        # Only windows of benchmark words can be seeds.
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        at = np.flatnonzero(unknown[SEED:] == unknown[:-SEED])
        if not len(at):
            return []
        hashes = self._hashes(ids)[at]
        rank = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        shared = self.seeds[rank] == hashes
        at, rank = at[shared], rank[shared]
        around = np.concatenate(([self.OTHER], np.where(ids < 0, self.OTHER, ids + self.KNOWN), [self.OTHER]))
        firsts = self._ends(0, rank, around[at], at)
        lasts = self._ends(1, rank, around[at + SEED + 1], at)
        number, p, q = (np.concatenate(pair) for pair in zip(firsts, lasts))
        order = np.argsort(number, kind="stable")
        number, pairs = number[order], np.column_stack((p[order], q[order]))
        met, begin = np.unique(number, return_index=True)
        leaked = []
        for k, start, stop in zip(met.tolist(), begin.tolist(), [*begin[1:].tolist(), len(number)]):
            item_id, item, times = self.items[k]
            made = tiles(item, ids, pairs[start:stop])
            covered = sum(size for _, _, size in made)
            if covered >= COVERAGE * len(item):
                leaked += [(item_id, len(made), covered, len(item))] * times
        return leaked


def _blocks(benchmark: DataFrame) -> Iterator:
    """The benchmark in blocks of bounded size, each shipped once to each executor; equal rows are one with a count.

    Their number follows from the measured size. Yields (block, whether it is the only one).
    """
    items = benchmark.groupBy("item_id", "text").agg(F.count("*").alias("_times"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).orderBy("item_id", "text")
        rows = [tuple(r) for r in part.toLocalIterator()]
        yield benchmark.sparkSession.sparkContext.broadcast(rows), count == 1


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it leaks.

    With several blocks the hits of each are written down, and the block is released before the next one is read.
    """
    out = None
    for items, only in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            block = Block(items.value)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for item_id, n, covered, size in block.leaks(text.as_py()):
                        rows.append((doc_id, item_id, n, covered, size, covered / size))
                columns = list(zip(*rows)) if rows else [()] * 6
                kinds = [pa.int64()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "item_id", "n_tiles", "covered", "item_words", "coverage"],
                )

        hits = docs.select("doc_id", "text").mapInArrow(run, HITS)
        if not only:
            hits = stage(hits, "leaks")
            items.destroy()
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns; written down between blocks."""
    at = docs.columns.index("text")
    for items, only in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            block = Block(items.value)
            for batch in batches:
                yield batch.filter(pa.array([not block.leaks(text.as_py()) for text in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not only:
            docs = stage(docs, "without-leaks")
            items.destroy()
    return docs
