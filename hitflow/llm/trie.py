"""Prefix trie of conversations in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest is the exclusive-or of its turns' hashes, each with its place, in
two lanes of 64 bits, so a running window gives the digests of all prefixes and a node's parent is its digest without the
last turn.

1. Nodes are counted by digest, partially before the shuffle, so that common first turns are no hot keys.
2. A node's weight is the number of turns at and behind it in all its conversations, at least the size of its subtree. Its
   level says in which class of weights it lies: up to ``CELL``, then ``FAN`` times as much from level to level.
   Neighbouring nodes of one level are a cell; a cell has at most ``CELL`` nodes, or ``FAN`` for each depth.
3. Cells are hashed to tasks and packed into shards of bounded size. A shard enumerates its digests, gives each a slot of
   its own by minimal perfect hashing (``SlotTable``, verified against the digest stored there), scatters the counts into flat
   arrays by slot, and adds children to their parents' slots, the deepest first.
4. Levels go from the lightest to the heaviest: the sums at the tops of cells are what the next level adds to their parents. A
   corpus of any size has a handful of levels.
5. Conversations that end at a node are listed in order as pieces of bounded size, by tasks that hold ranges of (node,
   conversation), and hashed piece by piece. Only the hash itself is sequential; it holds one piece at a time.

Defined cases: a null role or text is empty; rows with a null conv_id belong to no conversation and are left out; turns of
equal number are ordered by a hash of role and text, and repeated rows are turns of their own; a null turn comes
first; a conversation without turns ends at the root; without any conversation there is no node, not even a root; other
columns are not read. Long texts are read once, for their hash and length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.llm.words import mix
from hitflow.sources.staging import stage

CELL, FAN = 100_000, 1_000
# Nodes of one shard, and conversation ids of one piece.
SHARD, PIECE = 200_000, 4_000

NODE = ["p1", "p2"]


class SlotTable:
    """Slots 0 .. n - 1 for n distinct digests of two lanes, without a collision.

    Every level hashes what is left into a field half as large again and keeps those that are alone in their cell; the
    slot is the number of taken cells before. A digest stored at its slot tells strangers apart.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        left, taken = np.arange(len(first)), 0
        slots = np.empty(len(first), np.int64)
        while len(left):
            if len(self.levels) == 200:
                raise ValueError("digests are not distinct")
            size = len(left) + len(left) // 2 + 1
            at = self._at(first[left], second[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.cumsum(alone) - alone
            placed = alone[at]
            slots[left[placed]] = taken + ranks[at[placed]]
            self.levels.append((size, alone, ranks, taken))
            taken += int(placed.sum())
            left = left[~placed]
        self.first, self.second = np.empty_like(first), np.empty_like(second)
        self.first[slots], self.second[slots] = first, second
        self.slots = slots

    @staticmethod
    def _at(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            salt = mix(np.array([level + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            return (mix(mix(first.view(np.uint64) ^ salt) + second.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slots of digests, -1 for those not in the table."""
        found = np.full(len(first), -1, np.int64)
        left = np.arange(len(first))
        for number, (size, alone, ranks, taken) in enumerate(self.levels):
            at = self._at(first[left], second[left], number, size)
            here = alone[at]
            found[left[here]] = taken + ranks[at[here]]
            left = left[~here]
        hit = np.flatnonzero(found >= 0)
        wrong = (self.first[found[hit]] != first[hit]) | (self.second[found[hit]] != second[hit])
        found[hit[wrong]] = -1
        return found


def rebuilt(conversations: DataFrame, graft: bool = True) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, depth, x1, x2, bytes) of their turns.

    With ``graft`` (the query's rule) each takes its first turns, up to eight by its number, from the conversation whose number
    is the multiple of five below.
    """
    named = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    hashed = named.select(
        "conv_id", "turn", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(7), "text", "role").alias("t2"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    own_order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    turns = stage(hashed.select("conv_id", F.row_number().over(own_order).alias("pos"), "t1", "t2", "bytes"), "trie-turns")
    ids = turns.where("pos = 1").select("conv_id")
    if graft:
        drawn = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
        base = turns.where("pos <= 8").select(F.col("conv_id").alias("_base"), "pos", "t1", "t2", "bytes")
        takers = ids.where("conv_id % 5 <> 0").select("conv_id", drawn.alias("_h"), F.expr("conv_id - conv_id % 5").alias("_taken"))
        taken = takers.join(base, (F.col("_taken") == F.col("_base")) & (F.col("pos") <= F.col("_h")))
        kept = turns.where((F.col("conv_id") % 5 == 0) | (F.col("pos") > drawn))
        turns = taken.select("conv_id", F.lit(0).alias("part"), "pos", "t1", "t2", "bytes").unionByName(
            kept.select("conv_id", F.lit(1).alias("part"), "pos", "t1", "t2", "bytes")
        )
    else:
        turns = turns.withColumn("part", F.lit(1))
    order = W.partitionBy("conv_id").orderBy("part", "pos")
    placed = turns.select("conv_id", F.row_number().over(order).alias("depth"), "t1", "t2", "bytes")
    return ids, placed.select(
        "conv_id", "depth", F.xxhash64("t1", "t2", "depth").alias("x1"), F.xxhash64("depth", "t2", "t1").alias("x2"), "bytes"
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """A row for every conversation and prefix: digests of it and of its parent, turns from here on, whether it ends."""
    order = W.partitionBy("conv_id").orderBy("depth")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    length = F.count("*").over(W.partitionBy("conv_id").orderBy("depth").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = turns.withColumn("p1", F.bit_xor("x1").over(upto)).withColumn("p2", F.bit_xor("x2").over(upto)).withColumn("_n", length)
    return rows.select(
        "conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("pp1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("pp2"),
        "bytes", F.expr("_n - depth + 1").alias("turns_left"),
    )


def _with_cells(prefixes: DataFrame, cell: int, fan: int) -> DataFrame:
    """Adds level and cell (digest of its top) to every row."""
    weights = prefixes.groupBy(*NODE).agg(F.sum("turns_left").alias("_weight")).where(F.col("_weight") > cell)
    classes = F.ceil(F.log(F.col("_weight") / float(cell)) / F.log(F.lit(float(fan))) - 1e-9).cast("int")
    heavy = weights.select(F.col("p1").alias("_p1"), F.col("p2").alias("_p2"), F.greatest(classes, F.lit(1)).alias("_level"))
    heavy = stage(heavy, "trie-heavy")
    rows = prefixes.join(heavy, (F.col("p1") == F.col("_p1")) & (F.col("p2") == F.col("_p2")), "left")
    rows = rows.withColumn("level", F.coalesce("_level", F.lit(0)))
    # Levels fall along a conversation, so a cell's top is the first of its level.
    of_level = W.partitionBy("conv_id", "level").orderBy("depth")
    return rows.withColumn("c1", F.first("p1").over(of_level)).withColumn("c2", F.first("p2").over(of_level)).drop("_p1", "_p2", "_level")


SOLVED = (
    "p1 bigint, p2 bigint, depth int, conv_id bigint, n_convs bigint, parent_conv_id bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, pp1 bigint, pp2 bigint, top boolean"
)


def solve_shard(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Sums over the subtrees of all nodes of a shard; ``in_`` columns are what other cells add to a node."""
    table = SlotTable(columns["p1"], columns["p2"])
    n = len(table.slots)

    def flat(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[table.slots] = values
        return out

    depth, conv_id, n_convs = flat(columns["depth"]), flat(columns["conv_id"]), flat(columns["n_convs"])
    parent = flat(table.find(columns["pp1"], columns["pp2"]))
    children, leaves = flat(columns["in_children"]), flat(columns["in_leaves"])
    saved = flat(columns["in_saved"]) + (n_convs - 1) * flat(columns["bytes"])
    inner = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[inner], 1)
    leaves[children == 0] = 1
    by_depth = inner[np.argsort(depth[inner], kind="stable")]
    edges = np.flatnonzero(np.diff(depth[by_depth], prepend=-1))
    for nodes in reversed(np.split(by_depth, edges[1:]) if len(by_depth) else []):
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    top = parent < 0
    return {
        "p1": table.first, "p2": table.second, "depth": depth, "conv_id": conv_id, "n_convs": n_convs, "parent_conv_id": conv_id[parent],
        "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "pp1": flat(columns["pp1"]), "pp2": flat(columns["pp2"]), "top": top,
    }


_INPUT = ["c1", "c2", "p1", "p2", "pp1", "pp2", "depth", "n_convs", "conv_id", "bytes", "in_children", "in_leaves", "in_saved"]


def _solved(nodes: DataFrame, shard: int, partitions: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
            found = solve_shard({name: np.concatenate([p[name] for p in parts]) for name in _INPUT})
            arrays = [
                pa.array(found[f], pa.bool_() if f == "top" else pa.int32() if f == "depth" else pa.int64(), mask=found["top"] if f == "parent_conv_id" else None)
                for f in found
            ]
            return pa.RecordBatch.from_arrays(arrays, list(found))

        held: list[dict[str, np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(_INPUT)}
            if held and size >= shard:
                # A shard ends where the first cell that starts in this batch does.
                last = held[-1]
                same = (part["c1"] == last["c1"][-1]) & (part["c2"] == last["c2"][-1])
                cut = len(same) if same.all() else int(np.argmin(same))
                held.append({name: values[:cut] for name, values in part.items()})
                part = {name: values[cut:] for name, values in part.items()}
                if len(part["c1"]):
                    yield answer(held)
                    held, size = [], 0
            if len(part["c1"]):
                held.append(part)
                size += len(part["c1"])
        if held:
            yield answer(held)

    return nodes.repartition(partitions, "c1", "c2").sortWithinPartitions("c1", "c2", "depth").select(*_INPUT).mapInArrow(run, SOLVED)


def _end_hashes(ends: DataFrame, piece: int) -> DataFrame:
    """SHA-256 of the ids, in order, of (p1, p2, conv_id) for every node."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p1", "p2", "first", "ids"]
        kinds = [pa.int64()] * 3 + [pa.string()]
        for batch in batches:
            rows: list[tuple] = []
            held: list[str] = []
            node, first = None, 0
            for p1, p2, conv_id in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and (node != (p1, p2) or len(held) == piece):
                    rows.append((*node, first, ",".join(held)))
                    held = []
                if not held:
                    node, first = (p1, p2), conv_id
                held.append(str(conv_id))
            if held:
                rows.append((*node, first, ",".join(held)))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["e1", "e2", "ends_sha256"])

        for batch in batches:
            for p1, p2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if node == (p1, p2):
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (p1, p2), hashlib.sha256(ids.encode())
            yield flush()
            rows.clear()
        if node is not None:
            rows.append((*node, state.hexdigest()))
            yield flush()

    partitions = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ends.select("p1", "p2", "conv_id").repartitionByRange(partitions, "p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    pieces = ordered.mapInArrow(listed, "p1 bigint, p2 bigint, first bigint, ids string")
    together = pieces.repartition(partitions, "p1", "p2").sortWithinPartitions("p1", "p2", "first")
    return together.mapInArrow(hashed, "e1 bigint, e2 bigint, ends_sha256 string")


def trie(conversations: DataFrame, graft: bool = True, cell: int = CELL, fan: int = FAN, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids, turns = rebuilt(conversations, graft)
    prefixes = stage(_prefixes(turns), "trie-prefixes")
    nodes = (
        _with_cells(prefixes, cell, fan)
        .groupBy(*NODE, "pp1", "pp2", "depth", "level", "c1", "c2", "bytes")
        .agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    )
    nodes = stage(nodes, "trie-nodes")
    levels = sorted(r.level for r in nodes.select("level").distinct().collect())
    solved = None
    for level in levels:
        own = nodes.where(F.col("level") == level)
        if solved is None:
            own = own.select("*", *(F.lit(0).cast("bigint").alias(c) for c in ("in_children", "in_leaves", "in_saved")))
        else:
            added = solved.where("top").groupBy(F.col("pp1").alias("_p1"), F.col("pp2").alias("_p2")).agg(
                F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved")
            )
            own = own.join(added, (F.col("p1") == F.col("_p1")) & (F.col("p2") == F.col("_p2")), "left").na.fill(0, ["in_children", "in_leaves", "in_saved"])
        now = stage(_solved(own, shard, partitions), "trie-level")
        solved = now if solved is None else solved.unionByName(now)
    if solved is None:
        solved = conversations.sparkSession.createDataFrame([], SOLVED)
    smallest = ids.agg(F.min("conv_id").alias("_all"), F.count("*").alias("_count"))
    # Parents of cell tops lie in other cells; those of first turns are the root.
    parents = nodes.where("level > 0").select(F.col("p1").alias("_p1"), F.col("p2").alias("_p2"), F.col("conv_id").alias("_parent"))
    tops = solved.where("top and depth > 1").drop("parent_conv_id").join(parents, (F.col("pp1") == F.col("_p1")) & (F.col("pp2") == F.col("_p2")))
    first = smallest.head()
    below = solved.where("not top").unionByName(tops.withColumnRenamed("_parent", "parent_conv_id").drop("_p1", "_p2")).unionByName(
        solved.where("top and depth = 1").withColumn("parent_conv_id", F.lit(first["_all"]).cast("bigint"))
    )
    turnless = ids.join(prefixes.where("depth = 1").select(F.col("conv_id").alias("_with")), F.col("conv_id") == F.col("_with"), "left_anti")
    ends = prefixes.where("turns_left = 1").select("p1", "p2", "conv_id").unionByName(
        turnless.select(F.lit(0).cast("bigint").alias("p1"), F.lit(0).cast("bigint").alias("p2"), "conv_id")
    )
    root = solved.where("depth = 1").agg(
        F.count("*").alias("n_children"), F.greatest(F.coalesce(F.sum("n_leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    ).select(
        F.lit(0).cast("bigint").alias("p1"), F.lit(0).cast("bigint").alias("p2"), F.lit(0).alias("depth"), F.lit(first["_all"]).cast("bigint").alias("conv_id"),
        F.lit(first["_count"]).cast("bigint").alias("n_convs"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_children", "n_leaves", "saved_tokens",
    ).where("n_convs > 0")
    shared = ["p1", "p2", "depth", "conv_id", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
    hashes = _end_hashes(ends, piece)
    found = below.select(*shared).unionByName(root.select(*shared)).join(hashes, (F.col("p1") == F.col("e1")) & (F.col("p2") == F.col("e2")), "left")
    return found.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


TRIE_SQL = """
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295::UBIGINT, list_reduce(
           list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda crc, byte: list_reduce(
             list_concat([xor(crc, byte)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT))))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)
), turns AS (
  SELECT i.conv_id, 0 AS part, n.pos, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.base AND n.pos <= i.h
  UNION ALL
  SELECT i.conv_id, 1, n.pos, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.pos > i.h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM turns
), prefixes AS (
  SELECT conv_id, depth, text, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         depth = max(depth) OVER (PARTITION BY conv_id) AS last
  FROM placed
  UNION ALL
  SELECT conv_id, 0, '', [], conv_id NOT IN (SELECT conv_id FROM placed) FROM ids
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * strlen(any_value(text)) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM prefixes GROUP BY path
), children AS (
  SELECT list_slice(path, 1, depth - 1) AS parent, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), marked AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.path = c.parent
), above AS (
  SELECT list_slice(path, 1, k) AS top, saved, n_children
  FROM (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS k FROM marked)
), sums AS (
  SELECT top, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM above GROUP BY top
)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums s ON m.path = s.top
LEFT JOIN nodes p ON m.depth > 0 AND p.path = list_slice(m.path, 1, m.depth - 1)
"""
