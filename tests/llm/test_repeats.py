"""Byte repeats, prefix tries and periodic runs against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitflow.llm import byterepeats, periods, queries, trie
from hitflow.llm.runindex import RunIndex
from tests.llm.test_corpus import odd_documents
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


# --- byte repeats


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.binary(max_size=40) | st.text("ab", max_size=60).map(str.encode) | st.just(b"abcabcabcabc" * 4), min_size=1, max_size=8),
    st.integers(1, 20),
)
def test_matching_statistics_mark_what_stands_twice(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    expected = [e for t in texts for e in [*(i + length <= len(t) and counts[t[i : i + length]] > 1 for i in range(len(t))), False]]
    assert RunIndex(texts).repeated(length).tolist() == expected


def test_repetitive_texts_have_few_runs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, 300).astype(np.uint8).tobytes()
    index = RunIndex([base[: 250 + i % 50] for i in range(400)])
    assert len(index.head) < index.size / 20


def _without_repeats(rows):
    texts = [(r.text or "").encode() for r in rows]
    size = byterepeats.LENGTH
    counts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if counts[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(g and not b for b, g in zip(b"\0" + gone, gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((r.doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("group", [byterepeats.GROUP, 1])
def test_byte_repeats_equal_brute_force(spark, group):
    docs = queries.table(spark, SF_DIR, "documents")
    found = byterepeats.remove_repeats(docs, group=group).drop("kept")
    assert Counter(tuple(r) for r in found.collect()) == _without_repeats(docs.collect())


def test_byte_repeats_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    prose = " ".join(f"w{x}" for x in rng.integers(0, 5000, 400))
    texts = [prose, "é" * 300, None, "", "x" * 199, "y" * 201, "head:" + prose[300:900] + ":tail", prose[:260] + "#" + prose[261:700], "ab " * 5000]
    df = odd_documents(spark, texts)
    found = byterepeats.remove_repeats(df, with_bytes=True)
    assert Counter(tuple(r)[:-1] for r in found.collect()) == _without_repeats(df.collect())
    kept = {r.doc_id: bytes(r.kept) for r in found.collect() if r.doc_id in (4, 6)}
    assert kept == {4: b"x" * 199, 6: b"head::tail"}
    assert byterepeats.remove_repeats(df.where("false")).count() == 0


def test_chunks_of_a_long_text_give_the_same_anchors(monkeypatch):
    text = np.random.default_rng(2).integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = byterepeats.anchors(text)
    monkeypatch.setattr(byterepeats, "CHUNK", 700)
    parts = byterepeats.anchors(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


# --- tries


def test_slots_are_a_bijection_that_knows_strangers():
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(-(2**62), 2**62, 5000))
    first, second = keys[:4000], keys[:4000][::-1].copy()
    table = trie.SlotTable(first, second)
    assert sorted(table.slots.tolist()) == list(range(4000))
    assert (table.find(first, second) == table.slots).all()
    assert (table.find(keys[4000:], keys[4000:]) == -1).all()
    assert (table.find(first, first) >= 0).sum() == (first == second).sum()
    with pytest.raises(ValueError):
        trie.SlotTable(np.array([1, 1]), np.array([2, 2]))


@pytest.mark.parametrize("limits", [{}, {"cell": 5, "fan": 2, "shard": 3, "piece": 2}])
def test_trie_equals_its_sql(spark, limits):
    conversations = queries.table(spark, SF_DIR, "conversations")
    assert difference(trie.trie(conversations, **limits), connect(SF_DIR), trie.TRIE_SQL) is None


def _trie(rows):
    """The query's contract, node by node."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found, key=lambda t: t[:2])] for c, found in turns.items()}
    built = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h]) + tuple(found[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for path, cs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(c for c in cs if built[c] == path))
        out.append((
            min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), sum(len(p) == len(path) + 1 for p in below),
            sum(all(q[:-1] != p for q in members if q) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"cell": 4, "fan": 3, "shard": 2, "piece": 1}])
def test_trie_of_odd_rows(spark, limits):
    rows = [(c, t, "user" if t % 2 else None, "é" if t % 3 == 0 else None) for c in range(12) for t in range(c % 7)]
    rows += [(100 + c, t, "user", f"t{t}") for c in range(30) for t in range(1 + c // 10)]
    rows += [(200, None, None, "first"), (200, 0, "a", "b"), (None, 1, "x", "y"), (201, 3, "user", "long " * 10_000), (7, 0, "u", "own")]
    schema = "conv_id bigint, turn bigint, role string, text string, depth string, p1 string, n_convs int"
    df = spark.createDataFrame([(*r, "own", "own", 1) for r in rows], schema)
    assert Counter(tuple(r) for r in trie.trie(df, **limits).collect()) == _trie(rows)
    assert trie.trie(df.where("false")).count() == 0
    twice = spark.createDataFrame([(5, 0, "u", "a"), (5, 0, "u", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert sorted(r.depth for r in trie.trie(twice, graft=False).collect()) == [0, 1, 2]


# --- periodic runs


def _runs(numbers):
    n, found = len(numbers), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if numbers[i] != numbers[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and numbers[i] == numbers[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=25), st.integers(1, 12)), max_size=4), st.sampled_from([1, 60, periods.TILE]))
def test_stitched_tiles_equal_brute_force(parts, tile):
    numbers = [x for part, times in parts for x in part * times]
    by_period = defaultdict(list)
    for q, a, b in zip(*(c.tolist() for c in periods.fragments(np.array(numbers, np.int64), tile))):
        by_period[q].append((a, b))
    found = {}
    for q in sorted(by_period):
        stretches = []
        for a, b in sorted(by_period[q]):
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = max(b, stretches[-1][1])
            else:
                stretches.append([a, b])
        for a, b in stretches:
            if b - a >= max(q, 12 - q):
                found.setdefault((a, b + q), q)
    assert sorted((s, e - s, q) for (s, e), q in found.items()) == _runs(numbers)


def _collapsed(doc_id, text, plant):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in sorted((s, q, length) for s, length, q in runs))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_runs_equal_brute_force(spark):
    short = queries.table(spark, SF_DIR, "documents").where("length(text) < 6000")
    got = [tuple(r) for r in periods.digests(periods.find_runs(short, plant=True)).collect()]
    assert Counter(got) == Counter(_collapsed(r.doc_id, r.text, True) for r in short.collect())
    assert sum(r[1] > 0 for r in got) > 10


@pytest.mark.parametrize("tile", [40, periods.TILE])
def test_periodic_runs_of_odd_rows(spark, tile):
    texts = ["a " * 11, "a " * 12, None, "", "x " + "a b\x0bc  " * 40, "one two " * 200 + "one " * 30, " ".join(str(i % 97) for i in range(500)), "ab " * 900 + "ba " * 800]
    df = odd_documents(spark, texts).withColumnRenamed("size", "runs").withColumnRenamed("target", "node")
    got = [tuple(r) for r in periods.digests(periods.find_runs(df, tile=tile)).collect()]
    assert Counter(got) == Counter(_collapsed(r.doc_id, r.text, False) for r in df.collect())
    assert periods.digests(periods.find_runs(df.where("false"))).count() == 0


def test_query_of_all_documents_keeps_every_row(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    assert queries.op13_periodic_runs(spark, SF_DIR).select("doc_id").distinct().count() == docs.count()
