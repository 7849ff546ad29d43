"""Operators over whole tables: chat, tokens, decontamination, quality, substrings, mixing, near copies, the pipeline."""

import hashlib
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from hitflow.llm import chat, coder, mixing, near, quality, queries, substrings, tiling, tokens
from hitflow.session import shared_dir
from hitflow.sources.staging import stage
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, component_id int, target string, n_words string"


def odd_documents(spark, texts):
    """Rows with nulls, repeats and columns that clash with those of results."""
    rows = [(i, t, None if i == 1 else "en", None if i == 2 else "s", None, "own", 1, "own", "own") for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[0], "en", "s", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}


# --- chat


def test_chat_equals_its_sql(spark):
    assert difference(queries.op2_chat_formatting(spark, SF_DIR), connect(SF_DIR), chat.COLLAPSE_SQL) is None


def test_snapshots_collapse(spark):
    def conversation(conv_id, texts):
        return [(conv_id, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    rows = conversation(5, "ab") + conversation(4, "abc") + conversation(3, "abc") + conversation(9, "abd") + conversation(8, "b")
    rows += [(None, None, None, None), (7, 0, "user", "<|im_end|> x"), (7, 0, "user", "<|im_end|> x")]
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.collapse(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert set(got) == {3, 9, 8, None, 7}
    assert got[3] == (3, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n")
    assert got[7][0] == 2 and got[7][1].count(chat.CLOSE) == 2
    assert chat.collapse(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_marks_in_roles_and_texts_close_no_turn(spark):
    rows = [(1, 0, "user<|im_end|>", "a<|im_start|>system", "own", 5), (1, 1, None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, place string, n_turns int")
    [got] = chat.collapse(turns).collect()
    assert got.text == "<|im_start|>user< |im_end| >\na< |im_start| >system<|im_end|>\n<|im_start|>\n<|im_end|>\n"
    assert got.n_turns == 2
    con = duckdb.connect()
    con.register("conversations", turns.toPandas())
    assert difference(chat.collapse(turns), con, chat.COLLAPSE_SQL) is None


# --- tokens


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 65534), max_size=5000), st.integers(1, 3))
def test_coder_round_trip(ids, repeat):
    ids = np.array(ids * repeat, np.int64)
    data = coder.encode(ids)
    assert (coder.decode(data) == ids).all()


def test_coded_ids_are_smaller_than_their_entropy_and_than_zlib():
    """All documents of a table: below zlib on 16-bit ids and below order-0 entropy, header and checksums included."""
    texts = connect("/root/testdata/sf0.01").execute("SELECT text FROM documents ORDER BY doc_id").fetchall()
    own = tokens.Encoder(tokens.default_tokenizer())
    ids = np.frombuffer(b"".join(x + b"\1\0" for x in own.encode([t for t, in texts])), "<u2")
    shares = np.bincount(ids)[np.unique(ids)] / len(ids)
    bits = 8 * len(coder.encode(ids)) / len(ids)
    assert bits < -(shares * np.log2(shares)).sum()
    assert bits < 8 * len(zlib.compress(ids.tobytes(), 9)) / len(ids)


def test_coding_takes_no_longer_than_a_microsecond_an_id():
    """Both ways, on a full segment of words in several vocabularies; the coder before took 1.4 on ids of documents."""
    rng = np.random.default_rng(5)
    topic = np.repeat(rng.integers(0, 4, 1 << 10), 1 << 11)
    ids = topic * 4000 + rng.zipf(1.3, len(topic)) % 4000
    start = time.process_time()
    data = coder.encode(ids)
    assert (coder.decode(data) == ids).all()
    assert time.process_time() - start < len(ids) * 1e-6
    # What follows an id depends on its class, so the four vocabularies cost no two bits an id.
    shares = np.unique(ids, return_counts=True)[1] / len(ids)
    assert 8 * len(data) / len(ids) < -(shares * np.log2(shares)).sum() - 1


def test_carries_reach_units_that_were_sent():
    """A last id that is very likely after many unlikely ones, over many blocks, carries through full units."""
    rng = np.random.default_rng(6)
    for high in (2, 3, 60000):
        ids = np.where(rng.random(300 * coder.BLOCK + 9) < 0.999, high, rng.integers(0, 65535, 300 * coder.BLOCK + 9))
        data = coder.encode(ids)
        assert (coder.decode(data) == ids).all()
        assert (coder.decode(data, slice(7, 9)) == ids[7 * coder.BLOCK : 9 * coder.BLOCK]).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("aZéÿß .!|x1'ﬁ\u0301\t\n\x1c日", max_size=30) | st.none(), max_size=8), st.integers(1, 3))
def test_texts_encode_alike_alone_and_in_columns_cut_anywhere(texts, cache):
    own = tokens.Encoder(tokens.default_tokenizer())
    assert own.closes and own.by_word and own.lowers
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(tokens, "JOINED", 2)
        patched.setattr(tokens, "MAX_CACHE", cache)
        whole = [own.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == whole
        ids, lengths = own.encode_column(pa.array(["a b", *texts], pa.string()).slice(1))
        assert ids.tolist() == sum(whole, []) and lengths.tolist() == list(map(len, whole))


def test_tokenisers_of_another_kind_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    cased = Tokenizer(models.WordLevel({"Ab": 0, "ab": 1, " ": 2, "[UNK]": 3}, unk_token="[UNK]"))
    cased.pre_tokenizer = pre_tokenizers.Split(" ", "isolated")
    cased.save(str(tmp_path / "cased.json"))
    own = tokens.Encoder(str(tmp_path / "cased.json"))
    for text in ("Ab ab", "ab", " Ab", "x  ab", ""):
        assert own.encode([text])[0] == np.array(cased.encode(text).ids, "<u2").tobytes()


def test_blocks_decode_alone_and_damage_is_seen():
    ids = np.random.default_rng(3).zipf(1.5, 3 * coder.BLOCK + 7) % 4000
    data = coder.encode(ids)
    assert len(data) < 2 * len(ids)
    assert (coder.decode(data, slice(2, 4)) == ids[2 * coder.BLOCK :]).all()
    for place in (0, len(data) // 2, len(data) - 1):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(broken))
    with pytest.raises(ValueError):
        coder.decode(data[:-2])
    with pytest.raises(ValueError):
        coder.encode(np.array([65535]))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_like_the_whole_text(text):
    own = tokens.Encoder(tokens.default_tokenizer())
    whole = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode([text])[0], "<u2").tolist() == whole


def _expected_tokens(rows):
    encoder = tokens.Encoder(tokens.default_tokenizer())
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_a_plain_encoding(spark, documents, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 20_000)
    got = [tuple(r) for r in queries.op3_token_ids(spark, SF_DIR).orderBy("start").collect()]
    assert got == _expected_tokens(sorted(documents.items()))


def test_token_files_of_odd_rows(spark):
    df = odd_documents(spark, ["a b c <|endoftext|> d", "", None, "Zürich " * 3000])
    got = tokens.round_trip(df).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 0, 0, 1, 2, 3]
    assert Counter((r.n_tokens, r.ids_crc32) for r in got) == Counter(
        r[2:] for r in _expected_tokens([(r.doc_id, r.text) for r in df.collect()])
    )
    assert tokens.round_trip(df.where("false")).count() == 0


# --- decontamination


def _greedy(item, doc, least):
    """Tiles by looking at every pair of places, again and again."""
    used_i, used_d, made = set(), set(), []
    while True:
        best = None
        for q in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while p + n < len(item) and q + n < len(doc) and item[p + n] == doc[q + n] and p + n not in used_i and q + n not in used_d:
                    n += 1
                if n >= least and (best is None or (-n, q, p) < best):
                    best = (-n, q, p)
        if best is None:
            return sum(m[2] for m in made)
        n, q, p = -best[0], best[1], best[2]
        used_i |= set(range(p, p + n))
        used_d |= set(range(q, q + n))
        made.append((p, q, n))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=14), st.lists(st.integers(0, 2), max_size=20))
def test_tiling_equals_greedy_search(item, doc):
    pairs = [(p, q) for p in range(len(item) - 2) for q in range(len(doc) - 2) if item[p : p + 3] == doc[q : q + 3]]
    made = tiling.tiles(np.array(item, np.int64), np.array(doc, np.int64), pairs, least=3)
    assert sum(n for _, _, n in made) == _greedy(item, doc, 3)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("ab"), min_size=5, max_size=16), min_size=1, max_size=4),
    st.lists(st.sampled_from("abc"), max_size=40),
)
def test_run_ends_by_bisection_give_the_same_tiles(items, doc):
    block = tiling.Block([(n, " ".join(item), 1) for n, item in enumerate(items)])
    got = {n: covered for n, _, covered, _ in block.leaks(" ".join(doc))}
    covers = {n: _greedy(item, doc, tiling.SEED) for n, item in enumerate(items)}
    assert got == {n: c for n, c in covers.items() if c >= tiling.COVERAGE * len(items[n])}


def test_one_repeated_word_stays_small():
    block = tiling.Block([(1, "word " * 1_000, 1), (2, "left right " * 500, 1)])
    tracemalloc.start()
    assert block.leaks("word " * 20_000) == [(1, 1, 1_000, 1_000)]
    assert block.leaks("right left " * 10_000) == [(2, 1, 1_000, 1_000)]
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()


def test_repeated_items_are_reported_each(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, "a b c d e f")] * 3 + [(6, "b c d e f g")], "item_id bigint, text string")
    assert sorted(r.item_id for r in tiling.leaks(docs, bench).collect()) == [5, 5, 5, 6]


def test_reordered_passages_are_leaks(spark, monkeypatch):
    item = "one two three four five six seven. Eight nine ten eleven twelve thirteen fourteen."
    texts = [
        "Start EIGHT nine ten, eleven\ntwelve thirteen fourteen and then one two three four five six seven end",
        "one two three four other words only here and there six seven eight",
        None,
        "",
    ]
    docs = odd_documents(spark, texts)
    bench = spark.createDataFrame([(1, item), (2, "too short"), (None, None), (3, "")], "item_id bigint, text string")
    for size in (tiling.BLOCK_BYTES, 30):  # one block, and several
        monkeypatch.setattr(tiling, "BLOCK_BYTES", size)
        got = tiling.leaks(docs, bench).collect()
        assert sorted((r.doc_id is None, r.item_id, r.n_tiles, r.coverage) for r in got) == [(False, 1, 2, 1.0)] * 2 + [(True, 1, 2, 1.0)]
        kept = tiling.drop_leaks(docs, bench)
        assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert tiling.leaks(docs, bench.where("false")).count() == 0
    assert tiling.leaks(docs.where("false"), bench).count() == 0


def test_leaks_equal_brute_force(spark, documents):
    items = {r.item_id: tiling.tokens(r.text) for r in queries.table(spark, SF_DIR, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): r.covered for r in queries.op4_decontamination(spark, SF_DIR).collect()}
    seeds = defaultdict(set)
    for i, w in items.items():
        for p in range(len(w) - 4):
            seeds[tuple(w[p : p + 5])].add(i)
    expected = {}
    for d, text in documents.items():
        w = tiling.tokens(text)
        near_items = set().union(*(seeds.get(tuple(w[q : q + 5]), set()) for q in range(max(0, len(w) - 4))), set())
        for i in near_items:
            places = [q for q in range(len(w) - 4) if i in seeds.get(tuple(w[q : q + 5]), ())]
            part = w[max(0, places[0] - 80) : places[-1] + 80]
            if len(part) < 1500 and (covered := _greedy(items[i], part, 5)) >= tiling.COVERAGE * len(items[i]):
                expected[d, i] = covered
    assert expected and got == expected


# --- quality


def _measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)


def test_quality_counts_equal_brute_force(spark, documents):
    for row in queries.op5_quality_rules(spark, SF_DIR).collect():
        expected = _measures(documents[row.doc_id])
        assert tuple(row)[1:6] == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (row.kept and row.base_failed)


def test_quality_of_odd_rows(spark):
    df = odd_documents(spark, ["a b c a b c " * 10, "", None, "  x\x0by\r\n\n \ny\ny | <b>", "w " * 3 + "é\n" * 3])
    got = Counter(tuple(r)[2:7] for r in quality.measure_table(df).select("doc_id", "stratum", *quality.COUNTS).collect())
    assert got == Counter(_measures(r.text) for r in df.collect())
    kept = quality.accepted(df, queries.table(spark, SF_DIR, "labels").where("false"))
    assert kept.columns == df.columns and kept.count() == 0
    assert quality.measure_table(df.where("false")).count() == 0


def _binomial_tail(k, n, p):
    from math import comb

    return sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_cutoffs_are_the_smallest_proven_ones(spark):
    rows, labels = [], []
    for i in range(900):
        good = i % 3 != 0
        symbols = (i % 100 == 1) * 10 if good else 5 + i % 40
        rows.append((i, "en", 100, 600, symbols, 0, 0, 1))
        labels.append((i, int(good)))
    labels += [(1, 0), (None, 1), (5, None)]
    measured = spark.createDataFrame(rows, "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint")
    risk = quality.Risk(alpha=0.05, delta=0.05, grid=10)
    cuts = {r.measure: r for r in quality.cutoffs(measured, spark.createDataFrame(labels, "doc_id bigint, quality int"), risk).collect()}
    good = [r[4] / 100 for r in rows if r[0] % 3 and r[0] not in (1,)]
    best = cuts["symbols"]
    assert best.n == len(good) and best.rejected == sum(v >= best.cutoff for v in good)
    assert _binomial_tail(best.rejected, best.n, risk.alpha) <= risk.delta
    assert _binomial_tail(0, 20, 0.05) > 0.05
    few = quality.cutoffs(measured.where("doc_id < 20"), spark.createDataFrame(labels, "doc_id bigint, quality int"), risk)
    assert few.count() == 0  # too few labels prove nothing


def test_cutoffs_count_every_labelled_document(spark):
    rows = spark.range(66_000).selectExpr("id as doc_id", "int(id % 3 > 0) as good")
    counts = ("100L as n_words", "600L as word_chars", "0L as n_dup_lines", "0L as n_repeat_words", "1L as n_lines")
    measured = rows.selectExpr("doc_id", "'en' as stratum", *counts, "if(good = 0, 5 + doc_id % 40, 0L) as n_symbols")
    labels = rows.selectExpr("doc_id", "good as quality")
    cuts = {r.measure: r for r in quality.cutoffs(measured, labels).collect()}
    assert cuts["symbols"].n == 44_000


def test_counts_of_texts_with_any_edge(spark):
    edges = ["\t", "\n", "\x0b", "\f", "\r", " ", *"fntrb", "\x1c", "\x85", "\xa0", ""]
    texts = [a + "foo bar half" + b for a in edges for b in edges] + ["f " * 60, "\f\x0b", "f", " f", "b\\f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang", F.lit("x"))
    got = {r.doc_id: (r.n_words, r.word_chars) for r in quality.measure_table(df).collect()}
    for i, text in enumerate(texts):
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert got[i] == (len(own), sum(map(len, own))), repr(text)


# --- substrings


def _without_repeats(rows):
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (text or "").encode().split()
        for s in range(len(w) - 49):
            first.setdefault(tuple(w[s : s + 50]), doc_id)
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        gone = {s + k for s in range(len(w) - 49) if doc_id is not None and first[tuple(w[s : s + 50])] < doc_id for k in range(50)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("subtree", [substrings.SUBTREE, 1])
def test_removed_words_equal_brute_force(spark, documents, subtree):
    got = substrings.remove_repeats(queries.table(spark, SF_DIR, "documents"), subtree).drop("kept")
    assert Counter(map(tuple, got.collect())) == _without_repeats(list(documents.items()))


def test_substrings_equal_their_sql(spark):
    assert difference(queries.op7_substring_dedup(spark, SF_DIR), connect(SF_DIR), substrings.REPEATS_SQL) is None


@pytest.mark.parametrize("subtree", [substrings.SUBTREE, 1])
def test_substrings_of_odd_rows(spark, subtree):
    passage = " ".join(f"w{i}" for i in range(60))
    loop = "x y " * 60
    texts = [f"a {passage} b", f"c\t{passage}\nd {passage}", None, "", loop, loop + "z", f"{passage} w60", " ".join(f"w{i}" for i in range(49))]
    df = odd_documents(spark, texts)
    got = substrings.remove_repeats(df, subtree, with_text=True).collect()
    assert Counter(tuple(r)[:4] for r in got) == _without_repeats([(r.doc_id, r.text) for r in df.collect()])
    assert substrings.remove_repeats(df.where("false")).count() == 0


# --- mixing


def _targets(sizes):
    total, open_, out = sum(sizes.values()), set(sizes), {}
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left = total
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 3 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def _check_mix(rows, tolerance):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
    targets = _targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= tolerance(s)


@pytest.mark.parametrize("bucket_rows", [mixing.BUCKET_ROWS, 4])
def test_mix_meets_its_targets(spark, documents, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    source = {r.doc_id: r.source for r in queries.table(spark, SF_DIR, "documents").collect()}
    got = queries.op8_source_mixing(spark, SF_DIR).collect()
    again = queries.op8_source_mixing(spark, SF_DIR).collect()
    assert sorted(got) == sorted(again)
    rows = [r.asDict() | {"source": source[r.doc_id]} for r in got]
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", documents[r["doc_id"]])) for r in rows)
    largest = defaultdict(int)
    for r in rows:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    _check_mix(rows, lambda s: largest[s])


def test_mix_of_odd_rows_and_capped_sources(spark):
    schema = "doc_id bigint, source string, text string, size string, target string, bucket int"
    rows = [(i, "a", "w " * 10, "x", "y", 1) for i in range(300)] + [(1000 + i, "b", "w", "x", "y", 1) for i in range(5)]
    rows += [(2000, None, "w w w", None, None, None), (2001, None, None, None, None, None), (None, "c", "", None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = mixing.mix(df).collect()
    source = {r[0]: r[1] for r in rows}
    _check_mix([r.asDict() | {"source": source[r.doc_id]} for r in got], lambda s: 10)
    assert {r.taken for r in got if source[r.doc_id] == "b"} == {3}
    mix = mixing.mixed(df)
    assert mix.columns == df.columns
    copies = Counter(r.doc_id for r in mix.collect())
    assert copies == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})
    assert mixing.mix(df.where("false")).count() == mixing.mixed(df.where("false")).count() == 0


def test_mix_draws_rows_without_an_id_and_equal_rows_each_for_itself(spark):
    schema = "doc_id bigint, source string, text string"
    rows = [(None, "a", f"null {i} x y") for i in range(500)] + [(7, "b", "w " * 4)] * 500 + [(i, "c", "w " * 4) for i in range(1500)]
    df = spark.createDataFrame(rows, schema)
    got = mixing.mix(df).collect()
    # Keys of equal rows differ, so each source comes near its target.
    for size in {r.source_size for r in got}:
        part = [r for r in got if r.source_size == size]
        taken, target = sum(r.taken for r in part), sum({r.target for r in part})
        assert abs(taken - target) <= 8
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(5)).collect()))
    assert sum(r.taken for r in got) == 4 * mixing.mixed(df).count()


def test_buckets_are_even_for_any_weight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 500)
    texts = ["# $ % & |", "plain words without any sign at all", "some # of it is a sign"]
    rows = [(i, "code" if i % 2 else "prose", texts[0 if i % 2 else i % 3]) for i in range(20_000)]
    draws = mixing.stage(mixing.drawn(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).drop("text"), "draws")
    placed = mixing.with_plan(draws, mixing.plan(draws))
    counts = placed.groupBy("source", "bucket").count().collect()
    assert len(counts) == 40 and max(r["count"] for r in counts) <= 3 * 500


# --- near copies


def _shingle_sets(rows, size):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets = []
    for doc_id, text in rows:
        w = (text or "").encode().translate(lower).split()
        sets.append((doc_id, {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
    return sets


def _components(sets):
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in parent}


def test_near_copies_equal_brute_force(spark, documents):
    sets = _shingle_sets(documents.items(), 4)
    expected = _components(sets)
    got = queries.op10_near_dedup(spark, SF_DIR).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (d, len(s), expected[d], expected[d] == d) for d, s in sets
    }


def test_chains_and_hubs_of_copies(spark):
    base = [f"w{i}" for i in range(60)]
    texts = []
    for step in range(12):  # each next to its neighbours, the ends far apart
        texts.append(" ".join(base[:step] and [f"v{i}" for i in range(step)] + base[step:] or base))
    texts += [" ".join([*base[:30], f"x{k}", *base[31:]]) for k in range(20)]
    texts += ["one two", "One TWO", "one two three", "", None, "a b c d e", "a b c d e f", "a b c d e f g h"]
    df = odd_documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets = _shingle_sets(rows, 4)
    expected = _components(sets)
    got = near.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        (d, len(s), expected.get(d), d is None or expected[d] == d) for d, s in sets
    )
    kept = near.drop_near_duplicates(df, 4)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*set(expected.values()), None, None])
    assert near.near_duplicates(df.where("false")).count() == 0


def _varied(rng, base, count, edits):
    out = []
    for _ in range(count):
        own = list(base)
        for at in rng.choice(len(base), edits, replace=False):
            own[at] = f"z{rng.integers(10**9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("exhaustive", [False, True])
def test_links_around_the_threshold_are_found(spark, exhaustive):
    """Groups whose members are near their origin, but many of them not near each other."""
    rng = np.random.default_rng(8)
    texts = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(150)]
        texts += [" ".join(base), *_varied(rng, base, 25, 3), *_varied(rng, base, 25, 5), *_varied(rng, base, 25, 8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = _components(_shingle_sets(list(enumerate(texts)), 4))
    got = {r.doc_id: r.component_id for r in near.near_duplicates(df, exhaustive=exhaustive).collect()}
    assert sum(got[d] == c for d, c in expected.items()) >= (1.0 if exhaustive else 0.99) * len(expected)


@pytest.mark.parametrize("size", [4, corpus_pipeline.SHINGLE])
def test_links_that_hashing_misses_are_found(spark, size):
    """Without any band no bucket forms; every link above the threshold is found all the same, and no other."""
    rng = np.random.default_rng(21)
    texts = ["a b c d e f g h i j", "a b c d e f g h i j k", "x a b c d e f g h i j k", "p q r s t u", "p q r s t u v", "a b", None]
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(120)]
        texts += [" ".join(base), *_varied(rng, base, 6, 2), *_varied(rng, base, 6, 4), " ".join(base[:60] + [f"o{group}{i}" for i in range(60)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    signed = stage(near.signatures(df, size).withColumn("bands", F.array().cast("array<bigint>")), "no-bands")
    got = {r.node: r.component for r in near.linked_components(df, signed, size).collect()}
    expected = _components(_shingle_sets(list(enumerate(texts)), size))
    assert any(d != c for d, c in expected.items())
    assert {d: got.get(d, d) for d in expected} == expected


def test_a_common_passage_makes_few_pairs(spark, monkeypatch):
    """One passage in 2,000 documents: pairs stay below members times bands."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"u{x}" for x in rng.integers(0, 10**9, 60)) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sizes, plain = [], near.stage

    def counted(frame, name, **options):
        table = plain(frame, name, **options)
        if name == "near-pairs":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(near, "stage", counted)
    assert near.near_duplicates(df).where("component_id <> doc_id").count() == 0
    assert all(size <= 2000 * near.BANDS for size in sizes)


def test_the_exact_step_tests_only_pairs_that_can_be_similar(spark, monkeypatch):
    """Texts of seven out of ten blocks: every shingle is in many texts, no pair is similar, but for one near copy."""
    blocks = [" ".join(f"b{b}w{i}" for i in range(20)) for b in range(10)]
    texts = [" ".join(chosen) for chosen in combinations(blocks, 7)]
    texts.append(texts[0] + " end")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = _components(_shingle_sets(list(enumerate(texts)), 4))
    signed = stage(near.signatures(df).withColumn("bands", F.array().cast("array<bigint>")), "no-bands")
    sizes, plain = [], near.stage

    def counted(frame, name, **options):
        table = plain(frame, name, **options)
        if name == "near-pairs":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(near, "stage", counted)
    got = {r.node: r.component for r in near.linked_components(df, signed).collect()}
    assert {d: got.get(d, d) for d in expected} == expected and got[len(texts) - 1] == 0
    assert sum(sizes) < len(texts)


def test_parities_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(3)
    for size in (1, 5, 300, 3000):
        a = np.unique(rng.integers(0, 2**64, size, np.uint64))
        b = np.unique(np.concatenate([a[size // 7 :], rng.integers(0, 2**64, size // 9 + 1, np.uint64)]))
        differ = sum(int(x ^ y).bit_count() for x, y in zip(near.parity(a).view(np.uint64), near.parity(b).view(np.uint64)))
        assert 0 < differ <= len(np.setxor1d(a, b))


def test_rows_of_one_id_keep_both_texts(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(1, one + " x"), (5, one), (5, two), (9, two + " y"), (7, "alone in the world today")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(df).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 7: 7}


def test_entries_agree_like_sets_do():
    rng, orders = np.random.default_rng(5), near._orders()
    agree = []
    for size in (6, 40, 400) * 40:
        a = np.unique(rng.integers(0, 2**64, size, np.uint64))
        b = np.unique(np.concatenate([a[: int(size * 0.9)], rng.integers(0, 2**64, size - int(size * 0.9), np.uint64)]))
        share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        agree.append((near.signature(a, orders) == near.signature(b, orders)).mean() - share)
    assert abs(np.mean(agree)) < 0.03


# --- pipeline


def test_pipeline_stage_by_stage(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    functions = dict(corpus_pipeline.STAGES)
    assert len(functions) == 5

    kept = functions["quality rules"](spark, docs, SF_DIR).cache()
    assert kept.columns == columns
    failed = {d for d, t in rows.items() if (m := _measures(t))[0] < 50 or 100 * m[4] > 50 * m[0]}
    assert {r.doc_id for r in kept.collect()} == set(rows) - failed  # few labels: only the base rule rejects

    unique = functions["MinHash near-dedup"](spark, kept, SF_DIR).cache()
    left = _components(_shingle_sets(sorted((d, t) for d, t in rows.items() if d not in failed), 5))
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == set(left.values())

    clean = functions["benchmark decontamination"](spark, unique, SF_DIR).cache()
    leaked = {r.doc_id for r in tiling.leaks(unique, queries.table(spark, SF_DIR, "benchmark")).collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == set(left.values()) - leaked

    mix = functions["mixing sources to target weights"](spark, clean, SF_DIR).cache()
    counts = {r.doc_id: r.taken // r.size for r in mixing.mix(clean).collect() if r.taken}
    assert mix.columns == columns and Counter(r.doc_id for r in mix.collect()) == Counter(counts)

    out = functions["token-ID / binary output"](spark, mix, SF_DIR)
    expected = _expected_tokens(sorted((r.doc_id, r.text) for r in mix.collect()))
    assert [tuple(r) for r in out.orderBy("start").collect()] == expected


def test_pipeline_runs_as_a_whole(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
