"""Token ids of all documents in one order, written as coded segments and read back.

Documents are range-partitioned by doc_id and sorted; each task tokenises its range and cuts it into segments
of whole documents. A row of the written Parquet table is one segment: which documents it holds, how long they
are, and their ids as a self-describing payload of independently coded, checksummed blocks (``coder``). Parquet
gives atomic commits, so a lost executor leaves no half-written segment, on any file system Spark can write.

The tokeniser works on one word between ASCII white space at a time and remembers parts of words. That changes no id:
its normaliser turns white space into a blank, its splitter drops it, and no merge crosses it. Whether a tokeniser is of
that kind is tried out on some words at the start; texts go to any other one whole.

Defined cases: a null or empty text is the end id alone; null doc_ids come first; rows that share a doc_id are
ordered by a hash of their texts; a document longer than a segment is a segment of its own; an empty table
gives an empty one. The ids of any other tokeniser must lie below 65535.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.llm import coder
from hitflow.sources.staging import new_location

END = 1
# Ids of one segment, coded at once.
SEGMENT = 1 << 23
# Parts of words that a Python worker keeps before it starts anew; a bound on memory only.
MAX_CACHE = 1_200_000
# Parts of words that are encoded as one text.
JOINED = 1000
# Bytes of text whose words are looked up together.
PART = 8 << 20

STORED = "shard int, segment int, doc_ids array<bigint>, lengths array<bigint>, payload binary"
DECODED = "shard int, segment int, nth bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"

# Letters that lower-case one by one and are in composed form, then signs that the splitter takes as one piece.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_SIMPLE = f"^(?P<letters>{_LETTERS})(?P<signs>[.,!?;:#$%&*|]*)$"
# What some tokenisers mark the last id of a piece with.
_CLOSING = "</w>"
_of_letters = re.compile(_LETTERS).fullmatch


class Encoder:
    """Ids of texts as little-endian 16-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() >= coder.IDS:
            raise ValueError("the vocabulary does not fit into 16 bits")
        self.parts: dict[str, bytes] = {}
        self.closing = np.zeros(coder.IDS, bool)
        self.closing[[own for token, own in self.tokenizer.get_vocab().items() if token.endswith(_CLOSING)]] = True
        # What the shortcuts rest on is tried out: words between white space stand alone, letters are lower-cased, and
        # the last id of a word of letters, and no other, is a closing one.
        words, signs = ("Ab", "éÀz", "x1", "Straße"), ".,!?;:#$%&*|"
        gaps = (*" \t\n\r", " \n\n ", "\t\x0b\x0c")
        self.by_word = all(self._plain(a + gap + b) == self._plain(a) + self._plain(b) for a in words for b in words for gap in gaps)
        self.lowers = all(self._plain(w + sign) == self._plain(w.lower()) + self._plain(sign) for w in ("ABC", "Éa") for sign in signs)

        letters = [chr(c) for c in range(256) if re.fullmatch(_LETTERS, chr(c))]
        self.closes = self.by_word and all(
            closed.tolist() == [False] * (len(closed) - 1) + [True]
            for word in (*letters, *map("".join, zip(letters, letters[::-1])), "".join(letters))
            for closed in [self.closing.take(np.frombuffer(self._plain(word), "<u2"))]
        )

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(lengths)
        return [ids[end - length : end].tobytes() for end, length in zip(ends, lengths)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        if not self.by_word:
            found = [self._plain(text or "") for text in texts.to_pylist()]
            return np.frombuffer(b"".join(found), "<u2"), np.array([len(own) // 2 for own in found], np.int64)
        # Splits at ASCII white space only; an empty word at an edge has no ids.
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        # A word is taken apart once for all its places: words differ by case and signs far more than by letters.
        coded = split.flatten().dictionary_encode()
        letters, signs = self._halves(coded.dictionary)
        halves = pa.concat_arrays([letters, signs]).dictionary_encode()
        found = self._learned(halves.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(found), "<u2")
        sizes = np.array([len(own) // 2 for own in found], np.int64)
        ids, ends = _gathered(flat, sizes, halves.indices.to_numpy().reshape(2, -1).T.ravel())
        ids, ends = _gathered(ids, np.diff(ends[::2]), coded.indices.to_numpy())
        # Offsets of a slice do not start at 0.
        bounds = split.offsets.to_numpy()
        return ids, np.diff(ends.take(bounds - bounds[0]))

    def _halves(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each word the letters in lower case and the signs behind them; other words are whole, and without signs."""
        if not self.lowers:
            return words, pa.repeat(pa.scalar("", words.type), len(words))
        found = pc.extract_regex(words, _SIMPLE)
        letters, signs = pc.struct_field(found, "letters"), pc.struct_field(found, "signs")
        simple = found.is_valid()
        return pc.if_else(simple, pc.utf8_lower(letters), words), pc.if_else(simple, signs, pa.scalar("", words.type))

    def _learned(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.parts.get, parts))
        places = [place for place, own in enumerate(found) if own is None]
        if len(self.parts) + len(places) > MAX_CACHE:
            self.parts.clear()
        unknown = list(map(parts.__getitem__, places))
        joined = [self.closes and _of_letters(part) is not None for part in unknown]
        for start in range(0, len(places), JOINED):
            some = slice(start, start + JOINED)
            self._learn(unknown[some], joined[some], found, places[some])
        return found

    def _learn(self, parts: list[str], joined: list[bool], found: list[bytes | None], places: list[int]) -> None:
        """Parts of letters as one text, which costs less than a text each; their closing ids tell them apart."""
        as_one = list(compress(parts, joined))
        text, *texts = self.tokenizer.encode_batch_fast(
            [" ".join(as_one), *(part for part, join in zip(parts, joined) if not join)], add_special_tokens=False
        )
        ids = np.array(text.ids, "<u2")
        ends = (2 * (np.flatnonzero(self.closing.take(ids)) + 1)).tolist()
        if len(ends) != len(as_one):
            return self._learn(parts, [False] * len(parts), found, places)
        data, start, rest = ids.tobytes(), 0, iter(texts)
        pieces = iter(ends)
        for part, join, place in zip(parts, joined, places):
            if join:
                end = next(pieces)
                own, start = data[start:end], end
            else:
                own = array("H", next(rest).ids).tobytes()
            self.parts[part] = found[place] = own


def _gathered(ids: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs at some places of runs of such sizes, one after the other, and where each of them ends, after a 0."""
    starts = np.cumsum(sizes) - sizes
    many = sizes.take(places)
    ends = np.concatenate(([0], np.cumsum(many)))
    return ids.take(np.repeat(starts.take(places) - ends[:-1], many) + np.arange(ends[-1])), ends


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for each Python worker; later tasks of the worker find its words known."""
    return Encoder(path)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts (column 1) come to about ``PART`` bytes, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(), dtype=np.int64) // PART
    bounds = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for start, end in zip(bounds, bounds[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def write(docs: DataFrame, path: str, tokenizer: str, shards: int) -> None:
    """Write doc_id and text of ``docs`` as segments below ``path``; ``tokenizer`` is a file on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = worker_encoder(tokenizer)
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        segment = held = 0

        def close() -> pa.RecordBatch:
            payload = coder.encode(np.concatenate(ids))
            row = {"shard": shard, "segment": segment, "doc_ids": list(names), "lengths": list(lengths), "payload": payload}
            for held_list in (ids, names, lengths):
                held_list.clear()
            return pa.RecordBatch.from_pylist([row], schema=pa.schema({
                "shard": pa.int32(), "segment": pa.int32(), "doc_ids": pa.list_(pa.int64()),
                "lengths": pa.list_(pa.int64()), "payload": pa.binary(),
            }))

        for batch in batches:
            for part in _parts(batch):
                found, sizes = encoder.encode_column(part.column(1))
                upto = np.cumsum(sizes)
                found = np.insert(found, upto, END)
                # Of each document of the part, where it ends with its end id.
                upto += np.arange(1, len(upto) + 1)
                taken = since = 0
                for nth, (doc_id, end) in enumerate(zip(part.column(0).to_pylist(), upto.tolist())):
                    names.append(doc_id)
                    lengths.append(end - since)
                    held += end - since
                    since = end
                    if held >= SEGMENT or nth == len(upto) - 1:
                        ids.append(found[taken:end])
                        taken = end
                    if held >= SEGMENT:
                        yield close()
                        segment, held = segment + 1, 0
        if names:
            yield close()

    placed = (
        docs.select("doc_id", "text")
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
        .select("doc_id", "text")
    )
    # A row group holds few segments, so that readers hold few at once.
    placed.mapInArrow(run, STORED).write.option("parquet.block.size", str(32 << 20)).parquet(path)


def _crcs(ids: np.ndarray, lengths: list[int]) -> list[int]:
    data, at, out = memoryview(ids.astype("<u4").tobytes()), 0, []
    for length in lengths:
        out.append(zlib.crc32(data[at : at + 4 * length]))
        at += 4 * length
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the written segments alone: doc_id, start, n_tokens and ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, segment = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                names, lengths = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                ids = coder.decode(batch.column(4)[i].as_py())
                if sum(lengths) != len(ids):
                    raise ValueError("a segment does not hold its documents")
                within = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int32()), pa.array([segment] * n, pa.int32()), pa.array(range(n), pa.int64()),
                     pa.array(names, pa.int64()), pa.array(within, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(_crcs(ids, lengths), pa.int64())],
                    ["shard", "segment", "nth", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema(STORED).parquet(path)
    documents = stored.mapInArrow(run, DECODED)
    sizes = stored.select(
        F.col("shard").alias("_shard"),
        F.col("segment").alias("_segment"),
        F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("_n"),
    )
    # Offsets in two steps: of shards (one row per task that wrote), then of segments within their shard.
    shards = sizes.groupBy("_shard").agg(F.sum("_n").alias("_n"))
    all_before = W.orderBy("_shard").rowsBetween(W.unboundedPreceding, -1)
    shards = shards.select(F.col("_shard").alias("_of"), F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_base"))
    before = W.partitionBy("_shard").orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(shards, F.col("_shard") == F.col("_of"))
    joined = documents.join(offsets, (F.col("shard") == F.col("_shard")) & (F.col("segment") == F.col("_segment")))
    return joined.select("doc_id", (F.col("_base") + F.col("_before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def shard_count(spark: SparkSession) -> int:
    """As many ranges as a shuffle of this session has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all of ``docs`` to a new place in the shared folder and return what reading it back gives."""
    spark = docs.sparkSession
    path = new_location(spark, "tokens")
    write(docs, path, tokenizer or default_tokenizer(), shard_count(spark))
    return read_documents(spark, path)
