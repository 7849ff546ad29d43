"""Near-duplicate documents by one-permutation hashing, with links confirmed on whole shingle sets.

1. Each text becomes its set of 64-bit shingle hashes. One hash function deals the set over 128 bins; the least
   member of each bin is its entry. An empty bin borrows from the first occupied bin in an order of its own
   (optimal densification), so entries of two sets agree with the probability of their Jaccard similarity.
2. Equal sets form one class, represented by its smallest doc_id; only representatives go on.
3. 32 bands of 4 entries name buckets. In each bucket one member, the best connected one, is the centre of a
   star: pairs grow with the members of a bucket, not with their square. Members whose four-bit sketches of the
   entries differ more than those of similar sets do, by five standard deviations, make no pair.
4. Pairs are confirmed on the whole sets. Members of a bucket that end up in different components are dealt anew, ``ROUNDS``
   times, by 32 fresh bands of 8 entries of a new permutation of their sets. Such a band parts those that only share a
   passage (similarity 0.3 meets with 0.3 ** 8), and each has a centre of its own, drawn by a hash. Members leave as
   soon as all their buckets are in one component. Pairs of a round are at most 32 for each member.
5. Components take the smallest doc_id as label, by label spreading with pointer jumping over written tables.

6. What hashing may have missed is settled exactly, on whole sets. A set of n shingles with at least
   n - ceil(0.8 n) + 1 of them in no other component has no similar set outside its own; the shingles of the lowest
   ``LOW`` share of hash values suffice to show that for most. The others meet by their rare shingles, where similar sets
   share one of the n - ceil(0.8 n) + 1 rarest. Their pairs are tested with more stars in each round, until every bucket
   is in one component or all its pairs across components were tested. Pairs that the place of the shingle or the
   parities of the sets rule out are not. That takes quadratic time in groups whose members are all just below the
   similarity, spread over tasks.

Steps 3 and 4 alone (``exhaustive=False``) lose a link with small probability: two sets with similarity 0.8 share no first
band with probability (1 - 0.8 ** 4) ** 32, more where few shingles fall together in bins, and a pair may meet only
where neither is the centre or linked to it.

Defined cases: a null or blank text has no shingles and is linked with nothing; fewer words than a shingle form
one shingle; rows that share a doc_id count as one document, linked through any of them with whichever text; a null
doc_id is linked with nothing, its component is null and it is kept. Further columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.llm import words
from hitflow.sources.staging import scratch, stage

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
PERCENT = 80
# Entries, entries of a band, and number of the rounds of fresh bands.
FRESH_BINS, FRESH_ROWS, ROUNDS = 256, 8, 3
# Share of all hash values whose shingles are counted to settle sets; any share gives the same links.
LOW = 0.35
LOW_END = np.uint64(int(LOW * 2**64))
# Documents of an Arrow batch that are worked on and handed on at a time.
SLICE = 1000
# Stars of a bucket grow by this factor from round to round of the exhaustive search.
WIDER = 16

#: Longs of a sketch: four bits of each entry.
SKETCH = BINS * 4 // 64
#: Bits of a set's parity: whether the number of members that fall on each bit is odd.
PARITY = 512

SIGNATURE = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>, low array<bigint>"


def shingles(text: str | None, size: int, cache: words.WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    tokens = words.split(text, lower=True)
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = cache.of(tokens, len(tokens))
    return np.unique(words.windows(hashes, min(size, len(tokens))))


def _orders(bins: int = BINS) -> np.ndarray:
    """For each bin, the rank at which it would borrow from each other bin."""
    return np.argsort(np.random.default_rng(20).random((bins, bins)), axis=1).argsort(axis=1)


def signature(members: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """A densified entry for each bin (a power of two) of a sorted, not empty set; a member's upper bits name its bin."""
    bins = len(orders)
    starts = np.searchsorted(members, np.arange(bins, dtype=np.uint64) << np.uint64(64 - bins.bit_length() + 1))
    occupied = np.diff(starts, append=len(members)) > 0
    entries = members[np.minimum(starts, len(members) - 1)]
    if not occupied.all():
        full, empty = np.flatnonzero(occupied), np.flatnonzero(~occupied)
        entries[empty] = entries[full[orders[np.ix_(empty, full)].argmin(axis=1)]]
    return entries


def band_keys(entries: np.ndarray, size: int = ROWS) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = entries.reshape(-1, size)
        key = np.arange(1, len(rows) + 1, dtype=np.uint64)
        for i in range(size):
            key = words.mix(key * words._BASE + rows[:, i])
    return words.signed(key)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def sketch(entries: np.ndarray) -> np.ndarray:
    """Four bits of each entry, packed into longs."""
    nibbles = (words.mix(entries) >> np.uint64(60)).reshape(SKETCH, 16)
    return words.signed((nibbles << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64))


def too_far(a: str, b: str, least: str) -> str:
    """Whether sketches differ in more bits than those of sets with the similarity asked for.

    Entries that disagree differ in two of four bits on average. ``least`` is the smaller set's size; it fills about
    128 * (1 - exp(-least / 128)) bins, and only so many entries are independent.
    """
    bits = " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH))
    share = 1 - PERCENT / 100
    spread = 5 * (share * (1 - share)) ** 0.5
    bins = f"({BINS}D * (1 - exp(-{least} / {BINS}D)))"
    return f"({bits}) > {2 * BINS}D * ({share}D + {spread}D / sqrt({bins})) + 15"


def signatures(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, size of the shingle set, its 128-bit digest, its band keys and its lowest shingles; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, orders = words.WordHashes(), _orders()
        none = np.empty(0, np.int64)
        for batch in _slices(batches):
            counts, digests, bands, sketches, lows = [], [], [], [], []
            for text in batch.column(1):
                members = shingles(text.as_py(), size, cache)
                counts.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                entries = signature(members, orders) if len(members) else None
                bands.append(none if entries is None else band_keys(entries))
                sketches.append(none if entries is None else sketch(entries))
                lows.append(words.signed(members[: np.searchsorted(members, LOW_END)].copy()))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 _lists(bands), _lists(sketches), _lists(lows)],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch", "low"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SIGNATURE)


def parity(members: np.ndarray) -> np.ndarray:
    """Bits of a set, packed into longs; those of two sets differ in no more places than the sets have members apart."""
    odd = np.bincount((members & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def out_of_reach() -> str:
    """Whether two members (n, at, parity) and (_nc, _at, _parity) of a bucket cannot be similar; no similar pair is.

    Similar sets share P (n + _nc) / (100 + P) shingles or more. Those they share stand, rarest first, at or behind the
    first one they share; ``at`` is the place of the bucket's shingle in either set. Some bucket of the pair is that of the
    first. All others are apart, and parities differ in no more places.
    """
    apart = " + ".join(f"bit_count(parity[{i}] ^ _parity[{i}])" for i in range(PARITY // 64))
    return (
        f"({100 + PERCENT}L * least(n - at, _nc - _at) < {PERCENT}L * (n + _nc)"
        f" or {100 + PERCENT}L * ({apart}) > {100 - PERCENT}L * (n + _nc))"
    )


def shingle_sets(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, its whole shingle set and the parity of that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = words.WordHashes()
        for batch in _slices(batches):
            sets = [shingles(text.as_py(), size, cache) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists([words.signed(found) for found in sets]), _lists([parity(found) for found in sets])],
                ["doc_id", "members", "parity"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, members array<bigint>, parity array<bigint>")


def fresh_bands(sets: DataFrame, number: int) -> DataFrame:
    """node, size of the set and band keys of every set, under the permutation of the round of that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(FRESH_BINS)
        with np.errstate(over="ignore"):
            salt = words.mix(np.array([number], np.uint64) * words._STEP)
        for batch in batches:
            keys, counts = [], []
            for found in batch.column(1):
                members = found.values.to_numpy().view(np.uint64)
                keys.append(band_keys(signature(np.sort(words.mix(members ^ salt)), orders), FRESH_ROWS))
                counts.append(len(members))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), _lists(keys)], ["node", "n", "keys"])

    return sets.select("doc_id", "members").mapInArrow(run, "node bigint, n bigint, keys array<bigint>")


def components(edges: DataFrame, outer: int = 0) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b), as node and component; a table as ``stage`` writes it."""
    with scratch(edges.sparkSession):
        return stage(_spread_labels(edges), "near-components", outer=outer + 1)


def _spread_labels(edges: DataFrame) -> DataFrame:
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "near-edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("node"), F.least("a", "_b").alias("component")), "near-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("_near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        # A label is a node too: take over the label it has.
        jump = labels.select(F.col("node").alias("_l"), F.col("component").alias("_up"))
        labels = stage(
            step.join(jump, F.col("_new") == F.col("_l")).select("node", "_old", F.least("_new", "_up").alias("component")),
            "near-labels",
        )
        if labels.where("component <> _old").isEmpty():
            return labels.select("node", "component")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("_ma"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("_mb"))
    both = F.size(F.array_intersect("_ma", "_mb"))
    # The centre's set repeats for every member of its star; skewed joins are split at run time.
    joined = pairs.join(right, "b").join(left, "a").withColumn("_both", both)
    linked = F.expr(f"100L * _both >= {PERCENT}L * (size(_ma) + size(_mb) - _both)")
    return joined.where(linked).select("a", "b").distinct()


def _stars(buckets: DataFrame, used: DataFrame | None, width: int) -> DataFrame:
    """The next ``width`` centres of each bucket, best connected first: key, centre, its set size and component."""
    left = buckets if used is None else buckets.join(used, used.columns, "left_anti")
    best = F.row_number().over(W.partitionBy("key").orderBy(F.desc("degree"), "node"))
    more = [F.col(name).alias(f"_{name}") for name in ("sketch", "set", "at", "parity") if name in left.columns]
    return left.withColumn("_rank", best).where(F.col("_rank") <= width).select(
        "key", F.col("node").alias("centre"), F.col("n").alias("_nc"), F.col("component").alias("_cc"), *more,
    )


class _Links:
    """Pairs tested and links found so far, as written tables that outlive one scratch, and the components of the links."""

    def __init__(self, nothing: DataFrame):
        # Whole sets of the documents whose pairs are tested next.
        self.sets: DataFrame | None = None
        self.tested, self.links, self.found = None, None, nothing

    def test(self, pairs: DataFrame) -> None:
        """Confirms those of the pairs (a, b) that were not tested yet."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-pairs", outer=1)
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        fresh = stage(_confirmed(pairs, self.sets), "near-links", outer=1)
        if not fresh.isEmpty():
            self.links = fresh if self.links is None else self.links.union(fresh)
            self.found = components(self.links, outer=1)

    def named(self, rows: DataFrame) -> DataFrame:
        """Rows (node, component, ...) with the components of now."""
        renamed = rows.withColumnRenamed("component", "_own").join(self.found, "node", "left")
        return renamed.withColumn("component", F.coalesce("component", "_own")).drop("_own")


def _pair(node: str, centre: str) -> list:
    return [F.least(node, centre).alias("a"), F.greatest(node, centre).alias("b")]


def _similar_size(n: str, other: str) -> str:
    return f"100 * least({n}, {other}) >= {PERCENT} * greatest({n}, {other})"


def linked_components(
    docs: DataFrame, signed: DataFrame, size: int = 4, rounds: int = ROUNDS, exhaustive: bool = True
) -> DataFrame:
    """node and component of every class representative that has a link. ``signed`` is a written table."""
    # One row of each class; a row is named by half its digest, which by chance may only add candidates.
    reps = stage(
        signed.withColumn("n_low", F.size("low"))
        .drop("low")
        .join(_classes(signed), ["d1", "d2"])
        .where("doc_id = rep")
        .dropDuplicates(["d1", "d2"])
        .select("d1", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "n_low", "bands", "sketch"),
        "near-classes",
    )
    state = _Links(reps.select("node", F.col("node").alias("component")).where("false"))
    # Buckets and sets are many times the size of the links, so those of one step go before the next begins.
    with scratch(docs.sparkSession):
        _hashed_links(docs, reps, state, size, rounds)
    if exhaustive:
        with scratch(docs.sparkSession):
            left = stage(_unsettled(reps, signed, state), "near-unsettled", outer=1)
        with scratch(docs.sparkSession):
            if not left.isEmpty():
                state.sets = _sets_of(docs, left, size)
                _test_the_rest(left, state)
    return state.found


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    involved = nodes.select(F.col("node").alias("doc_id")).distinct()
    return stage(shingle_sets(docs.join(involved, "doc_id", "left_semi"), size), "near-sets")


def _hashed_links(docs: DataFrame, reps: DataFrame, state: _Links, size: int, rounds: int) -> None:
    """Links between members of common buckets, of the first bands and of the rounds of fresh ones."""
    keys = reps.select(F.explode("bands").alias("key"), "d1")
    # Most keys are of one document only; sketches join those that share a key, not every key.
    shared = stage(keys.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1"), "near-shared")
    buckets = stage(keys.join(shared, "key"), "near-keys")
    degrees = buckets.groupBy("d1").agg(F.sum("_c").alias("degree"))
    members = reps.drop("bands", "n_low").withColumn("component", F.col("node"))
    open_buckets = stage(buckets.drop("_c").join(degrees, "d1").join(members, "d1").drop("d1"), "near-buckets")
    if open_buckets.isEmpty():
        return
    sets = state.sets = _sets_of(docs, open_buckets, size)
    state.test(_star_pairs(open_buckets, stage(_stars(open_buckets, None, 1), "near-stars")))
    left = stage(_unresolved(state.named(open_buckets), None).select("node", "component").distinct(), "near-open")
    for number in range(1, rounds + 1):
        if left.isEmpty():
            break
        own = fresh_bands(sets.join(left.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), number)
        dealt = stage(own.select("node", "n", F.explode("keys").alias("key")).join(left, "node"), "near-fresh")
        state.test(_fresh_pairs(dealt))
        left = stage(_unresolved(state.named(dealt), None).select("node", "component").distinct(), "near-open")


def _unsettled(reps: DataFrame, signed: DataFrame, state: _Links) -> DataFrame:
    """Representatives that could have a similar set in another component: node, n, component and degree.

    A similar set shares all but n - ceil(0.8 n) shingles. Who has more that occur in its own component only, among those
    of low hash value, is done with.
    """
    by_key, by_class = W.partitionBy("key"), W.partitionBy("d1")
    # Most shingles are of one class. All go through one shuffle, those of several classes alone go further.
    entries = signed.where("n_shingles > 0 and doc_id is not null").select("d1", F.explode("low").alias("key"))
    several = F.min("d1").over(by_key) != F.max("d1").over(by_key)
    shared = stage(entries.withColumn("_several", several).where("_several").select("key", "d1").distinct(), "near-spread")
    named = state.named(reps.select("d1", "node", "n", "n_low").withColumn("component", F.col("node")))
    apart = F.min("component").over(by_key) != F.max("component").over(by_key)
    met = (
        shared.join(named.select("d1", "component"), "d1")
        .withColumn("_apart", apart)
        .where("_apart")
        .groupBy("d1")
        .agg(F.count("*").alias("degree"))
    )
    # Classes that by chance have one name are never done with here.
    counted = (
        named.withColumn("_names", F.count("*").over(by_class))
        .join(met, "d1", "left")
        .withColumn("degree", F.coalesce("degree", F.lit(0)))
    )
    alone = f"n_low - degree > n - ({PERCENT}L * n + 99) div 100"
    return counted.where(f"_names > 1 or not ({alone})").select("node", "n", "component", "degree")


def _fresh_pairs(dealt: DataFrame) -> DataFrame:
    """Every member (key, node, n, component) with the centre of its bucket, one of them drawn by a hash."""
    drawn = F.struct(F.xxhash64("key", "node").alias("_draw"), F.col("node").alias("centre"), F.col("n").alias("_nc"), F.col("component").alias("_cc"))
    centres = dealt.groupBy("key").agg(F.min(drawn).alias("_m"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    centres = centres.where("_lo <> _hi").select("key", "_m.centre", "_m._nc", "_m._cc")
    pairs = dealt.join(centres, "key").where(f"component <> _cc and {_similar_size('n', '_nc')}")
    return pairs.select(*_pair("node", "centre")).distinct()


def _star_pairs(buckets: DataFrame, stars: DataFrame, sketched: bool = True) -> DataFrame:
    """Members with the centres of their buckets; ``sketched`` leaves out those whose sketches are too far apart, else those
    that cannot be similar."""
    pairs = buckets.join(stars, "key").where(f"component <> _cc and {_similar_size('n', '_nc')}")
    pairs = pairs.where("not " + (f"({too_far('sketch', '_sketch', 'least(n, _nc)')})" if sketched else out_of_reach()))
    return pairs.select(*_pair("node", "centre")).distinct()


def _test_the_rest(members: DataFrame, state: _Links) -> None:
    """All pairs across components that share a rare shingle, star by star."""
    open_buckets = stage(_unresolved(state.named(_by_rare_shingles(members, state.sets)), None), "near-buckets")
    used, width = None, 1
    while not open_buckets.isEmpty():
        stars = stage(_stars(open_buckets, used, width), "near-stars")
        state.test(_star_pairs(open_buckets, stars, sketched=False))
        centres = stars.select("key", F.col("centre").alias("node"), F.col("_set").alias("set"))
        used = centres if used is None else used.union(centres)
        open_buckets = stage(_unresolved(state.named(open_buckets), used), "near-buckets")
        width *= WIDER


def _unresolved(buckets: DataFrame, used: DataFrame | None) -> DataFrame:
    """Buckets that hold two components, and a member that was no centre yet."""
    spread = buckets.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo <> _hi")
    left = buckets.join(spread.select("key"), "key", "left_semi")
    if used is None:
        return left
    alive = buckets.join(used, used.columns, "left_anti").select("key").distinct()
    return left.join(alive, "key", "left_semi")


def _by_rare_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members (node, n, component, degree) dealt to buckets by their rare shingles, with the place of each among
    their own, their set and its parity.

    Two sets of the similarity asked for share at least one of the n - ceil(0.8 n) + 1 rarest shingles of each, in
    one order for all. Members that only have a common passage in common do not meet here, and no similar
    pair is lost.
    """
    # A doc_id may stand for several sets; each is a member of its own.
    named = sets.withColumn("set", F.xxhash64("members")).withColumnRenamed("doc_id", "node")
    members = members.dropDuplicates(["node", "n"])
    each = named.join(members.select("node").distinct(), "node", "left_semi").select("node", "set", F.explode("members").alias("key"))
    own = named.select("node", "set", F.size("members").cast("bigint").alias("n"), "parity").dropDuplicates(["node", "set"])
    listed = (
        each.withColumn("_c", F.count("*").over(W.partitionBy("key")))
        .where("_c > 1")
        .groupBy("node", "set")
        .agg(F.sort_array(F.collect_set(F.struct("_c", "key"))).alias("_shared"))
        .join(own, ["node", "set"])
        .join(members, ["node", "n"])
    )
    # Shingles of one member only come first in the order and meet nothing.
    rare = f"greatest(0, int(n - ({PERCENT} * n + 99) div 100 + 1 - (n - size(_shared))))"
    return listed.select(
        *members.columns, "set", "parity", (F.col("n") - F.size("_shared")).alias("_alone"),
        F.posexplode(F.expr(f"slice(_shared, 1, {rare})").getField("key")).alias("_nth", "key"),
    ).withColumn("at", F.col("_alone") + F.col("_nth")).drop("_alone", "_nth")


def _classes(signed: DataFrame) -> DataFrame:
    return signed.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))


def near_duplicates(docs: DataFrame, size: int = 4, rounds: int = ROUNDS, exhaustive: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    signed = stage(signatures(docs, size), "near-signatures")
    with scratch(docs.sparkSession):
        found = stage(linked_components(docs, signed, size, rounds, exhaustive), "near-found", keep=True)
    # A document belongs to its class, and through any of its rows to the component of the class.
    own = signed.join(_classes(signed), ["d1", "d2"]).select("doc_id", "rep").distinct()
    labels = (
        own.join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("component", "rep")).alias("_component"))
    )
    return signed.join(labels, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("_component", "doc_id").alias("component_id"),
        F.expr("doc_id is null or doc_id = coalesce(_component, doc_id)").alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay, one for each group; of rows that repeat a doc_id the first text in order."""
    verdict = near_duplicates(docs, size).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    named = docs.where("doc_id is not null")
    kept = named.join(verdict, named["doc_id"] == verdict["_gone"], "left_anti")
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy("text"))
    kept = kept.withColumn("_near_rank", rank).where("_near_rank = 1").drop("_near_rank")
    # All rows without a doc_id stay; they go to no common task.
    return kept.unionByName(docs.where("doc_id is null"))
