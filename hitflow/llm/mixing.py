"""Mixing sources to target weights by exponential keys (Efraimidis-Spirakis sampling).

Targets: the sources, in order of code points with null last, weigh 1, 2, 3, 1, 2, 3, ... and share the words of
all documents by weight; none may exceed three times its own size, and the excess goes to the others by weight.
A source takes as many complete epochs as its target holds. The rest is a sample without replacement: each
document draws an exponential key divided by its quality weight, keys are sorted within the source and sizes
summed up to the rest of the target.

A source of any size is sorted in parts: keys fall into buckets, bucket totals are summed up, and only the bucket
in which the sum passes the target is sorted. What leaves this is one row per source with a cut through its keys.
Buckets are even whatever the weights: they follow the distribution of the keys, which the number of documents in
each of twenty classes of weight gives.

Keys come from a digest of doc_id, text and a running number among equal rows, so reruns agree. Defined cases: null,
empty and blank texts have size 0 and are taken 0 times; a null source is a source; rows with a null or a repeated
doc_id are drawn each for itself; an empty table gives an empty mix. Further columns of the input are kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitflow.sources.staging import stage

CYCLE = (1, 2, 3)
MAX_EPOCHS = 3
# Rows of a source that one bucket of keys is meant to hold.
BUCKET_ROWS = 5_000
SALT = "mix-1"
# Classes of weight, of equal width up to 1.
CLASSES = 20


def size_of(text: str = "text") -> str:
    """Words of a text, without building them: starts of runs of other characters than white space."""
    return f"bigint(regexp_count(coalesce({text}, ''), '[^\\\\x20\\\\x09-\\\\x0D]+'))"


def quality_of(text: str = "text") -> str:
    """Weight between 0.05 and 1, lower the more symbols a text holds."""
    symbols = f"regexp_count(coalesce({text}, ''), '[#*$%&|<>]')"
    return f"greatest(0.05D, 1.0D - 5.0D * {symbols} / greatest(length(coalesce({text}, '')), 1))"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with ``_hash`` of the text and ``_nth``, the running number among equal rows.

    Only rows that have an equal are numbered, which are few; all others stay where they are.
    """
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    counts = hashed.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_hash").alias("_h")).agg(F.count("*").alias("_c"))
    repeated = stage(counts.where("_c > 1").drop("_c"), "mix-repeated")
    if repeated.isEmpty():
        return hashed.withColumn("_nth", F.lit(0))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_hash") == F.col("_h"))
    order = F.row_number().over(W.partitionBy("doc_id", "source", "_hash").orderBy(F.lit(0)))
    single = hashed.join(repeated, same, "left_anti").withColumn("_nth", F.lit(0))
    return single.unionByName(hashed.join(repeated, same, "left_semi").withColumn("_nth", order))


def drawn(docs: DataFrame) -> DataFrame:
    """``docs`` with size, key and class of weight as ``_size``, ``_key`` and ``_class``."""
    # 52 bits of a digest as a number strictly between 0 and 1.
    digits = f"substr(md5(concat_ws(':', '{SALT}', coalesce(string(doc_id), ''), _hash, _nth)), 1, 13)"
    uniform = f"((double(conv({digits}, 16, 10)) + 0.5D) / 4503599627370496.0D)"
    sized = numbered(docs).withColumn("_size", F.expr(size_of())).withColumn("_quality", F.expr(quality_of()))
    return sized.withColumns({
        "_key": F.expr(f"-ln({uniform}) / _quality"), "_class": F.expr(f"int(round(_quality * {CLASSES}))")
    }).drop("_hash", "_nth", "_quality")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, rows, classes and target from one row per source (source, source_size, rows, classes).

    Water filling in closed form: in order of cap per weight the sources up to some point are capped, and the level
    of the others follows from what is left.
    """
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("_rank", F.row_number().over(by_name)).withColumn(
        "_w", F.element_at(F.array(*map(F.lit, CYCLE)), (F.pmod(F.col("_rank") - 1, F.lit(len(CYCLE))) + 1).cast("int"))
    ).withColumn("_cap", F.col("source_size") * MAX_EPOCHS)
    order = W.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    levels = (
        weighted.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(order), F.lit(0)))
        .withColumn("_open", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(order), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.col("_open"))
        .withColumn("_capped", F.col("_cap") <= F.col("_level") * F.col("_w"))
        .withColumn("_final", F.min(F.expr("if(_capped, null, struct(_cap / _w as r, _rank, _level))")).over(everything))
    )
    target = F.expr("if(_capped or _final is null, double(_cap), least(double(_cap), _final._level * _w))")
    return levels.select("source", "source_size", "rows", "classes", target.alias("target"))


def plan(draws: DataFrame) -> DataFrame:
    """One row per source: source_size, target, complete epochs and where the last, partial one is cut.

    ``draws`` is a written table of source, _size, _key and _class. A document is in the partial epoch if its bucket lies
    below ``cut_bucket``, or is that bucket and its key is at most ``cut_key`` or just ``fill_key``.
    """
    classes = draws.groupBy("source", "_class").agg(F.sum("_size").alias("_words"), F.count("*").alias("_n"))
    sizes = classes.groupBy("source").agg(
        F.sum("_words").alias("source_size"), F.sum("_n").alias("rows"), F.collect_list(F.struct("_class", "_n")).alias("classes")
    )
    sources = (
        targets(sizes)
        .withColumn("epochs", F.expr("if(source_size = 0, 0L, bigint(floor(target / source_size + 1e-9D)))"))
        .withColumn("_rest", F.expr("target - epochs * source_size"))
        .withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS))
    )
    sources = stage(sources, "mix-sources")
    placed = with_plan(draws, sources)
    totals = placed.groupBy(F.col("source").alias("_s"), "bucket").agg(F.sum("_size").alias("_sum"), F.min("_rest").alias("_rest"))
    run = W.partitionBy("_s").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = (
        totals.withColumn("_upto", F.sum("_sum").over(run))
        .where("_upto - _sum < _rest and _upto >= _rest")
        .groupBy("_s")
        .agg(F.min(F.struct("bucket", (F.col("_upto") - F.col("_sum")).alias("before"))).alias("_edge"))
        .select("_s", F.col("_edge.bucket").alias("cut_bucket"), F.col("_edge.before").alias("_before"))
    )
    inner = placed.join(edge, F.col("source").eqNullSafe(F.col("_s"))).where("bucket = cut_bucket").drop("_s")
    along = W.partitionBy("source").orderBy("_key", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = inner.withColumn("_upto", F.col("_before") + F.sum("_size").over(along))
    taken = (
        summed.groupBy(F.col("source").alias("_t"))
        .agg(
            F.max(F.expr("if(_upto <= _rest, _key, null)")).alias("cut_key"),
            F.min(F.expr("_rest - if(_upto <= _rest, _upto, _before)")).alias("_open"),
        )
    )
    # What is still open is less than the document at the edge; the document behind the cut that fits best fills it.
    fits = "abs(_size - _open)"
    filler = (
        summed.join(taken, F.col("source").eqNullSafe(F.col("_t")))
        .where(f"_upto > _rest and _size > 0 and {fits} < _open")
        .groupBy(F.col("source").alias("_f"))
        .agg(F.min(F.struct(F.expr(fits), "_key")).getField("_key").alias("fill_key"))
    )
    cut = (
        edge.join(taken, F.col("_s").eqNullSafe(F.col("_t")), "left")
        .join(filler, F.col("_s").eqNullSafe(F.col("_f")), "left")
        .select("_s", "cut_bucket", "cut_key", "fill_key")
    )
    whole = sources.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left")
    return stage(
        whole.select("source", "source_size", "target", "epochs", "rows", "classes", "buckets", "cut_bucket", "cut_key", "fill_key"), "mix-plan"
    )


def with_plan(draws: DataFrame, sources: DataFrame) -> DataFrame:
    """Draws with the columns of their source and their bucket, into which keys of any weights fall evenly.

    A key of weight w lies below k with probability 1 - exp(-w k); over the classes this gives the share of the source's
    keys below k, which grows with k.

    ``sources`` is a written table of one row per source, so Spark knows its size and broadcasts it if small.
    """
    right = sources.withColumnRenamed("source", "_plan_source")
    return (
        draws.join(right, F.col("source").eqNullSafe(F.col("_plan_source")))
        .drop("_plan_source")
        .withColumn("_below", F.expr(f"aggregate(classes, 0D, (a, c) -> a + c._n * (1 - exp(-c._class / {CLASSES}D * _key)))"))
        .withColumn("bucket", F.expr("least(buckets - 1, bigint(floor(buckets * _below / rows)))"))
        .drop("_below", "classes", "rows")
    )


def copies() -> str:
    """How many times a document is taken."""
    partial = "coalesce(bucket < cut_bucket or (bucket = cut_bucket and _key <= cut_key), false)"
    partial = f"({partial} or coalesce(bucket = cut_bucket and _key = fill_key, false))"
    return f"if(_size = 0, 0L, epochs + if({partial}, 1L, 0L))"


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (doc_id, source, text)."""
    draws = stage(drawn(docs.select("doc_id", "source", "text")).drop("text"), "mix-draws")
    placed = with_plan(draws, plan(draws))
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.expr(f"_size * {copies()}").alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    draws = stage(drawn(docs.select("doc_id", "source", "text")).drop("text"), "mix-draws")
    # The own columns wait in a struct meanwhile, as some could be named like those of the plan.
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", "text")
    placed = with_plan(drawn(packed).drop("text"), plan(draws))
    times = F.sequence(F.lit(1), F.expr(copies()).cast("int"))
    return placed.where(f"{copies()} > 0").select("_row", F.explode(times).alias("_copy")).select("_row.*")
