"""Quality rules with risk-controlled thresholds.

Every text is measured once, in SQL functions only. A labelled holdout then fixes, for each stratum and each
measure, the strictest cutoff that is proven to reject few good documents: a candidate cutoff is admissible if
the exact binomial (Clopper-Pearson) upper bound of its false-rejection rate stays within the measure's share of the
allowed risk, with the confidence level divided by the number of tests made (Bonferroni). The measures of a
stratum share its risk evenly, so that all of them together stay within it. A stratum with too few labels to prove
anything gets no cutoff, so nothing in it is rejected by the method.

Defined cases: a null text has no words; a null stratum is a stratum of its own; labels that are null or
contradict each other for one doc_id are left out; a doc_id that is null or repeated is measured row by row;
without labels no cutoff exists and only the fixed base rule rejects. Further columns of the input are kept by
``with_measures``; the working columns carry a prefix so that they cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitflow.sources.staging import stage

P = "_q_"

# The base rule: fixed values.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Measures that the method may cut on, as expressions over the counts; larger is worse.
MEASURES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Risk:
    """Parameters of the thresholds.

    ``alpha``: share of good documents of a stratum that its measures together may reject. ``delta``: probability that any
    of the promises fails. ``grid``: candidate cutoffs per stratum and measure.
    """

    alpha: float = 0.01
    delta: float = 0.05
    grid: int = 40
    stratum: str = "lang"


def _words(text: str) -> str:
    # White space at an edge leaves an empty piece there, which is no word.
    return f"array_remove(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), '')"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once for each row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words() -> str:
    """Words covered by three-word windows that occur at least twice in one text.

    Windows are hashed to 64 bits. Where one occurs twice, the hashes are sorted with the position in the low
    bits (as many as the text needs), neighbours that agree in the whole hash are repeats, and the union of
    their three-word spans is counted in order of position.
    """
    hashes = (
        f"transform(sequence(0, {P}n - 3), i -> xxhash64({P}w[i], {P}w[i + 1], {P}w[i + 2]))"
    )
    packed = "sort_array(transform(h, (x, i) -> shiftleft(shiftright(x, b), b) | i))"

    def neighbour(step: str) -> str:
        """Whether the window next in hash order is the same; whole hashes are compared where the packed ones agree."""
        low = "(shiftleft(1L, b) - 1L)"
        packed_equal = f"shiftright(k[j {step} 1], b) = shiftright(x, b)"
        return f"({packed_equal} and h[int(k[j {step} 1] & {low})] = h[int(x & {low})])"

    # Positions, in order, of windows that equal the one before or after them in hash order.
    marked = (
        f"sort_array(filter(transform(k, (x, j) -> if((j > 0 and {neighbour('-')}) or "
        f"(j < size(k) - 1 and {neighbour('+')}), int(x & (shiftleft(1L, b) - 1L)), -1)), p -> p >= 0))"
    )
    covered = (
        "aggregate(transform(m, (p, j) -> if(j < size(m) - 1, least(3, m[j + 1] - p), 3)), 0L, (a, x) -> a + x)"
    )
    body = _let("length(bin(size(h)))", "b", _let(packed, "k", _let(marked, "m", covered)))
    whole = _let(hashes, "h", f"if(size(array_distinct(h)) = size(h), 0L, {body})")
    return f"if({P}n < 3, 0L, {whole})"


def _apart(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with a computed column that the optimizer neither repeats nor moves into filters.

    Inlined into a lambda function or a filter, a costly expression would run once for each element or use.
    """
    return df.select("*", F.explode(F.array(F.expr(value))).alias(name))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the counts of each text as one struct column ``_q_m``; one pass, no shuffle."""
    source = f"coalesce({text}, '')"
    words = _apart(docs, _words(source), f"{P}w").withColumn(f"{P}n", F.expr(f"size({P}w)"))
    lines = f"filter(split({source}, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    counts = {
        "n_words": f"bigint({P}n)",
        "word_chars": f"bigint(length(array_join({P}w, '')))",
        "n_symbols": f"bigint(regexp_count({source}, '[#*$%&|<>]'))",
        "n_dup_lines": _let(lines, "l", "bigint(size(l) - size(array_distinct(l)))"),
        "n_repeat_words": _repeat_words(),
        "n_lines": f"bigint(length({source}) - length(replace({source}, '\\n', '')) + 1)",
    }
    struct = ", ".join(f"'{name}', {expression}" for name, expression in counts.items())
    return _apart(words, f"named_struct({struct})", f"{P}m").drop(f"{P}w", f"{P}n")


def base_failed() -> str:
    """The fixed base rule over the counts."""
    return f"(n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


def _log_tail() -> str:
    """Natural logarithm of P(X <= k) for X ~ Binomial(n, alpha), by the ratio of neighbouring terms.

    The running largest term is factored out, so that no term of a large holdout underflows.
    """
    step = "s.t + ln((n - j + 1) / j) + ln(alpha / (1 - alpha))"
    add = (
        "named_struct('t', {t}, 'top', greatest(s.top, {t}), "
        "'sum', s.sum * exp(s.top - greatest(s.top, {t})) + exp({t} - greatest(s.top, {t})))"
    ).format(t=f"({step})")
    start = "named_struct('t', n * ln(1 - alpha), 'top', n * ln(1 - alpha), 'sum', 1.0D)"
    return (
        f"aggregate(if(k = 0, array(), sequence(1L, k)), {start}, (s, j) -> {add}, s -> s.top + ln(s.sum))"
    )


def cutoffs(measured: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """One row per stratum and measure with an admissible cutoff: stratum, measure, cutoff, n, rejected.

    ``measured`` has doc_id, stratum and the counts. Documents that the base rule rejects take no part, as no
    cutoff decides about them. Candidates are quantiles of the bad documents' measure (where cutting is of use)
    and every candidate is tested on the good ones; the smallest admissible one wins. Every labelled document takes part.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi"))
        .where("_lo = _hi")
        .select("doc_id", F.col("_lo").alias("_good"))
    )
    rows = measured.where(f"not {base_failed()}").join(known, "doc_id")
    stack = ", ".join(f"'{name}', double({expression})" for name, expression in MEASURES.items())
    long = rows.select("stratum", "_good", F.expr(f"stack({len(MEASURES)}, {stack}) as (measure, value)"))
    shares = ", ".join(f"{i / risk.grid}D" for i in range(risk.grid))
    grid = (
        long.where("_good = 0")
        .groupBy("stratum", "measure")
        .agg(F.expr(f"percentile_approx(value, array({shares}), 10000)").alias("_cuts"))
        .select("stratum", "measure", F.explode(F.array_distinct("_cuts")).alias("cutoff"))
    )
    # Each good value counts for the candidates up to it: one row for each number of candidates that it reaches.
    cuts = grid.groupBy("stratum", "measure").agg(F.sort_array(F.collect_list("cutoff")).alias("_cuts"))
    same = F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("measure") == F.col("_m"))
    reached = (
        long.where("_good = 1")
        .join(cuts.select(F.col("stratum").alias("_s"), F.col("measure").alias("_m"), "_cuts"), same)
        .groupBy("stratum", "measure", F.expr("size(filter(_cuts, c -> c <= value))").alias("_reach"))
        .agg(F.count("*").alias("_n"))
    )
    marks = cuts.select("stratum", "measure", F.posexplode("_cuts").alias("_at", "value"))
    whole = reached.groupBy("stratum", "measure").agg(
        F.sum("_n").alias("n"), F.collect_list(F.struct("_reach", "_n")).alias("_steps")
    )
    tested = (
        marks.join(whole.select(F.col("stratum").alias("_s"), F.col("measure").alias("_m"), "n", "_steps"), same)
        .withColumn("k", F.expr("aggregate(filter(_steps, s -> s._reach > _at), 0L, (a, s) -> a + s._n)"))
        .withColumn("alpha", F.lit(risk.alpha / len(MEASURES)))
    )
    tests = grid.agg(F.greatest(F.count("*"), F.lit(1))).scalar()
    proven = (
        tested.withColumn("_tests", tests)
        # Beyond the mean the tail is above one half and never admissible; the sum stops there.
        .where("k <= n * alpha")
        .where(F.expr(f"{_log_tail()} <= ln({risk.delta}D / _tests)"))
    )
    return proven.groupBy("stratum", "measure").agg(
        F.min_by(F.struct("value", "n", "k"), "value").alias("_best")
    ).select("stratum", "measure", F.expr("_best.value as cutoff"), F.expr("_best.n as n"), F.expr("_best.k as rejected"))


def cutoff_map(cuts: DataFrame) -> DataFrame:
    """One row per stratum: a map from measure to cutoff, of at most as many entries as there are measures."""
    entries = F.map_from_entries(F.collect_list(F.struct("measure", "cutoff")))
    return cuts.groupBy("stratum").agg(entries.alias(f"{P}cuts"))


def verdict() -> str:
    """True where neither the base rule nor a cutoff rejects; over the counts and ``_q_cuts``."""
    rejects = [f"coalesce(double({expression}) >= {P}cuts['{name}'], false)" for name, expression in MEASURES.items()]
    return f"not ({base_failed()} or " + " or ".join(rejects) + ")"


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """``measured`` (stratum and counts among its columns) with base_failed and kept.

    The cutoffs are a few numbers for each stratum; Spark broadcasts them when their measured size is small and
    otherwise joins by shuffle.
    """
    per = cutoff_map(cuts).withColumnRenamed("stratum", f"{P}s")
    joined = measured.join(per, F.col("stratum").eqNullSafe(F.col(f"{P}s")), "left")
    return joined.withColumn("base_failed", F.expr(base_failed())).withColumn("kept", F.expr(verdict())).drop(f"{P}s", f"{P}cuts")


def measure_table(docs: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """doc_id, stratum and the counts of every document."""
    return with_measures(docs.select("doc_id", "text", F.col(risk.stratum).alias("stratum"))).select(
        "doc_id", "stratum", f"{P}m.*"
    )


def accepted(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only.

    Every text is measured once: rows and counts are written together, as the thresholds need the counts of all labelled
    documents before the first row can be judged. Thresholds join ids and counts only, no texts.
    """
    # The own columns are in a struct, as some could be named like counts.
    packed = with_measures(docs).select(F.struct(*docs.columns).alias(f"{P}row"), f"{P}m")
    measured = stage(packed, "quality-measured")
    counts = measured.select(f"{P}row.doc_id", F.col(f"{P}row.{risk.stratum}").alias("stratum"), f"{P}m.*")
    per = stage(cutoff_map(cutoffs(counts, labels, risk)), "quality-cutoffs").withColumnRenamed("stratum", f"{P}s")
    joined = measured.join(per, F.col(f"{P}row.{risk.stratum}").eqNullSafe(F.col(f"{P}s")), "left")
    return joined.select(f"{P}row", f"{P}m.*", f"{P}cuts").where(verdict()).select(f"{P}row.*")
