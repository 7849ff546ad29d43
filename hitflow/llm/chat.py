"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Chat logs often hold one conversation many times, each snapshot a few turns longer. The hash of a prefix is the
exclusive-or of its turns' hashes, each salted with its place, so prefixes roll on from turn to turn in one
window. A conversation whose whole hash is a proper prefix of another one goes (anti-join); of equal ones
the smallest conv_id stays. What is left is rendered, one text per conversation.

Hashes have 128 bits. Prefixes are made distinct before the join, so many conversations with one beginning cost no
pairs. A conversation is one row of the result, hence the unit that a task must hold.

Defined cases: turns are in order of turn (null first), then role and text; a null role or text counts as empty; rows
with a null conv_id form one conversation; repeated rows are turns of their own; control marks inside a
text or a role are broken up, so that neither can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with its place, the length of its conversation and the hash of the prefix that it ends."""
    clean = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rolling = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = clean.withColumn("place", F.row_number().over(order)).withColumn("n_turns", F.count("*").over(W.partitionBy("conv_id")))
    salted = placed.withColumns(
        {
            "_s1": F.xxhash64("place", F.length("role"), "role", "text"),
            "_s2": F.xxhash64(F.lit(7), "text", F.length("role"), "role", "place"),
        }
    )
    return salted.withColumns({"h1": F.bit_xor("_s1").over(rolling), "h2": F.bit_xor("_s2").over(rolling)}).drop("_s1", "_s2")


def maximal(hashed: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no prefix of another one, one of each set of equal ones."""
    inner = hashed.where("place < n_turns").select("h1", "h2").distinct()
    ends = hashed.where("place = n_turns").groupBy("h1", "h2", "n_turns").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id")).alias("_first"))
    return ends.join(inner, ["h1", "h2"], "left_anti").select(F.col("_first.conv_id").alias("kept_id"))


def _broken(column: str) -> str:
    return f"replace(replace({column}, '<|', '< |'), '|>', '| >')"


def rendered_turn() -> str:
    return f"concat('{OPEN}', {_broken('role')}, '\\n', {_broken('text')}, '{CLOSE}\\n')"


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and text of every maximal conversation of ``turns`` (conv_id, turn, role, text)."""
    hashed = prefixes(turns)
    kept = hashed.join(maximal(hashed), F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    turn = F.struct("place", F.expr(rendered_turn()).alias("line"))
    return (
        kept.groupBy("conv_id")
        .agg(F.count("*").alias("n_turns"), F.sort_array(F.collect_list(turn)).alias("_turns"))
        .select("conv_id", "n_turns", F.array_join("_turns.line", "").alias("text"))
    )


COLLAPSE_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER w AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))
), whole AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY place) AS turns, count(*) AS n_turns FROM turns GROUP BY conv_id
), inner_prefix AS (
  SELECT DISTINCT whole.turns[1:i.i] AS turns FROM whole, LATERAL (SELECT unnest(range(1, whole.n_turns)) AS i) i
), kept AS (
  SELECT min(conv_id) AS conv_id FROM whole WHERE turns NOT IN (SELECT turns FROM inner_prefix) GROUP BY turns
)
SELECT conv_id, count(*) AS n_turns,
  string_agg('<|im_start|>' || replace(replace(role, '<|', '< |'), '|>', '| >') || chr(10) || replace(replace(text, '<|', '< |'), '|>', '| >') || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
FROM turns WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id
"""
