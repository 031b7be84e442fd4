"""Chat formatting with cumulative-snapshot collapse.

Loggers often store a conversation again after each turn. A rolling hash over the turns names
every prefix of every conversation; one whose whole hash is a proper prefix of another is a
snapshot and an anti-join drops it, so that only maximal conversations are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_shuffles, scratch

#: A conversation's key: its id, and whether it has one.
KEY = ["known", "id"]


def _turns(turns: DataFrame) -> DataFrame:
    """Rows known, id, turn, role, text; null role or text counts as empty."""
    conv = F.col("conv_id").cast("long")
    return turns.select(conv.isNotNull().alias("known"), F.coalesce(conv, F.lit(0).cast("long")).alias("id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def prefixes(turns: DataFrame) -> DataFrame:
    """The rolling hash after each turn: known, id, k (turns so far), h1, h2, whole (no turn follows).

    Rows that repeat a whole turn count once; turns of one number stand by role and text, a null
    number first. One sort by conversation and running sums: time and memory do not depend on how
    many turns a conversation has.
    """
    order = Window.partitionBy(*KEY).orderBy(F.asc_nulls_first("turn"), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = lambda c: F.lag(c).over(order)
    again = F.col("turn").eqNullSafe(before("turn")) & (F.col("role") == before("role")) & (F.col("text") == before("text"))
    rows = _turns(turns).withColumn("again", F.coalesce(again, F.lit(False))).where("not again").withColumn("k", F.row_number().over(order))
    # A turn's hash has its place in it, so the exclusive or of all so far names the prefix; the length keeps role and text apart.
    mix = lambda seed: F.bit_xor(f"h{seed}").over(so_far).alias(f"h{seed}")
    hashed = rows.select(*KEY, "turn", "role", "text", "k", *[F.xxhash64(F.lit(seed), "k", F.length("role"), "role", "text").alias(f"h{seed}") for seed in (1, 2)])
    return hashed.select(*KEY, "k", mix(1), mix(2), F.lead("k").over(order).isNull().alias("whole"))


def rendered(turns: DataFrame) -> DataFrame:
    """known, id, rendered: whole conversations in the chat format."""
    convs = _turns(turns).groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    body: Column = F.array_join(F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))), "")
    return convs.select(*KEY, body.alias("rendered"))


def maximal(turns: DataFrame) -> DataFrame:
    """Conversations that are no proper prefix of another; of identical ones the smallest conv_id stays (a null is the smallest).

    Columns: conv_id, n_turns, n_copies (identical logs, itself included), rendered. A null conv_id
    is a conversation too; null role or text counts as empty; other columns play no part; no rows
    give no rows.
    """
    # Texts are dealt out twice and not kept in between: once to be hashed, once to be rendered.
    rolled = scratch(prefixes(turns), "prefixes")
    free_shuffles(turns.sparkSession)
    # Proper prefixes of all conversations, folded before the shuffle: a common first turn is one row a task.
    proper = rolled.where("not whole").select("k", "h1", "h2").distinct()
    kept = rolled.where("whole").groupBy("k", "h1", "h2").agg(F.min(F.struct(*KEY)).alias("first"), F.count("*").alias("n_copies")).join(proper, ["k", "h1", "h2"], "left_anti")
    kept = kept.select("first.known", "first.id", F.col("k").cast("long").alias("n_turns"), "n_copies")
    return rendered(turns).join(kept, KEY).select(F.when(F.col("known"), F.col("id")).alias("conv_id"), "n_turns", "n_copies", "rendered")


ORACLE = """
    WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
    r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t),
    p AS (SELECT conv_id, k, string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY k) AS prefix,
          string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '') OVER (PARTITION BY conv_id ORDER BY k) AS rendered, max(k) OVER (PARTITION BY conv_id) AS n FROM r),
    f AS (SELECT conv_id, n, prefix, rendered FROM p WHERE k = n)
    SELECT CASE WHEN count(*) = count(conv_id) THEN min(conv_id) END AS conv_id, n AS n_turns, count(*) AS n_copies, any_value(rendered) AS rendered FROM f
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k < p.n AND p.prefix = f.prefix) GROUP BY prefix, n"""
