"""Preference formatting, in DataFrame functions only.

A pair's conversations share their longest common prefix of equal turns
(role and text). The prefix is rendered once, as the prompt; what follows on
either side becomes that side's completion, with a mask that trains only the
assistant's turns: run lengths in characters, ``<length>:<0 or 1>`` joined by
commas, headers and other roles 0. Turn markers inside texts are broken up,
so no text can open or close a turn.

Defined results: a null role or text counts as empty; identical
conversations, or one that is a prefix of the other, leave an empty
completion and are not usable; so is a side without an assistant's turn after
the prompt. Turns repeated row by row count once; turns of one number stand
in order of role and text; a null number comes first. Turns without a
conversation belong to none. An empty table gives an empty result; only
conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.common import bind, table

OPEN, CLOSE, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit(f"{CLOSE}\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Run lengths of a rendering with their training flags."""
    flag = lambda t: F.when(t["role"] == TRAINED, F.lit(":1")).otherwise(F.lit(":0"))
    return F.array_join(F.transform(turns, lambda t: F.concat(F.length(_header(t)).cast("string"), F.lit(":0,"), F.length(_body(t)).cast("string"), flag(t))), ",")


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """How many leading turns are equal (null-safe)."""
    longest = F.greatest(F.size(chosen), F.size(rejected))
    differs = F.transform(F.sequence(F.lit(0), longest), lambda i: (i == longest) | ~F.get(chosen, i).eqNullSafe(F.get(rejected, i)))
    return F.array_position(differs, True) - 1


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` has a key, chosen and rejected (arrays of struct role, text): key, n_shared,
    prompt, chosen, rejected, their masks, and usable (both sides train something)."""
    def shape(side: Column, shared: Column) -> Column:
        rest = F.slice(side, (shared + 1).cast("int"), F.greatest(F.size(side) - shared, F.lit(0)).cast("int"))
        return bind(rest, lambda t: F.struct(render(t).alias("text"), mask(t).alias("mask"), F.exists(t, lambda x: x["role"] == TRAINED).alias("trains")))

    def both(p: Column) -> Column:
        return bind(common_prefix(p["c"], p["r"]), lambda n: F.struct(
            n.cast("long").alias("n"), render(F.slice(p["c"], F.lit(1), n.cast("int"))).alias("prompt"), shape(p["c"], n).alias("c"), shape(p["r"], n).alias("r")))

    clean = lambda side: F.transform(side, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    pair = F.struct(clean(F.col("chosen")).alias("c"), clean(F.col("rejected")).alias("r"))
    return pairs.select("key", bind(pair, both).alias("_x")).select(
        "key", F.col("_x.n").alias("n_shared"), F.col("_x.prompt").alias("prompt"), F.col("_x.c.text").alias("chosen"), F.col("_x.r.text").alias("rejected"),
        F.col("_x.c.mask").alias("chosen_mask"), F.col("_x.r.mask").alias("rejected_mask"), (F.col("_x.c.trains") & F.col("_x.r.trains")).alias("usable"))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order (array of struct role, text); a conversation is one row's value."""
    clean = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_set(clean)).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def stale_reply_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: chosen is the conversation; rejected ends at its last
    assistant's turn with the reply of the assistant's turn before it (empty if there is none).
    Without an assistant's turn both are the conversation."""
    def reject(t: Column) -> Column:
        places = F.filter(F.transform(t, lambda x, i: F.when(x["role"] == TRAINED, i)), lambda i: i.isNotNull())
        swapped = lambda p: F.concat(
            F.slice(t, F.lit(1), F.element_at(p, -1)),
            F.array(F.struct(F.lit(TRAINED).alias("role"), F.coalesce(F.get(t, F.get(p, F.size(p) - 2))["text"], F.lit("")).alias("text"))))
        return bind(places, lambda p: F.when(F.size(p) > 0, swapped(p)).otherwise(t))

    return conversations(turns).select(F.col("conv_id").alias("key"), F.col("turns").alias("chosen"), bind(F.col("turns"), reject).alias("rejected"))


def op9_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(stale_reply_pairs(table(spark, sf_dir, "conversations"))).withColumnRenamed("key", "conv_id")


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, role, body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS k FROM t),
a AS (SELECT conv_id, max(k) AS n, max(k) FILTER (role = 'assistant') AS last FROM s GROUP BY conv_id),
stale AS (SELECT a.conv_id, coalesce(arg_max(s.body, s.k), '') AS body FROM a LEFT JOIN s ON s.conv_id = a.conv_id AND s.role = 'assistant' AND s.k < a.last GROUP BY a.conv_id),
r AS (SELECT s.conv_id, s.k, s.role, CASE WHEN s.k = a.last THEN stale.body ELSE s.body END AS body
      FROM s JOIN a USING (conv_id) JOIN stale USING (conv_id) WHERE a.last IS NULL OR s.k <= a.last),
d AS (SELECT s.conv_id, min(s.k) - 1 AS shared FROM s LEFT JOIN r ON r.conv_id = s.conv_id AND r.k = s.k
      WHERE r.k IS NULL OR r.role <> s.role OR r.body <> s.body GROUP BY s.conv_id),
p AS (SELECT conv_id, coalesce(shared, n) AS shared FROM a LEFT JOIN d USING (conv_id)),
x AS (SELECT side, q.conv_id, q.k, q.role, p.shared, '<|im_start|>' || q.role || chr(10) AS head, replace(q.body, '<|', '< |') || '<|im_end|>' || chr(10) AS tail
      FROM (SELECT 'c' AS side, * FROM (SELECT conv_id, k, role, body FROM s) UNION ALL SELECT 'r', conv_id, k, role, body FROM r) q JOIN p USING (conv_id)),
y AS (SELECT *, length(head) || ':0,' || length(tail) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END AS marks FROM x)
SELECT conv_id, CAST(any_value(shared) AS BIGINT) AS n_shared,
  coalesce(string_agg(head || tail, '' ORDER BY k) FILTER (side = 'c' AND k <= shared), '') AS prompt,
  coalesce(string_agg(head || tail, '' ORDER BY k) FILTER (side = 'c' AND k > shared), '') AS chosen,
  coalesce(string_agg(head || tail, '' ORDER BY k) FILTER (side = 'r' AND k > shared), '') AS rejected,
  coalesce(string_agg(marks, ',' ORDER BY k) FILTER (side = 'c' AND k > shared), '') AS chosen_mask,
  coalesce(string_agg(marks, ',' ORDER BY k) FILTER (side = 'r' AND k > shared), '') AS rejected_mask,
  coalesce(bool_or(role = 'assistant') FILTER (side = 'c' AND k > shared), false) AND coalesce(bool_or(role = 'assistant') FILTER (side = 'r' AND k > shared), false) AS usable
FROM y GROUP BY conv_id"""
