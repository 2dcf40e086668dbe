"""Multi-party perspective rotation of dialogues with DataFrame functions only (operator 3).

For every participant of a conversation there is one rendering with that speaker as the assistant, every other
speaker as a named user, and the loss mask on the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwright.llm.arrays import scanned

SYSTEM = "system"
END = "<|end|>\n"


def _head(role: Column, perspective: Column) -> Column:
    return F.when(role == SYSTEM, F.lit("<|system|>\n")).when(role == perspective, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, n_turns, n_target, rendered, mask), a row for each participant of each conversation.

    Turns come in ascending order of turn, then speaker, then text; null turns first, so ties and repeated rows have
    one order. A null speaker is ``unknown``, a null text is empty, and a null conversation id is a conversation of
    its own. ``system`` speaks in every rendering and is no participant; a conversation with no other speaker has no
    rows. ``<|`` within a text or a name becomes ``< |``, so no text can forge a marker.

    mask lists the spans that carry loss as start:end in code points of rendered, comma-joined: the assistant's
    texts with their end markers. One row is one rendered dialogue; nothing larger than a conversation is gathered.
    """
    def safe(c: Column) -> Column:
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    role = safe(F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")))
    text = safe(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("m"))
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    speakers = F.array_sort(F.array_distinct(F.filter(F.transform("ms", lambda m: m["role"]), lambda r: r != SYSTEM)))
    turned = talks.select("conv_id", "ms", F.explode(speakers).alias("perspective"))
    me = F.col("perspective")
    parts = F.transform("ms", lambda m: F.struct(_head(m["role"], me).alias("head"), F.concat(m["text"], F.lit(END)).alias("body"), (m["role"] == me).alias("mine")))
    turned = turned.select("conv_id", "perspective", F.size("ms").cast("long").alias("n_turns"), parts.alias("parts"))

    ends = scanned(F.transform("parts", lambda p: F.length(p["head"]) + F.length(p["body"])))
    turned = turned.withColumn("placed", F.arrays_zip(F.col("parts").alias("p"), ends.alias("end")))
    spans = F.transform(F.filter("placed", lambda x: x["p"]["mine"]), lambda x: F.concat_ws(":", (x["end"] - F.length(x["p"]["body"])).cast("string"), x["end"].cast("string")))
    return turned.select(
        F.col("conv_id").alias(conv_col),
        "perspective",
        "n_turns",
        F.size(F.filter("parts", lambda p: p["mine"])).cast("long").alias("n_target"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        F.array_join(spans, ",").alias("mask"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM conversations
), p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
s AS (
  SELECT t.conv_id, p.perspective, t.turn, t.role, t.body, t.role = p.perspective AS mine,
         CASE WHEN t.role = 'system' THEN '<|system|>' WHEN t.role = p.perspective THEN '<|assistant|>'
              ELSE '<|user name=' || t.role || '|>' END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective
            ORDER BY turn NULLS FIRST, role, body ROWS UNBOUNDED PRECEDING) AS stop
  FROM s
)
SELECT conv_id, perspective, count(*) AS n_turns, count(*) FILTER (WHERE mine) AS n_target,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, body) AS rendered,
       coalesce(string_agg(CAST(CAST(stop AS BIGINT) - length(body) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR), ',' ORDER BY stop)
                FILTER (WHERE mine), '') AS mask
FROM o GROUP BY conv_id, perspective
"""
