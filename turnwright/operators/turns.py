"""Operators on flat turns: (ticket_id, turn_pos, role, content, comment_ids), often with split and conv_pos.

The order of a conversation is explicit in turn_pos; rows themselves have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUSTOMER, AGENT, SYSTEM = "customer", "agent", "system"


def merge_runs(turns: DataFrame, key: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """Neighbouring turns of one role become one: contents joined by line ends, comment ids gathered.

    turn_pos is numbered anew from 0. Ties of turn_pos are ordered by content.
    """
    order = Window.partitionBy(*key).orderBy("turn_pos", "content")
    marked = turns.withColumn("_new", (~F.col("role").eqNullSafe(F.lag("role").over(order)) | (F.row_number().over(order) == 1)).cast("int"))
    runs = marked.withColumn("_run", F.sum("_new").over(order) - 1)
    item = F.struct("turn_pos", "content", "comment_ids")
    gathered = runs.groupBy(*key, "_run").agg(F.first("role").alias("role"), F.array_sort(F.collect_list(item)).alias("_items"))
    return gathered.select(*key, F.col("_run").cast("int").alias("turn_pos"), "role", F.array_join(F.transform("_items", lambda x: x["content"]), "\n").alias("content"), F.flatten(F.transform("_items", lambda x: x["comment_ids"])).alias("comment_ids"))


def fold_runs(messages: Column) -> Column:
    """The same on an array<struct<role, text, comment_id>> within a row, without a shuffle.

    Gives array<struct<role, content, comment_ids>>.
    """
    empty = F.expr("cast(array() as array<struct<role:string,content:string,comment_ids:array<bigint>>>)")

    def step(done: Column, m: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["role"].alias("role"), F.concat_ws("\n", last["content"], m["text"]).alias("content"), F.concat(last["comment_ids"], F.array(m["comment_id"])).alias("comment_ids"))
        fresh = F.struct(m["role"].alias("role"), m["text"].alias("content"), F.array(m["comment_id"]).alias("comment_ids"))
        same = (F.size(done) > 0) & (last["role"] == m["role"])
        return F.when(same, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(fresh)))

    return F.aggregate(messages, empty, step)


def with_both_roles(turns: DataFrame, key: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """Turns of conversations that have a customer's and an agent's turn."""
    both = turns.groupBy(*key).agg(F.max((F.col("role") == CUSTOMER).cast("int")).alias("_c"), F.max((F.col("role") == AGENT).cast("int")).alias("_a")).where("_c = 1 and _a = 1").select(*key)
    return turns.join(both, list(key), "left_semi")


def without_broken(turns: DataFrame, key: Sequence[str] = ("ticket_id",), least: int = 2) -> DataFrame:
    """Turns of conversations with ``least`` turns that aren't the system's."""
    whole = turns.groupBy(*key).agg(F.count_if(F.col("role") != SYSTEM).alias("_n")).where(F.col("_n") >= least).select(*key)
    return turns.join(whole, list(key), "left_semi")


def conversation_stats(turns: DataFrame, key: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """One row: conversations, turns, customer and agent turns, and the average, least and most turns of one."""
    each = turns.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(F.col("role") == CUSTOMER).alias("c"))
    return each.agg(
        F.count("*").alias("total_conversations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_turns"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("customer_turns"),
        F.coalesce(F.sum("n") - F.sum("c"), F.lit(0)).alias("agent_turns"),
        F.bround(F.avg("n"), 1).alias("avg_turns"),
        F.min("n").alias("min_turns"),
        F.max("n").alias("max_turns"),
    )


def chat_records(turns: DataFrame, system_prompt: str, key: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """(key, messages): the prompt first, then the turns with customer as user and all others as assistant."""
    role = F.when(F.col("role") == CUSTOMER, F.lit("user")).otherwise(F.lit("assistant"))
    rows = turns.select(*key, F.struct("turn_pos", role.alias("role"), "content").alias("_m"))
    told = F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    talk = F.transform(F.array_sort(F.collect_list("_m")), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return rows.groupBy(*key).agg(F.concat(told, talk).alias("messages"))


def prompt_and_reply(records: DataFrame) -> DataFrame:
    """messages split for training: everything before the last message is the prompt, the last one the reply."""
    n = F.size("messages")
    return records.withColumn("prompt", F.slice("messages", F.lit(1), F.greatest(n - 1, F.lit(0)))).withColumn("reply", F.try_element_at("messages", F.lit(-1)))
