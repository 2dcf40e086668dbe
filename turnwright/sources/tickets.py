"""Landed tickets, JSON lines of chat records, and tables that stand in for either."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.functions.speakers import ticket_messages
from turnwright.functions.text import clean_message, is_filler_only
from turnwright.operators.turns import fold_runs
from turnwright.sources.settings import PrepareSettings

ATTACHMENT = "struct<file_name:string,content_url:string>"
COMMENT = f"struct<id:bigint,author_id:bigint,created_at:string,public:boolean,body:string,attachments:array<{ATTACHMENT}>>"
METADATA = "struct<id:bigint,subject:string,status:string,created_at:string,updated_at:string,requester_id:bigint,submitter_id:bigint,assignee_id:bigint,group_id:bigint,tags:array<string>>"
TICKET = f"ticket_id bigint, id bigint, channel string, metadata {METADATA}, comments array<{COMMENT}>"
MESSAGES = "messages array<struct<role:string,content:string>>"
CORRUPT = "_corrupt"


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """One row for each landed ticket, with ``file`` and, for what can't be parsed, ``_corrupt``.

    A ticket has landed as a document of its own (``ticket_*.json``) or as a line of what an export wrote
    (``part-*.json``, in folders below too); a line's file is named as its document would be, so that both have the same
    order. The schema is given, not inferred, so batches can't drift and unread fields are never parsed.
    """

    def reader(glob: str, whole: bool) -> DataFrame:
        options = {"multiLine": whole, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreMissingFiles": True, "pathGlobFilter": glob, "recursiveFileLookup": True}
        return spark.read.schema(f"{TICKET}, {CORRUPT} string").options(**options).json(path).withColumn("file", F.col("_metadata.file_name"))

    lines = reader("part-*.json*", False)
    named = F.format_string("ticket_%d.json", F.coalesce("ticket_id", "id"))
    return reader("ticket_*.json", True).unionByName(lines.withColumn("file", F.when(F.coalesce("ticket_id", "id").isNotNull(), named).otherwise(F.col("file"))))


def assemble_tickets(tickets: DataFrame, comments: DataFrame, channel: str) -> DataFrame:
    """Ticket documents from search results and comments (ticket_id, id, author_id, created_at, public, body,
    attachments): each ticket with its comments in order of created_at, missing first, then as given by id."""
    item = F.struct(F.coalesce("created_at", F.lit("")).alias("k"), F.col("id").alias("i"), F.struct("id", "author_id", "created_at", F.coalesce("public", F.lit(True)).alias("public"), F.coalesce("body", F.lit("")).alias("body"), F.coalesce("attachments", F.expr(f"cast(array() as array<{ATTACHMENT}>)")).alias("attachments")).alias("c"))
    nested = comments.groupBy("ticket_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["c"]).alias("comments"))
    fields = [F.col(c) for c in ("id", "subject", "status", "created_at", "updated_at", "requester_id", "submitter_id", "assignee_id", "group_id")]
    metadata = F.struct(*fields, F.coalesce("tags", F.expr("cast(array() as array<string>)")).alias("tags"))
    found = tickets.select(F.col("id").alias("ticket_id"), "id", F.lit(channel).alias("channel"), metadata.alias("metadata"))
    return found.join(nested, "ticket_id", "left").withColumn("comments", F.coalesce("comments", F.expr(f"cast(array() as array<{COMMENT}>)")))


def not_yet_done(tickets: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Tickets whose id isn't among those done."""
    return tickets.join(done.select(id_col).distinct(), id_col, "left_anti")


def build_turns(tickets: DataFrame, settings: PrepareSettings) -> DataFrame:
    """(ticket_id, file, turn_pos, role, content, comment_ids) of all tickets that have a usable message.

    Messages are cleaned, judged and measured before neighbours of one role are merged. Everything happens within the
    row. Tickets take far more time than their bytes say, and a file of one row group is read by one task, so they are
    dealt out over all cores first.
    """
    s = settings
    tickets = tickets.repartition(F.xxhash64("ticket_id", "id", "comments"))
    ticket_id = F.coalesce(F.when(F.col("ticket_id") != 0, F.col("ticket_id")), F.col("id"))
    messages = ticket_messages(F.coalesce("comments", F.expr(f"cast(array() as array<{COMMENT}>)")), F.col("metadata.requester_id"), s.agent_names)
    cleaned = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), clean_message(m["text"], s.clean_attachments, s.clean_urls, s.redact_pii, s.clean_fillers, s.pii_safe_patterns).alias("text"), m["comment_id"].alias("comment_id")))

    def usable(m):
        fine = m["text"].isNotNull() & (m["text"] != "") & (F.length(m["text"]) >= s.min_message_length)
        return fine & ~is_filler_only(m["text"]) if s.drop_filler_only else fine

    rows = tickets.select(ticket_id.alias("ticket_id"), *([F.col("file")] if "file" in tickets.columns else []), F.filter(cleaned, usable).alias("_messages"))
    rows = rows.select(*[c for c in rows.columns if c != "_messages"], F.posexplode(fold_runs(F.col("_messages"))).alias("turn_pos", "_m"))
    return rows.select(*[c for c in rows.columns if c not in ("_m", "turn_pos")], "turn_pos", "_m.*")


def turns_of_conversations(conversations: DataFrame) -> DataFrame:
    """The table (conv_id, turn, role, text) as turns: user is the customer, assistant the agent; others are left out."""
    role = F.when(F.col("role") == "user", F.lit("customer")).when(F.col("role") == "assistant", F.lit("agent"))
    rows = conversations.select(F.col("conv_id").alias("ticket_id"), F.col("turn").cast("int").alias("turn_pos"), role.alias("role"), F.coalesce("text", F.lit("")).alias("content"), F.array(F.col("turn")).alias("comment_ids"))
    return rows.where("role is not null")


def turns_of_documents(documents: DataFrame) -> DataFrame:
    """Each document as a conversation of one turn, in a single split and in order of its id."""
    return documents.select(F.lit("all").alias("split"), F.col("doc_id").alias("conv_pos"), F.lit(0).alias("turn_pos"), F.lit("customer").alias("role"), F.coalesce("text", F.lit("")).alias("content"))


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def read_records(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """Chat records from JSON lines; blank lines are skipped. A missing path has no records, or raises if required."""
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], MESSAGES)
    return spark.read.schema(MESSAGES).json(path).where("messages is not null")


def write_records(records: DataFrame, path: str, order: str | None = None, single_file: bool = False) -> None:
    """Chat records as JSON lines in UTF-8. Only a small dataset that must be one ordered file is brought together."""
    rows = records
    if single_file:
        rows = rows.orderBy(order).coalesce(1) if order else rows.coalesce(1)
    rows.select("messages").write.mode("overwrite").json(path)


def write_summary(spark: SparkSession, summary: Mapping[str, Any], path: str) -> None:
    spark.createDataFrame([(json.dumps(summary, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_summary(given: str | None, defaults: tuple[str, ...] = ("score_stats.json",), keys: tuple[str, ...] = ("total_raw", "skip_count", "duplicate_dropped", "train_stats")) -> dict[str, Any]:
    """Run counters from a file, from inline JSON, or from the first default file with a known key; else none."""
    import os

    def parse(text: str) -> dict[str, Any]:
        value = json.loads(text)
        return value if isinstance(value, dict) else {}

    if given:
        if os.path.isfile(given):
            with open(given, encoding="utf-8") as f:
                return parse(f.read())
        return parse(given)
    for path in defaults:
        if os.path.isfile(path):
            with open(path, encoding="utf-8") as f:
                found = parse(f.read())
            if any(k in found for k in keys):
                return found
    return {}
