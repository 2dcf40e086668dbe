"""From the search API to landed tickets: search, leave out what is done, fetch comments, assemble, land a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.sources.rest import TicketSearch, fetch_comments
from turnwright.sources.settings import ExportSettings
from turnwright.sources.tickets import _exists, assemble_tickets, not_yet_done
from turnwright.storage import cut


def search(spark: SparkSession, s: ExportSettings) -> DataFrame:
    """Tickets of the settings' range and channel."""
    spark.dataSource.register(TicketSearch)
    given = {"base_url": s.base_url, "user": s.user, "token": s.token, "channel": None if s.channel == "any" else s.channel, "start": s.start, "end": s.end, "page_size": s.page_size, "most_rows": s.most_rows, "retries": s.retries, "backoff": s.backoff}
    return spark.read.format("ticket_search").options(**{k: str(v) for k, v in given.items() if v is not None}).load()


def export(spark: SparkSession, s: ExportSettings, out: str) -> dict:
    """Lands new tickets as a batch of JSON lines below ``out``/raw, in order of their creation, and then their ids
    below ``out``/done; returns counters. ``read_tickets`` reads what is landed.

    A batch's number is that of the first run that isn't done, and its folders are overwritten: what a run that ended
    early has landed is replaced by the next one, so a ticket is there once. A ticket whose comments can't be found is
    counted as failed and tried again by the next run. Missing credentials or dates return an error instead.
    """
    if not s.base_url or not s.token:
        return {"error": "missing_credentials"}
    if not s.start:
        return {"error": "missing_start_date"}
    found = cut(search(spark, s).dropDuplicates(["id"]))
    done = spark.read.schema("id bigint, batch bigint").parquet(f"{out}/done") if _exists(spark, f"{out}/done") else spark.createDataFrame([], "id bigint, batch bigint")
    number = done.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]
    todo = cut(not_yet_done(found, done.select("id")))
    comments = cut(fetch_comments(todo, s.base_url, s.user, s.token, s.retries, s.backoff))
    failed = comments.where("failed").select(F.col("ticket_id").alias("id")).distinct()
    fetched = todo.join(failed, "id", "left_anti")
    tickets = assemble_tickets(fetched, comments.where("not failed").drop("failed"), s.channel)
    tickets.orderBy(F.col("metadata.created_at"), "ticket_id").write.mode("overwrite").json(f"{out}/raw/batch={number}")
    fetched.select("id").write.mode("overwrite").parquet(f"{out}/done/batch={number}")
    counts = {"found": found.count(), "to_do": todo.count(), "failed": failed.count()}
    return counts | {"already_done": counts["found"] - counts["to_do"], "exported": counts["to_do"] - counts["failed"]}
