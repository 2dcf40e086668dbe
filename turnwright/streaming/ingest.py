"""Landing tickets as a stream: new files are parsed, built into turns and appended, each ticket once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnwright.sources.settings import PrepareSettings
from turnwright.sources.tickets import CORRUPT, TICKET, build_turns


def stream_tickets(spark: SparkSession, path: str, lines: bool = False, files_per_batch: int = 10_000) -> DataFrame:
    """New tickets of a folder, as they come: documents of their own, or ``lines`` that an export landed. The schema is
    fixed."""
    options = {"multiLine": not lines, "columnNameOfCorruptRecord": CORRUPT, "pathGlobFilter": "part-*.json*" if lines else "ticket_*.json", "maxFilesPerTrigger": files_per_batch, "recursiveFileLookup": True}
    return spark.readStream.schema(f"{TICKET}, {CORRUPT} string").options(**options).json(path)


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, settings: PrepareSettings, lines: bool = False) -> StreamingQuery:
    """Appends turns of tickets not seen before to ``out``/turns and their ids to ``out``/done, until no file is left.

    ``lines`` is as in stream_tickets. Each batch writes folders of its own number, overwriting what a failed attempt left, so a restart repeats nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        tickets = rows.where(F.col(CORRUPT).isNull()).withColumn("_key", F.coalesce("ticket_id", "id")).dropDuplicates(["_key"])
        done_path = session._jvm.org.apache.hadoop.fs.Path(f"{out}/done")
        if done_path.getFileSystem(session._jsc.hadoopConfiguration()).exists(done_path):
            done = session.read.schema("_key bigint, batch bigint").parquet(f"{out}/done").where(F.col("batch") != number)
            tickets = tickets.join(done, "_key", "left_anti")
        tickets = tickets.persist()
        try:
            build_turns(tickets.drop("_key"), settings).write.mode("overwrite").parquet(f"{out}/turns/batch={number}")
            tickets.select("_key").write.mode("overwrite").parquet(f"{out}/done/batch={number}")
        finally:
            tickets.unpersist()

    return stream_tickets(spark, path, lines).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
