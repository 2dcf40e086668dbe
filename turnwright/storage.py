"""Where rows that are worked out once are kept: the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only where that is unset and all runs in one process, a folder of our own, which goes
    with the process; elsewhere executors could not see such a folder, so an unset one raises."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="turnwright-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        root = f"file://{own}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """The rows worked out once and kept in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, as a URI; it goes with the driver, as far as that ends in order."""
    import pyarrow.fs as pafs

    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else f"file://{folder}"
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)

    def remove() -> None:
        with contextlib.suppress(OSError):
            fs.delete_dir(path)

    atexit.register(remove)
    return folder
