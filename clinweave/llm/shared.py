"""Scratch space that all executors see, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`. Where none is set, a local master gets one of its own (tests)."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="clinweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows as Parquet in the shared folder, read again: survives lost executors and cuts lineage."""
    path = table_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Rows per partition of a checkpointed table that is read again.
CHECKPOINT_ROWS = 100_000


def checkpointed(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint, for small rows in loops; few rows come back in few partitions."""
    shared_folder(frame.sparkSession)
    frame = frame.checkpoint(eager=True)
    return frame.coalesce(1 + frame.count() // CHECKPOINT_ROWS)
