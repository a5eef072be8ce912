"""Session defaults and the shared scratch location."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Plans here have hundreds of columns; recording the Python line of each costs more than planning them.
    "spark.sql.dataFrameQueryContext.enabled": "false",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One patient, site or concept may own a large share of the rows; let the join split it even where
    # that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def session(master: str | None = None, app: str = "clinweave", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a new one on a local master."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/clinweave/{name}-{uuid.uuid4().hex[:12]}"


def settle(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint, so that later branches read the same rows once."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=eager)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of finished steps, which it does once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def in_parallel[A, B](run: Callable[[A], B], items: Sequence[A], at_once: int) -> list[B]:
    """Independent Spark jobs side by side, so that the tail of one does not idle the cluster."""
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(run, items))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver imported it from. Once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="run-")) / f"{here.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.rglob("*")):
            if f.is_file() and "__pycache__" not in f.parts:
                z.write(f, f.relative_to(here.parent))
    # Spark copies the file to every executor.
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
