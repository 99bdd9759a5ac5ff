"""Stored intermediate tables.

An operator that reads its input more than once should read a stored table, not
recompute the plan behind it. Stages live in the shared folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor costs a re-read and nothing
more.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stage_root(spark: SparkSession) -> str:
    """The shared folder of the session; a scratch folder only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sectorgauge-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder below the session's own, for one stored table."""
    path = f"{stage_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the stage folder and return the stored table."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files behind stored tables: it does once the driver forgets their plans.

    Listeners hold the plan of a write for a moment after it, so this looks twice.
    """
    for pause in (0.5, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(pause)


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the stages made inside the block when it ends; gives their folders.

    For jobs, whose results are stored tables: a DataFrame that still reads a stage
    can't be used after the block.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
