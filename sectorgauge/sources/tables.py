"""Readers and writers of Parquet tables and dated snapshots."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from hashlib import md5
from itertools import groupby
from os.path import commonprefix
from urllib.parse import unquote
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorgauge.sources import schemas

SNAPSHOT = "syscreated"
#: Attempts to store a version while others store theirs.
COMMIT_TRIES = 20


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Table with the given columns, whatever their case and order in the files.

    The declared schema replaces footer merging: files written before a column
    existed give NULL, and planning does not open every file. Files may hold a
    narrower type than declared, each its own: integers for a long, a double or a
    decimal with room for their digits, decimals for a wider one. Partition folders
    under ``path`` are discovered, and filters on them prune folders.
    """
    columns = T.StructType.fromDDL(schema).fieldNames()
    return spark.read.schema(schema).parquet(path).select(*columns)


def sample_files(
    spark: SparkSession, path: str, schema: str, fraction: float, seed: int = 42
) -> DataFrame:
    """A trial run's share of a table's files; the other files are never opened.

    Files are put in order by a hash of seed, folder and place among the files of the
    folder, not of their random names, and the first ``fraction`` of them, rounded up,
    are read. A table rewritten with the same folders and numbers of files gives the
    same choice. Files count alike whatever their size, and one file is read whole.
    """
    if not 0 < fraction <= 1:
        raise ValueError("the share of files lies between 0 and 1")
    files = sorted(map(unquote, spark.read.schema(schema).parquet(path).inputFiles()))
    if not files:
        return read_table(spark, path, schema)
    folders = [f.rpartition("/")[0] for f in files]
    skip = commonprefix(folders).rfind("/") + 1
    ranked = []
    for folder, own in groupby(zip(folders, files, strict=True), key=lambda x: x[0]):
        for place, (_, name) in enumerate(own):
            ranked.append((md5(f"{seed}:{folder[skip:]}:{place}".encode()).hexdigest(), name))
    chosen = [name for _, name in sorted(ranked)[: math.ceil(fraction * len(files))]]
    literal = [re.sub(r"([\\*?{}\[\]])", r"\\\1", name) for name in chosen]
    columns = T.StructType.fromDDL(schema).fieldNames()
    return spark.read.schema(schema).option("basePath", path).parquet(*literal).select(*columns)


def _dated_folders(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of the first-level partition folders that hold finished writes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{column}=*/_SUCCESS")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    names = [f.getPath().getParent().getName() for f in files or []]
    return sorted(name.split("=", 1)[1] for name in names)


def latest_date(spark: SparkSession, root: str, column: str = SNAPSHOT) -> str | None:
    """Most recent finished snapshot, from one folder listing; no data is read."""
    dates = _dated_folders(spark, root, column)
    return dates[-1] if dates else None


def read_snapshot(
    spark: SparkSession, root: str, schema: str, date: str | None = None, column: str = SNAPSHOT
) -> DataFrame | None:
    """One snapshot, the latest by default; None when there is no such snapshot."""
    dates = _dated_folders(spark, root, column)
    chosen = date or (dates[-1] if dates else None)
    if chosen not in dates:
        return None
    return read_table(spark, f"{root}/{column}={chosen}", schema)


def _written(df: DataFrame, path: str, *partition_by: str) -> int:
    """Write ``df`` over ``path``; its rows are counted by the tasks that write them."""
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return counted.get["rows"]


def write_table(df: DataFrame, path: str, sort_by: str | None = None) -> int:
    """Replace a table; returns the number of rows stored.

    ``sort_by`` orders the rows of each file, so that readers of few values of the
    column skip most row groups.
    """
    if sort_by is not None:
        df = df.sortWithinPartitions(sort_by)
    return _written(df, path)


def write_snapshot(
    df: DataFrame,
    root: str,
    date: str,
    partition_by: str | None = None,
    column: str = SNAPSHOT,
) -> int:
    """Write one dated snapshot, replacing a previous one of the same date.

    Rows are rebalanced on the partition column before the write: small
    partitions become one file, large ones are split over several tasks. Returns
    the number of rows stored.
    """
    path = f"{root}/{column}={date}"
    if partition_by is None:
        return _written(df.hint("rebalance"), path)
    return _written(df.hint("rebalance", partition_by), path, partition_by)


def write_snapshots(df: DataFrame, root: str, column: str = SNAPSHOT) -> int:
    """Write a snapshot for each value of ``column`` in one job, replacing those of the
    same dates and no others; returns the number of rows stored.

    Rows are dealt to as many tasks as the session shuffles to, by ranges of date and row
    hash: a large date is split, and many small ones are not one task's. The dates must fit a list on the driver, which marks their folders as finished.
    """
    counted = Observation()
    dates = F.collect_set(F.col(column).cast("string")).alias("dates")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, column, F.xxhash64(*df.columns)).sortWithinPartitions(column)
    rows = dealt.observe(counted, F.count(F.lit(1)).alias("rows"), dates)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(root)
    for date in counted.get["dates"]:
        marker, fs = _file(df.sparkSession, f"{root}/{column}={date}/_SUCCESS")
        fs.create(marker, True).close()
    return counted.get["rows"]


# ------------------------------------------------------------------ versioned tables
def _file(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the newest version of a table; 0 before the first."""
    pattern, fs = _file(spark, f"{root}/versions/[0-9]*")
    return max((int(f.getPath().getName()) for f in fs.globStatus(pattern) or []), default=0)


def read_version(
    spark: SparkSession, root: str, schema: str, version: int | None = None
) -> DataFrame | None:
    """One version of a table, the newest by default; None before the first."""
    version = latest_version(spark, root) if version is None else version
    if version == 0:
        return None
    folder = spark.read.text(f"{root}/versions/{version:010d}").first()[0]
    return read_table(spark, f"{root}/data/{folder}", schema)


def _claim(spark: SparkSession, root: str, version: int, folder: str) -> bool:
    """Make ``folder`` the given version, unless another folder already is.

    The marker is complete before it gets its name, and a name is given once: renaming
    without overwriting is one step on file systems that offer it (HDFS does; a local
    folder or an object store may let two writers through that rename at once).
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft, fs = _file(spark, f"{root}/drafts/{folder}")
    out = fs.create(draft, True)
    out.write(bytearray(folder.encode()))
    out.close()
    marker, _ = _file(spark, f"{root}/versions/{version:010d}")
    fs.mkdirs(marker.getParent())
    context = hadoop.FileContext.getFileContext(
        fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(marker), options)
    except Py4JJavaError as refused:
        if "FileAlreadyExistsException" not in refused.java_exception.getClass().getName():
            raise
        fs.delete(draft, False)
        return False
    return True


def commit_version(
    spark: SparkSession,
    root: str,
    schema: str,
    build: Callable[[DataFrame | None], DataFrame],
) -> int:
    """Store what ``build`` makes of the newest version as the next one; gives its number.

    Data are stored in a folder of their own first, so readers keep the newest version
    until the next is complete. If another writer took the number in between, its rows
    are the newest version now, and ``build`` starts again from them: no change is lost.
    """
    for _ in range(COMMIT_TRIES):
        latest = latest_version(spark, root)
        rows = build(read_version(spark, root, schema, latest))
        folder = uuid4().hex
        check_columns(rows, schema).hint("rebalance").write.parquet(f"{root}/data/{folder}")
        if _claim(spark, root, latest + 1, folder):
            return latest + 1
        lost, fs = _file(spark, f"{root}/data/{folder}")
        fs.delete(lost, True)
    raise RuntimeError(f"{root} changed {COMMIT_TRIES} times while a version was made")


def read_bookmarks(spark: SparkSession, root: str) -> DataFrame:
    """Current registry; empty before the first publication."""
    return or_no_bookmarks(spark, read_version(spark, root, schemas.BOOKMARKS))


def or_no_bookmarks(spark: SparkSession, registry: DataFrame | None) -> DataFrame:
    """The registry, or an empty one."""
    return spark.createDataFrame([], schemas.BOOKMARKS) if registry is None else registry


def check_columns(df: DataFrame, schema: str) -> DataFrame:
    """``df`` in the declared column order; fails early if a column is missing."""
    wanted = T.StructType.fromDDL(schema)
    missing = set(wanted.fieldNames()) - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
