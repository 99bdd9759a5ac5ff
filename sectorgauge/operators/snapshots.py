"""Snapshot registry: bookmarks, rollback."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OK, CORRUPTED = "OK", "Corrupted"
BOOKMARK_COLUMNS = ["s3key", "servicename", "status", "created", "updated"]


def append_bookmark(bookmarks: DataFrame, incoming: DataFrame) -> DataFrame:
    """Registry with new entries; an entry for a known snapshot replaces the old one."""
    kept = bookmarks.join(
        incoming.select("servicename", "s3key"), ["servicename", "s3key"], "left_anti"
    )
    return kept.select(*BOOKMARK_COLUMNS).unionByName(incoming.select(*BOOKMARK_COLUMNS))


def _newest_ok(bookmarks: DataFrame, rank: int) -> DataFrame:
    """The rank-th newest good snapshot per service.

    The rank filter is applied before the shuffle as well, so a service with most
    of the entries does not gather them in one task.
    """
    newest_first = Window.partitionBy("servicename").orderBy(
        F.desc("updated"), F.desc("s3key")
    )
    return (
        bookmarks.filter(F.col("status") == OK)
        .withColumn("age", F.row_number().over(newest_first))
        .filter(F.col("age") <= 2)
        .filter(F.col("age") == rank)
        .drop("age")
    )


def rollback_target(bookmarks: DataFrame) -> DataFrame:
    """Snapshot to return to: the second newest good one, if there is one."""
    return _newest_ok(bookmarks, 2).select("servicename", "s3key", "updated")


def mark_rolled_back(bookmarks: DataFrame, now: dt.datetime) -> DataFrame:
    """Registry after a rollback: the newest good snapshot becomes 'Corrupted'.

    Services without a second good snapshot are left alone.
    """
    services = rollback_target(bookmarks).select("servicename")
    withdrawn = (
        _newest_ok(bookmarks, 1)
        .join(services, "servicename", "left_semi")
        .select("servicename", "s3key", F.lit(True).alias("withdrawn"))
    )
    marked = bookmarks.join(withdrawn, ["servicename", "s3key"], "left")
    return marked.select(
        "s3key",
        "servicename",
        F.when(F.col("withdrawn"), CORRUPTED).otherwise(F.col("status")).alias("status"),
        "created",
        F.when(F.col("withdrawn"), F.lit(now).cast(bookmarks.schema["updated"].dataType))
        .otherwise(F.col("updated"))
        .alias("updated"),
    )
