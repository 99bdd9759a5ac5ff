"""Mixing sources to target weights.

Every document gets a random key, the hash of its id. Keys are split into equal ranges;
word counts are summed per source and range, prefix sums over the ranges find the range
in which a source's budget ends, and only that range is sorted to find the cut. So no
source is ever sorted in one task, and a document needs nothing but its source's cut to
know how many of its words the mix takes.

Sizes are words; a null text has none. A null source is a source of its own. Rows with
the same id have the same key; where the cut falls on such rows, they share the rest in
proportion to size. A source without words has a budget of zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.llm.common import WORD, text_of
from sectorgauge.sources.stages import stage

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
#: Ranges of a source's keys: as many as this many hex digits tell apart.
RANGE_DIGITS = 4
#: Sources whose cuts may be broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 100_000


def document_size(text: str = "text") -> Column:
    """Words of a text."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def random_key(doc_id: str = "doc_id") -> Column:
    """Key that orders a source at random, the same in every run."""
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``source, source_size, target``: weights over sources by code point, null last.

    A source stops at ``max_epochs`` times its size and its excess is shared by weight.
    That ends where every open source has the same target per weight, the level: sources
    are sorted by limit per weight, and the level is the first that its own limit holds;
    later ones are lower, so it is the largest.
    The windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1)
    limited = per_source.withColumn("weight", weight.cast("long")).withColumn(
        "limit", max_epochs * F.col("source_size")
    )
    ratio = (F.col("limit") / F.col("weight")).alias("ratio")
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    levels = limited.select("*", ratio).select(
        "*",
        (F.sum("source_size").over(whole) * F.lit(share_percent) / 100).alias("total"),
        (F.sum("limit").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("limit")).alias("below"),
        (F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing))).alias("open"),
    )
    level = (F.col("total") - F.col("below")) / F.col("open")
    open_level = F.max(F.when(level <= F.col("ratio"), level)).over(whole)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.col("level"))
    return levels.withColumn("level", F.coalesce(open_level, F.col("ratio"))).select(
        "source", "source_size", target.alias("target")
    )


def source_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Where each source's budget ends.

    Columns of ``targets`` and ``epochs`` (whole passes), ``cut_key`` (null: no partial
    pass), ``cut_words`` (words left at the cut) and ``cut_size`` (words that share it).
    """
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    goals = targets.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", budget - F.col("epochs") * F.col("source_size")
    )
    ranged = sizes.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("range")
    running = sums.withColumn("upto", F.sum("words").over(order))
    wanted = goals.select(F.col("source").alias("s"), "rest").where("rest > 0")
    same = F.col("source").eqNullSafe(F.col("s"))
    last = (
        running.join(wanted, same)
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
        .select("s", F.col("range").alias("r"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left"))
    )
    keys = (
        ranged.join(last, same & (F.col("range") == F.col("r")), "inner")
        .groupBy("s", "key", "left")
        .agg(F.sum("size").alias("cut_size"))
    )
    inside = keys.withColumn("upto", F.sum("cut_size").over(Window.partitionBy("s").orderBy("key")))
    cuts = inside.where(
        (F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("cut_size") < F.col("left"))
    ).select(
        "s",
        F.col("key").alias("cut_key"),
        (F.col("left") - F.col("upto") + F.col("cut_size")).alias("cut_words"),
        "cut_size",
    )
    return goals.join(cuts, same, "left").drop("s", "rest")


def stored_cuts(sizes: DataFrame) -> DataFrame:
    """``source_cuts``, stored; broadcast behind a check of the number of sources.

    So documents aren't shuffled by source, of which one may have a third of them.
    """
    cuts = stage(source_cuts(sizes, source_targets(sizes)), "cuts")
    return F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts


def taken_words() -> Column:
    """Words that the mix takes from a row with ``size``, ``key`` and its source's cut."""
    part = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(
            F.col("key") == F.col("cut_key"),
            F.floor(F.col("cut_words") * F.col("size") / F.col("cut_size")).cast("long"),
        )
        .otherwise(0)
    )
    return F.col("epochs") * F.col("size") + part


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, key, size`` of every row, stored once."""
    return stage(docs.select("doc_id", "source", random_key().alias("key"), document_size().alias("size")), "sizes")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row."""
    sizes = sized(docs)
    cuts = stored_cuts(sizes).withColumnRenamed("source", "s")
    joined = sizes.join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return joined.select("doc_id", "size", "source_size", "target", taken_words().alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: each row as often as its taken words fill it, rounded."""
    sizes = sized(docs)
    cuts = stored_cuts(sizes)
    row = F.struct(*(F.col(c) for c in docs.columns))
    rows = docs.select(
        row.alias("row"), F.col("source").alias("s"), random_key().alias("key"), document_size().alias("size")
    )
    joined = rows.join(cuts, F.col("s").eqNullSafe(F.col("source")))
    copies = F.when(F.col("size") > 0, F.round(taken_words() / F.col("size"))).otherwise(0)
    repeated = joined.select(F.explode(F.array_repeat("row", copies.cast("int"))).alias("row"))
    return repeated.select(*(F.col("row")[c].alias(c) for c in docs.columns))
