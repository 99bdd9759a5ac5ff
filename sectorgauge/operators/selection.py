"""Exact percentiles of groups of any size.

A window or a collected list would keep a whole group in one task. Here each group is
first cut at approximate quantiles next to the wanted rank. The values below the cuts
and between them are only counted, and counts combine before they move. The rank then
lies in one slice of its group, usually the narrow one between the cuts; only that
slice's distinct values, with their counts, are put in order. Approximate cuts affect
how much is put in order, not the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.sources.stages import stage

#: Distance of the cuts from the wanted share, and accuracy of the sketch behind them.
MARGIN, ACCURACY = 0.001, 4000
#: Groups whose cuts may be broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 100_000


def exact_percentile(
    rows: DataFrame, keys: list[str], value: str, share: float = 0.5
) -> DataFrame:
    """``keys, value, population``: the smallest value at or above ``share`` of the group.

    Of an even group the median is therefore the lower middle value. NULL values don't
    count, a group of only NULLs has a NULL and a population of 0, and NaN is above all
    numbers. NULL keys are a group. ``rows`` should be a stored table: it is read three
    times. Other columns may have any name.
    """
    if not 0 < share <= 1:
        raise ValueError("a share above 0 and up to 1 is needed")
    named = [F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]
    plain = rows.select(*named, F.col(value).alias("v"))
    by, v = plain.columns[:-1], F.col("v")
    steps = [max(0.0, share - MARGIN), min(1.0, share + MARGIN)]
    cuts = plain.groupBy(*by).agg(F.percentile_approx(v, steps, ACCURACY).alias("cuts"))
    cuts = _sent(stage(_other(cuts, by), "cuts"))
    # 0: below both cuts, 1: from the lower to the upper one, 2: above both.
    place = (v >= F.col("cuts")[0]).cast("int") + (v > F.col("cuts")[1]).cast("int")
    sliced = plain.join(cuts, _same(by)).select(*by, "v", place.alias("slice"))
    part, low, middle = F.col("slice"), F.col("low"), F.col("middle")
    counts = sliced.groupBy(*by).agg(
        F.count(v).alias("population"),
        F.count_if(part == 0).alias("low"),
        F.count_if(part == 1).alias("middle"),
    )
    rank = F.ceil(F.col("population") * F.lit(Decimal(str(share)))).cast("long")
    wanted = F.when(rank <= low, 0).when(rank <= low + middle, 1).otherwise(2)
    below = F.when(rank <= low, 0).when(rank <= low + middle, low).otherwise(low + middle)
    goals = counts.select(
        *by, "population", wanted.alias("wanted"), (rank - below).alias("rest")
    )
    goals = stage(_other(goals, by), "goals")
    within = sliced.join(_sent(goals), _same(by) & (part == F.col("wanted")))
    values = within.groupBy(*by, "v", "rest").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy(*by).orderBy("v"))
    found = (
        values.withColumn("upto", upto)
        .filter(F.col("upto") >= F.col("rest"))
        .groupBy(*by)
        .agg(F.min("v").alias("found"))
    )
    return goals.join(found, _same(by), "left").select(
        *(F.col(f"other_{b}").alias(k) for b, k in zip(by, keys, strict=True)),
        F.col("found").alias(value),
        "population",
    )


def _other(table: DataFrame, by: list[str]) -> DataFrame:
    """The same with other names of the keys, to join by."""
    return table.withColumnsRenamed({b: f"other_{b}" for b in by})


def _same(by: list[str]) -> Column:
    result = F.lit(True)
    for b in by:
        result = result & F.col(b).eqNullSafe(F.col(f"other_{b}"))
    return result


def _sent(groups: DataFrame) -> DataFrame:
    """One row per group: broadcast behind a count, so that no group's rows move for it."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups
