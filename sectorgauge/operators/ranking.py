"""Percent rank and quartile fences within peer groups of any size.

A window keeps its whole partition in one task. That is right for the usual peer
group and wrong for one that holds a large share of the table. Groups above
``Settings.hot_group_rows`` are therefore cut into slices at approximate
quantiles; ranks are exact within a slice and shifted by the rows in lower
slices. Approximate cuts only affect how even the slices are, not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings


def _fences(percentile: Column, value: Column, settings: Settings) -> tuple[Column, Column]:
    """Largest value below the low quantile, smallest value above the high one."""
    return (
        F.max(F.when(percentile < settings.low_quantile, value)),
        F.min(F.when(percentile > settings.high_quantile, value)),
    )


def _rank_whole(df: DataFrame, keys: list[str], value: str, settings: Settings) -> DataFrame:
    """One shuffle on the keys and one sort: the ordered window comes first."""
    group = Window.partitionBy(*keys)
    ranked = df.withColumn("percentile", F.percent_rank().over(group.orderBy(value)))
    q1, q3 = _fences(F.col("percentile"), F.col(value), settings)
    return ranked.select(
        "*",
        F.count(F.lit(1)).over(group).alias("group_rows"),
        q1.over(group).alias("q1"),
        q3.over(group).alias("q3"),
    )


def _rank_sliced(
    df: DataFrame, keys: list[str], value: str, spread_by: str, settings: Settings
) -> DataFrame:
    """Same result for hot groups (``df`` carries their ``group_rows``).

    Values equal to a cut form a slice of their own, and so do NULLs. All rows of
    such a slice have the same rank, so they are spread over many tasks; this is
    what keeps a single value held by half of a group from piling up.
    """
    v = F.col(value)
    steps = [i / settings.rank_slices for i in range(1, settings.rank_slices)]
    cuts = df.groupBy(*keys).agg(F.percentile_approx(v, steps, 1000).alias("cuts"))
    # One row per hot group, so their number grows with the data: no hint. The adaptive
    # planner broadcasts by measured size and otherwise splits the hot groups.
    cut = df.join(cuts, keys)
    below = F.size(F.filter("cuts", lambda c: c < v))
    tied = F.array_contains("cuts", v)
    sliced = cut.withColumn(
        "slice", F.when(v.isNull(), F.lit(-1)).otherwise(2 * below + tied.cast("int"))
    ).drop("cuts")
    lower = (
        Window.partitionBy(*keys)
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        sliced.groupBy(*keys, "slice")
        .agg(F.count(F.lit(1)).alias("slice_rows"))
        .select(
            *keys,
            "slice",
            F.coalesce(F.sum("slice_rows").over(lower), F.lit(0)).alias("rows_below"),
        )
    )
    same_rank = F.col("slice") % 2 != 0
    part = F.when(
        same_rank, F.pmod(F.xxhash64(spread_by), F.lit(settings.rank_slices))
    ).otherwise(F.lit(0))
    within = Window.partitionBy(*keys, "slice", "part").orderBy(value)
    rows_before = F.col("rows_below") + F.rank().over(within) - 1
    ranked = (
        sliced.join(shifts, [*keys, "slice"])
        .withColumn("part", part)
        .withColumn("rows_before", rows_before)
        .withColumn(
            "percentile",
            F.when(
                F.col("group_rows") > 1, F.col("rows_before") / (F.col("group_rows") - 1)
            ).otherwise(F.lit(0.0)),
        )
    )
    q1, q3 = _fences(F.col("percentile"), v, settings)
    fences = ranked.groupBy(*keys).agg(q1.alias("q1"), q3.alias("q3"))
    return ranked.join(fences, keys).drop(
        "slice", "part", "rows_below", "rows_before"
    )


def rank_in_groups(
    df: DataFrame, keys: list[str], value: str, spread_by: str, settings: Settings
) -> DataFrame:
    """Add ``group_rows``, ``percentile``, ``q1`` and ``q3`` to every row.

    ``keys`` must not be NULL and ``df`` should be a stored table: its group sizes
    are looked at first, and one window serves all groups if none is hot.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))
    hot = sizes.filter(F.col("group_rows") > settings.hot_group_rows)
    if hot.isEmpty():
        return _rank_whole(df, keys, value, settings)
    ordinary = df.join(hot.select(*keys), keys, "left_anti")
    whole = _rank_whole(ordinary, keys, value, settings)
    sliced = _rank_sliced(df.join(hot, keys), keys, value, spread_by, settings)
    return whole.unionByName(sliced)
