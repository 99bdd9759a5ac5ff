"""Peer medians of the ratios over sector, subsector and company size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import is_finite
from sectorgauge.operators.divisions import UNKNOWN
from sectorgauge.operators.selection import exact_percentile
from sectorgauge.sources.stages import stage

ALL = "ALL"
# The unit of every ratio.
RATIO_UNITS = {
    "employee_costs": "percent",
    "receivable_days": "days",
    "gross_margin": "percent",
    "quick_ratio": "ratio",
    "roe": "percent",
    "inventory_turnover": "ratio",
    "solvability": "percent",
    "current_ratio": "ratio",
}
CELL_COLUMNS = [
    "entryperiod",
    "sizedescription",
    "sectorcode",
    "subsectorcode",
    "value",
    "population",
    "kpi",
    "unit",
]


def _unit_of(kpi: Column) -> Column:
    pairs = [F.lit(x) for pair in RATIO_UNITS.items() for x in pair]
    return F.create_map(*pairs)[kpi]


def ratio_members(flagged: DataFrame, profile: DataFrame) -> DataFrame:
    """Ratio rows within the wide fences, with their cube keys."""
    return (
        flagged.filter(F.col("is_3point0_iqr_outlier") == "N")
        .filter(is_finite(F.col("value")))
        .select("division", "entryperiod", "kpi", "value")
        .join(profile, "division")
    )


def ratio_cube(members: DataFrame, how: str = "median") -> DataFrame:
    """Median or mean per month, ratio and sector, cubed over size and subsector.

    The four groupings are one grouping-sets pass, and the median is a mergeable
    sketch, so a cell of any size is combined before the shuffle. ``exact_median``
    picks the lower middle value by counts instead. Cells with an unknown key are
    dropped, but their members count in the 'ALL' cells.
    """
    if how == "exact_median":
        return _named_cells(_exact_cells(_cube_members(members)))
    if how == "median":
        value = F.percentile_approx("value", 0.5)
    elif how == "mean":
        value = F.avg("value")
    else:
        raise ValueError(f"unknown aggregate: {how}")
    fixed = [F.col("entryperiod"), F.col("kpi"), F.col("sectorcode")]
    size, subsector = F.col("sizedescription"), F.col("subsectorcode")
    cells = (
        _cube_members(members)
        .groupingSets(
            [fixed, [*fixed, size], [*fixed, subsector], [*fixed, size, subsector]],
            *fixed,
            size,
            subsector,
        )
        .agg(
            F.grouping("sizedescription").alias("all_sizes"),
            F.grouping("subsectorcode").alias("all_subsectors"),
            value.alias("value"),
            F.count("value").alias("population"),
        )
    )
    return _named_cells(cells)


def _cube_members(members: DataFrame) -> DataFrame:
    return members.filter(F.col("kpi").isin(*RATIO_UNITS)).filter(
        F.col("sectorcode") != UNKNOWN
    )


def _exact_cells(members: DataFrame) -> DataFrame:
    """Cells of the four groupings with the exact lower middle value."""

    def each_and_all(column: str, flag: str) -> Column:
        own = F.struct(F.lit(0).alias(flag), F.col(column).alias(column))
        every = F.struct(F.lit(1).alias(flag), F.lit(None).cast("string").alias(column))
        return F.inline(F.array(own, every))

    fixed = ["entryperiod", "kpi", "sectorcode"]
    sizes = members.select(
        *fixed,
        "value",
        "subsectorcode",
        each_and_all("sizedescription", "all_sizes"),
    )
    rows = sizes.select(
        *fixed,
        "value",
        "sizedescription",
        "all_sizes",
        each_and_all("subsectorcode", "all_subsectors"),
    )
    by = [*fixed, "sizedescription", "all_sizes", "subsectorcode", "all_subsectors"]
    return exact_percentile(stage(rows, "cube-rows"), by, "value")


def _named_cells(cells: DataFrame) -> DataFrame:
    """Cells as published: 'ALL' for what a grouping leaves out, no unknown keys."""
    size, subsector = F.col("sizedescription"), F.col("subsectorcode")
    return (
        cells.withColumn(
            "sizedescription", F.when(F.col("all_sizes") == 1, ALL).otherwise(size)
        )
        .withColumn(
            "subsectorcode",
            F.when(F.col("all_subsectors") == 1, ALL).otherwise(subsector),
        )
        .filter((size != UNKNOWN) & (subsector != UNKNOWN))
        .withColumn("unit", _unit_of(F.col("kpi")))
        .select(*CELL_COLUMNS)
    )


def until_publishable(cells: DataFrame, settings: Settings) -> DataFrame:
    """Drop the latest months, whose bookkeeping is still incomplete."""
    return cells.filter(
        F.col("entryperiod") <= settings.month(-settings.publish_lag_months)
    )
