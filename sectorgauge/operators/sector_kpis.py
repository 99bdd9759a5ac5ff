"""Sector benchmarks per month from flagged company KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import amount, units, is_finite, month_number
from sectorgauge.operators.selection import exact_percentile
from sectorgauge.sources.stages import stage

ALL = "ALL"
SERIES_COLUMNS = ["entryperiod", "sectorcode", "kpi", "value", "population", "unit"]


def _by_sector(rows: DataFrame, by: list[str], *aggregates: Column) -> DataFrame:
    """Aggregate per sector and over all sectors ('ALL') in one grouping-sets pass."""
    everyone = [F.col(c) for c in by]
    return (
        rows.groupingSets(
            [everyone, [*everyone, F.col("sectorcode")]], *everyone, F.col("sectorcode")
        )
        .agg(F.grouping("sectorcode").alias("over_all"), *aggregates)
        .withColumn(
            "sectorcode",
            F.when(F.col("over_all") == 1, F.lit(ALL)).otherwise(F.col("sectorcode")),
        )
        .drop("over_all")
    )


def average_kpis(flagged: DataFrame, settings: Settings) -> DataFrame:
    """Rows that enter an averaged sector KPI: (division, entryperiod, kpi, unit, value).

    Days to cash enter as they are. Cash flows enter as 100 or 0, so that their
    mean is the percentage of companies with a positive one. Rows are picked by
    ``kpi``, the folder column of the stored table, so other KPIs are not read.
    """
    inner_ok = F.col("is_1point5_iqr_outlier") == "N"
    outer_ok = F.col("is_3point0_iqr_outlier") == "N"
    name, value = F.col("kpi"), F.col("value")
    d2c = (name == "D2C_30d") & inner_ok
    position = (name == "CashFlowPosition") & outer_ok
    monthly = (name == "CashFlowMonthly") & outer_ok

    def percent(condition: Column) -> Column:
        return F.when(condition, F.lit(100.0)).otherwise(F.lit(0.0))

    averaged = name.isin("D2C_30d", "CashFlowPosition", "CashFlowMonthly")
    return flagged.filter(averaged & (d2c | position | monthly)).select(
        "division",
        "entryperiod",
        F.when(d2c, F.lit("d2c_30d_mean"))
        .when(position, F.lit("positive_cash_flow_position"))
        .otherwise(F.lit("positive_cash_flow_monthly"))
        .alias("kpi"),
        F.when(d2c, F.lit("days")).otherwise(F.lit("percent")).alias("unit"),
        F.when(d2c, value)
        .when(position, percent(value > settings.cash_position_floor))
        .otherwise(percent(value > 0))
        .alias("value"),
    )


def sector_average(rows: DataFrame, sectors: DataFrame, how: str = "mean") -> DataFrame:
    """Mean or median of ``value`` per month and KPI, per sector and over all.

    ``average`` is accepted as another word for ``mean``. The median is the lower
    middle value, from a mergeable sketch; ``exact_median`` picks it by counts.
    """
    members = rows.filter(is_finite(F.col("value"))).join(sectors, "division")
    if how == "exact_median":
        return _exact_medians(members)
    if how in ("mean", "average"):
        value = F.avg("value")
    elif how == "median":
        value = F.percentile_approx("value", 0.5)
    else:
        raise ValueError(f"unknown aggregate: {how}")
    return _by_sector(
        members,
        ["entryperiod", "kpi", "unit"],
        value.alias("value"),
        F.count("value").alias("population"),
    ).select(*SERIES_COLUMNS)


def _exact_medians(members: DataFrame) -> DataFrame:
    """Exact lower middle value per sector and over all."""
    own = F.struct(F.lit(0).alias("over_all"), F.col("sectorcode").alias("sectorcode"))
    every = F.struct(F.lit(1).alias("over_all"), F.lit(ALL).alias("sectorcode"))
    by = ["entryperiod", "kpi", "unit"]
    placed = members.select(*by, "value", F.inline(F.array(own, every)))
    keys = [*by, "over_all", "sectorcode"]
    medians = exact_percentile(stage(placed, "sector-rows"), keys, "value")
    return medians.select(*SERIES_COLUMNS)


def revenue_year_on_year(flagged: DataFrame) -> DataFrame:
    """Revenue next to the same month a year earlier, where both exist.

    A range frame of exactly twelve months back finds the earlier row: one shuffle
    on the division, no self join, and a missing month matches nothing.
    """
    year_ago = (
        Window.partitionBy("division")
        .orderBy(month_number(F.col("entryperiod")))
        .rangeBetween(-12, -12)
    )
    return (
        flagged.filter(
            (F.col("kpi") == "Revenue") & (F.col("is_3point0_iqr_outlier") == "N")
        )
        .select(
            "division",
            "entryperiod",
            F.col("value").alias("revenue"),
            F.max("value").over(year_ago).alias("lastyear_revenue"),
        )
        .filter(F.col("lastyear_revenue").isNotNull())
    )


def total_growth(growth: DataFrame, sectors: DataFrame) -> DataFrame:
    """Growth of the summed revenue in percent, per sector and over all."""
    members = growth.filter(
        is_finite(F.col("revenue")) & is_finite(F.col("lastyear_revenue"))
    ).join(sectors, "division")
    grown = _by_sector(
        members,
        ["entryperiod"],
        amount(F.sum(units(F.col("revenue")))).alias("revenue"),
        amount(F.sum(units(F.col("lastyear_revenue")))).alias("lastyear_revenue"),
        F.count("division").alias("population"),
    )
    return grown.select(
        "entryperiod",
        "sectorcode",
        F.lit("total_growth_lastyear").alias("kpi"),
        F.expr(
            "try_divide(revenue - lastyear_revenue, lastyear_revenue) * 100.0D"
        ).alias("value"),
        "population",
        F.lit("percent").alias("unit"),
    )


def sector_kpis(
    flagged: DataFrame, sectors: DataFrame, settings: Settings
) -> DataFrame:
    """All published sector KPIs in the month window, rounded to four places."""
    averaged = sector_average(average_kpis(flagged, settings), sectors)
    growth = total_growth(revenue_year_on_year(flagged), sectors)
    period = F.col("entryperiod")
    return (
        averaged.unionByName(growth)
        .filter(
            (period >= settings.kpi_start)
            & (period <= settings.month(-settings.aggregate_lag_months))
        )
        .withColumn("value", F.round("value", 4))
    )


def densify(points: DataFrame) -> DataFrame:
    """Every month x sector x KPI that occurs anywhere; missing ones are NULL.

    The three distinct lists are bounded by the calendar, the sector scheme and
    the KPI list, and travel as arrays of one row. A NULL sector is kept as a
    list member and matches no point.
    """
    lists = points.agg(
        F.collect_set("entryperiod").alias("periods"),
        F.collect_set(F.struct("sectorcode")).alias("sectors"),
        F.collect_set("kpi").alias("kpis"),
    )
    grid = (
        lists.select(F.explode("periods").alias("entryperiod"), "sectors", "kpis")
        .select("entryperiod", F.explode("sectors").alias("sector"), "kpis")
        .select("entryperiod", "sector.sectorcode", F.explode("kpis").alias("kpi"))
    )
    return grid.join(points, ["sectorcode", "entryperiod", "kpi"], "left").select(
        *SERIES_COLUMNS
    )


def until_publishable(points: DataFrame, settings: Settings) -> DataFrame:
    """Drop the latest months, whose bookkeeping is still incomplete."""
    return points.filter(
        F.col("entryperiod") <= settings.month(-settings.publish_lag_months)
    )
