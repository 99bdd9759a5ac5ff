"""Lookup tables for readers, and the checks that guard them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import kpi_identifier

UNKNOWN = "Unknown"


def two_places(value: Column) -> Column:
    """Published precision."""
    return F.round(value, 2).cast("decimal(18,2)")


def published_points(series: DataFrame, settings: Settings) -> DataFrame:
    """Monthly points to serve: listed sectors, within the served months."""
    period = F.col("entryperiod")
    first = settings.month(-settings.serve_history_months - settings.serve_lag_months)
    sector = F.col("sectorcode")
    return series.filter(
        sector.isin(*settings.sectors)
        & ~sector.isin(UNKNOWN, "")
        & (period >= first)
        & (period < settings.month(-settings.serve_lag_months))
    ).select(
        "kpi",
        "sectorcode",
        "entryperiod",
        "value",
        F.col("population").cast("int").alias("population"),
        "unit",
        "deseasonalizedvalue",
        "trendvalue",
    )


def series_documents(points: DataFrame, updated: Column) -> DataFrame:
    """One document per series with its points in month order.

    A document holds at most the served months, so the list is bounded.
    """
    point = F.struct(
        "entryperiod",
        two_places(F.col("value")).alias("value"),
        "population",
        "unit",
        two_places(F.col("deseasonalizedvalue")).alias("deseasonalizedvalue"),
        two_places(F.col("trendvalue")).alias("trendvalue"),
    )
    return points.groupBy("sectorcode", "kpi").agg(
        F.array_sort(F.collect_list(point)).alias("data")
    ).select(
        kpi_identifier(["sectorcode", "kpi"]).alias("kpi_identifier"),
        F.lower("sectorcode").alias("sectorcode"),
        "kpi",
        "data",
        updated.alias("updated"),
    )


def quality_report(documents: DataFrame, settings: Settings) -> DataFrame:
    """Violation counts of the served series, and whether they may be published.

    Expected: one document per sector and KPI; mean days to cash within 0 and 70,
    growth within -100 and 100, both over more than ``min_population`` companies,
    in every month. A missing value is a violation.
    """
    points = documents.select(
        "kpi_identifier", "kpi", F.explode_outer("data").alias("p")
    )
    value, enough = F.col("p.value"), F.col("p.population") > settings.min_population
    days_ok = (value > 0) & (value < 70) & enough
    growth_ok = (value > -100) & (value < 100) & enough

    def violations(kpi: str, ok: Column) -> Column:
        return F.count_if((F.col("kpi") == kpi) & ~F.coalesce(ok, F.lit(False)))

    expected = len(settings.sectors) * len(settings.kpis)
    counts = points.agg(
        F.count_distinct("kpi_identifier").alias("series"),
        violations("d2c_30d_mean", days_ok).alias("bad_days"),
        violations("total_growth_lastyear", growth_ok).alias("bad_growth"),
    )
    return counts.select(
        "series",
        F.lit(expected).cast("bigint").alias("expected_series"),
        "bad_days",
        "bad_growth",
        (
            (F.col("series") == expected)
            & (F.col("bad_days") == 0)
            & (F.col("bad_growth") == 0)
        ).alias("passed"),
    )


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace current rows with the same key."""
    kept = current.join(incoming.select(key), key, "left_anti")
    return incoming.unionByName(kept)


def lookup_series(
    documents: DataFrame, sectorcode: str, kpi: str, settings: Settings, history: str = ""
) -> DataFrame:
    """The document of one series; the latest points unless ``history`` is 'full'."""
    if not sectorcode or not kpi:
        raise ValueError("sectorcode and kpi are required")
    found = documents.filter(
        F.col("kpi_identifier") == f"{sectorcode.lower()}-{kpi.lower()}"
    )
    return found.select(
        "kpi_identifier",
        "sectorcode",
        "kpi",
        (F.col("data") if history.lower() == "full" else recent(settings)).alias("body"),
    )


def recent(settings: Settings) -> Column:
    """The latest points of a document, all of them if there are fewer."""
    n = settings.recent_points
    return F.slice("data", F.greatest(F.size("data") - n + 1, F.lit(1)), F.lit(n))


def latest_period(cells: DataFrame) -> DataFrame:
    """Cells of the most recent month; the month itself is a one-row result."""
    last = cells.agg(F.max("entryperiod").alias("entryperiod"))
    return cells.join(F.broadcast(last), "entryperiod")


def publishable_cells(cells: DataFrame, settings: Settings) -> DataFrame:
    """Cells over more than ``min_population`` companies."""
    return cells.filter(F.col("population") > settings.min_population)


def ratio_documents(cells: DataFrame, updated: Column) -> DataFrame:
    """One lookup row per cube cell."""
    return cells.select(
        kpi_identifier(["kpi", "sectorcode", "subsectorcode", "sizedescription"]).alias(
            "kpi_identifier"
        ),
        F.lower("kpi").alias("kpi"),
        F.lower("sectorcode").alias("sector"),
        F.lower("subsectorcode").alias("subsector"),
        F.lower("sizedescription").alias("companysize"),
        two_places(F.col("value")).alias("value"),
        F.col("population").cast("int").alias("population"),
        updated.alias("updated"),
    )


def scan_ratios(documents: DataFrame) -> DataFrame:
    """All served ratios under their public column names."""
    return documents.select(
        F.col("sector").alias("Sector"),
        F.col("subsector").alias("SubSector"),
        F.col("companysize").alias("CompanySize"),
        F.col("kpi").alias("KPI"),
        F.col("population").alias("Population"),
        F.col("value").alias("Value"),
    )


def reconcile(published: DataFrame, loaded: DataFrame) -> DataFrame:
    """Whether as many rows arrived as were published."""
    sides = published.select(F.lit(False).alias("arrived")).union(
        loaded.select(F.lit(True))
    )
    return sides.agg(
        F.count_if(~F.col("arrived")).alias("published"),
        F.count_if("arrived").alias("loaded"),
    ).withColumn("matches", F.col("published") == F.col("loaded"))
