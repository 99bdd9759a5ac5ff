"""From measures to monthly company KPIs, outlier flags and sector series.

Every function takes stored tables and returns one table to store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sectorgauge.config import Settings
from sectorgauge.operators.company_kpis import company_kpis
from sectorgauge.operators.divisions import peer_profile, sector_profile
from sectorgauge.operators.moving_season import deseasonalize_moving
from sectorgauge.operators.outliers import flag_monthly_outliers, with_peer_profile
from sectorgauge.operators.seasonal import deseasonalize, seasonal_series
from sectorgauge.operators.sector_kpis import densify, sector_kpis, until_publishable
from sectorgauge.operators.trading_days import remove_trading_days
from sectorgauge.sources.stages import stage


def flagged_kpis(measures: DataFrame, lookup: DataFrame, settings: Settings) -> DataFrame:
    """Company KPIs with outlier flags."""
    kpis = with_peer_profile(company_kpis(measures, settings), peer_profile(lookup))
    return flag_monthly_outliers(stage(kpis, "kpis"), settings)


def sector_points(flagged: DataFrame, lookup: DataFrame, settings: Settings) -> DataFrame:
    """Dense monthly points per sector and KPI, up to the last publishable month."""
    points = sector_kpis(flagged, sector_profile(lookup), settings)
    return until_publishable(densify(stage(points, "points")), settings)


def sector_series(flagged: DataFrame, lookup: DataFrame, settings: Settings) -> DataFrame:
    """Published series with seasonal adjustment and trend.

    ``Settings.moving_season`` lets the season change from year to year, and
    ``Settings.trading_days`` takes the weekdays of a month out first.
    """
    adjust = deseasonalize_moving if settings.moving_season else deseasonalize
    points = stage(sector_points(flagged, lookup, settings), "dense-points")
    prepare = remove_trading_days if settings.trading_days else None
    return seasonal_series(points, settings, adjust, prepare).distinct()
