"""Seasonal adjustment and trend of the published series.

X-11 style filters (Shiskin, Young & Musgrave, 1967) written as windows, so all
series are adjusted in one pass. A series is one (sector, KPI) pair with one row
per calendar month; that bounds every window here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import month_start

SERIES = ["sectorcode", "kpi"]
OUTPUT_COLUMNS = [
    "entryperiod",
    "sectorcode",
    "kpi",
    "unit",
    "population",
    "value",
    "deseasonalizedvalue",
    "trendvalue",
]
# 13-term Henderson weights for distances 0 to 6.
HENDERSON = (0.24006, 0.21434, 0.14736, 0.06549, 0.0, -0.02786, -0.01935)


def published_series(points: DataFrame, settings: Settings) -> DataFrame:
    """Points of the published sectors and KPIs."""
    return points.filter(
        F.col("sectorcode").isin(*settings.sectors) & F.col("kpi").isin(*settings.kpis)
    )


def calendar_series(points: DataFrame) -> DataFrame:
    """One row per calendar month between the first and the last point of a series."""
    span = points.groupBy(*SERIES).agg(
        F.min("entryperiod").alias("first"), F.max("entryperiod").alias("last")
    )
    months = F.sequence(
        month_start(F.col("first")), month_start(F.col("last")), F.expr("interval 1 month")
    )
    spine = span.select(*SERIES, F.explode(months).alias("month")).select(
        *SERIES, F.date_format("month", "yyyy-MM").alias("entryperiod")
    )
    return spine.join(points, [*SERIES, "entryperiod"], "left")


def interpolate(series: DataFrame) -> DataFrame:
    """Add ``filled``: gaps on a straight line, the end carried on, the start left NULL."""
    ordered = Window.partitionBy(*SERIES).orderBy("entryperiod")
    behind = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known = F.when(F.col("value").isNotNull(), F.col("position"))
    marked = series.withColumn("position", F.row_number().over(ordered))
    looked = marked.select(
        "*",
        F.last("value", ignorenulls=True).over(behind).alias("left_value"),
        F.last(known, ignorenulls=True).over(behind).alias("left_position"),
        F.first("value", ignorenulls=True).over(ahead).alias("right_value"),
        F.first(known, ignorenulls=True).over(ahead).alias("right_position"),
    )
    slope = (F.col("right_value") - F.col("left_value")) / (
        F.col("right_position") - F.col("left_position")
    )
    on_line = F.col("left_value") + slope * (F.col("position") - F.col("left_position"))
    filled = F.when(F.col("value").isNotNull(), F.col("value")).otherwise(
        F.when(F.col("right_value").isNull(), F.col("left_value")).otherwise(on_line)
    )
    return looked.withColumn("filled", filled).drop(
        "position", "left_value", "left_position", "right_value", "right_position"
    )


def last_months(series: DataFrame, months: int) -> DataFrame:
    """The latest ``months`` rows of every series."""
    newest_first = Window.partitionBy(*SERIES).orderBy(F.desc("entryperiod"))
    return (
        series.withColumn("age", F.row_number().over(newest_first))
        .filter(F.col("age") <= months)
        .drop("age")
    )


def _shifted(column: str, distance: int, window) -> Column:
    return (F.lag(column, distance) if distance >= 0 else F.lead(column, -distance)).over(
        window
    )


def _weighted(column: str, weights: dict[int, float], window) -> tuple[Column, Column]:
    """Weighted sum over neighbours, and the total weight of those that exist."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for distance, w in weights.items():
        x = _shifted(column, distance, window)
        total = total + F.coalesce(x * w, F.lit(0.0))
        weight = weight + F.when(x.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    return total, weight


def deseasonalize(series: DataFrame, settings: Settings) -> DataFrame:
    """Add ``deseasonalizedvalue`` and ``trendvalue`` to interpolated series.

    The centred 2x12 moving average is the first trend. Its difference to the
    series, averaged per calendar month and centred, is the seasonal part. The
    13-term Henderson average of the rest is the trend; at the ends its weights
    are rescaled to the months there are. Short series stay NULL.
    """
    ordered = Window.partitionBy(*SERIES).orderBy("entryperiod")
    whole = Window.partitionBy(*SERIES)
    by_month = Window.partitionBy(*SERIES, "calendar_month")

    around = ordered.rowsBetween(-5, 5)
    ends = (F.lag("filled", 6).over(ordered) + F.lead("filled", 6).over(ordered)) / 2
    inner = F.when(F.count("filled").over(around) == 11, F.sum("filled").over(around))
    trend = (inner + ends) / 12
    detrended = (
        series.withColumn("points", F.count("filled").over(whole))
        .withColumn("calendar_month", F.substring("entryperiod", 6, 2))
        .withColumn("seasonal_part", F.col("filled") - trend)
        .withColumn("month_mean", F.avg("seasonal_part").over(by_month))
    )
    # Each calendar month counts once in the level, however often it occurs.
    once = F.row_number().over(by_month.orderBy("entryperiod"))
    level = F.avg(F.when(F.col("occurrence") == 1, F.col("month_mean"))).over(whole)
    adjusted = (
        detrended.withColumn("occurrence", once)
        .withColumn("level", level)
        .withColumn(
            "adjusted",
            F.when(
                F.col("points") >= settings.series_min_points,
                F.col("filled") - (F.col("month_mean") - F.col("level")),
            ),
        )
    )
    weights = {d: HENDERSON[abs(d)] for d in range(-6, 7)}
    total, weight = _weighted("adjusted", weights, ordered)
    return adjusted.select(
        *series.columns,
        F.col("adjusted").alias("deseasonalizedvalue"),
        F.when(F.col("adjusted").isNotNull(), total / weight).alias("trendvalue"),
    )


def seasonal_series(
    points: DataFrame,
    settings: Settings,
    adjust: Callable[[DataFrame, Settings], DataFrame] = deseasonalize,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Published series with seasonally adjusted value and trend, latest months only.

    ``adjust`` is ``deseasonalize`` for a season that stays the same, or
    ``moving_season.deseasonalize_moving``; ``prepare`` changes ``filled`` before it, as
    ``trading_days.remove_trading_days`` does.
    """
    series = interpolate(calendar_series(published_series(points, settings)))
    history = last_months(series, settings.series_history)
    adjusted = adjust(prepare(history) if prepare else history, settings)
    return last_months(adjusted, settings.series_output).select(*OUTPUT_COLUMNS)
