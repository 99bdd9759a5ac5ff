"""Seasonal adjustment whose season may change from year to year.

The iteration of X-11 (Shiskin, Young & Musgrave, 1967), additive, as windows over a
series: a first trend, a season from the same month of neighbouring years, extreme months
brought in by a moving standard deviation, both again, a Henderson trend of the adjusted
series, extremes brought in once more, and a longer seasonal filter on what that trend
leaves. At both ends the trend uses Musgrave's weights, which lag behind a steep slope. A series is one (sector, KPI) pair with a row per calendar month.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.operators.seasonal import HENDERSON, SERIES

#: Weights by distance in years of the 3x3 and the 3x5 seasonal filter.
SHORT_FILTER = {0: 3, 1: 2, 2: 1}
LONG_FILTER = {0: 3, 1: 3, 2: 2, 3: 1}
#: Standard deviations up to which a month counts fully, and from which it counts nothing.
FULL, NONE = 1.5, 2.5
#: Months on either side of the moving standard deviation.
AROUND = 30
#: Ratio of irregular to trend movement that the end weights assume.
END_RATIO = 3.5
_REACH = len(HENDERSON) - 1


def end_weights(missing: int, ratio: float = END_RATIO) -> dict[int, float]:
    """Trend weights by distance where the last ``missing`` neighbours do not exist yet.

    Musgrave's rule: the symmetric weights that fall away are shared among the rest so
    that the revision to come is least for a straight line of slope to noise ``ratio``.
    """
    weights = {d: HENDERSON[abs(d)] for d in range(-_REACH, _REACH + 1)}
    kept = [d for d in weights if d <= _REACH - missing]
    n, middle = len(kept), (kept[0] + kept[-1]) / 2
    lost = [d for d in weights if d > kept[-1]]
    slope = 4 / (pi * ratio**2)
    level = sum(weights[d] for d in lost) / n
    tilt = sum((d - middle) * weights[d] for d in lost) * slope / (1 + n * (n - 1) * (n + 1) / 12 * slope)
    return {d: weights[d] + level + (d - middle) * tilt for d in kept}


def trend_weights() -> list[dict[int, float]]:
    """Weights by case: 0 to 5 months ahead, 6 for the middle, 7 to 12 for 5 to 0 behind."""
    ahead = [end_weights(_REACH - k) for k in range(_REACH + 1)]
    return ahead + [{-d: w for d, w in weights.items()} for weights in ahead[-2::-1]]


def _ordered():
    return Window.partitionBy(*SERIES).orderBy("entryperiod")


def _beside(column: str, distance: int) -> Column:
    window = _ordered()
    return (F.lag(column, -distance) if distance < 0 else F.lead(column, distance)).over(window)


def _first_trend(column: str) -> Column:
    """Centred 2x12 moving average; NULL where a month of it is missing."""
    inner = _ordered().rowsBetween(-5, 5)
    eleven = F.when(F.count(column).over(inner) == 11, F.sum(column).over(inner))
    return (eleven + (_beside(column, -6) + _beside(column, 6)) / 2) / 12


def _season(column: str, weights: dict[int, int], emphasis: str | None = None) -> Column:
    """Weighted mean of the same month in neighbouring years, of those that exist."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for years, w in weights.items():
        for d in {12 * years, -12 * years}:
            x = F.col(column) if d == 0 else _beside(column, d)
            e = F.lit(float(w))
            if emphasis:
                e = w * (F.col(emphasis) if d == 0 else _beside(emphasis, d))
            total = total + F.coalesce(e * x, F.lit(0.0))
            weight = weight + F.when(x.isNotNull(), e).otherwise(F.lit(0.0))
    return F.when(weight > 0, F.try_divide(total, weight))


def _centred(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``column`` less its yearly mean; the ends take the nearest mean there is."""
    behind = _ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = _ordered().rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = F.coalesce(
        "season_level",
        F.last("season_level", ignorenulls=True).over(behind),
        F.first("season_level", ignorenulls=True).over(ahead),
    )
    leveled = df.withColumn("season_level", _first_trend(column))
    return leveled.withColumn(name, F.col(column) - F.coalesce(level, F.lit(0.0))).drop("season_level")


def _weighed(df: DataFrame, irregular: Column) -> DataFrame:
    """Add ``irregular`` and its month's weight ``e``.

    The moving deviation is taken twice, the second time without months of no weight.
    """
    near = _ordered().rowsBetween(-AROUND, AROUND)
    part = F.col("irregular")
    first = df.withColumn("irregular", irregular).withColumn("spread", F.sqrt(F.avg(part * part).over(near)))
    usual = F.when(F.abs(part) <= NONE * F.col("spread"), part * part)
    second = first.withColumn("usual", usual).withColumn("spread", F.sqrt(F.avg("usual").over(near)))
    share = F.abs(part) / F.when(F.col("spread") > 0, F.col("spread"))
    weight = F.when(share >= NONE, 0.0).when(share > FULL, (NONE - share) / (NONE - FULL)).otherwise(1.0)
    return second.withColumn("e", weight).drop("spread", "usual")


def _brought_in(df: DataFrame, irregular: Column, name: str) -> DataFrame:
    """Add ``x`` without the share of its irregular part that is extreme."""
    moved = F.col("x") - F.coalesce((1 - F.col("e")) * F.col("irregular"), F.lit(0.0))
    return _weighed(df, irregular).withColumn(name, moved)


def _henderson(column: str) -> Column:
    """13-term Henderson trend with end weights by the months before and after."""
    rows = trend_weights()
    behind = F.count(column).over(_ordered().rowsBetween(-_REACH, -1))
    ahead = F.count(column).over(_ordered().rowsBetween(1, _REACH))
    case = F.when(ahead < _REACH, ahead).otherwise(2 * _REACH - behind).cast("int")
    total = F.lit(0.0)
    for d in range(-_REACH, _REACH + 1):
        weight = F.get(F.array(*(F.lit(w.get(d, 0.0)) for w in rows)), case)
        x = F.col(column) if d == 0 else _beside(column, d)
        total = total + F.coalesce(weight * x, F.lit(0.0))
    return F.when(F.col(column).isNotNull(), total)


def deseasonalize_moving(series: DataFrame, settings: Settings) -> DataFrame:
    """Add ``deseasonalizedvalue`` and ``trendvalue`` to interpolated series.

    The trend leaves extremes out, the adjusted value keeps them. Series with fewer than
    ``Settings.series_min_points`` points stay NULL, and so do months before the first
    known one.
    """
    whole = Window.partitionBy(*SERIES)
    points = F.count("filled").over(whole)
    enough = points >= max(settings.series_min_points, 2 * _REACH + 1)
    work = series.withColumn("x", F.when(enough, F.col("filled")))
    usual = "x"
    same_month = Window.partitionBy(*SERIES, F.substring("entryperiod", 6, 2))
    for turn in (1, 2):  # the second time without the extremes of the first
        work = work.withColumn("si", F.col(usual) - _first_trend(usual))
        raw = _season("si", SHORT_FILTER)
        if turn == 1:  # medians find the extremes, since one bends the means of its month
            work = _weighed(work, F.col("si") - F.median("si").over(same_month))
            raw = F.coalesce(_season("si", SHORT_FILTER, "e"), raw)
        work = _centred(work.withColumn("raw", raw), "raw", "season")
        if turn == 1:
            work, usual = _brought_in(work, F.col("si") - F.col("season"), "usual_1"), "usual_1"
    work = work.withColumn("adjusted", F.col(usual) - F.col("season")).withColumn("trend", _henderson("adjusted"))
    work = _brought_in(work, F.col("x") - F.col("season") - F.col("trend"), "usual_2")
    work = work.withColumn("si", F.col("usual_2") - F.col("trend"))
    work = _centred(work.withColumn("raw", _season("si", LONG_FILTER)), "raw", "season")
    work = work.withColumn("smooth", F.col("usual_2") - F.col("season")).withColumn("trend", _henderson("smooth"))
    work = work.withColumn("adjusted", F.col("x") - F.col("season"))
    return work.select(
        *series.columns,
        F.col("adjusted").alias("deseasonalizedvalue"),
        F.col("trend").alias("trendvalue"),
    )
