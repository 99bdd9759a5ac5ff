"""Trading-day effect: what the weekdays of a month add to a series.

A month's value is taken as level, season and six weekday effects, each times the number
of that weekday less the number of Sundays. Differences to the month before and to the
year before leave a straight line and a fixed season out of both sides, so that only the
six effects remain to be found, by least squares. Their normal equations are sums over a
series, combined before they move, and six rounds of elimination on one small matrix per
series solve them, all in built-in functions. Effects are to be removed before the
seasonal filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.functions.columns import month_start
from sectorgauge.operators.seasonal import SERIES

WEEKDAYS = 6
#: Months behind a month whose values its difference takes, and their signs.
DIFFERENCE = {0: 1, 1: -1, 12: -1, 13: 1}
#: Pivots below this mean that the months of a series don't tell the weekdays apart.
LEAST_PIVOT = 1e-6


def weekday_contrasts(month: Column) -> list[Column]:
    """Mondays less Sundays of a month given by its first day, then Tuesdays, up to Saturdays."""
    over_four_weeks = F.dayofmonth(F.last_day(month)) - 28

    def has_fifth(day: int) -> Column:
        after_first = F.pmod(F.lit(day) - F.weekday(month), F.lit(7))
        return (after_first < over_four_weeks).cast("int")

    return [has_fifth(day) - has_fifth(6) for day in range(WEEKDAYS)]


def trading_day_effects(series: DataFrame) -> DataFrame:
    """``sectorcode, kpi, effects``: six weekday effects of every series with ``filled``.

    ``series`` has a row per calendar month; differences with a missing month count for
    nothing. Null where the months of a series don't tell the weekdays apart, as in series
    of less than 19 months.
    """
    ordered = Window.partitionBy(*SERIES).orderBy("entryperiod")
    month = month_start(F.col("entryperiod"))
    dy = F.lit(0.0)
    dx = [F.lit(0)] * WEEKDAYS
    for behind, sign in DIFFERENCE.items():
        dy = dy + sign * F.lag("filled", behind).over(ordered)
        contrasts = weekday_contrasts(F.add_months(month, -behind))
        dx = [a + sign * x for a, x in zip(dx, contrasts, strict=True)]
    rows = series.select(*SERIES, F.array(*dx).alias("dx"), dy.alias("dy")).filter("dy is not null")
    sums = [F.sum(F.col("dx")[i] * F.col("dx")[j]).cast("double") for i in range(WEEKDAYS) for j in range(WEEKDAYS)]
    sides = [F.sum(F.col("dx")[i] * F.col("dy")) for i in range(WEEKDAYS)]
    matrix = F.array(
        *(F.array(*sums[i * WEEKDAYS : (i + 1) * WEEKDAYS], sides[i]) for i in range(WEEKDAYS))
    )
    solved = rows.groupBy(*SERIES).agg(matrix.alias("matrix")).select(*SERIES, _solution("matrix"))
    known = F.forall("effects", lambda e: e.isNotNull())
    return solved.select(*SERIES, F.when(known, F.col("effects")).alias("effects"))


def _solution(matrix: str) -> Column:
    """Right sides after elimination; NULL where a pivot vanishes."""

    def without(rows: Column, k: Column) -> Column:
        pivot = F.get(F.get(rows, k), k)
        usable = F.when(pivot > LEAST_PIVOT, pivot)
        scaled = F.transform(F.get(rows, k), lambda x: x / usable)
        return F.transform(
            rows,
            lambda row, i: F.when(i == k, scaled).otherwise(
                F.zip_with(row, scaled, lambda a, b: a - F.get(row, k) * b)
            ),
        )

    steps = F.array(*map(F.lit, range(WEEKDAYS)))
    solved = F.aggregate(steps, F.col(matrix), without)
    return F.transform(solved, lambda row: row[WEEKDAYS]).alias("effects")


def remove_trading_days(series: DataFrame) -> DataFrame:
    """Add ``tradingday`` and take it off ``filled``; 0 for series without effects.

    A series is one (sector, KPI) pair, so the effects are few rows; the join is left to
    the planner.
    """
    named = [F.col(c).alias(f"of_{c}") for c in SERIES]
    effects = trading_day_effects(series).select(*named, "effects")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in SERIES]
    contrasts = weekday_contrasts(month_start(F.col("entryperiod")))
    part = F.lit(0.0)
    for day, x in enumerate(contrasts):
        part = part + F.col("effects")[day] * x
    return (
        series.join(effects, same[0] & same[1], "left")
        .withColumn("tradingday", F.coalesce(part, F.lit(0.0)))
        .withColumn("filled", F.col("filled") - F.col("tradingday"))
        .select(*series.columns, "tradingday")
    )
