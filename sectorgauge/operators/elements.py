"""Cumulative statement elements per company and fiscal month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import amount, units, month_start

# The ledger codes of every statement element.
PROFIT_AND_LOSS = {
    "Revenues-C": ("WOmz", "WOvb"),
    "EmployeeCosts-D": ("WPer",),
    "CostOfGoods-D": ("WKpr",),
}
NET_INCOME = "NetIncome-C"
BALANCE_SHEET = {
    "AccountReceivables-D": ("BVorDeb",),
    "Stock-D": ("BVrd",),
    "WorkInProgress-D": ("BPro",),
    "Bank-D": ("BLimBan", "BLimKru"),
    "Cash-D": ("BLimKas",),
    "TaxToClaim-D": ("BVorBtw",),
    "OtherReceivables-D": ("BVorOvr", "BVorOva"),
    "Securities-D": ("BEff",),
    "AccountPayables-C": ("BSchCre",),
    "Equity-C": ("BEiv",),
    "Provisions-C": ("BVrz",),
    "LongtermDebt-C": ("BLas",),
    "TaxToPay-C": ("BSchBtw", "BSchVpb", "BSchOvb"),
    "OtherDebts-C": (
        "BSchKol",
        "BSchSav",
        "BSchSal",
        "BSchLhe",
        "BSchOvs",
        "BSchOpa",
    ),
}
ELEMENTS = (*PROFIT_AND_LOSS, NET_INCOME, *BALANCE_SHEET)
LEGACY_PERIOD, LEGACY_MONTH = "2005-2016", "2016-12"


def fiscal_year_bounds(periods: DataFrame, settings: Settings) -> DataFrame:
    """First and last day of every fiscal year of a division."""
    if settings.fin_year_max is not None:
        periods = periods.filter(
            F.col("finyear").cast("int") <= settings.fin_year_max
        )
    return periods.groupBy("division", "finyear").agg(
        F.min("startdate").cast("date").alias("startdate"),
        F.max("enddate").cast("date").alias("enddate"),
    )


def fiscal_spine(bounds: DataFrame, settings: Settings) -> DataFrame:
    """Calendar months whose first day lies in the fiscal year.

    Every fiscal year is expanded to its months, so later joins are equi joins.
    """
    first_day = F.trunc("startdate", "month")
    first = F.when(first_day == F.col("startdate"), first_day).otherwise(
        F.add_months(first_day, 1)
    )
    low = F.greatest(first, month_start(F.lit(settings.element_start)))
    high = F.least(
        F.trunc("enddate", "month"), month_start(F.lit(settings.element_last))
    )
    return (
        bounds.withColumn("low", low)
        .withColumn("high", high)
        .filter(F.col("low") <= F.col("high"))
        .select(
            "division",
            "finyear",
            F.explode(F.expr("sequence(low, high, interval 1 month)")).alias("month"),
        )
        .select("division", F.date_format("month", "yyyy-MM").alias("entryperiod"), "finyear")
    )


def element_measures(measures: DataFrame) -> DataFrame:
    """Measures that may enter an element: no closing entries of profit and loss."""
    closing_result = F.col("aggregate").startswith("W") & F.col("type").contains("310")
    return measures.filter(~closing_result).withColumn(
        "entryperiod",
        F.when(F.col("entryperiod") == LEGACY_PERIOD, F.lit(LEGACY_MONTH)).otherwise(
            F.col("entryperiod")
        ),
    )


def _monthly_sums() -> list[Column]:
    """Per element its movement; per balance element also the reversed closing part."""
    code, value = F.col("aggregate"), F.col("units")
    sums = []
    for element, codes in (PROFIT_AND_LOSS | BALANCE_SHEET).items():
        sums.append(F.sum(F.when(code.isin(*codes), value)).alias(element))
    result = (F.length(code) == 4) & code.startswith("W")
    sums.append(F.sum(F.when(result, value)).alias(NET_INCOME))
    closing = F.col("type").contains("310")
    for element, codes in BALANCE_SHEET.items():
        sums.append(
            F.sum(F.when(code.isin(*codes) & closing, -value)).alias(f"{element}*")
        )
    return sums


def statement_elements(
    measures: DataFrame, periods: DataFrame, settings: Settings
) -> DataFrame:
    """Cumulative value of all 18 elements for every fiscal month of a division.

    Profit and loss accumulates within the fiscal year. Balance elements
    accumulate over the whole spine, plus the closing entries reversed within
    their fiscal year. All elements sit side by side in one row per month until
    the end, so one grouping, one join and one sort order replace one branch per
    element. A division has one row per month in the windows.
    """
    monthly = (
        element_measures(measures)
        .withColumn("units", units(F.col("value")))
        .groupBy("division", "entryperiod")
        .agg(*_monthly_sums())
    )
    spine = fiscal_spine(fiscal_year_bounds(periods, settings), settings)
    active = monthly.select("division").distinct()
    months = spine.join(active, "division", "left_semi").join(
        monthly, ["division", "entryperiod"], "left"
    )
    to_date = Window.partitionBy("division").orderBy("entryperiod", "finyear")
    in_year = Window.partitionBy("division", "finyear").orderBy("entryperiod")

    def running(name: str, window) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(F.coalesce(F.col(f"`{name}`"), F.lit(0))).over(frame)

    cumulative = [
        amount(running(e, in_year)).alias(e)
        for e in (*PROFIT_AND_LOSS, NET_INCOME)
    ] + [
        amount(running(e, to_date) + running(f"{e}*", in_year)).alias(e)
        for e in BALANCE_SHEET
    ]
    pairs = ", ".join(f"'{e}', `{e}`" for e in ELEMENTS)
    return months.select("division", "entryperiod", *cumulative).select(
        "division",
        "entryperiod",
        F.expr(f"stack({len(ELEMENTS)}, {pairs}) as (element, cumvalue)"),
    )
