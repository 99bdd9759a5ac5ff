"""Monthly KPIs per company from the long table of measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import amount, units, sum_if

# Ledger codes behind each KPI.
REVENUE_CODES = ("WOmz", "WOvb")
COST_CODES = ("WPer", "WBed", "WKpr", "WAfs", "WFbe")
CASH_CODES = ("BLim",)
D2C_KPIS = ("D2C_30d", "D2C_14d", "D2C_all")

# Result column of every KPI, in the order in which they are stacked.
KPI_COLUMNS = {
    "Revenue": "revenue",
    "Cost": "cost",
    "Profitability": "profitability",
    "CashFlowPosition": "cash_position",
    "CashFlowMonthly": "cash_monthly",
    "D2C_30d": "d2c_30d",
    "D2C_14d": "d2c_14d",
    "D2C_all": "d2c_all",
}


def kpis_wide(measures: DataFrame) -> DataFrame:
    """One row per division and month with all KPIs side by side.

    One pass over the measures instead of one per KPI. A division has a few
    dozen rows per month, so a single shuffle on the division serves the
    de-duplication, the grouping and the running cash position.
    """
    used = (*REVENUE_CODES, *COST_CODES, *CASH_CODES, *D2C_KPIS)
    code, value, in_units = F.col("aggregate"), F.col("value"), F.col("units")
    rows = (
        measures.filter(~F.col("type").like("%310"))
        .filter(code.isin(*used))
        .repartition("division")
        .distinct()
        .withColumn("units", F.when(~code.isin(*D2C_KPIS), units(value)))
    )
    sums = rows.groupBy("division", "entryperiod").agg(
        amount(-sum_if(code.isin(*REVENUE_CODES), in_units)).alias("revenue"),
        amount(sum_if(code.isin(*COST_CODES), in_units)).alias("cost"),
        sum_if(code.isin(*CASH_CODES), in_units).alias("cash"),
        F.count_if(code.isin(*CASH_CODES)).alias("cash_rows"),
        *[F.max(F.when(code == k, value)).alias(k.lower()) for k in D2C_KPIS],
    )
    to_date = (
        Window.partitionBy("division")
        .orderBy("entryperiod")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sums.select(
        "division",
        "entryperiod",
        "revenue",
        "cost",
        F.expr("try_divide(revenue - cost, revenue)").alias("profitability"),
        F.when(F.col("cash_rows") > 0, amount(F.sum("cash").over(to_date))).alias(
            "cash_position"
        ),
        amount(F.col("cash")).alias("cash_monthly"),
        *[k.lower() for k in D2C_KPIS],
    )


def company_kpis(measures: DataFrame, settings: Settings) -> DataFrame:
    """All KPIs as (division, entryperiod, aggregate, value), limited to the window."""
    pairs = ", ".join(f"'{k}', {c}" for k, c in KPI_COLUMNS.items())
    in_window = (F.col("entryperiod") >= settings.kpi_start) & (
        F.col("entryperiod") < settings.month()
    )
    return (
        kpis_wide(measures)
        .filter(in_window)
        .select(
            "division",
            "entryperiod",
            F.expr(f"stack({len(KPI_COLUMNS)}, {pairs}) as (aggregate, value)"),
        )
        .filter(F.col("value").isNotNull())
    )
