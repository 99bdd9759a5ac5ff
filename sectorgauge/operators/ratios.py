"""Eight financial ratios per company and month from cumulative elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import amount, units

# The elements of short-term solvency.
QUICK_ELEMENTS = (
    "Bank-D",
    "AccountReceivables-D",
    "TaxToClaim-D",
    "OtherReceivables-D",
    "Securities-D",
    "AccountPayables-C",
    "TaxToPay-C",
    "OtherDebts-C",
)
LONG_TERM_ELEMENTS = ("Provisions-C", "LongtermDebt-C")
RATIOS = (
    "employee_costs",
    "receivable_days",
    "gross_margin",
    "roe",
    "inventory_turnover",
    "quick_ratio",
    "current_ratio",
    "solvability",
)

_AMOUNT = "cumvalue"


def _is(*elements: str) -> Column:
    return F.col("element").isin(*elements)


def _debit(*elements: str) -> Column:
    return _is(*elements) & (F.col(_AMOUNT) > 0)


def _credit(*elements: str) -> Column:
    return _is(*elements) & (F.col(_AMOUNT) < 0)


def _ratio_inputs() -> dict[str, tuple[Column, Column, Column]]:
    """Per ratio: rows of the numerator, rows of the denominator, rows it needs."""
    revenue = _credit("Revenues-C")
    quick_up = _is("Cash-D") | _debit(*QUICK_ELEMENTS)
    quick_down = _credit(*QUICK_ELEMENTS)
    quick_any = _is("Cash-D", *QUICK_ELEMENTS)
    current_up = quick_up | _is("Stock-D") | _debit("WorkInProgress-D")
    current_down = quick_down | _credit("WorkInProgress-D")
    current_any = quick_any | _is("Stock-D", "WorkInProgress-D")
    return {
        "employee_costs": (
            _debit("EmployeeCosts-D"),
            revenue,
            _is("Revenues-C", "EmployeeCosts-D"),
        ),
        "receivable_days": (
            _debit("AccountReceivables-D"),
            revenue,
            _is("Revenues-C", "AccountReceivables-D"),
        ),
        "gross_margin": (
            _is("Revenues-C", "CostOfGoods-D"),
            revenue,
            _is("Revenues-C", "CostOfGoods-D"),
        ),
        "roe": (
            _is("NetIncome-C"),
            _credit("Equity-C"),
            _is("NetIncome-C", "Equity-C"),
        ),
        "inventory_turnover": (
            _debit("CostOfGoods-D"),
            _debit("Stock-D"),
            _is("CostOfGoods-D", "Stock-D"),
        ),
        "quick_ratio": (quick_up, quick_down, quick_any),
        "current_ratio": (current_up, current_down, current_any),
        "solvability": (
            _credit("Equity-C"),
            current_down | _credit(*LONG_TERM_ELEMENTS),
            current_any | _is("Equity-C", *LONG_TERM_ELEMENTS),
        ),
    }


def _ratio_value() -> Column:
    """Value by ratio; NULL where the signs make the ratio meaningless."""
    kpi, num, den = F.col("kpi"), F.col("numerator"), F.col("denominator")
    both = (num > 0) & (den < 0)
    return (
        F.when((kpi == "employee_costs") & both, num / den * -100.0)
        .when((kpi == "receivable_days") & both, num / den * -365.0)
        .when(kpi.isin("gross_margin", "roe") & (den < 0), 100.0 * num / den)
        .when((kpi == "inventory_turnover") & (num > 0) & (den > 0), num / den)
        .when(
            kpi.isin("quick_ratio", "current_ratio") & (den != 0), -1.0 * num / den
        )
        .when((kpi == "solvability") & (den != 0), 100.0 * num / den)
    )


def ratio_months(elements: DataFrame, settings: Settings) -> DataFrame:
    """Both sides of all ratios per division and month, and the negative stock/cash flag.

    One grouping computes sixteen conditional sums and the flag.
    """
    inputs = _ratio_inputs()
    aggregates = []
    for name, (up, down, needed) in inputs.items():
        sign = -1 if name == "solvability" else 1
        aggregates += [
            amount(sign * F.sum(F.when(up, F.col("units")))).alias(f"{name}_num"),
            amount(sign * F.sum(F.when(down, F.col("units")))).alias(f"{name}_den"),
            (F.count_if(needed) > 0).alias(f"{name}_any"),
        ]
    negative = _is("Stock-D", "Cash-D") & (F.col(_AMOUNT) < settings.negative_limit)
    return (
        elements.filter(F.col(_AMOUNT) != 0)
        .withColumn("units", units(F.col(_AMOUNT)))
        .groupBy("division", "entryperiod")
        .agg(
            *aggregates,
            F.when(F.count_if(negative) > 0, "Y").otherwise("N").alias("negative_stock_cash"),
        )
    )


def negative_stock_cash(elements: DataFrame, settings: Settings) -> DataFrame:
    """Division months with a negative stock or cash balance, one row each."""
    flagged = ratio_months(elements, settings).filter(F.col("negative_stock_cash") == "Y")
    return flagged.select("division", "entryperiod", "negative_stock_cash")


def statement_ratios(elements: DataFrame, settings: Settings) -> DataFrame:
    """All ratios per division and month, with the negative stock/cash flag.

    A ratio has a row when any of its elements is present.
    """
    inputs = _ratio_inputs()
    stacked = ", ".join(f"'{n}', {n}_num, {n}_den, {n}_any" for n in inputs)
    return (
        ratio_months(elements, settings).select(
            "division",
            "entryperiod",
            F.expr(
                f"stack({len(inputs)}, {stacked})"
                " as (kpi, numerator, denominator, present)"
            ),
            "negative_stock_cash",
        )
        .filter("present")
        .select(
            "division",
            "entryperiod",
            "numerator",
            "denominator",
            _ratio_value().alias("value"),
            "kpi",
            F.col("kpi").alias("aggregate"),
            "negative_stock_cash",
        )
    )
