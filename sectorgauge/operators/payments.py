"""Days-to-cash operators on matched invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import month_of

DAYS_TYPE = "Days to Cash In"


def prepare_invoices(invoices: DataFrame) -> DataFrame:
    """Typed invoice lines with their payment month."""
    return invoices.filter(F.col("division").isNotNull()).select(
        F.col("division").cast("string").alias("division"),
        "matchid",
        month_of(F.col("paymententrydate")).alias("entryperiod"),
        F.col("atbip").alias("days_to_cash"),
        "paymentmethod",
        F.col("paymentdays").try_cast("int").alias("paymentdays"),
        "paymentid",
        "uniqueinvoicenumber",
    )


def match_months(invoices: DataFrame, settings: Settings) -> DataFrame:
    """Rows per match and month with the class of the match and sums by term band.

    Usable: exactly one payment, for one invoice (``single``) or several (``multi``).

    Lines collapse to (division, match, month) with a map-side combine before any
    match is looked at as a whole, so a match holding a third of all lines is
    reduced to one row per month; "one payment" is then min = max, which needs
    neither a distinct count nor a join back to the lines.
    """
    usable = (F.col("paymentmethod") == settings.payment_method) & (
        F.col("days_to_cash") >= 0
    )
    lines = prepare_invoices(invoices).filter(F.col("matchid").isNotNull())
    ends = {"payment": "paymentid", "invoice": "uniqueinvoicenumber"}
    by_month = lines.groupBy("division", "matchid", "entryperiod").agg(
        *[F.min(c).alias(f"first_{k}") for k, c in ends.items()],
        *[F.max(c).alias(f"last_{k}") for k, c in ends.items()],
        *[F.count_if(usable & b).alias(f"n_{k}") for k, b in term_bands(settings).items()],
        *[
            F.sum(F.when(usable & b, F.col("days_to_cash"))).alias(f"days_{k}")
            for k, b in term_bands(settings).items()
        ],
    )
    match = Window.partitionBy("division", "matchid")

    def one(k: str) -> Column:
        return F.min(f"first_{k}").over(match) == F.max(f"last_{k}").over(match)

    # Null unless the match has a payment and an invoice at all.
    kind = F.when(one("invoice"), "single").when(~one("invoice"), "multi")
    return by_month.withColumn(
        "match_class", F.coalesce(F.when(one("payment"), kind), F.lit("unusable"))
    )


def match_classes(invoices: DataFrame, settings: Settings) -> DataFrame:
    """Distinct invoices and payments per match, and whether the match is usable."""
    counts = (
        prepare_invoices(invoices)
        .groupBy("division", "matchid")
        .agg(
            F.count_distinct("uniqueinvoicenumber").alias("invoices"),
            F.count_distinct("paymentid").alias("payments"),
        )
    )
    classes = match_months(invoices, settings).select("division", "matchid", "match_class")
    return counts.join(classes.distinct(), ["division", "matchid"])


def term_bands(settings: Settings) -> dict[str, Column]:
    """Name and condition of each band of payment terms."""
    return {"all": F.lit(True)} | {
        f"{t}d": F.abs(F.col("paymentdays") - t) < settings.term_tolerance
        for t in settings.term_days
    }


def days_to_cash(invoices: DataFrame, settings: Settings) -> DataFrame:
    """Mean days between invoice and payment per division, month and term band."""
    bands = term_bands(settings)
    usable = match_months(invoices, settings).filter(F.col("match_class") != "unusable")
    per_division = usable.groupBy("division", "entryperiod").agg(
        *[F.sum(f"n_{k}").alias(f"n_{k}") for k in bands],
        *[F.sum(f"days_{k}").alias(f"days_{k}") for k in bands],
    )
    stacked = ", ".join(f"'D2C_{k}', n_{k}, days_{k}" for k in bands)
    return (
        per_division.select(
            "division",
            "entryperiod",
            F.expr(f"stack({len(bands)}, {stacked}) as (aggregate, transactions, days)"),
        )
        .filter(F.col("transactions") > 0)
        .select(
            "division",
            "entryperiod",
            "aggregate",
            F.round(F.col("days") / F.col("transactions"), 4).alias("value"),
            "transactions",
            F.lit(DAYS_TYPE).alias("type"),
        )
    )
