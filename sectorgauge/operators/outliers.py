"""Outlier flags within peer groups: one policy per product line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.functions.columns import group_label, yes_no
from sectorgauge.operators.power import with_transformed, yeo_johnson_lambda
from sectorgauge.operators.ranking import rank_in_groups

MONTHLY_COLUMNS = [
    "division",
    "aggregate",
    "value",
    "entryperiod",
    "is_1point5_iqr_outlier",
    "is_3point0_iqr_outlier",
    "percentile",
    "group_id",
    "size_of_merged_group",
    "size_of_group_per_period",
    "q1",
    "q3",
    "iqr",
    "kpi",
]
RATIO_COLUMNS = [
    "division",
    "entryperiod",
    "numerator",
    "denominator",
    "value",
    "kpi",
    "aggregate",
    "is_1point5_iqr_outlier",
    "is_3point0_iqr_outlier",
    "percentile",
    "group_id",
    "size_of_merged_group",
    "size_of_group_per_period",
    "q1",
    "q3",
    "iqr",
    "negative_stock_cash",
]


def beyond_fences(value: Column, width: float) -> Column:
    """Further than ``width`` interquartile ranges outside the quartiles."""
    return (value > F.col("q3") + width * F.col("iqr")) | (
        value < F.col("q1") - width * F.col("iqr")
    )


def with_peer_profile(kpis: DataFrame, profile: DataFrame) -> DataFrame:
    """Inner join of KPI rows to the peer-group columns of their division."""
    return kpis.join(profile, "division")


def flag_monthly_outliers(kpis: DataFrame, settings: Settings) -> DataFrame:
    """Flags for monthly KPIs; ``kpis`` is the stored join of KPIs and profile.

    Days-to-cash KPIs are judged within their sector on power-transformed values,
    with no size rule. All others are judged within their peer group, and groups
    below the minimum size are flagged as a whole. A NULL peer group is one group.

    The transform is increasing, so ranks are the same before and after it and the
    quartile fences can be transformed instead of every group: all KPIs share one
    ranking pass over the plain values, and the exponents join in afterwards.
    """
    is_d2c = F.col("aggregate").startswith("D2C")
    by_group = group_label("G", F.col("group_id"))
    by_sector = group_label("S", F.col("sectorcode"))
    placed = kpis.withColumn("peer", F.when(is_d2c, by_sector).otherwise(by_group))
    keys = ["entryperiod", "aggregate", "peer"]

    days = placed.filter(is_d2c)
    exponents = yeo_johnson_lambda(days, keys, "value", settings)
    sizes = days.groupBy("entryperiod", "aggregate", by_group.alias("group_label")).agg(
        F.count("division").alias("companies")
    )
    # Both right sides hold one row per group; the planner picks the join.
    plain = rank_in_groups(placed, keys, "value", "division", settings)
    ranked = (
        with_transformed(plain, exponents, keys, "value", "q1", "q3")
        .withColumn("group_label", by_group)
        .join(sizes, ["entryperiod", "aggregate", "group_label"], "left")
    )

    def judged(column: str) -> Column:
        return F.when(is_d2c, F.col(f"{column}_t")).otherwise(F.col(column))

    fenced = ranked.select(
        *[c for c in ranked.columns if c not in ("q1", "q3")],
        judged("value").alias("sort_value"),
        judged("q1").alias("q1"),
        judged("q3").alias("q3"),
        F.coalesce("companies", "group_rows").alias("size_of_group_per_period"),
    ).withColumn("iqr", F.coalesce(F.col("q3") - F.col("q1"), F.lit(0.0)))
    too_small = ~is_d2c & (F.col("size_of_group_per_period") < settings.min_group)
    value = F.col("sort_value")
    return (
        fenced.withColumn(
            "is_1point5_iqr_outlier",
            yes_no(too_small | beyond_fences(value, settings.inner_fence)),
        )
        .withColumn(
            "is_3point0_iqr_outlier",
            yes_no(too_small | beyond_fences(value, settings.outer_fence)),
        )
        .withColumn("kpi", F.col("aggregate"))
        .select(*MONTHLY_COLUMNS)
    )


def flag_ratio_outliers(ratios: DataFrame, settings: Settings) -> DataFrame:
    """Flags for statement ratios; ``ratios`` is the stored join with the profile.

    NULL values and companies with negative stock or cash are ranked apart and
    always flagged. Rows without a peer group get a percentile but no size and no
    fences, so only those two reasons can flag them.
    """
    keyed = ratios.select(
        "*",
        F.col("value").isNull().alias("value_is_null"),
        group_label("G", F.col("group_id")).alias("peer"),
    )
    keys = ["entryperiod", "aggregate", "peer", "value_is_null", "negative_stock_cash"]
    ranked = rank_in_groups(keyed, keys, "value", "division", settings)
    grouped = F.col("group_id").isNotNull()
    fenced = ranked.select(
        *[c for c in ranked.columns if c not in ("q1", "q3")],
        F.when(grouped, F.col("group_rows")).alias("size_of_group_per_period"),
        F.when(grouped, F.col("q1")).alias("q1"),
        F.when(grouped, F.coalesce("q3", "q1")).alias("q3"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    always = F.col("value_is_null") | (F.col("negative_stock_cash") == "Y")
    too_small = F.col("size_of_group_per_period") < settings.min_group
    value = F.col("value")
    return (
        fenced.withColumn(
            "is_1point5_iqr_outlier",
            yes_no(too_small | beyond_fences(value, settings.inner_fence) | always),
        )
        .withColumn(
            "is_3point0_iqr_outlier",
            yes_no(too_small | beyond_fences(value, settings.outer_fence) | always),
        )
        .select(*RATIO_COLUMNS)
    )
