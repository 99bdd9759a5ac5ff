import dataclasses

import pytest
from pyspark.sql import functions as F

from sectorgauge.operators import outliers

KPIS = (
    "division string, entryperiod string, aggregate string, value double, "
    "sectorcode string, group_id int, size_of_merged_group bigint"
)
RATIOS = (
    "division string, entryperiod string, numerator double, denominator double, "
    "value double, kpi string, aggregate string, negative_stock_cash string, "
    "group_id int, size_of_merged_group bigint"
)


def kpi(i, value, aggregate="Revenue", sector="C", group=1):
    return (f"d{i}", "2018-01", aggregate, float(value), sector, group, 100)


def ratio(i, value, negative="N", group=1):
    value = None if value is None else float(value)
    return (f"d{i}", "2018-01", 1.0, 1.0, value, "roe", "roe", negative, group, 100)


@pytest.fixture
def monthly(table, settings):
    def run(*given, **changes):
        chosen = dataclasses.replace(settings, **changes)
        flagged = outliers.flag_monthly_outliers(table(KPIS, *given), chosen)
        assert flagged.columns == outliers.MONTHLY_COLUMNS
        return {r.division: r for r in flagged.collect()}

    return run


@pytest.fixture
def ratios(table, settings):
    def run(*given, **changes):
        chosen = dataclasses.replace(settings, **changes)
        flagged = outliers.flag_ratio_outliers(table(RATIOS, *given), chosen)
        assert flagged.columns == outliers.RATIO_COLUMNS
        return {r.division: r for r in flagged.collect()}

    return run


VALUES = [10, 11, 12, 13, 14, 15, 16, 17, 24]


def test_fences_at_both_widths(monthly):
    got = monthly(*[kpi(i, v) for i, v in enumerate(VALUES)], min_group=1)
    # percentiles are multiples of 1/8: q1 = 11, q3 = 17, iqr = 6
    row = got["d0"]
    assert (row.q1, row.q3, row.iqr, row.size_of_group_per_period) == (11.0, 17.0, 6.0, 9)
    assert {d for d, r in got.items() if r.is_1point5_iqr_outlier == "Y"} == set()
    far = monthly(*[kpi(i, v) for i, v in enumerate([*VALUES[:-1], 27])], min_group=1)
    assert far["d8"].is_1point5_iqr_outlier == "Y"
    assert far["d8"].is_3point0_iqr_outlier == "N"
    further = monthly(*[kpi(i, v) for i, v in enumerate([*VALUES[:-1], 36])], min_group=1)
    assert further["d8"].is_3point0_iqr_outlier == "Y"


@pytest.mark.parametrize("size, flag", [(74, "Y"), (75, "N"), (76, "N")])
def test_size_rule(monthly, ratios, size, flag):
    got = monthly(*[kpi(i, 100 + i % 7) for i in range(size)])
    assert {r.is_3point0_iqr_outlier for r in got.values()} == {flag}
    got = ratios(*[ratio(i, 100 + i % 7) for i in range(size)])
    assert {r.is_3point0_iqr_outlier for r in got.values()} == {flag}


def test_days_to_cash_have_no_size_rule_and_use_the_sector(monthly):
    values = [10, 11, 12, 13, 14, 15, 16, 17, 18, 400]
    got = monthly(*[kpi(i, v, "D2C_30d", group=i) for i, v in enumerate(values)])
    assert got["d4"].is_3point0_iqr_outlier == "N"
    assert got["d4"].size_of_group_per_period == 1
    assert got["d0"].percentile == 0.0 and got["d9"].percentile == 1.0


def test_days_fences_are_those_of_the_transformed_values(table, settings, monthly):
    from sectorgauge.operators.power import yeo_johnson_transform

    values = [1, 2, 2, 3, 5, 8, 13, 21, 34]
    got = monthly(*[kpi(i, v, "D2C_30d") for i, v in enumerate(values)])
    schema = "g string, division string, value double"
    plain = table(schema, *[("g", f"d{i}", float(v)) for i, v in enumerate(values)])
    moved = sorted(
        r.value_t
        for r in yeo_johnson_transform(plain, ["g"], "value", settings).collect()
    )
    # lowest below a quarter: second and third value are tied at 1/8
    assert got["d0"].q1 == pytest.approx(moved[2])
    assert got["d0"].q3 == pytest.approx(moved[7])
    assert got["d0"].value == 1.0


def test_missing_group_is_one_group_for_monthly_kpis(monthly):
    got = monthly(*[kpi(i, i, group=None) for i in range(3)], kpi(9, 5, group=2), min_group=3)
    assert got["d0"].size_of_group_per_period == 3
    assert got["d0"].is_1point5_iqr_outlier == "N"
    assert got["d9"].is_1point5_iqr_outlier == "Y"


def test_missing_group_has_no_size_and_no_fences_for_ratios(ratios):
    got = ratios(
        ratio(0, 1, group=None), ratio(1, 2, group=None), ratio(2, 900, group=None),
        ratio(3, None, group=None), ratio(4, 5, "Y", group=None),
    )
    assert got["d2"].size_of_group_per_period is None and got["d2"].q1 is None
    assert got["d2"].percentile == 1.0
    flags = {d: r.is_1point5_iqr_outlier for d, r in got.items()}
    assert flags == {"d0": "N", "d1": "N", "d2": "N", "d3": "Y", "d4": "Y"}


def test_single_row_groups(monthly, ratios):
    one = monthly(kpi(0, 7), min_group=1)["d0"]
    assert (one.percentile, one.q1, one.q3, one.iqr) == (0.0, 7.0, None, 0.0)
    assert one.is_1point5_iqr_outlier == "N"
    one = ratios(ratio(0, 7), min_group=1)["d0"]
    assert (one.percentile, one.q1, one.q3, one.iqr) == (0.0, 7.0, 7.0, 0.0)
    assert one.is_1point5_iqr_outlier == "N"


def test_null_values_and_negative_balances_are_ranked_apart(ratios):
    got = ratios(
        *[ratio(i, v) for i, v in enumerate([1, 2, 3])],
        ratio(7, None), ratio(8, 900, "Y"), min_group=1,
    )
    assert got["d2"].percentile == 1.0 and got["d2"].size_of_group_per_period == 3
    assert got["d7"].size_of_group_per_period == 1 and got["d7"].is_3point0_iqr_outlier == "Y"
    assert got["d8"].size_of_group_per_period == 1 and got["d8"].is_3point0_iqr_outlier == "Y"


def test_hot_groups_give_the_same_flags(spark, settings, rows):
    import random

    rng = random.Random(8)
    given = [
        kpi(i, rng.choice([0, 0, 0, rng.gauss(50, 30)]), rng.choice(["Revenue", "D2C_30d"]),
            rng.choice(["C", "C", "C", None]), rng.choice([1, 1, 1, 2, None]))
        for i in range(400)
    ]
    df = spark.createDataFrame(given, KPIS)
    hot = dataclasses.replace(settings, hot_group_rows=20, rank_slices=8)


    def nine_places(flagged):
        """The exponent of a split group is merged in another order of the same sums."""
        fences = {c: F.round(c, 9) for c in ("q1", "q3", "iqr")}
        return rows(flagged.withColumns(fences))

    assert nine_places(outliers.flag_monthly_outliers(df, hot)) == nine_places(
        outliers.flag_monthly_outliers(df, settings)
    )
    given = [
        ratio(i, rng.choice([None, 0, rng.gauss(1, 9)]), rng.choice("NNNY"),
              rng.choice([1, 1, 1, None]))
        for i in range(400)
    ]
    df = spark.createDataFrame(given, RATIOS)
    assert rows(outliers.flag_ratio_outliers(df, hot)) == rows(
        outliers.flag_ratio_outliers(df, settings)
    )


def test_wide_outliers_are_narrow_outliers_and_quartiles_are_ordered(spark, settings):
    import random

    rng = random.Random(4)
    df = spark.createDataFrame([kpi(i, rng.gauss(0, 1) ** 3) for i in range(200)], KPIS)
    for r in outliers.flag_monthly_outliers(df, settings).collect():
        assert r.q1 <= r.q3
        assert not (r.is_3point0_iqr_outlier == "Y" and r.is_1point5_iqr_outlier == "N")
