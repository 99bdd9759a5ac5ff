import pytest

from sectorgauge.operators import divisions, sector_kpis

FLAGGED = (
    "division string, entryperiod string, kpi string, value double, "
    "is_1point5_iqr_outlier string, is_3point0_iqr_outlier string"
)
ROWS = "division string, entryperiod string, kpi string, unit string, value double"
SECTORS = "division string, sectorcode string"
LOOKUP = (
    "division int, country string, sectorcode string, subsectorcode string, "
    "sizedescription string, allow_data_sharing string, group_id int, "
    "size_of_merged_group bigint, eurocurrency string"
)


def flag(division, value, kpi="D2C_30d", period="2018-01", narrow="N", wide="N"):
    return (division, period, kpi, float(value), narrow, wide)


def test_dimension_filters(table, rows):
    df = table(
        LOOKUP,
        (1, "NL", "M", "69", "Small", "True", 1, 1, "1"),
        (2, "BE", "M", "70", None, "True", 1, 1, "1"),
        (3, "NL", "M", None, None, None, 1, 1, "1"),
        (4, "NL", None, "70", "Large", "False", 1, 1, "1"),
        (5, "NL", "C", "70", "Large", "True", 1, 1, "0"),
    )
    assert rows(divisions.eligible_divisions(df)) == [("1",), ("3",)]
    assert rows(divisions.consent_report(df)) == [(1, 3)]
    assert rows(divisions.sector_profile(df)) == [("1", "M69"), ("3", "M"), ("4", None)]
    assert rows(divisions.cube_profile(df)) == [
        ("1", "Small", "M", "69"),
        ("3", "Unknown", "M", "Unknown"),
        ("4", "Large", "Unknown", "70"),
    ]


def test_only_finite_values_count(table, rows):
    values = [1.0, float("nan"), float("inf"), -float("inf"), None]
    df = table(ROWS, *[(str(i), "2018-01", "k", "u", v) for i, v in enumerate(values)])
    sectors = table(SECTORS, *[(str(i), "C") for i in range(5)])
    got = rows(sector_kpis.sector_average(df, sectors), "sectorcode", "value", "population")
    assert got == [("ALL", 1.0, 1), ("C", 1.0, 1)]


def test_missing_sector_and_total_stay_apart(table, rows):
    df = table(ROWS, ("a", "2018-01", "k", "u", 1.0), ("b", "2018-01", "k", "u", 3.0))
    sectors = table(SECTORS, ("a", None), ("b", "C"))
    got = rows(sector_kpis.sector_average(df, sectors), "sectorcode", "value", "population")
    assert got == [("ALL", 2.0, 2), ("C", 3.0, 1), (None, 1.0, 1)]


def test_median_is_the_lower_middle(table, rows):
    df = table(ROWS, *[(str(i), "2018-01", "k", "u", float(i)) for i in (1, 2, 3, 4)])
    sectors = table(SECTORS, *[(str(i), "C") for i in (1, 2, 3, 4)])
    got = rows(sector_kpis.sector_average(df, sectors, "median"), "sectorcode", "value")
    assert got == [("ALL", 2.0), ("C", 2.0)]
    with pytest.raises(ValueError):
        sector_kpis.sector_average(df, sectors, "mode")


def test_positions_become_shares_and_each_kpi_has_its_flag(table, rows, settings):
    df = table(
        FLAGGED,
        flag("a", 10000, "CashFlowPosition"),
        flag("b", 10001, "CashFlowPosition", narrow="Y"),
        flag("c", 10002, "CashFlowPosition", wide="Y"),
        flag("a", 0, "CashFlowMonthly"),
        flag("b", 0.01, "CashFlowMonthly"),
        flag("a", 12.5),
        flag("b", 12.5, narrow="Y"),
        flag("a", 1, "Cost"),
    )
    got = rows(sector_kpis.average_kpis(df, settings), "kpi", "division", "value", "unit")
    assert got == [
        ("d2c_30d_mean", "a", 12.5, "days"),
        ("positive_cash_flow_monthly", "a", 0.0, "percent"),
        ("positive_cash_flow_monthly", "b", 100.0, "percent"),
        ("positive_cash_flow_position", "a", 0.0, "percent"),
        ("positive_cash_flow_position", "b", 100.0, "percent"),
    ]


def test_year_on_year_needs_the_same_month_a_year_ago(table, rows):
    df = table(
        FLAGGED,
        flag("a", 100, "Revenue", "2017-01"),
        flag("a", 150, "Revenue", "2018-01"),
        # twelve rows back, but not twelve months
        flag("b", 10, "Revenue", "2016-05"),
        flag("b", 20, "Revenue", "2018-05"),
        flag("c", 10, "Revenue", "2017-05", wide="Y"),
        flag("c", 20, "Revenue", "2018-05"),
        flag("d", 10, "Revenue", "2017-12"),
        flag("d", 30, "Revenue", "2018-12", narrow="Y"),
    )
    got = rows(sector_kpis.revenue_year_on_year(df))
    assert got == [("a", "2018-01", 150.0, 100.0), ("d", "2018-12", 30.0, 10.0)]


def test_total_growth_compares_sums(table, rows):
    growth = table(
        "division string, entryperiod string, revenue double, lastyear_revenue double",
        ("a", "2018-01", 150.0, 100.0),
        ("b", "2018-01", 50.0, 100.0),
        ("c", "2018-01", 7.0, 0.0),
        ("d", "2018-01", float("nan"), 1.0),
        ("e", "2018-01", 1.0, float("inf")),
    )
    sectors = table(SECTORS, ("a", "C"), ("b", "M69"), ("c", "G"), ("d", "C"), ("e", "C"))
    got = rows(sector_kpis.total_growth(growth, sectors), "sectorcode", "value", "population")
    assert got == [
        ("ALL", pytest.approx(3.5), 3), ("C", 50.0, 1), ("G", None, 1), ("M69", -50.0, 1),
    ]


def test_densify_fills_every_combination(table, rows):
    points = table(
        "entryperiod string, sectorcode string, kpi string, value double, "
        "population bigint, unit string",
        ("2018-01", "C", "k1", 1.0, 5, "u"),
        ("2018-02", "ALL", "k2", 2.0, 6, "u"),
        ("2018-02", None, "k2", 9.0, 6, "u"),
    )
    dense = sector_kpis.densify(points)
    assert dense.count() == 2 * 3 * 2
    assert rows(dense.filter("value is not null"), "entryperiod", "sectorcode", "value") == [
        ("2018-01", "C", 1.0), ("2018-02", "ALL", 2.0),
    ]


def test_publishable_months(table, rows, settings):
    df = table("entryperiod string", ("2019-03",), ("2019-04",))
    assert rows(sector_kpis.until_publishable(df, settings)) == [("2019-03",)]
