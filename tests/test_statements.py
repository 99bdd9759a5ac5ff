import dataclasses
import datetime as dt
import random

import pytest

from sectorgauge.operators import elements, ratio_cube, ratios

MEASURES = (
    "division string, entryperiod string, aggregate string, value double, "
    "transactions bigint, type string"
)
PERIODS = "division string, finyear int, finperiod int, startdate date, enddate date"
ELEMENTS = "division string, entryperiod string, element string, cumvalue double"


def m(code, value, period, type="RGSL2", division="d"):
    return (division, period, code, float(value), 1, type)


def fiscal_year(year, first=1, division="d"):
    """Twelve fiscal months starting in month ``first``."""
    out = []
    for i in range(12):
        n = year * 12 + first - 1 + i
        start = dt.date(n // 12, n % 12 + 1, 1)
        after = dt.date((n + 1) // 12, (n + 1) % 12 + 1, 1)
        out.append((division, year, i + 1, start, after - dt.timedelta(days=1)))
    return out


@pytest.fixture
def cumulative(table, settings):
    def run(periods, *measures):
        df = elements.statement_elements(
            table(MEASURES, *measures), table(PERIODS, *periods), settings
        )
        return {(r.element, r.entryperiod): r.cumvalue for r in df.collect()}

    return run


def test_result_restarts_with_the_fiscal_year_and_balance_does_not(cumulative):
    periods = fiscal_year(2017, 7) + fiscal_year(2018, 7)
    months = [f"{n // 12}-{n % 12 + 1:02d}" for n in range(2017 * 12 + 6, 2019 * 12 + 6)]
    got = cumulative(
        periods,
        *[m("WOmz", -1, p) for p in months],
        *[m("BVrd", 1, p) for p in months],
    )
    assert got["Revenues-C", "2018-06"] == -12 and got["Revenues-C", "2018-07"] == -1
    assert got["NetIncome-C", "2018-06"] == -12
    assert got["Stock-D", "2018-06"] == 12 and got["Stock-D", "2018-07"] == 13
    assert got["Cash-D", "2018-07"] == 0
    assert len(got) == 24 * 18


def test_closing_entries(cumulative):
    """A balance counts its closing entry and the reversal within the fiscal year."""
    got = cumulative(
        fiscal_year(2017) + fiscal_year(2018),
        m("BVrd", 10, "2017-03"),
        m("BVrd", -4, "2017-12", "RGSL2-hastype310"),
        m("WOmz", -5, "2017-12"),
        m("WOmz", 5, "2017-12", "RGSL2-hastype310"),
    )
    assert got["Stock-D", "2017-11"] == 10
    assert got["Stock-D", "2017-12"] == 10
    assert got["Stock-D", "2018-01"] == 6
    assert got["Revenues-C", "2017-12"] == -5


def test_spine_limits(cumulative, table, rows, settings):
    periods = fiscal_year(2016) + fiscal_year(2019) + fiscal_year(2020)
    got = cumulative(
        periods,
        m("BVrd", 3, "2005-2016"),
        m("BVrd", 100, "2016-06"),
        m("BVrd", 1, "2019-02"),
    )
    stock = {p: v for (e, p), v in got.items() if e == "Stock-D"}
    assert min(stock) == "2016-12" and max(stock) == "2019-12" and len(stock) == 13
    assert stock["2016-12"] == 3 and stock["2019-12"] == 4
    odd = table(PERIODS, ("d", 2018, 1, dt.date(2018, 1, 15), dt.date(2018, 3, 14)))
    spine = elements.fiscal_spine(elements.fiscal_year_bounds(odd, settings), settings)
    assert rows(spine, "entryperiod") == [("2018-02",), ("2018-03",)]


def test_only_divisions_with_measures_have_elements(cumulative):
    periods = fiscal_year(2018) + fiscal_year(2018, division="idle")
    got = cumulative(periods, m("WOmz", 1, "2018-01", "RGSL2-hastype310"))
    assert got == {}
    got = cumulative(periods, m("XXXX", 1, "2011-01"))
    assert len(got) == 12 * 18 and set(got.values()) == {0.0}


def ratio_rows(table, settings, values, **more):
    given = [("d", "2018-01", e, float(v)) for e, v in values.items()]
    df = ratios.statement_ratios(table(ELEMENTS, *given), settings)
    return {r.kpi: r for r in df.collect()}


def test_ratio_values(table, settings):
    got = ratio_rows(
        table,
        settings,
        {
            "Revenues-C": -1000, "EmployeeCosts-D": 250, "CostOfGoods-D": 400,
            "NetIncome-C": -90, "AccountReceivables-D": 100, "Stock-D": 50,
            "WorkInProgress-D": 20, "Bank-D": 80, "Cash-D": -5, "AccountPayables-C": -120,
            "TaxToPay-C": 15, "Equity-C": -300, "Provisions-C": -40, "LongtermDebt-C": 10,
        },
    )
    values = {k: r.value for k, r in got.items()}
    assert values == pytest.approx(
        {
            "employee_costs": 25.0,
            "receivable_days": 36.5,
            "gross_margin": 100 * (-600) / -1000,
            "roe": 100 * -90 / -300,
            "inventory_turnover": 8.0,
            "quick_ratio": (100 + 80 - 5 + 15) / 120,
            "current_ratio": (190 + 50 + 20) / 120,
            "solvability": 100 * 300 / (120 + 40),
        }
    )
    assert {r.negative_stock_cash for r in got.values()} == {"Y"}


def test_wrong_signs_give_a_row_without_value(table, settings):
    got = ratio_rows(table, settings, {"Revenues-C": 10, "EmployeeCosts-D": 5, "Stock-D": 0})
    assert {k: r.value for k, r in got.items()} == {
        "employee_costs": None, "receivable_days": None, "gross_margin": None,
    }
    assert got["employee_costs"].numerator == 5.0 and got["employee_costs"].denominator is None


def test_related_ratios_exist_together(table, settings):
    assert set(ratio_rows(table, settings, {"Bank-D": 1})) == {
        "quick_ratio", "current_ratio", "solvability",
    }
    assert set(ratio_rows(table, settings, {"WorkInProgress-D": 1})) == {
        "current_ratio", "solvability",
    }
    assert set(ratio_rows(table, settings, {"Equity-C": -1})) == {"roe", "solvability"}


def test_negative_stock_and_cash_together_give_one_row_per_ratio(table, rows, settings):
    df = table(
        ELEMENTS,
        ("d", "2018-01", "Stock-D", -5.0), ("d", "2018-01", "Cash-D", -5.0),
        ("d", "2018-02", "Stock-D", -0.1), ("d", "2018-03", "Cash-D", -0.11),
    )
    got = rows(ratios.statement_ratios(df, settings), "entryperiod", "kpi", "negative_stock_cash")
    assert len(got) == len(set(got))
    assert {(p, f) for p, _, f in got} == {("2018-01", "Y"), ("2018-02", "N"), ("2018-03", "Y")}
    assert rows(ratios.negative_stock_cash(df, settings), "entryperiod") == [
        ("2018-01",), ("2018-03",),
    ]


MEMBERS = (
    "entryperiod string, kpi string, sizedescription string, sectorcode string, "
    "subsectorcode string, value double"
)


def test_cube_groups_and_unknown_keys(table, rows):
    df = table(
        MEMBERS,
        ("2018-01", "roe", "Small", "C", "70", 1.0),
        ("2018-01", "roe", "Large", "C", "70", 2.0),
        ("2018-01", "roe", "Unknown", "C", "Unknown", 6.0),
        ("2018-01", "roe", "Small", "Unknown", "70", 9.0),
        ("2018-01", "other", "Small", "C", "70", 9.0),
    )
    got = rows(ratio_cube.ratio_cube(df), "sizedescription", "subsectorcode", "value", "population")
    assert got == [
        ("ALL", "70", 1.0, 2),
        ("ALL", "ALL", 2.0, 3),
        ("Large", "70", 2.0, 1),
        ("Large", "ALL", 2.0, 1),
        ("Small", "70", 1.0, 1),
        ("Small", "ALL", 1.0, 1),
    ]
    means = rows(ratio_cube.ratio_cube(df, "mean"), "sizedescription", "subsectorcode", "value")
    assert ("ALL", "ALL", 3.0) in means
    with pytest.raises(ValueError):
        ratio_cube.ratio_cube(df, "mode")


def test_cube_totals_are_the_sums_of_their_members(spark, settings):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    df = spark.createDataFrame(
        [
            ("2018-01", rng.choice(ratios.RATIOS), rng.choice(["Small", "Large", "Unknown"]),
             rng.choice("CG"), rng.choice(["70", "71"]), rng.random())
            for _ in range(300)
        ],
        MEMBERS,
    )
    total = {
        (r.kpi, r.sectorcode): r.n
        for r in df.groupBy("kpi", "sectorcode").agg(F.count("*").alias("n")).collect()
    }
    cells = ratio_cube.ratio_cube(df).filter("sizedescription = 'ALL' and subsectorcode = 'ALL'")
    assert {(r.kpi, r.sectorcode): r.population for r in cells.collect()} == total
    units = {(r.kpi, r.unit) for r in ratio_cube.ratio_cube(df).collect()}
    assert units == set(ratio_cube.RATIO_UNITS.items())


def test_year_cap_is_optional(table, rows, settings):
    periods = table(PERIODS, *fiscal_year(2019), *fiscal_year(2020))
    assert len(rows(elements.fiscal_year_bounds(periods, settings))) == 1
    free = dataclasses.replace(settings, fin_year_max=None)
    assert len(rows(elements.fiscal_year_bounds(periods, free))) == 2
