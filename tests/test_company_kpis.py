import pytest

from sectorgauge.operators import company_kpis

MEASURES = (
    "division string, entryperiod string, aggregate string, value double, "
    "transactions bigint, type string"
)


def m(code, value, period="2018-01", type="RGSL2", division="d"):
    return (division, period, code, value, 1, type)


@pytest.fixture
def kpis(table, settings):
    def run(*measures):
        df = company_kpis.company_kpis(table(MEASURES, *measures), settings)
        return {(r.aggregate, r.entryperiod): r.value for r in df.collect()}

    return run


def test_revenue_cost_and_profitability(kpis):
    got = kpis(m("WOmz", -80.0), m("WOvb", -20.0), m("WPer", 30.0), m("WKpr", 10.0))
    assert got == {
        ("Revenue", "2018-01"): 100.0,
        ("Cost", "2018-01"): 40.0,
        ("Profitability", "2018-01"): 0.6,
    }


def test_zero_revenue_gives_no_profitability(kpis):
    got = kpis(m("WOmz", 0.0), m("WPer", 5.0))
    assert set(got) == {("Revenue", "2018-01"), ("Cost", "2018-01")}


def test_closing_and_untyped_rows_and_copies_do_not_count(kpis):
    got = kpis(
        m("WOmz", -10.0),
        m("WOmz", -10.0),
        m("WOmz", -99.0, type="RGSL2-hastype310"),
        m("WOmz", -99.0, type=None),
    )
    assert got == {("Revenue", "2018-01"): 10.0}


def test_cash_position_uses_all_history_but_skips_months_without_cash(kpis):
    got = kpis(
        m("BLim", 5.0, "2011-12"),
        m("BLim", 1.0, "2018-01"),
        m("WOmz", -1.0, "2018-02"),
        m("BLim", 2.5, "2018-03"),
    )
    assert {k: v for k, v in got.items() if k[0].startswith("Cash")} == {
        ("CashFlowPosition", "2018-01"): 6.0,
        ("CashFlowPosition", "2018-03"): 8.5,
        ("CashFlowMonthly", "2018-01"): 1.0,
        ("CashFlowMonthly", "2018-03"): 2.5,
    }


def test_days_to_cash_pass_through(kpis):
    days = "Days to Cash In"
    got = kpis(m("D2C_30d", 12.3456, type=days), m("D2C_all", 9.0, type=days))
    assert got == {("D2C_30d", "2018-01"): 12.3456, ("D2C_all", "2018-01"): 9.0}


def test_window_excludes_the_running_month(kpis):
    got = kpis(m("WPer", 1.0, "2011-12"), m("WPer", 1.0, "2012-01"),
               m("WPer", 1.0, "2019-05"), m("WPer", 1.0, "2019-06"))
    assert set(got) == {("Cost", "2012-01"), ("Cost", "2019-05")}
