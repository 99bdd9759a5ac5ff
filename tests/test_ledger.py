import dataclasses
from decimal import Decimal

import pytest

from sectorgauge.operators import ledger

TX = (
    "id string, type string, sysmodified int, x_sysingested int, x_isdeleted string, "
    "amountdc decimal(18,2), glaccount bigint, entrydate string"
)


def tx(id="a", type="20", modified=1, ingested=1, deleted="N", amount="1.00", account=1,
       date="2018-03-05"):
    return (id, type, modified, ingested, deleted, Decimal(amount), account, date)


def test_newest_version_wins_and_tombstones_remove_the_id(table, rows):
    df = table(
        TX,
        tx("a", modified=1),
        tx("a", modified=2, deleted="Y"),
        tx("b", modified=1, amount="5.00"),
        tx("b", modified=1, ingested=2, amount="7.00"),
        tx("c", modified=2, deleted="N", amount="3.00"),
        tx("c", modified=1, deleted="Y"),
    )
    got = rows(ledger.current_transactions(df), "id", "amountdc")
    assert [(i, float(a)) for i, a in got] == [("b", 7.0), ("c", 3.0)]


def test_version_choice_has_a_total_order(table, rows):
    versions = [tx("a", amount=str(n)) for n in range(20)]
    forward = ledger.current_transactions(table(TX, *versions))
    backward = ledger.current_transactions(table(TX, *reversed(versions)).repartition(3))
    assert rows(forward) == rows(backward)


def test_hot_id_is_reduced_before_the_shuffle(table):
    df = ledger.current_transactions(table(TX, tx()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_exchange


def test_period_bucket_and_date_range(table, rows, settings):
    dates = ["2009-12-31", "2010-01-01", "1983-12-31", "2025-01-01", "2024-12-31"]
    df = table(TX, *[tx(d, date=d) for d in dates], tx("x", "310"))
    got = rows(ledger.with_entry_period(df, settings), "id", "entryperiod", "hastype310")
    assert got == [
        ("2009-12-31", "2009-12", "N"),
        ("2010-01-01", "2010-01", "N"),
        ("2024-12-31", "2024-12", "N"),
        ("x", "2018-03", "Y"),
    ]


@pytest.mark.parametrize(
    "customer, model, expected",
    [
        ("WOmzNo", "BLimKasKas", "BLimKasKas"),
        ("WOmzNop", "BLimKasKas", "WOmzNop"),
        ("WOmzNopOpoExtra", None, "WOmzNopOpo"),
        (None, "BLimKasKa", None),
        ("WOmzNo", "BLimKasKa", None),
        (None, None, None),
    ],
)
def test_account_code_choice(table, rows, settings, customer, model, expected):
    schema = "id bigint, division string, rgscode string, exactrgscode string"
    df = table(schema, (1, "d", customer, model))
    got = rows(ledger.choose_account_codes(df, settings), "rgscode")
    assert got == ([(expected,)] if expected else [])


CODED = (
    "division string, entryperiod string, rgscode string, hastype310 string, "
    "units bigint, transactions bigint"
)


def test_amounts_keep_four_decimals(table, rows, settings):
    schema = "glaccount bigint, entryperiod string, hastype310 string, amountdc decimal(18,4)"
    parts = [Decimal("0.0049"), Decimal("0.0049"), Decimal("-1.0001")]
    months = ledger.account_months(table(schema, *[(1, "2018-01", "N", x) for x in parts]))
    codes = table("id bigint, division string, rgscode string", (1, "d", "WOmz"))
    got = ledger.roll_up(ledger.with_ledger_code(months, codes), settings)
    assert rows(got, "value", "transactions") == [(-0.9903, 3)]


def test_roll_up_levels_by_code_length(table, rows, settings):
    df = table(
        CODED,
        ("d", "2018-01", "WOmzNop", "N", 100000, 1),
        ("d", "2018-01", "WOmzNopOpo", "N", 25000, 2),
        ("d", "2018-01", "WOm", "N", 99900, 9),
        ("d", "2018-01", "WOmzNopOpo", "Y", 5000, 1),
    )
    got = rows(ledger.roll_up(df, settings), "aggregate", "type", "value", "transactions")
    assert got == [
        ("WOmz", "RGSL2", 12.5, 3),
        ("WOmz", "RGSL2-hastype310", 0.5, 1),
        ("WOmzNop", "RGSL3", 12.5, 3),
        ("WOmzNop", "RGSL3-hastype310", 0.5, 1),
    ]
    deep = dataclasses.replace(settings, levels=(10,))
    got = rows(ledger.roll_up(df, deep), "aggregate", "type", "value")
    assert got == [
        ("WOmzNopOpo", "RGSL4", 2.5),
        ("WOmzNopOpo", "RGSL4-hastype310", 0.5),
    ]


def test_one_shuffle_serves_all_levels(table, settings):
    plan = ledger.roll_up(table(CODED), settings)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange") == 1
    # levels are combined before they are shuffled
    assert "partial_sum" in text.split("Exchange")[1] and "explode" in text.split("Exchange")[1]


MEASURES = (
    "division string, entryperiod string, aggregate string, value double, "
    "transactions bigint, type string"
)


def test_bad_divisions_are_judged_per_code_over_all_time(table, rows, settings):
    df = table(
        MEASURES,
        # cash and stock cancel out, but each is tested alone
        ("x", "2018-01", "BVrd", -5.0, 1, "RGSL2"),
        ("x", "2018-01", "BLimKas", 9.0, 1, "RGSL3"),
        ("x", "2018-01", "D2C_all", 3.0, 1, "Days to Cash In"),
        # negative month, positive total, with the closing entry counted
        ("y", "2018-01", "BVrd", -5.0, 1, "RGSL2"),
        ("y", "2018-02", "BVrd", 5.0, 1, "RGSL2-hastype310"),
        # exactly at the limit
        ("z", "2018-01", "BLimKas", -0.1, 1, "RGSL3"),
        ("n", "2018-01", "WOmz", -9.0, 1, "RGSL2"),
    )
    bad = ledger.bad_divisions(df, settings)
    assert rows(bad) == [("x",)]
    kept = ledger.drop_bad_divisions(df, bad)
    assert rows(kept.select("division").distinct()) == [("n",), ("y",), ("z",)]
    assert kept.columns == df.columns


def test_levels_add_up(table, settings):
    from pyspark.sql import functions as F

    df = table(
        CODED,
        *[
            ("d", f"2018-{m:02d}", c, "N", 7 * m + i, 1)
            for m in range(1, 13)
            for i, c in enumerate(["WOmzNopOpo", "WOmzNopXyz", "WOmzAbcDef"])
        ],
    )
    sums = {
        r["type"]: r["total"]
        for r in ledger.roll_up(df, settings)
        .groupBy("type")
        .agg(F.round(F.sum("value"), 2).alias("total"))
        .collect()
    }
    assert sums["RGSL2"] == sums["RGSL3"]
