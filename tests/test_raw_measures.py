from decimal import Decimal

from sectorgauge.plans.raw import raw_measures


def test_measures_are_stored_parts_without_bad_divisions(table, rows, settings):
    """A caller can read the result twice without computing anything of it again."""
    accounts = table(
        "id bigint, division string, rgscode string, exactrgscode string",
        (1, "1", "WOmzNopOpo", None),
        (2, "2", "BVrdHanHan", None),
        (3, "2", "WOmzNopOpo", None),
    )
    transactions = table(
        "id string, type string, sysmodified int, x_sysingested int, x_isdeleted string, "
        "amountdc decimal(18,2), glaccount bigint, entrydate string",
        *[(str(a), "20", 1, 1, "N", Decimal(-5), a, "2018-03-05") for a in (1, 2, 3)],
    )
    invoices = table(
        "division string, matchid bigint, paymententrydate string, atbip int, "
        "paymentmethod string, paymentdays int, paymentid bigint, uniqueinvoicenumber bigint",
        *[(d, n, "2018-03-05", 7, "B", 30, n, n) for n, d in enumerate("12")],
    )
    lookup = table(
        "division string, country string, eurocurrency string, allow_data_sharing string",
        *[(d, "NL", "1", "True") for d in "12"],
    )
    got = raw_measures(accounts, transactions, invoices, lookup, settings)
    found = rows(got, "division", "aggregate", "value")
    assert found == [
        ("1", "D2C_30d", 7.0), ("1", "D2C_all", 7.0), ("1", "WOmz", -5.0), ("1", "WOmzNop", -5.0)
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "Window" not in plan
