import dataclasses

from sectorgauge.operators import payments

INVOICES = (
    "division string, paymententrydate string, atbip int, paymentmethod string, "
    "paymentdays int, paymentid bigint, uniqueinvoicenumber bigint, matchid bigint"
)


def line(match, invoice, payment, days=10, term=30, method="B", date="2018-03-09", division="d"):
    return (division, date, days, method, term, payment, invoice, match)


def test_match_classes(table, rows, settings):
    df = table(
        INVOICES,
        line(1, 1, 1),
        line(2, 1, 1), line(2, 2, 1),
        line(3, 1, 1), line(3, 1, 2),
        line(4, 1, 1), line(4, 2, 2),
        line(5, 1, None),
        line(6, None, 1),
    )
    assert rows(payments.match_classes(df, settings), "matchid", "match_class") == [
        (1, "single"), (2, "multi"), (3, "unusable"), (4, "unusable"),
        (5, "unusable"), (6, "unusable"),
    ]


def test_only_single_payment_matches_count(table, rows, settings):
    df = table(
        INVOICES,
        line(1, 1, 1, days=10),
        line(2, 1, 1, days=20), line(2, 2, 1, days=30),
        # two payments: nothing of it counts
        line(3, 1, 1, days=500), line(3, 1, 2, days=500),
        # the second payment is in another month and still spoils the match
        line(4, 1, 1, days=500), line(4, 2, 2, days=500, date="2018-04-01"),
        # not matched at all
        line(None, 1, 1, days=500),
    )
    got = rows(payments.days_to_cash(df, settings), "aggregate", "value", "transactions")
    assert got == [("D2C_30d", 20.0, 3), ("D2C_all", 20.0, 3)]


def test_filtered_lines_still_take_part_in_matching(table, rows, settings):
    """A line with another method is no day count, but its payment is a payment."""
    df = table(
        INVOICES,
        line(1, 1, 1, days=10), line(1, 2, 2, days=12, method="K"),
        line(2, 1, 1, days=10), line(2, 2, 1, days=-1),
    )
    got = rows(payments.days_to_cash(df, settings), "aggregate", "value", "transactions")
    assert got == [("D2C_30d", 10.0, 1), ("D2C_all", 10.0, 1)]


def test_term_bands(table, rows, settings):
    df = table(INVOICES, *[line(t, t, t, days=t, term=t) for t in (11, 12, 16, 17, 28, 33)])
    got = {a: n for a, n in rows(payments.days_to_cash(df, settings), "aggregate", "transactions")}
    assert got == {"D2C_all": 6, "D2C_14d": 2, "D2C_30d": 1}


def test_against_counting_by_hand(spark, rows, settings):
    """Random lines with one match that holds a third of them."""
    import random

    rng = random.Random(3)
    lines = []
    for _ in range(900):
        hot = rng.random() < 1 / 3
        lines.append(
            line(
                0 if hot else rng.randrange(1, 300),
                rng.randrange(50),
                7 if hot else rng.randrange(3),
                days=rng.randrange(-2, 60),
                term=rng.choice([14, 30, 31, 60, None]),
                method=rng.choice("BBK"),
                date=f"2018-{rng.randrange(1, 4):02d}-01",
                division=rng.choice("de"),
            )
        )
    df = spark.createDataFrame(lines, INVOICES)
    pays, values = {}, {}
    for d, _, _, _, _, p, _, m in lines:
        pays.setdefault((d, m), set()).add(p)
    for d, date, days, method, term, p, _, m in lines:
        if len(pays[d, m]) > 1 or method != "B" or days < 0:
            continue
        bands = ["all"] + [f"{t}d" for t in (30, 14) if term and abs(term - t) < 3]
        for b in bands:
            values.setdefault((d, date[:7], f"D2C_{b}"), []).append(days)
    want = sorted((*k, round(sum(v) / len(v), 4), len(v)) for k, v in values.items())
    got = rows(
        payments.days_to_cash(df, dataclasses.replace(settings)),
        "division", "entryperiod", "aggregate", "value", "transactions",
    )
    assert got == sorted(want, key=lambda r: tuple(map(str, r)))
