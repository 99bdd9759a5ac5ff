import math

import pytest

from sectorgauge.operators import seasonal

POINTS = (
    "entryperiod string, sectorcode string, kpi string, value double, "
    "population bigint, unit string"
)


def month(n):
    return f"{2014 + n // 12}-{n % 12 + 1:02d}"


def series(values, sector="C", kpi="d2c_30d_mean", skip=()):
    return [
        (month(i), sector, kpi, v, 100 + i, "days")
        for i, v in enumerate(values)
        if i not in skip
    ]


def test_gaps_are_filled_like_a_line(table, rows):
    df = table(POINTS, *series([None, 1.0, None, 3.0, None]))
    got = rows(seasonal.interpolate(df), "entryperiod", "filled")
    assert [v for _, v in got] == [None, 1.0, 2.0, 3.0, 3.0]


def test_missing_calendar_months_are_gaps(table, rows):
    df = table(POINTS, *series([1.0, 0.0, 0.0, 4.0], skip=(1, 2)))
    got = rows(seasonal.interpolate(seasonal.calendar_series(df)), "entryperiod", "filled", "value")
    assert got == [
        ("2014-01", 1.0, 1.0), ("2014-02", 2.0, None), ("2014-03", 3.0, None), ("2014-04", 4.0, 4.0),
    ]


def test_tail_keeps_the_latest_months_of_each_series(table, rows):
    df = table(POINTS, *series([1.0] * 5), *series([1.0] * 2, sector="G"))
    got = rows(seasonal.last_months(df, 3), "sectorcode", "entryperiod")
    assert got == [
        ("C", "2014-03"), ("C", "2014-04"), ("C", "2014-05"), ("G", "2014-01"), ("G", "2014-02"),
    ]


def test_a_regular_season_on_a_line_is_removed(table, settings):
    season = [10 * math.sin(2 * math.pi * m / 12) for m in range(12)]
    values = [50 + 0.5 * i + season[i % 12] for i in range(60)]
    out = seasonal.seasonal_series(table(POINTS, *series(values)), settings).collect()
    assert len(out) == settings.series_output
    for r in out:
        i = (int(r.entryperiod[:4]) - 2014) * 12 + int(r.entryperiod[5:]) - 1
        assert r.value == pytest.approx(values[i])
        assert r.population == 100 + i and r.unit == "days"
        assert r.deseasonalizedvalue == pytest.approx(50 + 0.5 * i, abs=1e-9)
        if i < 54:
            assert r.trendvalue == pytest.approx(50 + 0.5 * i, abs=1e-2)


def test_seasonal_parts_cancel_over_a_year(table, settings):
    values = [math.cos(i * i) * 5 + i for i in range(60)]
    out = sorted(seasonal.seasonal_series(table(POINTS, *series(values)), settings).collect())
    parts = [r.value - r.deseasonalizedvalue for r in out]
    assert sum(parts[-12:]) == pytest.approx(0, abs=1e-9)


def test_short_and_unlisted_series(table, settings):
    df = table(
        POINTS,
        *series([float(i) for i in range(23)]),
        *series([float(i) for i in range(24)], sector="G"),
        *series([1.0] * 30, sector="X"),
        *series([1.0] * 30, kpi="other"),
    )
    out = seasonal.seasonal_series(df, settings).collect()
    assert {r.sectorcode for r in out} == {"C", "G"} and {r.kpi for r in out} == {"d2c_30d_mean"}
    assert all(r.deseasonalizedvalue is None for r in out if r.sectorcode == "C")
    assert all(r.trendvalue is not None for r in out if r.sectorcode == "G")
