import calendar
import dataclasses
import math

import numpy as np
import pytest

from sectorgauge.operators import seasonal
from sectorgauge.operators import trading_days as td

POINTS = "entryperiod string, sectorcode string, kpi string, filled double"
EFFECTS = [0.4, 0.1, -0.3, 0.25, 0.5, -0.6]


def month_of(i):
    return 2014 + i // 12, i % 12 + 1


def contrasts(i):
    year, month = month_of(i)
    days = [calendar.weekday(year, month, d + 1) for d in range(calendar.monthrange(year, month)[1])]
    return [days.count(d) - days.count(6) for d in range(6)]


def planted(i):
    return sum(e * x for e, x in zip(EFFECTS, contrasts(i)))


def plain(i):
    return 50 + 0.5 * i + 10 * math.sin(2 * math.pi * i / 12)


def rows_of(values, sector="C"):
    return [("%d-%02d" % month_of(i), sector, "k", v) for i, v in enumerate(values)]


def test_contrasts_count_weekdays(table):
    frame = table("entryperiod string", *[("%d-%02d" % month_of(i),) for i in range(-24, 200)])
    got = frame.select("entryperiod", *td.weekday_contrasts(td.month_start(td.F.col("entryperiod")))).collect()
    assert {r[0]: list(r)[1:] for r in got} == {"%d-%02d" % month_of(i): contrasts(i) for i in range(-24, 200)}


def test_planted_effects_are_found_and_removed(table, settings):
    values = [plain(i) + planted(i) for i in range(60)]
    frame = table(POINTS, *rows_of(values), *rows_of(map(plain, range(60)), "G"))
    found = {r["sectorcode"]: r["effects"] for r in td.trading_day_effects(frame).collect()}
    assert found["C"] == pytest.approx(EFFECTS, abs=1e-6)
    assert found["G"] == pytest.approx([0] * 6, abs=1e-6)
    left = td.remove_trading_days(frame)
    assert left.columns == [*frame.columns, "tradingday"]
    for r in left.collect():
        i = (int(r.entryperiod[:4]) - 2014) * 12 + int(r.entryperiod[5:]) - 1
        assert r.filled == pytest.approx(plain(i), abs=1e-6)
    adjusted = seasonal.deseasonalize(left, settings).filter("sectorcode = 'C'").collect()
    assert all(r.deseasonalizedvalue is not None for r in adjusted)


def test_noise_gives_the_least_squares(table):
    rng = np.random.default_rng(5)
    values = [plain(i) + planted(i) + rng.normal() for i in range(60)]
    x, y = np.array([contrasts(i) for i in range(60)], float), np.array(values)

    def differenced(a):
        return a[13:] - a[12:-1] - a[1:-12] + a[:-13]

    want = np.linalg.lstsq(differenced(x), differenced(y), rcond=None)[0]
    got = td.trading_day_effects(table(POINTS, *rows_of(values.__iter__()))).first()["effects"]
    assert got == pytest.approx(want.tolist(), abs=1e-8)


def test_series_that_do_not_tell_stay_as_they_are(table):
    short = rows_of([1.0 * i * i for i in range(18)])
    holes = [(*r[:3], None) for r in rows_of(range(30), "H")]
    nameless = [(r[0], None, "k", r[3]) for r in rows_of([plain(i) + planted(i) for i in range(60)])]
    frame = table(POINTS, *short, *holes, *nameless)
    left = td.remove_trading_days(frame).collect()
    assert len(left) == 18 + 30 + 60
    assert all(r.tradingday == 0 for r in left if r.sectorcode)
    assert {r.filled for r in left if r.sectorcode == "H"} == {None}
    assert any(abs(r.tradingday) > 0.1 for r in left if r.sectorcode is None)
    assert td.remove_trading_days(frame.limit(0)).count() == 0


def test_the_option_changes_the_series(table, settings):
    rows = [(*r, 5, "days") for r in rows_of([plain(i) + planted(i) for i in range(60)])]
    points = table("entryperiod string, sectorcode string, kpi string, value double, population long, unit string", *rows)
    named = dataclasses.replace(settings, kpis=("k",), sectors=("C",))
    without = seasonal.seasonal_series(points, named)
    clean = seasonal.seasonal_series(points, named, prepare=td.remove_trading_days)
    assert clean.columns == without.columns
    assert clean.select("value").collect() == without.select("value").collect()
    assert clean.select("deseasonalizedvalue").collect() != without.select("deseasonalizedvalue").collect()
