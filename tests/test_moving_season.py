import math

import pytest

from sectorgauge.operators import moving_season as ms
from sectorgauge.operators import seasonal

POINTS = "entryperiod string, sectorcode string, kpi string, filled double"


def rows_of(values, sector="C"):
    return [(f"{2014 + i // 12}-{i % 12 + 1:02d}", sector, "k", v) for i, v in enumerate(values)]


def adjusted(table, settings, *series):
    found = ms.deseasonalize_moving(table(POINTS, *[r for s in series for r in s]), settings).collect()
    return {(r.sectorcode, (int(r.entryperiod[:4]) - 2014) * 12 + int(r.entryperiod[5:]) - 1): r for r in found}


def test_end_weights_are_the_published_ones():
    last = ms.end_weights(6)
    published = (-0.092, -0.058, 0.012, 0.120, 0.244, 0.353, 0.421)
    assert [last[d] for d in range(-6, 1)] == pytest.approx(published, abs=1e-3)
    rows = ms.trend_weights()
    assert len(rows) == 13 and all(sum(w.values()) == pytest.approx(1, abs=1e-4) for w in rows)
    assert rows[6] == {d: seasonal.HENDERSON[abs(d)] for d in range(-6, 7)}
    assert rows[12] == {-d: w for d, w in rows[0].items()}


def test_a_regular_season_on_a_line_is_removed(table, settings):
    season = [10 * math.sin(2 * math.pi * m / 12) for m in range(12)]
    got = adjusted(table, settings, rows_of([50 + 0.5 * i + season[i % 12] for i in range(60)]))
    for (_, i), r in got.items():
        assert r.deseasonalizedvalue == pytest.approx(50 + 0.5 * i, abs=0.05)
        assert r.trendvalue == pytest.approx(50 + 0.5 * i, abs=0.05 if 12 <= i < 48 else 0.5)


def test_a_season_that_grows_is_followed(table, settings):
    """Ten years; at the ends the filters lag behind, as those of five and seven years do."""
    season = [math.sin(2 * math.pi * m / 12) + 0.6 * math.cos(4 * math.pi * m / 12) for m in range(12)]
    truth = [50 + 0.2 * i for i in range(120)]
    values = [t + (2 + i / 12) * season[i % 12] for i, t in enumerate(truth)]
    moving = adjusted(table, settings, rows_of(values))
    stable = seasonal.deseasonalize(table(POINTS, *rows_of(values)), settings).collect()
    left = [abs(moving["C", i].deseasonalizedvalue - truth[i]) for i in range(120)]
    fixed = [abs(r.deseasonalizedvalue - truth[i]) for i, r in enumerate(sorted(stable))]
    assert sum(left) < 0.4 * sum(fixed)
    assert max(left[36:84]) < 0.5 * max(fixed[36:84])


def test_one_wild_month_does_not_bend_the_season(table, settings):
    season = [8 * math.sin(2 * math.pi * m / 12) for m in range(12)]
    noise = [0.3 * math.cos(i * i) for i in range(60)]
    values = [50 + 0.1 * i + season[i % 12] + noise[i] for i in range(60)]
    wild = list(values)
    wild[30] += 40
    plain = adjusted(table, settings, rows_of(values))
    got = adjusted(table, settings, rows_of(wild))
    assert got["C", 30].deseasonalizedvalue - plain["C", 30].deseasonalizedvalue == pytest.approx(40, abs=3)
    for i in (6, 18, 42, 54):  # the same month of the other years
        assert got["C", i].deseasonalizedvalue == pytest.approx(plain["C", i].deseasonalizedvalue, abs=1.5)


def test_short_constant_and_late_series(table, settings):
    got = adjusted(
        table,
        settings,
        rows_of([1.0 * i for i in range(23)], "short"),
        rows_of([7.0] * 40, "flat"),
        rows_of([None] * 5 + [3.0 + i for i in range(40)], "late"),
    )
    assert all(r.deseasonalizedvalue is None and r.trendvalue is None for (s, _), r in got.items() if s == "short")
    assert all(r.deseasonalizedvalue == pytest.approx(7) for (s, _), r in got.items() if s == "flat")
    late = {i: r for (s, i), r in got.items() if s == "late"}
    assert late[4].deseasonalizedvalue is None
    assert all(late[i].trendvalue == pytest.approx(i - 2, abs=0.1 if 17 <= i <= 32 else 0.9) for i in range(5, 45))
