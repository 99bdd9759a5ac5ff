import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sectorgauge.operators import serving, snapshots
from sectorgauge.sources import schemas

NOW = dt.datetime(2019, 6, 15, 12)


def point(period="2019-01", sector="C", kpi="d2c_30d_mean", value=30.0, population=80):
    return (period, sector, kpi, "days", population, value, 1.005, 2.0)


def complete(settings, **odd):
    """One good point for every served series; ``odd`` changes the first days series."""
    out = []
    for s in settings.sectors:
        for k in settings.kpis:
            change = odd if (s, k) == ("ALL", odd.get("kpi", "d2c_30d_mean")) else {}
            given = dict(sector=s, kpi=k, value=5.0) | change
            out.append(point(**given))
    return out


@pytest.fixture
def documents(table, settings):
    def make(*points):
        served = serving.published_points(table(schemas.SERIES, *points), settings)
        return serving.series_documents(served, F.lit(NOW))

    return make


def test_served_months_and_sectors(table, rows, settings):
    periods = ["2016-03", "2016-04", "2019-03", "2019-04"]
    df = table(
        schemas.SERIES,
        *[point(p) for p in periods],
        point(sector="Unknown"), point(sector=""), point(sector="X"),
    )
    got = rows(serving.published_points(df, settings), "entryperiod")
    assert got == [("2016-04",), ("2019-03",)]


def test_documents_hold_their_points_in_order(documents):
    (doc,) = documents(point("2019-02", value=2.345), point("2019-01"), point("2018-12")).collect()
    assert (doc.kpi_identifier, doc.sectorcode, doc.kpi) == ("c-d2c_30d_mean", "c", "d2c_30d_mean")
    assert [p.entryperiod for p in doc.data] == ["2018-12", "2019-01", "2019-02"]
    assert float(doc.data[2].value) == 2.35 and doc.updated == NOW


@pytest.mark.parametrize("length, expected", [(3, 3), (12, 12), (20, 12)])
def test_recent_points(documents, settings, length, expected):
    months = [f"{2017 + n // 12}-{n % 12 + 1:02d}" for n in range(length)]
    docs = documents(*[point(p) for p in months])
    short = serving.lookup_series(docs, "c", "D2C_30D_mean", settings).first()
    assert [p.entryperiod for p in short.body] == months[-expected:]
    full = serving.lookup_series(docs, "C", "d2c_30d_mean", settings, "FULL").first()
    assert [p.entryperiod for p in full.body] == months


def test_lookup_of_something_unknown(documents, settings):
    assert serving.lookup_series(documents(point()), "Z", "x", settings).count() == 0
    with pytest.raises(ValueError):
        serving.lookup_series(documents(point()), "", "x", settings)


@pytest.mark.parametrize(
    "odd, passed",
    [
        ({}, True),
        ({"value": 69.99}, True),
        ({"value": 69.996}, False),
        ({"value": 0.0}, False),
        ({"value": None}, False),
        ({"population": 75}, False),
        ({"population": 76}, True),
        ({"kpi": "total_growth_lastyear", "value": -100.0}, False),
        ({"kpi": "total_growth_lastyear", "value": 99.99}, True),
        ({"kpi": "total_growth_lastyear", "population": 75}, False),
        ({"kpi": "positive_cash_flow_monthly", "value": 100.0, "population": 1}, True),
    ],
)
def test_quality_gate(documents, settings, odd, passed):
    report = serving.quality_report(documents(*complete(settings, **odd)), settings).first()
    assert report.passed is passed and report.series == 28


def test_quality_gate_counts_the_series(documents, settings):
    report = serving.quality_report(documents(*complete(settings)[1:]), settings).first()
    assert (report.series, report.expected_series, report.passed) == (27, 28, False)
    report = serving.quality_report(documents(), settings).first()
    assert (report.series, report.passed) == (0, False)


def test_upsert(table, rows):
    old = table("k string, v int", ("a", 1), ("b", 2))
    new = table("k string, v int", ("b", 3), ("c", 4))
    merged = serving.upsert(old, new, "k")
    assert rows(merged) == [("a", 1), ("b", 3), ("c", 4)]
    assert rows(serving.upsert(merged, new, "k")) == rows(merged)


def test_ratio_documents(table, rows, settings):
    cells = table(
        schemas.CELLS,
        ("2018-12", "Small", "C", "70", 1.0, 90, "roe", "percent"),
        ("2019-01", "Small", "C", "70", 1.005, 76, "roe", "percent"),
        ("2019-01", "ALL", "C", "ALL", 2.0, 75, "roe", "percent"),
    )
    published = serving.publishable_cells(serving.latest_period(cells), settings)
    docs = serving.ratio_documents(published, F.lit(NOW))
    (doc,) = docs.collect()
    assert doc.kpi_identifier == "roe-c-70-small" and float(doc.value) == 1.01
    assert serving.scan_ratios(docs).columns == [
        "Sector", "SubSector", "CompanySize", "KPI", "Population", "Value",
    ]
    assert serving.reconcile(published, docs).first().asDict() == {
        "published": 1, "loaded": 1, "matches": True,
    }
    assert serving.reconcile(cells, docs).first().matches is False


def entry(key, status="OK", day=1, service="series"):
    when = dt.datetime(2019, 1, day)
    return (key, service, status, when, when)


def test_rollback_needs_two_good_snapshots(table, rows):
    none = table(schemas.BOOKMARKS, entry("a", "Corrupted"))
    one = table(schemas.BOOKMARKS, entry("a"), entry("b", "Corrupted", 2))
    for registry in (none, one):
        assert rows(snapshots.rollback_target(registry)) == []
        assert rows(snapshots.mark_rolled_back(registry, NOW)) == rows(registry)


def test_rollback_takes_the_second_newest_per_service(table, rows):
    registry = table(
        schemas.BOOKMARKS,
        entry("a", day=1), entry("b", day=2), entry("c", day=3), entry("d", "Corrupted", 4),
        entry("c", day=9, service="ratios"),
    )
    assert rows(snapshots.rollback_target(registry), "servicename", "s3key") == [("series", "b")]
    marked = snapshots.mark_rolled_back(registry, NOW)
    assert rows(marked, "servicename", "s3key", "status") == [
        ("ratios", "c", "OK"), ("series", "a", "OK"), ("series", "b", "OK"),
        ("series", "c", "Corrupted"), ("series", "d", "Corrupted"),
    ]
    assert rows(marked.filter(F.col("updated") == F.lit(NOW)), "s3key") == [("c",)]
    assert rows(snapshots.rollback_target(marked), "s3key") == [("a",)]


def test_bookmarking_a_snapshot_again_replaces_its_entry(table, rows):
    registry = table(schemas.BOOKMARKS, entry("a", "Corrupted"), entry("a", service="ratios"))
    again = snapshots.append_bookmark(registry, table(schemas.BOOKMARKS, entry("a", day=5)))
    assert rows(again, "servicename", "s3key", "status") == [
        ("ratios", "a", "OK"), ("series", "a", "OK"),
    ]


def test_settings_months():
    from sectorgauge import Settings

    s = Settings(as_of=dt.date(2019, 1, 31))
    assert (s.month(), s.month(-1), s.month(-13), s.element_last) == (
        "2019-01", "2018-12", "2017-12", "2019-12",
    )
    assert dataclasses.replace(s, min_group=1).min_group == 1
