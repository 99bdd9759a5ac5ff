"""Batch jobs: read tables, apply operators, write tables.

Jobs talk through stored tables only, so each can be run, repeated or lost on its
own. Paths are explicit; nothing is read from a default place.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorgauge.config import Settings
from sectorgauge.operators import serving, snapshots
from sectorgauge.operators.divisions import consent_report
from sectorgauge.operators.elements import statement_elements
from sectorgauge.plans.monthly import flagged_kpis, sector_series
from sectorgauge.plans.raw import raw_measures
from sectorgauge.plans.statements import cube_cells, flagged_ratios
from sectorgauge.sources import schemas, tables
from sectorgauge.sources.stages import removed_after

log = logging.getLogger(__name__)

SERIES_SERVICE = "series"
RATIO_SERVICE = "ratios"


@dataclass(frozen=True)
class Paths:
    """Folders of a run: domain tables below ``source``, results below ``target``.

    ``types`` replaces the declared columns of an input table whose files hold
    other types, such as text for account ids.
    """

    source: str
    target: str
    postfix: str = ""
    types: Mapping[str, str] = field(default_factory=dict)

    def domain(self, table: str) -> str:
        return f"{self.source}/{table}"

    def read(self, spark: SparkSession, table: str, sample: float | None = None) -> DataFrame:
        """An input table, or the given share of its files."""
        schema = self.types.get(table, schemas.INPUTS[table])
        if sample is None:
            return tables.read_table(spark, self.domain(table), schema)
        return tables.sample_files(spark, self.domain(table), schema, sample)

    def result(self, table: str) -> str:
        return f"{self.target}/{table}"

    @property
    def measures(self) -> str:
        return f"{self.target}/measures{self.postfix}"


@dataclass(frozen=True)
class Outcome:
    """Result of a publication step."""

    success: bool
    message: str = ""
    rows: int = 0


def _required(df: DataFrame | None, table: str) -> DataFrame:
    if df is None:
        raise FileNotFoundError(f"no snapshot of {table}")
    return df


def run_measures(
    spark: SparkSession, paths: Paths, settings: Settings, sample: float | None = None
) -> int:
    """Bookkeeping and invoices to monthly measures."""
    lookup = paths.read(spark, "division_lookup")
    log.info("divisions that share no data: %s", consent_report(lookup).first()["refused"])
    measures = raw_measures(
        paths.read(spark, "gl_account"),
        paths.read(spark, "gl_transaction", sample),
        paths.read(spark, "invoice_dso").withColumnRenamed(
            "actualtimebetweeninvoiceandpayment", "atbip"
        ),
        lookup,
        settings,
    )
    return tables.write_table(
        tables.check_columns(measures, schemas.MEASURES), paths.measures, "aggregate"
    )


def run_company_kpis(spark: SparkSession, paths: Paths, settings: Settings) -> int:
    """Measures to flagged company KPIs."""
    measures = tables.read_table(spark, paths.measures, schemas.MEASURES)
    flagged = flagged_kpis(measures, paths.read(spark, "division_lookup"), settings)
    return tables.write_snapshot(
        tables.check_columns(flagged, schemas.FLAGGED_KPIS),
        paths.result("division_level"),
        settings.as_of.isoformat(),
        "kpi",
    )


def run_sector_series(spark: SparkSession, paths: Paths, settings: Settings) -> int:
    """Latest flagged KPIs to the published sector series."""
    flagged = _required(
        tables.read_snapshot(spark, paths.result("division_level"), schemas.FLAGGED_KPIS),
        "division_level",
    )
    series = sector_series(flagged, paths.read(spark, "division_lookup"), settings)
    return tables.write_snapshot(
        tables.check_columns(series, schemas.SERIES),
        paths.result("aggregated"),
        settings.as_of.isoformat(),
    )


def run_elements(spark: SparkSession, paths: Paths, settings: Settings) -> int:
    """Measures and fiscal calendars to statement elements."""
    measures = tables.read_table(spark, paths.measures, schemas.MEASURES)
    periods = paths.read(spark, "financial_period")
    elements = statement_elements(measures, periods, settings)
    return tables.write_table(
        tables.check_columns(elements, schemas.ELEMENTS), paths.result("elements")
    )


def run_ratios(spark: SparkSession, paths: Paths, settings: Settings) -> int:
    """Elements to flagged company ratios."""
    elements = tables.read_table(spark, paths.result("elements"), schemas.ELEMENTS)
    flagged = flagged_ratios(elements, paths.read(spark, "division_lookup"), settings)
    return tables.write_snapshot(
        tables.check_columns(flagged, schemas.FLAGGED_RATIOS),
        paths.result("ratios"),
        settings.as_of.isoformat(),
        "kpi",
    )


def run_cells(spark: SparkSession, paths: Paths, settings: Settings) -> int:
    """Latest flagged ratios to cube cells."""
    flagged = _required(
        tables.read_snapshot(spark, paths.result("ratios"), schemas.FLAGGED_RATIOS),
        "ratios",
    )
    cells = cube_cells(flagged, paths.read(spark, "division_lookup"), settings).distinct()
    return tables.write_snapshot(
        tables.check_columns(cells, schemas.CELLS),
        paths.result("cells"),
        settings.as_of.isoformat(),
        "entryperiod",
    )


def run_all(spark: SparkSession, paths: Paths, settings: Settings) -> None:
    """All stages of both lines, in their order; each job's stages go when it ends."""
    for job in (
        run_measures,
        run_company_kpis,
        run_sector_series,
        run_elements,
        run_ratios,
        run_cells,
    ):
        with removed_after(spark):
            log.info("%s: %d rows", job.__name__, job(spark, paths, settings))


# ------------------------------------------------------------------ publication
def _store_documents(
    documents: DataFrame, root: str, replace: bool, schema: str
) -> DataFrame:
    """Write a new version of a serving table and return it as stored."""
    spark = documents.sparkSession

    def build(current: DataFrame | None) -> DataFrame:
        if replace or current is None:
            return documents
        return serving.upsert(current, documents, "kpi_identifier")

    version = tables.commit_version(spark, root, schema, build)
    return tables.read_version(spark, root, schema, version)


def _bookmark(
    spark: SparkSession, paths: Paths, service: str, snapshot: str, now: dt.datetime
) -> None:
    entry = spark.createDataFrame(
        [(snapshot, service, snapshots.OK, now, now)], schemas.BOOKMARKS
    )

    def build(current: DataFrame | None) -> DataFrame:
        return snapshots.append_bookmark(tables.or_no_bookmarks(spark, current), entry)

    tables.commit_version(spark, paths.result("bookmarks"), schemas.BOOKMARKS, build)


def _load_series(
    spark: SparkSession, paths: Paths, settings: Settings, snapshot: str, now: dt.datetime
) -> Outcome:
    """Check one snapshot of the series and serve it."""
    series = tables.read_snapshot(
        spark, paths.result("aggregated"), schemas.SERIES, snapshot
    )
    if series is None:
        return Outcome(False, f"snapshot {snapshot} has no files")
    documents = serving.series_documents(
        serving.published_points(series, settings), F.lit(now)
    )
    report = serving.quality_report(documents, settings).first()
    if not report["passed"]:
        return Outcome(False, f"snapshot {snapshot} misses the quality limits: {report.asDict()}")
    root = paths.result("serve_series")
    _store_documents(documents, root, False, schemas.SERIES_DOCUMENTS)
    return Outcome(True, rows=report["series"])


def _load_ratios(
    spark: SparkSession, paths: Paths, settings: Settings, snapshot: str, now: dt.datetime
) -> Outcome:
    """Serve the latest month of one snapshot of the cells."""
    cells = tables.read_snapshot(spark, paths.result("cells"), schemas.CELLS, snapshot)
    if cells is None:
        return Outcome(False, f"snapshot {snapshot} has no files")
    published = serving.publishable_cells(serving.latest_period(cells), settings)
    documents = serving.ratio_documents(published, F.lit(now))
    root = paths.result("serve_ratios")
    stored = _store_documents(documents, root, True, schemas.RATIO_DOCUMENTS)
    counts = serving.reconcile(published, stored).first()
    if not counts["matches"]:
        return Outcome(False, f"published {counts['published']}, loaded {counts['loaded']}")
    return Outcome(True, rows=counts["loaded"])


_LOADERS = {SERIES_SERVICE: _load_series, RATIO_SERVICE: _load_ratios}


def publish(
    spark: SparkSession,
    paths: Paths,
    settings: Settings,
    service: str,
    now: dt.datetime | None = None,
) -> Outcome:
    """Serve today's snapshot of a service; bookmark it once it is stored."""
    now = now or dt.datetime.now()
    snapshot = settings.as_of.isoformat()
    outcome = _LOADERS[service](spark, paths, settings, snapshot, now)
    if outcome.success:
        _bookmark(spark, paths, service, snapshot, now)
    return outcome


def publish_both(
    spark: SparkSession, paths: Paths, settings: Settings, now: dt.datetime | None = None
) -> Outcome:
    """Publish both services; the whole succeeds only if both do."""
    results = {s: publish(spark, paths, settings, s, now) for s in _LOADERS}
    failed = [f"{s}: {r.message}" for s, r in results.items() if not r.success]
    return Outcome(not failed, "; ".join(failed), sum(r.rows for r in results.values()))


def roll_back(
    spark: SparkSession,
    paths: Paths,
    settings: Settings,
    service: str,
    now: dt.datetime | None = None,
) -> Outcome:
    """Serve the second newest good snapshot again and mark the newest as corrupted."""
    now = now or dt.datetime.now()
    root = paths.result("bookmarks")
    bookmarks = tables.read_bookmarks(spark, root)
    own = F.col("servicename") == service
    good = bookmarks.filter(own & (F.col("status") == snapshots.OK)).limit(2).count()
    if good == 0:
        return Outcome(False, "nothing was published that could be taken back")
    if good == 1:
        return Outcome(False, "there is no earlier publication to go back to")
    target = snapshots.rollback_target(bookmarks.filter(own)).first()["s3key"]
    outcome = _LOADERS[service](spark, paths, settings, target, now)
    if outcome.success:
        seen = bookmarks.filter(own).select("servicename", "s3key", "updated")

        def build(current: DataFrame | None) -> DataFrame:
            """What was published since the target was chosen stays as it is."""
            known = current.join(seen, seen.columns, "left_semi")
            others = current.join(seen, seen.columns, "left_anti")
            return snapshots.mark_rolled_back(known, now).unionByName(others)

        tables.commit_version(spark, root, schemas.BOOKMARKS, build)
    return outcome


# ---------------------------------------------------------------------- lookups
def lookup_series(
    spark: SparkSession,
    paths: Paths,
    settings: Settings,
    sectorcode: str,
    kpi: str,
    history: str = "",
) -> DataFrame:
    """Served document of one series; empty when the series is not served."""
    documents = _required(
        tables.read_version(spark, paths.result("serve_series"), schemas.SERIES_DOCUMENTS),
        "serve_series",
    )
    return serving.lookup_series(documents, sectorcode, kpi, settings, history)


def scan_ratios(spark: SparkSession, paths: Paths) -> DataFrame:
    """All served ratios."""
    documents = _required(
        tables.read_version(spark, paths.result("serve_ratios"), schemas.RATIO_DOCUMENTS),
        "serve_ratios",
    )
    return serving.scan_ratios(documents)
