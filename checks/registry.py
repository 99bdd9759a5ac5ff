"""One Spark query per operator, over the domain tables of a test folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.chain import PUBLISHED_AT, Chain
from checks.domain import check_settings
from sectorgauge.functions.columns import amount
from sectorgauge.operators import (
    company_kpis,
    divisions,
    elements,
    ledger,
    moving_season,
    outliers,
    payments,
    power,
    ratio_cube,
    ratios,
    seasonal,
    sector_kpis,
    serving,
    trading_days,
    snapshots,
)
from sectorgauge.operators.company_kpis import D2C_KPIS
from sectorgauge.sources import tables
from sectorgauge.sources.stages import new_folder, stage

Query = Callable[[Chain], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[key] = function
        return function

    return register


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Doubles rounded for comparison; the columns stay in place.

    Nullable whole numbers are given as doubles, so that tools which cannot hold a
    missing integer read the same type from both engines.
    """
    return df.select(
        *[
            F.round(F.col(c).cast("double"), places[c]).alias(c) if c in places else F.col(c)
            for c in df.columns
        ]
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# -------------------------------------------------------------- scans, dimension
@query("scan_project")
def scan_project(c: Chain) -> DataFrame:
    return c.gl_account.select("id", "division", "rgscode", "exactrgscode")


@query("scan_partition_filter")
def scan_partition_filter(c: Chain) -> DataFrame:
    return divisions.domestic_divisions(c.division_lookup).select(
        "division", "country", "sectorcode", "subsectorcode", "sizedescription"
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


@query("latest_snapshot")
def latest_snapshot(c: Chain) -> DataFrame:
    """Every day written as a snapshot in one job; the newest is found and read."""
    day = F.col("o_orderdate").cast("date").cast("string")
    orders = c.table("orders").select(day.alias(tables.SNAPSHOT), "o_orderkey", "o_totalprice")
    root = new_folder(c.spark, "snapshots")
    tables.write_snapshots(orders, root)
    newest = tables.read_snapshot(c.spark, root, _ddl(orders.drop(tables.SNAPSHOT)))
    return newest.withColumn(tables.SNAPSHOT, F.lit(tables.latest_date(c.spark, root)))


@query("scan_file_sample")
def scan_file_sample(c: Chain) -> DataFrame:
    """A quarter of the files of a table in folders by month, a file each."""
    month = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM").alias("month")
    orders = c.table("orders").select("o_orderkey", "o_totalprice", month)
    path = new_folder(c.spark, "months")
    orders.repartition("month").write.partitionBy("month").parquet(path)
    return tables.sample_files(c.spark, path, _ddl(orders), 0.25)


@query("scan_mixed_types")
def scan_mixed_types(c: Chain) -> DataFrame:
    """One column as int, long and decimal in different files, read as one decimal."""
    lines = c.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("amount"))
    root = new_folder(c.spark, "mixed")
    number = F.col("l_linenumber")
    for kind, own in (("int", number == 1), ("bigint", number == 2), ("decimal(12,2)", number > 2)):
        lines.where(own).withColumn("amount", F.col("amount").cast(kind)).write.mode("append").parquet(root)
    read = tables.read_table(c.spark, root, "l_orderkey bigint, l_linenumber int, amount decimal(22,2)")
    return read.withColumn("amount", F.col("amount").cast("double"))


@query("table_round_trip")
def table_round_trip(c: Chain) -> DataFrame:
    """Overwritten, with other case and order in the files, and a column they lack."""
    path = new_folder(c.spark, "round-trip")
    accounts = c.gl_account
    tables.write_table(accounts, path)
    tables.write_table(accounts.select(F.col("rgscode").alias("RGSCode"), "division", "id"), path, "division")
    return tables.read_table(c.spark, path, "id bigint, division string, rgscode string, added string")


@query("snapshot_round_trip")
def snapshot_round_trip(c: Chain) -> DataFrame:
    """A dated snapshot in folders by value; a filter on them prunes folders."""
    root = new_folder(c.spark, "round-trip")
    days = c.invoice_dso.select("uniqueinvoicenumber", "atbip", "paymentmethod")
    for times in (1, 2):
        days = days.withColumn("atbip", F.col("atbip") * times)
        tables.write_snapshot(days, root, "2001-11-01", "paymentmethod")
    stored = tables.read_snapshot(c.spark, root, _ddl(days))
    return stored.filter(F.col("paymentmethod") == "B")


@query("eligible_divisions")
def eligible_divisions(c: Chain) -> DataFrame:
    return divisions.eligible_divisions(c.division_lookup)


@query("consent_report")
def consent_report(c: Chain) -> DataFrame:
    return divisions.consent_report(c.division_lookup)


@query("sector_override")
def sector_override(c: Chain) -> DataFrame:
    return c.sectors


# ------------------------------------------------------------------------ ledger
@query("account_code_choice")
def account_code_choice(c: Chain) -> DataFrame:
    return ledger.choose_account_codes(c.gl_account, c.settings)


@query("ledger_dedup")
def ledger_dedup(c: Chain) -> DataFrame:
    return ledger.current_transactions(c.gl_transaction).select(
        "id", "type", "entrydate", "glaccount", F.col("amountdc").cast("double").alias("amountdc")
    )


@query("ledger_period")
def ledger_period(c: Chain) -> DataFrame:
    narrow = check_settings(
        entry_from="1996-01-01",
        entry_before="2001-06-01",
        oldest_month="1997-01",
        older_label="1996-12",
    )
    current = ledger.current_transactions(c.gl_transaction)
    return ledger.with_entry_period(current, narrow).select(
        "id", "entrydate", "entryperiod", "hastype310"
    )


@query("ledger_join")
def ledger_join(c: Chain) -> DataFrame:
    current = ledger.with_entry_period(
        ledger.current_transactions(c.gl_transaction), c.settings
    )
    codes = ledger.choose_account_codes(c.gl_account, c.settings)
    return (
        ledger.with_ledger_code(ledger.account_months(current), codes)
        .groupBy("division", "entryperiod", "rgscode", "hastype310")
        .agg(
            amount(F.sum("units")).alias("amount"),
            F.sum("transactions").alias("transactions"),
        )
    )


def _all_ledger(c: Chain) -> DataFrame:
    codes = ledger.choose_account_codes(c.gl_account, c.settings)
    return ledger.ledger_measures(c.gl_transaction, codes, c.settings)


@query("ledger_rollup")
def ledger_rollup(c: Chain) -> DataFrame:
    return rounded(_all_ledger(c), value=4)


@query("bad_divisions")
def bad_divisions(c: Chain) -> DataFrame:
    return ledger.bad_divisions(_all_ledger(c), c.settings)


@query("bad_division_filter")
def bad_division_filter(c: Chain) -> DataFrame:
    measures = stage(_all_ledger(c), "all-ledger")
    bad = ledger.bad_divisions(measures, c.settings)
    return rounded(ledger.drop_bad_divisions(measures, bad), value=4)


# ---------------------------------------------------------------------- invoices
@query("dso_match_class")
def dso_match_class(c: Chain) -> DataFrame:
    return payments.match_classes(c.invoice_dso, c.settings)


@query("dso_by_term")
def dso_by_term(c: Chain) -> DataFrame:
    return payments.days_to_cash(c.invoice_dso, c.settings)


@query("raw_measures")
def raw_measures(c: Chain) -> DataFrame:
    return rounded(c.measures, value=4)


# ------------------------------------------------------------------ company KPIs
def _kpi(*names: str) -> Query:
    def run(c: Chain) -> DataFrame:
        rows = c.kpis.filter(F.col("aggregate").isin(*names))
        return rounded(rows, value=4)

    return run


QUERIES["kpi_revenue"] = _kpi("Revenue")
QUERIES["kpi_cost"] = _kpi("Cost")
QUERIES["kpi_profitability"] = _kpi("Profitability")
QUERIES["kpi_cash_flow_position"] = _kpi("CashFlowPosition")
QUERIES["kpi_cash_flow_monthly"] = _kpi("CashFlowMonthly")
QUERIES["kpi_d2c"] = _kpi(*D2C_KPIS)
QUERIES["kpi_union"] = _kpi(*company_kpis.KPI_COLUMNS)


@query("kpi_repeated_measures")
def kpi_repeated_measures(c: Chain) -> DataFrame:
    """Every measure twice: the KPIs must not move."""
    doubled = c.measures.union(c.measures)
    return rounded(company_kpis.company_kpis(doubled, c.settings), value=4)


@query("kpi_window")
def kpi_window(c: Chain) -> DataFrame:
    narrow = check_settings(kpi_start="1997-01", as_of=dt.date(2000, 5, 20))
    return rounded(company_kpis.company_kpis(c.measures, narrow), value=4)


def _profiled(c: Chain) -> DataFrame:
    return outliers.with_peer_profile(c.kpis, divisions.peer_profile(c.division_lookup))


@query("kpi_enriched")
def kpi_enriched(c: Chain) -> DataFrame:
    return rounded(_profiled(c), value=4, group_id=0)


_SECTOR_KEYS = ["entryperiod", "aggregate", "sectorcode"]


def _d2c(c: Chain) -> DataFrame:
    """Keys of groups are never NULL: companies without a sector are one group."""
    days = _profiled(c).filter(F.col("aggregate").isin(*D2C_KPIS))
    return stage(days.fillna("-", ["sectorcode"]), "days")


def _magnitude(column: str) -> Column:
    """Powers of days can be of any size, so they are compared by their logarithm."""
    x = F.col(column)
    return F.signum(x) * F.round(F.log(1 + F.abs(x)), 4)


@query("yeo_johnson_lambda")
def yeo_johnson_lambda(c: Chain) -> DataFrame:
    found = power.yeo_johnson_lambda(_d2c(c), _SECTOR_KEYS, "value", c.settings)
    return rounded(found, **{"lambda": 3})


@query("yeo_johnson_transform")
def yeo_johnson_transform(c: Chain) -> DataFrame:
    moved = power.yeo_johnson_transform(_d2c(c), _SECTOR_KEYS, "value", c.settings)
    given = moved.select("division", "entryperiod", "aggregate", "value", "value_t", "length")
    return rounded(given, value=4).withColumn("value_t", _magnitude("value_t"))


@query("mkt_outlier")
def mkt_outlier(c: Chain) -> DataFrame:
    is_d2c = F.col("aggregate").startswith("D2C")
    fences = {
        x: F.when(is_d2c, _magnitude(x)).otherwise(F.round(x, 3)) for x in ("q1", "q3", "iqr")
    }
    flagged = c.flagged_kpis.drop("kpi").withColumns(fences)
    return rounded(flagged, value=4, percentile=6, group_id=0)


# ------------------------------------------------------------------- sector KPIs
def _averages(c: Chain, pattern: str) -> DataFrame:
    rows = sector_kpis.average_kpis(c.flagged_kpis, c.settings)
    points = sector_kpis.sector_average(rows.filter(F.col("kpi").like(pattern)), c.sectors)
    return rounded(points, value=4)


@query("sector_kpi_mean")
def sector_kpi_mean(c: Chain) -> DataFrame:
    return _averages(c, "d2c_30d_mean")


@query("sector_kpi_finite")
def sector_kpi_finite(c: Chain) -> DataFrame:
    """Every row once more, without a number: the means must not move."""
    flagged = c.flagged_kpis
    odd = F.array(*[F.lit(float(x)) for x in ("nan", "inf", "-inf")], F.lit(None).cast("double"))
    without = flagged.withColumn("value", F.get(odd, (F.abs(F.hash("division")) % 4).cast("int")))
    rows = sector_kpis.average_kpis(flagged.union(without), c.settings)
    points = rows.filter(F.col("kpi") == "d2c_30d_mean")
    return rounded(sector_kpis.sector_average(points, c.sectors), value=4)


@query("sector_positive_cash")
def sector_positive_cash(c: Chain) -> DataFrame:
    return _averages(c, "positive_cash_flow%")


@query("sector_kpi_median")
def sector_kpi_median(c: Chain) -> DataFrame:
    rows = c.flagged_kpis.filter(F.col("aggregate").isin(*D2C_KPIS)).select(
        "division",
        "entryperiod",
        F.col("aggregate").alias("kpi"),
        F.lit("days").alias("unit"),
        "value",
    )
    return rounded(sector_kpis.sector_average(rows, c.sectors, "median"), value=4)


@query("sector_kpi_exact_median")
def sector_kpi_exact_median(c: Chain) -> DataFrame:
    rows = c.flagged_kpis.filter(F.col("aggregate").isin(*D2C_KPIS)).select(
        "division",
        "entryperiod",
        F.col("aggregate").alias("kpi"),
        F.lit("days").alias("unit"),
        "value",
    )
    return rounded(sector_kpis.sector_average(rows, c.sectors, "exact_median"), value=4)


@query("revenue_yoy")
def revenue_yoy(c: Chain) -> DataFrame:
    pairs = sector_kpis.revenue_year_on_year(c.flagged_kpis)
    return rounded(pairs, revenue=2, lastyear_revenue=2)


@query("sector_total_growth")
def sector_total_growth(c: Chain) -> DataFrame:
    pairs = sector_kpis.revenue_year_on_year(c.flagged_kpis)
    return rounded(sector_kpis.total_growth(pairs, c.sectors), value=4)


@query("sector_points")
def sector_points(c: Chain) -> DataFrame:
    return sector_kpis.sector_kpis(c.flagged_kpis, c.sectors, c.settings)


@query("kpi_densify")
def kpi_densify(c: Chain) -> DataFrame:
    return rounded(c.dense_points, value=4, population=0)


# ---------------------------------------------------------------------- seasonal
def _filled(c: Chain) -> DataFrame:
    points = seasonal.published_series(c.dense_points, c.settings)
    return seasonal.interpolate(seasonal.calendar_series(points))


@query("series_interpolate")
def series_interpolate(c: Chain) -> DataFrame:
    return rounded(
        _filled(c).select("sectorcode", "kpi", "entryperiod", "value", "filled"),
        value=4,
        filled=6,
    )


@query("series_tail")
def series_tail(c: Chain) -> DataFrame:
    tail = seasonal.last_months(_filled(c), c.settings.series_history)
    return rounded(tail.select("sectorcode", "kpi", "entryperiod", "filled"), filled=6)


@query("seasonal_adjust")
def seasonal_adjust(c: Chain) -> DataFrame:
    return rounded(
        c.series.drop("trendvalue"), value=4, population=0, deseasonalizedvalue=4
    )


@query("seasonal_trend")
def seasonal_trend(c: Chain) -> DataFrame:
    columns = ["entryperiod", "sectorcode", "kpi", "trendvalue"]
    return rounded(c.series.select(*columns), trendvalue=4)


@query("trading_day_effects")
def trading_day_effects(c: Chain) -> DataFrame:
    history = seasonal.last_months(_filled(c), c.settings.series_history)
    found = trading_days.remove_trading_days(history)
    columns = ["entryperiod", "sectorcode", "kpi", "tradingday", "filled"]
    return rounded(found.select(*columns), tradingday=4, filled=4)


@query("seasonal_moving")
def seasonal_moving(c: Chain) -> DataFrame:
    history = seasonal.last_months(_filled(c), c.settings.series_history)
    adjusted = moving_season.deseasonalize_moving(history, c.settings)
    columns = ["entryperiod", "sectorcode", "kpi", "deseasonalizedvalue", "trendvalue"]
    return rounded(adjusted.select(*columns), deseasonalizedvalue=6, trendvalue=6)


# -------------------------------------------------------------------- statements
@query("legacy_period")
def legacy_period(c: Chain) -> DataFrame:
    early = F.when(F.col("entryperiod") < "1997-01", "2005-2016").otherwise(F.col("entryperiod"))
    repaired = elements.element_measures(c.measures.withColumn("entryperiod", early))
    return repaired.groupBy("entryperiod").agg(F.count(F.lit(1)).alias("measures"))


@query("fiscal_year_bounds")
def fiscal_year_bounds(c: Chain) -> DataFrame:
    capped = check_settings(fin_year_max=1999)
    bounds = elements.fiscal_year_bounds(c.financial_period, capped)
    return as_text(bounds, "startdate", "enddate")


@query("fiscal_spine")
def fiscal_spine(c: Chain) -> DataFrame:
    bounds = elements.fiscal_year_bounds(c.financial_period, c.settings)
    return elements.fiscal_spine(bounds, c.settings)


@query("eol_elements")
def eol_elements(c: Chain) -> DataFrame:
    return rounded(c.elements, cumvalue=2)


def _ratio(name: str) -> Query:
    def run(c: Chain) -> DataFrame:
        columns = ["division", "entryperiod", "kpi", "numerator", "denominator", "value"]
        rows = c.ratios.filter(F.col("kpi") == name).select(*columns)
        return rounded(rows, numerator=2, denominator=2, value=4)

    return run


for _name in ratios.RATIOS:
    QUERIES[f"eol_ratio_{_name}"] = _ratio(_name)


@query("eol_negative_flag")
def eol_negative_flag(c: Chain) -> DataFrame:
    return ratios.negative_stock_cash(c.elements, c.settings).drop("negative_stock_cash")


@query("eol_outlier")
def eol_outlier(c: Chain) -> DataFrame:
    return rounded(
        c.flagged_ratios.drop("aggregate"),
        numerator=2,
        denominator=2,
        value=4,
        percentile=6,
        group_id=0,
        size_of_group_per_period=0,
        q1=4,
        q3=4,
        iqr=4,
    )


@query("eol_cube_median")
def eol_cube_median(c: Chain) -> DataFrame:
    return rounded(c.cells, value=4)


@query("eol_cube_exact_median")
def eol_cube_exact_median(c: Chain) -> DataFrame:
    members = ratio_cube.ratio_members(
        c.flagged_ratios, divisions.cube_profile(c.division_lookup)
    )
    cells = ratio_cube.ratio_cube(members, "exact_median")
    return rounded(ratio_cube.until_publishable(cells, c.settings), value=4)


@query("eol_cube_mean")
def eol_cube_mean(c: Chain) -> DataFrame:
    members = ratio_cube.ratio_members(
        c.flagged_ratios, divisions.cube_profile(c.division_lookup)
    )
    cells = ratio_cube.until_publishable(ratio_cube.ratio_cube(members, "mean"), c.settings)
    return rounded(cells, value=4)


@query("eol_latest_period")
def eol_latest_period(c: Chain) -> DataFrame:
    return rounded(serving.latest_period(c.cells), value=4)


@query("eol_publishable")
def eol_publishable(c: Chain) -> DataFrame:
    return rounded(serving.publishable_cells(c.cells, c.settings), value=4)


# ----------------------------------------------------------------------- serving
@query("serve_marketing_select")
def serve_marketing_select(c: Chain) -> DataFrame:
    return rounded(
        serving.published_points(c.series, c.settings),
        value=4,
        population=0,
        deseasonalizedvalue=4,
        trendvalue=4,
    )


def _unfold(documents: DataFrame, column: str) -> DataFrame:
    """One row per point of a document, numbered from 1."""
    rows = documents.select(
        "kpi_identifier", "sectorcode", "kpi", F.posexplode(column).alias("pos", "p")
    )
    return rows.select(
        "kpi_identifier",
        "sectorcode",
        "kpi",
        (F.col("pos") + 1).cast("bigint").alias("position"),
        "p.entryperiod",
        F.col("p.value").cast("double").alias("value"),
        F.col("p.population").cast("double").alias("population"),
        "p.unit",
        F.col("p.deseasonalizedvalue").cast("double").alias("deseasonalizedvalue"),
        F.col("p.trendvalue").cast("double").alias("trendvalue"),
    )


@query("serve_series_docs")
def serve_series_docs(c: Chain) -> DataFrame:
    return _unfold(c.documents, "data")


@query("serve_lookup_full")
def serve_lookup_full(c: Chain) -> DataFrame:
    found = serving.lookup_series(c.documents, "G", "d2c_30d_mean", c.settings, "full")
    return _unfold(found, "body")


@query("serve_lookup_recent")
def serve_lookup_recent(c: Chain) -> DataFrame:
    found = serving.lookup_series(c.documents, "ALL", "Total_Growth_LastYear", c.settings)
    return _unfold(found, "body")


@query("serve_upsert")
def serve_upsert(c: Chain) -> DataFrame:
    current = c.documents.withColumn("source", F.lit("old"))
    incoming = c.documents.filter(F.col("kpi") == "d2c_30d_mean").withColumn(
        "source", F.lit("new")
    )
    merged = serving.upsert(current, incoming, "kpi_identifier")
    return merged.select(
        "kpi_identifier", "source", F.size("data").cast("bigint").alias("points")
    )


@query("quality_gate")
def quality_gate(c: Chain) -> DataFrame:
    return serving.quality_report(c.documents, c.settings)


@query("serve_eol_documents")
def serve_eol_documents(c: Chain) -> DataFrame:
    return c.ratio_documents.drop("updated").withColumn(
        "value", F.col("value").cast("double")
    )


@query("serve_eol_scan")
def serve_eol_scan(c: Chain) -> DataFrame:
    scanned = serving.scan_ratios(c.ratio_documents)
    return scanned.withColumn("Value", F.col("Value").cast("double"))


@query("publish_reconcile")
def publish_reconcile(c: Chain) -> DataFrame:
    published = serving.publishable_cells(serving.latest_period(c.cells), c.settings)
    return serving.reconcile(published, c.ratio_documents)


# --------------------------------------------------------------------- snapshots
def _bookmark_text(df: DataFrame) -> DataFrame:
    return df.select(
        "s3key",
        "servicename",
        "status",
        F.date_format("updated", "yyyy-MM-dd HH:mm:ss").alias("updated"),
    )


@query("bookmark_append")
def bookmark_append(c: Chain) -> DataFrame:
    bookmarks = c.bookmarks
    kind = bookmarks.schema["updated"].dataType
    incoming = bookmarks.select("servicename").distinct().select(
        F.lit("snapshot-2001-11-01").alias("s3key"),
        "servicename",
        F.lit("OK").alias("status"),
        F.lit(PUBLISHED_AT).cast(kind).alias("created"),
        F.lit(PUBLISHED_AT).cast(kind).alias("updated"),
    )
    return _bookmark_text(snapshots.append_bookmark(bookmarks, incoming))


@query("rollback_target")
def rollback_target(c: Chain) -> DataFrame:
    target = snapshots.rollback_target(c.bookmarks)
    return target.withColumn("updated", F.date_format("updated", "yyyy-MM-dd HH:mm:ss"))


@query("rollback_status")
def rollback_status(c: Chain) -> DataFrame:
    return _bookmark_text(snapshots.mark_rolled_back(c.bookmarks, PUBLISHED_AT))


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query over a fresh chain of stages."""
    return QUERIES[key](Chain(spark, sf_dir))


__all__ = ["QUERIES", "run"]
