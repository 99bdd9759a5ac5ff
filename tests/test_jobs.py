"""Whole runs over stored tables with the case and names of real input files."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.domain import Domain, check_settings
from sectorgauge.__main__ import parser
from sectorgauge.operators import snapshots
from sectorgauge.plans import jobs
from sectorgauge.sources import schemas, stages, tables

SF_DIR = "/root/testdata/sf0.001"
NOW = dt.datetime(2001, 11, 1, 8)


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    paths = jobs.Paths(f"{folder}/in", f"{folder}/out")
    d = Domain(spark, SF_DIR)
    accounts = d.gl_account.toDF("ID", "Division", "RGSCode", "ExactRGSCode")
    accounts.write.parquet(paths.domain("gl_account"))
    log = d.gl_transaction.withColumn("sysmodified", F.col("sysmodified").cast("timestamp"))
    log = log.withColumnsRenamed({"id": "ID", "amountdc": "AmountDC", "entrydate": "EntryDate"})
    log.withColumn("x_sysingested", F.col("x_sysingested").cast("int").cast("timestamp")) \
        .withColumn("input_partition_NLC", F.lit(1)) \
        .withColumn("syscreated_year", F.substring("EntryDate", 1, 4)) \
        .write.partitionBy("input_partition_NLC", "syscreated_year") \
        .parquet(paths.domain("gl_transaction"))
    d.invoice_dso.withColumnRenamed("atbip", "ActualTimeBetweenInvoiceandPayment") \
        .withColumn("PaymentPaymentMethod", F.lit("B")) \
        .write.parquet(paths.domain("invoice_dso"))
    d.division_lookup.withColumn("product", F.lit("p")) \
        .write.partitionBy("eurocurrency").parquet(paths.domain("division_lookup"))
    d.financial_period.write.partitionBy("finyear").parquet(paths.domain("financial_period"))
    return paths


@pytest.fixture(scope="module")
def small():
    """Limits that the handful of test companies can meet."""
    return check_settings(
        min_group=1, min_population=0, sectors=("ALL",), kpis=("positive_cash_flow_monthly",)
    )


@pytest.fixture(scope="module")
def done(spark, paths, small):
    jobs.run_all(spark, paths, small)
    return paths


def test_stages_are_stored_with_their_schema(spark, done, small):
    assert spark.read.parquet(done.measures).count() > 4000
    for table, schema in [
        ("division_level", schemas.FLAGGED_KPIS),
        ("aggregated", schemas.SERIES),
        ("ratios", schemas.FLAGGED_RATIOS),
        ("cells", schemas.CELLS),
    ]:
        stored = tables.read_snapshot(spark, done.result(table), schema)
        assert stored.count() > 0, table
    assert jobs.run_cells(spark, done, small) == tables.read_snapshot(
        spark, done.result("cells"), schemas.CELLS
    ).count()
    assert tables.latest_date(spark, done.result("cells")) == "2001-11-01"


def test_stored_stages_equal_the_checked_queries(spark, done, small, rows):
    from checks.chain import Chain

    chain = Chain(spark, SF_DIR, min_group=1)
    stored = tables.read_snapshot(spark, done.result("cells"), schemas.CELLS)
    assert rows(stored) == rows(chain.cells.select(*stored.columns))
    elements = tables.read_table(spark, done.result("elements"), schemas.ELEMENTS)
    assert rows(elements) == rows(chain.elements)


def test_partition_filters_prune_folders(spark, done):
    lookup = tables.read_table(spark, done.domain("division_lookup"), schemas.DIVISION_LOOKUP)
    plan = lookup.filter("eurocurrency = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eurocurrency" in plan


def test_growth_reads_the_revenue_folder_only(spark, done):
    from sectorgauge.operators.sector_kpis import average_kpis, revenue_year_on_year

    flagged = tables.read_snapshot(spark, done.result("division_level"), schemas.FLAGGED_KPIS)
    plan = revenue_year_on_year(flagged)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kpi" in plan and "Revenue" in plan
    plan = average_kpis(flagged, check_settings())._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [kpi" in plan.toString()


def test_publish_lookup_and_roll_back(spark, done, small, rows):
    first = jobs.publish_both(spark, done, small, NOW)
    assert first.success, first.message
    found = jobs.lookup_series(spark, done, small, "all", "positive_cash_flow_monthly").first()
    assert len(found.body) == 12
    served = rows(jobs.scan_ratios(spark, done))
    assert len(served) > 0

    # publishing the same snapshot again changes nothing but the time stamps
    again = jobs.publish_both(spark, done, small, NOW)
    assert again.rows == first.rows and rows(jobs.scan_ratios(spark, done)) == served
    registry = tables.read_bookmarks(spark, done.result("bookmarks"))
    assert registry.count() == 2

    refused = jobs.roll_back(spark, done, small, jobs.RATIO_SERVICE, NOW)
    assert not refused.success and "no earlier publication" in refused.message

    # a later month with other cells, served and then withdrawn
    later = dataclasses.replace(small, as_of=dt.date(2001, 12, 1), min_population=1)
    jobs.run_cells(spark, done, dataclasses.replace(later, publish_lag_months=6))
    month = NOW + dt.timedelta(days=30)
    assert jobs.publish(spark, done, later, jobs.RATIO_SERVICE, month).success
    assert rows(jobs.scan_ratios(spark, done)) != served
    back = jobs.roll_back(
        spark, done, small, jobs.RATIO_SERVICE, month + dt.timedelta(hours=1)
    )
    assert back.success
    assert rows(jobs.scan_ratios(spark, done)) == served
    registry = tables.read_bookmarks(spark, done.result("bookmarks"))
    assert rows(registry, "s3key", "servicename", "status") == [
        ("2001-11-01", "ratios", "OK"),
        ("2001-11-01", "series", "OK"),
        ("2001-12-01", "ratios", snapshots.CORRUPTED),
    ]


def test_publication_is_refused_without_good_data(spark, done, small):
    absent = dataclasses.replace(small, as_of=dt.date(1990, 1, 1))
    assert jobs.publish(spark, done, absent, jobs.SERIES_SERVICE, NOW).message.endswith("has no files")
    strict = dataclasses.replace(small, sectors=("ALL", "Z"))
    outcome = jobs.publish_both(spark, done, strict, NOW)
    assert not outcome.success and outcome.message.startswith("series: snapshot 2001-11-01")
    nothing = jobs.Paths(done.source, done.target + "/empty")
    refused = jobs.roll_back(spark, nothing, small, jobs.SERIES_SERVICE, NOW)
    assert refused.message.startswith("nothing was published")
    with pytest.raises(FileNotFoundError):
        jobs.run_cells(spark, nothing, small)


def test_sample_run(spark, done, small):
    trial = dataclasses.replace(done, postfix="_trial")
    jobs.run_measures(spark, trial, small, sample=0.2)
    assert 0 < spark.read.parquet(trial.measures).count() < spark.read.parquet(done.measures).count()


def test_input_files_with_other_types(spark, done, small, tmp_path, rows):
    """Text for account and match ids, doubles for amounts."""
    other = dataclasses.replace(
        done,
        source=str(tmp_path),
        postfix="_other",
        types={
            "gl_account": schemas.GL_ACCOUNT.replace("id bigint", "id string"),
            "gl_transaction": schemas.GL_TRANSACTION.replace(
                "decimal(18,2)", "double"
            ).replace("glaccount bigint", "glaccount string"),
            "invoice_dso": schemas.INVOICE_DSO.replace("matchid bigint", "matchid string"),
        },
    )
    text = {"gl_account": "id", "gl_transaction": "glaccount", "invoice_dso": "matchid"}
    for table, column in text.items():
        df = done.read(spark, table).withColumn(column, F.concat(F.lit("x"), column))
        if table == "gl_transaction":
            df = df.withColumn("amountdc", F.col("amountdc").cast("double"))
        df.write.parquet(other.domain(table))
    done.read(spark, "division_lookup").write.parquet(other.domain("division_lookup"))
    jobs.run_measures(spark, other, small)
    got, want = spark.read.parquet(other.measures), spark.read.parquet(done.measures)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_files_without_a_column_give_null(spark, tmp_path, rows):
    spark.sql("select 1 as ID, 'd' as DIVISION").write.parquet(f"{tmp_path}/t/p=1")
    spark.sql("select 2 as id, 'e' as division, 'WOmzNop' as RGSCode").write.parquet(
        f"{tmp_path}/t/p=2"
    )
    schema = "id int, division string, rgscode string"
    got = rows(tables.read_table(spark, f"{tmp_path}/t", schema))
    assert got == [(1, "d", None), (2, "e", "WOmzNop")]
    with pytest.raises(ValueError, match="rgscode"):
        tables.check_columns(spark.sql("select 1 as id, 'd' as division"), schema)


def test_large_partitions_are_split_over_files(spark, tmp_path):
    df = spark.range(200000).selectExpr("id", "uuid() as text", "'one' as kpi")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.write_snapshot(df, f"{tmp_path}/s", "2001-01-01", "kpi")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "s").rglob("*.parquet"))
    assert len(files) > 1
    assert all("syscreated=2001-01-01/kpi=one" in str(f) for f in files)


class FakeSession:
    """The few parts of a session that name the stage folder."""

    def __init__(self, master, named=None, checkpoint=None):
        self.conf = {stages.CHECKPOINT_DIR: named}
        self.sparkContext = self
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = f"file:{folder}"


def test_an_empty_result_is_a_snapshot_too(spark, tmp_path, small):
    empty = spark.createDataFrame([], schemas.CELLS)
    assert tables.write_snapshot(empty, f"{tmp_path}/c", "2001-01-01", "entryperiod") == 0
    assert tables.read_snapshot(spark, f"{tmp_path}/c", schemas.CELLS).count() == 0
    assert tables.write_table(empty, f"{tmp_path}/t") == 0
    assert tables.read_snapshot(spark, f"{tmp_path}/none", schemas.CELLS) is None


def test_stage_folder_is_the_one_the_cluster_names():
    assert stages.stage_root(FakeSession("yarn", "hdfs:/shared/")) == "hdfs:/shared"
    assert stages.stage_root(FakeSession("yarn", None, "hdfs:/own")) == "hdfs:/own"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stages.stage_root(FakeSession("yarn"))
    alone = FakeSession("local[2]")
    assert stages.stage_root(alone).startswith("file:")
    assert stages.stage_root(alone) == stages.stage_root(alone)


def test_stage_is_a_stored_table(spark, rows):
    stored = stages.stage(spark.range(3), "numbers")
    assert rows(stored) == [(0,), (1,), (2,)]
    (folder,) = {f.rsplit("/", 1)[0] for f in stored.inputFiles()}
    assert "/numbers-" in folder and stages.stage_root(spark).removeprefix("file:") in folder


def test_stages_of_a_job_are_removed(spark, rows):
    kept = stages.stage(spark.range(1), "kept")
    with stages.removed_after(spark) as made:
        stages.stage(spark.range(3), "numbers")
    assert len(made) == 1 and rows(kept) == [(0,)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(made[0])


def test_command_line():
    args = parser().parse_args(
        ["publish", "--source", "a", "--target", "b", "--service", "series",
         "--as-of", "2019-06-15", "--types", "gl_account=id string"]
    )
    assert args.types == ["gl_account=id string"]
    assert args.as_of == dt.date(2019, 6, 15) and args.months_to_end == 3


def test_two_writers_lose_nothing(spark, tmp_path, rows):
    """A second writer commits while the first one builds its version."""
    root, schema, bases = f"{tmp_path}/t", "writer string", []

    def adds(name, meanwhile=()):
        def build(current):
            bases.append(tables.latest_version(spark, root))
            for other in list(meanwhile):
                meanwhile.remove(other)
                tables.commit_version(spark, root, schema, adds(other))
            own = spark.createDataFrame([(name,)], schema)
            return own if current is None else current.unionByName(own)

        return build

    assert tables.read_version(spark, root, schema) is None
    assert tables.commit_version(spark, root, schema, adds("a", ["b"])) == 2
    assert tables.commit_version(spark, root, schema, adds("c", ["d", "e"])) == 5
    assert bases == [0, 0, 1, 2, 2, 3, 4]
    assert rows(tables.read_version(spark, root, schema)) == [(x,) for x in "abcde"]
    assert rows(tables.read_version(spark, root, schema, 1)) == [("b",)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 5
    assert not [f for f in (tmp_path / "t" / "drafts").iterdir() if f.suffix != ".crc"]


def test_a_version_that_never_fits_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "COMMIT_TRIES", 2)
    monkeypatch.setattr(tables, "_claim", lambda *_: False)
    with pytest.raises(RuntimeError, match="changed 2 times"):
        tables.commit_version(spark, f"{tmp_path}/t", "a int", lambda _: spark.range(1).selectExpr("int(id) a"))


def test_sampled_files_are_the_only_ones_read(spark, tmp_path, rows):
    paths, schema = [f"{tmp_path}/{n}" for n in ("one", "two")], "id bigint, part string"
    df = spark.range(4000).withColumn("part", F.concat(F.lit("a b%:"), F.col("id") % 20))
    for path in paths:
        df.repartition("part").write.partitionBy("part").parquet(path)
    read = {f: tables.sample_files(spark, paths[0], schema, f) for f in (0.01, 0.25, 0.5, 1.0)}
    assert [len(d.inputFiles()) for d in read.values()] == [1, 5, 10, 20]
    assert rows(read[1.0]) == rows(df)
    assert set(rows(read[0.25])) < set(rows(read[0.5])) < set(rows(df))
    assert rows(tables.sample_files(spark, paths[1], schema, 0.25)) == rows(read[0.25])
    assert rows(tables.sample_files(spark, paths[1], schema, 0.25, seed=1)) != rows(read[0.25])
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none")
    assert tables.sample_files(spark, f"{tmp_path}/none", schema, 0.5).count() == 0
    with pytest.raises(ValueError):
        tables.sample_files(spark, paths[0], schema, 0)


def test_rows_are_counted_without_a_second_job(spark, tmp_path):
    df = spark.range(1000).withColumn("part", F.col("id") % 3)
    spark.sparkContext.setJobGroup("counting", "a write that counts")
    try:
        assert tables.write_table(df, f"{tmp_path}/t", "part") == 1000
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counting")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tables.write_snapshot(df, f"{tmp_path}/s", "2001-01-01", "part") == 1000


def test_snapshots_of_many_dates_in_one_write(spark, tmp_path, rows):
    root, schema = f"{tmp_path}/s", "id bigint"
    df = spark.range(90).withColumn("syscreated", F.concat(F.lit("2001-01-"), F.col("id") % 30 + 10))
    assert tables.write_snapshots(df, root) == 90
    again = df.filter("id % 30 in (3, 4)").withColumn("id", F.col("id") + 1000)
    assert tables.write_snapshots(again, root) == 6
    assert tables.latest_date(spark, root) == "2001-01-39"
    assert rows(tables.read_snapshot(spark, root, schema, "2001-01-13")) == [(1003,), (1033,), (1063,)]
    assert rows(tables.read_snapshot(spark, root, schema, "2001-01-15")) == [(35,), (5,), (65,)]
    assert tables.write_snapshots(df.limit(0), root) == 0
    assert len(tables._dated_folders(spark, root, tables.SNAPSHOT)) == 30


def test_files_of_different_types(spark, tmp_path, rows):
    path = f"{tmp_path}/mixed"
    for kind, values in (("int", [1, 2]), ("bigint", [3, None]), ("decimal(12,2)", [4.25])):
        own = spark.createDataFrame([(None if v is None else str(v),) for v in values], "a string")
        own.select(F.col("a").cast(kind)).write.mode("append").parquet(path)
    read = tables.read_table(spark, path, "a decimal(22,2)")
    assert [str(r[0]) for r in read.orderBy("a").collect()] == ["None", "1.00", "2.00", "3.00", "4.25"]
