"""Domain tables derived from the given test tables.

The texts run unchanged on Spark (with DataFrames for the braces) and as common
table expressions in the check SQL, so both sides start from the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorgauge.config import Settings

# Ledger codes of the test accounts, ten characters each.
ACCOUNT_CODES = (
    "WOmzNopOpo WOvbSubOvs WPerLesLon WKprKvgKvg WBedHuiHui WAfsAfiAfi BLimBanRba "
    "BLimKasKas BVorDebHad BVrdHanHan BProOnpOnp BVorBtwBtw BVorOvrOvr BEffAanAan "
    "BSchCreHac BEivGokGok BVrzLhrLhr BLasSohSoh BSchBtwBtw BSchSalSal"
).replace(" ", "")

DIVISION_LOOKUP = """
select cast(s_suppkey as string) as division,
       case when s_suppkey % 20 = 0 then 'BE' else 'NL' end as country,
       case when s_suppkey % 19 = 8 then null
            else substr('CFGIMN', cast(1 + s_nationkey % 6 as int), 1) end as sectorcode,
       cast(67 + s_suppkey % 5 as string) as subsectorcode,
       case when s_acctbal < 0 then null when s_acctbal < 3500 then 'Small'
            when s_acctbal < 7000 then 'Medium' else 'Large' end as sizedescription,
       case when s_suppkey % 25 = 3 then 'False' when s_suppkey % 25 = 4 then null
            else 'True' end as allow_data_sharing,
       case when s_suppkey % 17 = 0 then null else cast(s_nationkey % 6 as int) end as group_id,
       cast(100 + s_nationkey % 6 as bigint) as size_of_merged_group,
       case when s_suppkey % 23 = 7 then '0' else '1' end as eurocurrency
from {supplier}
"""

COMPANY_COUNT = "select count(*) as n from {supplier}"

CODED_PART = """
select p_partkey as id, 1 + p_partkey % n as company, p_size,
       cast(floor(p_partkey / n) % 20 as int) as i
from (select *, (select n from {company_count}) as n from {part}) p
"""

GL_ACCOUNT = f"""
select id, cast(company as string) as division,
       case when p_size % 10 = 0 then null when p_size % 10 = 1 then substr(code, 1, 4)
            when p_size % 10 = 2 then substr(code, 1, 7) else code end as rgscode,
       case when p_size % 10 = 1 and p_size > 30 then substr(code, 1, 7)
            else code end as exactrgscode
from (select id, company, p_size, substr('{ACCOUNT_CODES}', 1 + 10 * i, 10) as code
      from {{coded_part}}) p
"""

GL_TRANSACTION = """
select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as id,
       case when l_linenumber = 7 then '310' else '20' end as type,
       l_shipdate as sysmodified,
       l_suppkey as x_sysingested,
       case when l_returnflag = 'R' and l_linestatus = 'O' then 'Y' else 'N' end as x_isdeleted,
       cast(cast(l_extendedprice as decimal(18,2))
            * case when i in (0, 1) then -3 when i between 14 and 19 then -1 else 1 end
            * case when i in (7, 9) and (company % 9 = 0
                        or (company % 9 = 1 and year(l_shipdate) = 1997)) then -1 else 1 end
            as decimal(18,2)) as amountdc,
       l_partkey as glaccount,
       substr(cast(l_shipdate as string), 1, 10) as entrydate
from {lineitem} left join {coded_part} on id = l_partkey
"""

INVOICE_DSO = """
select cast(1 + o_custkey % n as string) as division,
       substr(cast(o_orderdate as string), 1, 10) as paymententrydate,
       cast(o_orderkey % 61 - 2 as int) as atbip,
       case when o_orderpriority = '4-NOT SPECIFIED' then 'K' else 'B' end as paymentmethod,
       case o_orderkey % 4 when 0 then 14 when 1 then 30 when 2 then 60 else 31 end
           as paymentdays,
       cast(floor(o_orderkey / 2) as bigint) as paymentid,
       o_orderkey as uniqueinvoicenumber,
       cast(floor(o_orderkey / 3) as bigint) as matchid
from (select *, (select n from {company_count}) as n from {orders}) o
"""

# Check SQL only: Spark expands the calendar with sequences instead (below).
FINANCIAL_PERIOD = """
select division, y as finyear, m as finperiod,
       case when cast(division as int) % 4 = 0
            then cast(make_date(y - 1, 7, 1) + to_months(m - 1) as date)
            else make_date(y, m, 1) end as startdate,
       last_day(case when cast(division as int) % 4 = 0
            then cast(make_date(y - 1, 7, 1) + to_months(m - 1) as date)
            else make_date(y, m, 1) end) as enddate
from division_lookup,
     (select cast(unnest(range(1995, 2003)) as int) as y) years,
     (select cast(unnest(range(1, 13)) as int) as m) months
"""

# Registry of published snapshots: one entry per event, written by a few services.
BOOKMARKS = """
select 'snapshot-' || cast(event_id as string) as s3key,
       'service_' || event_type as servicename,
       case when event_id % 7 = 3 then 'Corrupted' else 'OK' end as status,
       ts as created, ts as updated
from {events}
"""

AS_OF = dt.date(2001, 11, 1)


def check_settings(**changes) -> Settings:
    """Settings that fit the calendar and the group sizes of the test tables."""
    values = dict(
        as_of=AS_OF,
        oldest_month="1990-01",
        older_label="1989-12",
        kpi_start="1995-01",
        min_group=5,
        element_start="1996-12",
        fin_year_max=None,
        min_population=3,
    )
    return Settings(**(values | changes))


class Domain:
    """Lazily derived domain tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def division_lookup(self) -> DataFrame:
        return self.spark.sql(DIVISION_LOOKUP, supplier=self.table("supplier"))

    @property
    def _company_count(self) -> DataFrame:
        return self.spark.sql(COMPANY_COUNT, supplier=self.table("supplier"))

    @property
    def _coded_part(self) -> DataFrame:
        return self.spark.sql(
            CODED_PART, part=self.table("part"), company_count=self._company_count
        )

    @property
    def gl_account(self) -> DataFrame:
        return self.spark.sql(GL_ACCOUNT, coded_part=self._coded_part)

    @property
    def gl_transaction(self) -> DataFrame:
        return self.spark.sql(
            GL_TRANSACTION, lineitem=self.table("lineitem"), coded_part=self._coded_part
        )

    @property
    def invoice_dso(self) -> DataFrame:
        return self.spark.sql(
            INVOICE_DSO, orders=self.table("orders"), company_count=self._company_count
        )

    @property
    def financial_period(self) -> DataFrame:
        calendar = F.make_date("finyear", "finperiod", F.lit(1))
        broken = F.add_months(
            F.make_date(F.col("finyear") - 1, F.lit(7), F.lit(1)), F.col("finperiod") - 1
        )
        start = F.when(F.col("division").cast("int") % 4 == 0, broken).otherwise(calendar)
        return (
            self.division_lookup.select(
                "division", F.explode(F.sequence(F.lit(1995), F.lit(2002))).alias("finyear")
            )
            .select(
                "*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("finperiod")
            )
            .withColumn("startdate", start)
            .withColumn("enddate", F.last_day("startdate"))
        )

    @property
    def bookmarks(self) -> DataFrame:
        return self.spark.sql(BOOKMARKS, events=self.table("events"))
