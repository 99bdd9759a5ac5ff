"""Run every query next to its check SQL and compare whole results.

    python -m checks.compare [folder] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, registry
from checks.chain import Chain

TABLES = ("supplier", "part", "lineitem", "orders", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return con


def _plain(value):
    """Comparable form: whole numbers as floats, -0.0 as 0.0, NaN as text."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return "NaN" if math.isnan(number) else number + 0.0


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(chain: Chain, con, key: str) -> tuple[bool, str]:
    started = time.time()
    df = registry.QUERIES[key](chain)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    result = con.execute(oracle.sql(key))
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    extra, missing = got - want, want - got
    note = f"{sum(got.values())} rows, {took:.1f} s"
    if extra or missing:
        sample = f"\n   spark {list(extra)[:3]}\n   sql   {list(missing)[:3]}"
        return False, f"{note}, {sum(extra.values())} / {sum(missing.values())} differ{sample}"
    return True, note


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or list(registry.QUERIES)
    # Keys share the stages of one chain, as the jobs share stored tables.
    chain, con = Chain(local_session(), sf_dir), connect(sf_dir)
    failed = 0
    for key in keys:
        try:
            ok, note = compare(chain, con, key)
        except Exception as error:  # report and go on with the next key
            ok, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        failed += not ok
        print("ok  " if ok else "FAIL", key, note, flush=True)
    print(f"{len(keys) - failed} of {len(keys)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
