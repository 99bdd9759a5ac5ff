"""Time the headline queries; prints one JSON line.

Queries share one chain of stages, as the jobs share stored tables: a stage is
computed by, and counted under, the first query that needs it. Results are written
to the no-op sink, so every row and column is produced.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.chain import Chain
from checks.registry import QUERIES

HEADLINE = (
    "ledger_dedup",
    "ledger_rollup",
    "dso_by_term",
    "raw_measures",
    "kpi_union",
    "yeo_johnson_lambda",
    "mkt_outlier",
    "sector_points",
    "kpi_densify",
    "seasonal_adjust",
    "serve_series_docs",
    "quality_gate",
    "eol_elements",
    "eol_ratio_solvability",
    "eol_outlier",
    "eol_cube_median",
    "serve_eol_scan",
    "rollback_status",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chain = Chain(spark, sf_dir)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for key in HEADLINE:
        started = time.time()
        QUERIES[key](chain).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
