"""Run one job: ``spark-submit`` entry point of the package.

    python -m sectorgauge measures --source <folder> --target <folder>
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys

from pyspark.sql import DataFrame

from sectorgauge.config import Settings
from sectorgauge.plans import jobs
from sectorgauge.session import get_session

STAGES = {
    "measures": jobs.run_measures,
    "company-kpis": jobs.run_company_kpis,
    "sector-series": jobs.run_sector_series,
    "elements": jobs.run_elements,
    "ratios": jobs.run_ratios,
    "cells": jobs.run_cells,
}


KEEP = object()


def day(text: str) -> str:
    return dt.date.fromisoformat(text).isoformat()


def month(text: str) -> str:
    return dt.date.fromisoformat(f"{text}-01").strftime("%Y-%m")


def year_or_none(text: str) -> int | None:
    return None if text == "none" else int(text)


#: Limits of ``Settings`` outside which rows are left out.
LIMITS = {
    "entry_from": (day, "first entry date"),
    "entry_before": (day, "entries from this date on are left out"),
    "kpi_start": (month, "first month of the company KPIs"),
    "element_start": (month, "first month of the elements"),
    "fin_year_max": (year_or_none, "last fiscal year, or none"),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sectorgauge", description=__doc__)
    p.add_argument(
        "job", choices=[*STAGES, "all", "publish", "publish-both", "roll-back", "lookup", "scan"]
    )
    p.add_argument("--source", help="folder of the domain tables", required=True)
    p.add_argument("--target", help="folder of the results", required=True)
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--postfix", default="", help="suffix of the measures table")
    p.add_argument("--sample", type=float, help="share of the transaction files, for a trial run")
    p.add_argument(
        "--types",
        action="append",
        default=[],
        metavar="TABLE=COLUMNS",
        help="columns of an input table, where its files hold other types",
    )
    p.add_argument("--months-to-end", type=int, default=3)
    for option, (kind, what) in LIMITS.items():
        p.add_argument(f"--{option.replace('_', '-')}", type=kind, help=what, default=KEEP)
    p.add_argument("--service", choices=[jobs.SERIES_SERVICE, jobs.RATIO_SERVICE])
    p.add_argument("--sectorcode", default="")
    p.add_argument("--kpi", default="")
    p.add_argument("--history", default="")
    p.add_argument("--output", help="folder for the rows of lookup and scan; else they are printed")
    return p


def settings_of(args: argparse.Namespace) -> Settings:
    given = {name: getattr(args, name) for name in LIMITS}
    return Settings(
        as_of=args.as_of or dt.date.today(),
        publish_lag_months=args.months_to_end,
        **{name: value for name, value in given.items() if value is not KEEP},
    )


def give(found: DataFrame, output: str | None) -> None:
    """All rows: written to ``output`` as JSON lines, or printed one by one."""
    if output:
        found.write.mode("overwrite").json(output)
    else:
        for row in found.toJSON().toLocalIterator():
            print(row)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    settings = settings_of(args)
    types = dict(entry.split("=", 1) for entry in args.types)
    paths = jobs.Paths(args.source, args.target, args.postfix, types)
    spark = get_session(f"sectorgauge {args.job}")
    if args.sample is not None and args.job != "measures":
        raise SystemExit("--sample is an option of measures")
    if args.job == "measures":
        print(jobs.run_measures(spark, paths, settings, args.sample), "rows")
    elif args.job == "all":
        jobs.run_all(spark, paths, settings)
    elif args.job in STAGES:
        print(STAGES[args.job](spark, paths, settings), "rows")
    elif args.job == "lookup":
        found = jobs.lookup_series(
            spark, paths, settings, args.sectorcode, args.kpi, args.history
        )
        give(found, args.output)
    elif args.job == "scan":
        give(jobs.scan_ratios(spark, paths), args.output)
    else:
        if args.job == "publish-both":
            outcome = jobs.publish_both(spark, paths, settings)
        elif args.service is None:
            raise SystemExit("--service is required")
        else:
            step = jobs.publish if args.job == "publish" else jobs.roll_back
            outcome = step(spark, paths, settings, args.service)
        print(outcome)
        return 0 if outcome.success else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
