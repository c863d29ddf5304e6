"""Command-line entry for the pipeline jobs.

    python -m perfwatch.plans.cli all --root /shared/web-vitals
    python -m perfwatch.plans.cli page_loads --root /shared/web-vitals

Reads raw files from ``<root>/raw/{lab_reports,field_metrics,page_loads,devices}``
and writes ``processed/``, ``curated/`` and ``reports/`` under the same root.
This is the only place a session is created; the master, memory and the
checkpoint folder come from ``spark-submit`` / ``spark-defaults.conf``.
"""
from __future__ import annotations

import argparse
import dataclasses
import inspect
import json
import logging

from pyspark.sql import SparkSession

from perfwatch.config import RegressionThresholds
from perfwatch.plans import jobs

JOBS = {
    "lab": jobs.ingest_lab,
    "field": jobs.ingest_field_metrics,
    "page_loads": jobs.ingest_page_loads,
    "curated": jobs.build_curated,
    "regressions": jobs.build_regressions,
    "reports": jobs.build_reports,
    "all": jobs.run_all,
}


def main(argv=None) -> dict:
    parser = argparse.ArgumentParser(prog="perfwatch", description="web-vitals pipeline jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True, help="shared folder holding raw/, processed/, curated/, reports/")
    parser.add_argument("--replace-dates", action="store_true", help="page_loads: exchange only the days the raw input holds")
    parser.add_argument("--full", action="store_true", help="curated: build every day, changed or not")
    limits = parser.add_argument_group("regression limits")
    for field in dataclasses.fields(RegressionThresholds):
        limits.add_argument(f"--{field.name.replace('_', '-')}", type=float, default=field.default,
                            help=f"default {field.default}")
    args = parser.parse_args(argv)
    thresholds = RegressionThresholds(**{f.name: getattr(args, f.name) for f in dataclasses.fields(RegressionThresholds)})
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = (SparkSession.builder.appName(f"perfwatch-{args.job}")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    job = JOBS[args.job]
    given = {"thresholds": thresholds, "replace_dates": args.replace_dates, "full": args.full}
    takes = {name: value for name, value in given.items() if name in inspect.signature(job).parameters}
    result = job(spark, jobs.Layout(args.root.rstrip("/")), **takes)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
