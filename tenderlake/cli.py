"""Entry point for spark-submit: ``python -m tenderlake.cli <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tenderlake.functions.periods import listing
from tenderlake.operators.aggregates import GROUPINGS
from tenderlake.operators.anomaly import DEFAULT_SEED
from tenderlake.plans.aggregate import aggregate_series, aggregate_suppliers
from tenderlake.plans.ingest import ingest
from tenderlake.plans.load import load
from tenderlake.plans.score import score
from tenderlake.plans.train import train
from tenderlake.session import configure, job_scratch
from tenderlake.sources.tables import Tables


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tenderlake", description="Public-procurement data jobs.")
    root.add_argument("--data", required=True, help="folder with bronze/, silver/ and serving/")
    jobs = root.add_subparsers(dest="job", required=True)
    for name in ("ingest", "load"):
        job = jobs.add_parser(name)
        job.add_argument("--start", required=True, help="first period, yyyyMM")
        job.add_argument("--end", required=True, help="last period, yyyyMM")
    jobs.add_parser("aggregate")
    job = jobs.add_parser("train")
    job.add_argument("--series", choices=GROUPINGS, default="agency")
    job.add_argument("--horizon", type=int, default=12)
    job = jobs.add_parser("score")
    job.add_argument("--seed", type=int, default=DEFAULT_SEED)
    return root


def main(argv: list[str] | None = None) -> None:
    options = parser()
    args = options.parse_args(argv)
    periods: list[str] = []
    if args.job in ("ingest", "load"):
        try:
            periods = listing(args.start, args.end)
        except ValueError as error:
            options.error(str(error))
    spark = configure(SparkSession.builder.appName(f"tenderlake {args.job}").getOrCreate())
    with job_scratch(spark):
        run(spark, args, periods)


def run(spark: SparkSession, args: argparse.Namespace, periods: list[str]) -> None:
    data = args.data.rstrip("/")
    silver, tables = f"{data}/silver", Tables(spark, f"{data}/serving")
    if args.job == "ingest":
        ingest(spark, f"{data}/bronze", silver, periods).orderBy("period").show(len(periods), truncate=False)
    elif args.job == "load":
        load(spark, silver, tables, periods).orderBy("period").show(len(periods), truncate=False)
    elif args.job == "aggregate":
        print("monthly_series rows:", aggregate_series(tables))
        print("supplier_series, supplier_total rows:", *aggregate_suppliers(spark, silver, tables))
    elif args.job == "train":
        print(train(tables, args.series, args.horizon))
    else:
        print("scored notices:", score(spark, silver, tables, args.seed))


if __name__ == "__main__":
    main()
