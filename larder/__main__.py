"""Command line: products, layers, backfill, daily."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from larder.plans.jobs import JobSettings, job_backfill, job_daily, job_products
from larder.plans.layer_run import LayerConfig, run_layers
from larder.sources.landing import read_landing


def main(argv: list[str] | None = None) -> None:
    settings = JobSettings.from_env()
    parser = argparse.ArgumentParser(prog="larder")
    jobs = parser.add_subparsers(dest="job", required=True)
    p = jobs.add_parser("products", help="build the product table")
    p.add_argument("--count", type=int, default=settings.n_products)
    p.add_argument("--seed", type=int, default=settings.seed)
    p.add_argument("--out", default=settings.output)
    p = jobs.add_parser("layers", help="run bronze, silver and gold over a landed file")
    p.add_argument("--landing", required=True)
    p.add_argument("--expected-rows", type=int)
    p.add_argument("--no-gates", action="store_true", help="write without quality checks")
    p = jobs.add_parser("backfill", help="load the days of a range from a landed file")
    p.add_argument("--source", required=True)
    p.add_argument("--start", type=date.fromisoformat, default=settings.start_date)
    p.add_argument("--end", type=date.fromisoformat, required=True)
    p.add_argument("--ts", default="ts")
    p.add_argument("--out", default=settings.output)
    p = jobs.add_parser("daily", help="load one day from a landed file")
    p.add_argument("--source", required=True)
    p.add_argument("--date", type=date.fromisoformat, required=True)
    p.add_argument("--ts", default="ts")
    p.add_argument("--out", default=settings.output)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("larder").getOrCreate()
    if args.job == "products":
        print(job_products(spark, args.count, args.seed, args.out))
    elif args.job == "backfill":
        source = read_landing(spark, args.source)
        print(job_backfill(source, args.start, args.end, args.out, args.ts, args.source))
    elif args.job == "daily":
        print(job_daily(read_landing(spark, args.source), args.date, args.out, args.ts, args.source))
    else:
        print(run_layers(spark, LayerConfig(
            args.landing, expected_rows=args.expected_rows, gates=not args.no_gates
        )))


if __name__ == "__main__":
    main()
