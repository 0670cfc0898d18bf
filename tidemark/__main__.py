"""One load from the command line: ``python -m tidemark WAREHOUSE [--end yyyy-mm-dd] --us-confirmed FILE ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tidemark.plans.run import Landed, load_all
from tidemark.plans.steps import Report
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources.nested import read_documents

FILES = (
    "us_confirmed",
    "us_deaths",
    "global_confirmed",
    "global_deaths",
    "countries",
    "indexes",
    "series",
    "series_json",
    "prices",
    "price_errors",
)


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("warehouse", help="root folder of the tables")
    parser.add_argument("--end", type=dt.date.fromisoformat, help="last day to load, today if not given")
    parser.add_argument("--start", type=dt.date.fromisoformat, help="oldest market or labour day of a first load")
    parser.add_argument("--reset", action="store_true", help="start with empty tables")
    parser.add_argument("--lookback-days", type=int, default=0, help="days before the mark to read again")
    for name in FILES:
        parser.add_argument("--" + name.replace("_", "-"))
    parser.add_argument("--ticker-pages", help="HTML files with the ticker table")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> dict[str, Report]:
    wh = Warehouse(spark, options.warehouse)
    if options.reset:
        wh.reset()
    pages = read_documents(spark, options.ticker_pages, "html") if options.ticker_pages else None
    landed = Landed(ticker_pages=pages, **{name: getattr(options, name) for name in FILES})
    return load_all(wh, landed, options.end, options.lookback_days, options.start)


def main() -> None:
    options = parse()
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for job, report in run(spark, options).items():
        print(f"{job}: {report}")


if __name__ == "__main__":
    main()
