"""Command line: one sub-command per job.

    spark-submit ... -m ledgerwave preprocess --kind dfp_dre --years 2021 2022 \\
        --raw ... --processed ... --execution-date 2023-01-31
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerwave.operators.prices import typed_quotes
from ledgerwave.operators.registry import ticker_universe
from ledgerwave.plans import analytics
from ledgerwave.plans.preprocess import JOBS, Lake, preprocess_lake
from ledgerwave.sources import lake, quotes, schemas


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerwave")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for option in options:
            p.add_argument(f"--{option}", required=True)
        return p

    p = job("preprocess", "raw", "processed", "execution-date")
    p.add_argument("--kind", choices=sorted(JOBS), help="all kinds if left out")
    p.add_argument("--years", required=True, nargs="+", type=int)
    job("tickers", "register", "output")
    p = job("quotes", "wide", "registry", "output")
    p.add_argument("--execution-date")
    job("append-prices", "day", "prices")
    job("price-features", "prices", "output")
    for name in ("income-union", "income-features"):
        p = job(name, "processed", "output")
        p.add_argument("--years", required=True, nargs="+", type=int)
    p = job("fundamentals", "processed", "prices", "output")
    p.add_argument("--period", required=True, choices=["annual", "quarterly"])
    p.add_argument("--years", nargs="+", type=int, default=list(analytics.YEARS))
    p.add_argument("--buckets", type=int, help="read what co-partition wrote in so many buckets")
    p = job("co-partition", "processed")
    p.add_argument("--period", required=True, choices=["annual", "quarterly"])
    p.add_argument("--years", nargs="+", type=int, default=list(analytics.YEARS))
    p.add_argument("--buckets", type=int, required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerwave-{a.job}").getOrCreate()
    if a.job == "preprocess":
        kinds = [a.kind] if a.kind else list(JOBS)
        preprocess_lake(spark, Lake(a.raw, a.processed), a.years, a.execution_date, kinds)
        return
    if a.job == "co-partition":
        analytics.co_partition(spark, Lake("", a.processed), a.period == "annual", a.buckets, a.years)
        return
    if a.job == "append-prices":
        lake.append_days(spark.read.schema(schemas.DAILY_PRICES).parquet(a.day), a.prices)
        return
    partition_by = None
    if a.job == "tickers":
        df = ticker_universe(spark.read.parquet(a.register))
    elif a.job == "quotes":
        wide, registry = spark.read.parquet(a.wide), quotes.read_registry(spark, a.registry)
        long = quotes.attach_registry(quotes.quotes_long(wide), registry)
        df = typed_quotes(long, a.execution_date).select(*schemas.PRICE_COLUMNS)
        partition_by = ["dt_date"]
    elif a.job == "price-features":
        df = analytics.price_features(spark.read.parquet(a.prices))
    elif a.job == "fundamentals":
        prices = spark.read.parquet(a.prices)
        df = analytics.fundamentals_table(
            spark, Lake("", a.processed), prices, a.period == "annual", a.years, a.buckets
        )
    else:
        df = analytics.income_union(spark, Lake("", a.processed), a.years)
        if a.job == "income-features":
            df = analytics.income_features(df)
    if partition_by is None and "dt_year" in df.columns:
        partition_by = ["dt_year"]
    # A day without quotes writes nothing.
    lake.write_table(df, a.output, partition_by, skip_empty=a.job == "quotes")


if __name__ == "__main__":
    main()
