"""Daily prices: typing, day filter, period ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerwave.functions.calendar import fetch_window, iso_date
from ledgerwave.sources.schemas import PRICE_COLUMNS

_AMOUNTS = {
    "amt_adj_close": "adj_close", "amt_close": "close", "amt_high": "high", "amt_low": "low",
    "amt_open": "open", "qty_volume": "volume",
}


def price_day_filter(quotes: DataFrame, execution_date: str, date: str = "date") -> DataFrame:
    """Quotes of the day before the execution date."""
    start, _ = fetch_window(F.lit(execution_date).cast("date"))
    return quotes.filter(F.col(date) == start)


def typed_quotes(quotes: DataFrame, execution_date: str | None = None) -> DataFrame:
    """Quotes with ids -> the daily price schema.

    Dividends are whole currency units in the price schema; the untruncated
    amount stays beside it as ``amt_dividends_exact``. Without an execution
    date the whole history is kept.
    """
    df = quotes.withColumn("dt_date", iso_date(F.col("date").cast("string")))
    if execution_date is not None:
        df = price_day_filter(df, execution_date, date="dt_date")
    return df.withColumns({
        **{new: F.col(old).try_cast("double") for new, old in _AMOUNTS.items()},
        "amt_dividends": F.col("dividends").try_cast("int"),
        "cat_stock_splits": F.col("stock_splits").try_cast("int"),
        "amt_dividends_exact": F.col("dividends").try_cast("double"),
    }).select(*PRICE_COLUMNS, "amt_dividends_exact")


def price_period_end(prices: DataFrame) -> DataFrame:
    """Close and dividends on the last quoted day of each quarter.

    The row of the latest date is found by one aggregation (the maximum of a
    struct led by the date) instead of joining the maximum back; equal dates
    resolve by value, so the result is the same on every run.
    """
    last = F.max(F.struct("dt_date", "amt_adj_close", "amt_dividends")).alias("_last")
    return (
        prices.groupBy(
            "id_cnpj", "id_ticker",
            F.year("dt_date").alias("dt_year"), F.quarter("dt_date").alias("dt_quarter"),
        )
        .agg(last)
        .select("id_cnpj", "id_ticker", "dt_year", "dt_quarter", "_last.*")
    )
