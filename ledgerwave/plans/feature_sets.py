"""The published feature sets: which features, over which columns. The period
lists are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerwave.operators.features import (
    Feature, beta, broke_high, broke_low, ifr, lag_feature, moving, pct_change, with_features,
)
from ledgerwave.operators.series import MAX_ROWS

PRICE_KEYS, PRICE_ORDER = ["id_cnpj", "ticker"], ["date"]
STATEMENT_KEYS, STATEMENT_ORDER = ["id_cvm"], ["dt_year", "dt_quarter"]

MOVING_PERIODS = [5, 10, 15, 20, 25, 30, 60, 90, 120, 160, 180, 360]
BETA_PERIODS = [10, 15, 20, 25, 30, 60, 90, 120, 160, 180, 360]
BREAK_PERIODS = [5, 10, 15, 20, 25, 30, 60, 90, 120]
STRENGTH_PERIODS = [10, 15, 20, 25, 30, 60, 90, 120]
STATEMENT_VARIABLES = [
    "amt_sales_revenue", "amt_cost_goods_and_services", "amt_earnings_before_interest_and_taxes",
    "amt_financial_results", "amt_net_profit",
]
STATEMENT_RUNS = [1, 2, 3, 4]
STATEMENT_BETAS = [2, 5, 11]

# Price table column -> name in the feature tables.
PRICE_NAMES = {
    "dt_date": "date", "id_ticker": "ticker", "amt_adj_close": "adj_close",
    "amt_high": "high_price", "amt_low": "low_price",
    "high": "high_price", "low": "low_price",
}


def price_features_1() -> list[Feature]:
    moves = [
        moving("adj_close", n, m) for n in MOVING_PERIODS for m in ("mean", "std", "min", "max")
    ]
    changes = [
        pct_change(v, n, "d")
        for v in ("adj_close", "high_price", "low_price", "amplitude_close_high_price")
        for n in MOVING_PERIODS
    ]
    return moves + changes


def price_features_2() -> list[Feature]:
    betas = [beta("adj_close", n) for n in BETA_PERIODS]
    highs = [broke_high(v, n) for v in ("adj_close", "high_price") for n in BREAK_PERIODS]
    lows = [broke_low(v, n) for n in BREAK_PERIODS for v in ("adj_close", "low_price")]
    return betas + highs + lows + [ifr("adj_close", n) for n in STRENGTH_PERIODS]


def income_features() -> list[Feature]:
    out = []
    for v in STATEMENT_VARIABLES:
        out += [lag_feature(v, 1, "m"), lag_feature(v, 4, period_text="1y")]
    for v in STATEMENT_VARIABLES:
        out += [pct_change(v, 1, "m"), pct_change(v, 4, period_text="1y")]
    for measure in ("mean", "std"):
        out += [moving(v, n, measure) for v in STATEMENT_VARIABLES for n in STATEMENT_RUNS]
    return out + [beta(v, n) for n in STATEMENT_BETAS for v in STATEMENT_VARIABLES]


def price_base(prices: DataFrame) -> DataFrame:
    """Daily prices under the feature tables' names, with period and amplitude."""
    df = prices.withColumnsRenamed(PRICE_NAMES)
    return df.withColumns({
        "dt_year": F.year("date"),
        "dt_quarter": F.quarter("date"),
        "amplitude_close_high_price": F.col("adj_close") - F.col("high_price"),
    })


def with_price_features_1(prices: DataFrame, max_rows: int | None = MAX_ROWS) -> DataFrame:
    return with_features(price_base(prices), price_features_1(), PRICE_KEYS, PRICE_ORDER, max_rows)


def with_price_features_2(base: DataFrame, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """``base`` is the result of the first set or of ``price_base``."""
    return with_features(base, price_features_2(), PRICE_KEYS, PRICE_ORDER, max_rows)


def with_price_features(prices: DataFrame, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Both sets over one exchange: no table is written and re-read in between."""
    return with_features(
        price_base(prices), price_features_1() + price_features_2(), PRICE_KEYS, PRICE_ORDER,
        max_rows,
    )


def with_income_features(statements: DataFrame, max_rows: int | None = MAX_ROWS) -> DataFrame:
    return with_features(
        statements, income_features(), STATEMENT_KEYS, STATEMENT_ORDER, max_rows
    )
