"""Pre-processed tables -> analytical tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerwave.operators import fundamentals, quarters
from ledgerwave.plans import feature_sets
from ledgerwave.plans.preprocess import Lake
from ledgerwave.sources import buckets, lake, schemas

# Years the integration covers.
YEARS = range(2011, 2023)


def _years(spark: SparkSession, lake_: Lake, kind: str, years: Iterable[int], schema) -> DataFrame:
    return lake.scan_years(spark, lake_.table(kind), years, schema, "dt_file_year")


def income_union(spark: SparkSession, lake_: Lake, years: Iterable[int]) -> DataFrame:
    pair = (
        _years(spark, lake_, kind, years, schemas.INCOME_WIDE) for kind in ("itr_dre", "dfp_dre")
    )
    return quarters.income_union(*pair)


def income_features(union: DataFrame) -> DataFrame:
    return feature_sets.with_income_features(union)


def price_features(prices: DataFrame) -> DataFrame:
    return feature_sets.with_price_features(prices)


def _statement_tables(annual: bool) -> dict[str, StructType]:
    """Tables that the integration joins. Quarterly cash flow is read in its own-year
    dating, which is the one that meets the other statements' period ends."""
    kind = "dfp" if annual else "itr"
    return {
        f"{kind}_dre": schemas.INCOME_WIDE,
        f"{kind}_bpa": schemas.ASSETS_WIDE,
        f"{kind}_bpp": schemas.LIABILITIES_WIDE,
        "dfp_dfc" if annual else "itr_dfc_own_year": schemas.CASH_FLOW_WIDE,
    }


def co_partition(
    spark: SparkSession, lake_: Lake, annual: bool, n: int, years: Iterable[int] = YEARS
) -> None:
    """Lay the four statements of some years out by company and year, in ``n``
    buckets, beside the pre-processed tables. One exchange each; every join after
    it reads them as they lie."""
    for table, schema in _statement_tables(annual).items():
        df = _years(spark, lake_, table, years, schema)
        buckets.write_bucketed(df, lake_.bucketed(table), buckets=n)


def fundamentals_table(
    spark: SparkSession, lake_: Lake, prices: DataFrame, annual: bool,
    years: Iterable[int] = YEARS, bucketed: int | None = None,
) -> DataFrame:
    """The integrated table, from the slices of the pre-processed tables or, with
    ``bucketed``, from what ``co_partition`` left in so many buckets."""
    tables = _statement_tables(annual)
    if bucketed:
        four = [
            buckets.read_bucketed(spark, lake_.bucketed(t), schema, bucketed) for t, schema in tables.items()
        ]
    else:
        four = [_years(spark, lake_, t, years, schema) for t, schema in tables.items()]
    return fundamentals.integrated_fundamentals(*four, prices)
