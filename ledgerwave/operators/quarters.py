"""Fourth quarters from annual totals, multi-year union, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwave.functions.money import exact
from ledgerwave.sources.schemas import LEGACY_QUARTER_AMOUNTS

COMPANY_YEAR = ["id_cvm", "id_cnpj", "txt_company_name", "dt_year"]
DATES = ["dt_refer", "dt_ini_exerc", "dt_fim_exerc"]


def _amounts(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("amt_")]


def complete_years(itr: DataFrame, dfp: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """(company, year) with exactly three quarterly rows and an annual row."""
    keys = ["id_cvm", "dt_year", *also]
    three = (
        itr.groupBy(*COMPANY_YEAR, *also).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == 3)
        .select(*keys)
        .distinct()
    )
    return three.join(dfp.select(*keys), keys, "left_semi")


_ANNUAL = "_annual"


def _both(itr: DataFrame, dfp: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quarterly and annual rows, marked."""
    return itr.select(*columns, F.lit(False).alias(_ANNUAL)).unionByName(
        dfp.select(*columns, F.lit(True).alias(_ANNUAL))
    )


def _annual_less_quarters(
    both: DataFrame, keys: list[str], amounts: list[str], typed: bool
) -> DataFrame:
    """Annual rows and negated quarterly rows, added up per key.

    The dates ride along from the annual row, so no join has to bring them
    back; ``typed`` leaves them out for rows with a null key.
    """
    annual, carried = F.col(_ANNUAL), [*DATES, "dt_quarter"]

    def signed(a: str) -> Column:
        value = exact(F.col(a))
        return F.when(annual, value).otherwise((-value).cast("decimal(20,2)"))

    summed = both.groupBy(*keys).agg(
        *[F.max(F.when(annual, F.col(c))).alias(c) for c in carried],
        *[F.sum(signed(a)).cast("double").alias(a) for a in amounts],
    )
    if typed:
        whole_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
        summed = summed.withColumns({c: F.when(whole_key, F.col(c)) for c in carried})
    return summed


def last_quarter(itr: DataFrame, dfp: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Quarters 1-3 plus, for complete years, the fourth: annual minus their sum.

    Sums skip nulls: a missing annual amount leaves minus the sum of quarters.
    Quarterly and annual rows are dealt once by company and year; whether a year is
    complete is counted, and the fourth quarter summed, inside that layout.
    """
    itr, dfp = itr.drop("processed_at"), dfp.drop("processed_at")
    company = ["id_cvm", "dt_year", *also]
    annual = F.col(_ANNUAL)
    both = _both(itr, dfp, itr.columns).repartition(*company)
    three = F.sum((~annual).cast("int")).over(Window.partitionBy(*COMPANY_YEAR, *also)) == 3
    year = Window.partitionBy(*company)
    known = reduce(and_, [F.col(c).isNotNull() for c in company])
    marked = both.withColumn("_three", three & ~annual).withColumn(
        "_complete", known & F.max("_three").over(year) & F.max("_annual").over(year)
    )
    keys = [*COMPANY_YEAR, "cat_type_dre", *also]
    fourth = _annual_less_quarters(marked.filter("_complete"), keys, _amounts(itr), typed=True)
    return itr.unionByName(fourth)


def last_quarter_legacy(itr: DataFrame, dfp: DataFrame) -> DataFrame:
    """The older derivation: eight amounts, every company-year, no type, and
    only rows processed on the same day meet."""
    keys = ["processed_at", *COMPANY_YEAR]
    columns = [*keys, *DATES, "dt_quarter", *LEGACY_QUARTER_AMOUNTS]
    fourth = _annual_less_quarters(_both(itr, dfp, columns), keys, LEGACY_QUARTER_AMOUNTS, typed=False)
    return itr.select(*columns).unionByName(fourth.select(*columns))


def dedupe_subset(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the smallest by all other columns in order.

    The minimum of a struct combines before the shuffle: copies of a hot key
    are folded where they are read.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def dedupe_running_count(
    df: DataFrame, entity: str = "id_cnpj", period: tuple[str, ...] = ("dt_year", "dt_quarter"),
    order: str = "dt_fim_exerc",
) -> DataFrame:
    """Keep the row whose running count within entity and period is one.

    The count runs in date order over whole ties, nulls first. So the earliest
    date survives if it stands alone, and nothing survives if it is tied or if
    the entity is null. Said that way it needs no per-group ordering: count the
    rows of each date, then take the first date, both combined map-side.
    """
    keys = [entity, *period]
    rest = [c for c in df.columns if c not in (*keys, order)]
    per_date = (
        df.filter(F.col(entity).isNotNull())
        .groupBy(*keys, order)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*rest)).alias("_row"))
    )
    first = per_date.groupBy(*keys).agg(
        # Nulls first, as false sorts before true.
        F.min(F.struct(F.col(order).isNotNull(), order, "_n", "_row")).alias("_first")
    )
    return (
        first.filter(F.col("_first._n") == 1)
        .select(*keys, F.col(f"_first.{order}").alias(order), "_first._row.*")
        .select(*df.columns)
    )


def income_union(itr: DataFrame, dfp: DataFrame, legacy: bool = False) -> DataFrame:
    """All years of quarterly income with fourth quarters, duplicates removed."""
    df = last_quarter_legacy(itr, dfp) if legacy else last_quarter(itr, dfp)
    df = dedupe_subset(df, ["id_cnpj", *DATES])
    return dedupe_running_count(df)
