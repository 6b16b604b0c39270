"""Discrete-quarter cash flow from year-to-date filings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.functions.calendar import quarter_end, quarter_end_pinned
from ledgerwave.functions.money import MONEY_SQL
from ledgerwave.functions.text import label_slug_spaced
from ledgerwave.operators.charts import cash_flow_test
from ledgerwave.operators.statements import cash_flow_lines
from ledgerwave.sources.schemas import CASH_FLOW_AMOUNTS, CASH_FLOW_KEYS

ACCOUNT_KEYS = ["id_cvm", "id_cnpj", "txt_company_name", "dt_year", "id_account", "txt_account"]
COMPANY_KEYS = ACCOUNT_KEYS[:4]
QUARTERS = [1, 2, 3, 4]
TABLE_COLUMNS = ACCOUNT_KEYS + ["Q1", "Q2", "Q3", "Q4"]


def cash_flow_accounts(itr: DataFrame, dfp: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Per account: year-to-date and single-quarter amounts side by side.

    ``itr`` carries the year to date at quarters 1-3, ``dfp`` the full year. An
    account without a first quarter is left out; a quarter is null when either
    year-to-date amount it is the difference of is missing. Lines that repeat
    the same account in the same quarter add up. An account with a null key
    (for example no label) has no later quarters.
    """
    lines = cash_flow_lines(itr, also).unionByName(cash_flow_lines(dfp, also))
    quarter, amount = F.col("dt_quarter"), F.col("amt_account")
    ytd = lines.groupBy(*ACCOUNT_KEYS, *also).agg(
        F.count_if(quarter == 1).alias("n1"),
        *[F.sum(F.when(quarter == q, amount)).alias(f"c{q}") for q in QUARTERS],
    ).filter(F.col("n1") > 0)

    whole_key = reduce(and_, [F.col(k).isNotNull() for k in ACCOUNT_KEYS])

    def later(q: int) -> Column:
        return F.when(whole_key, F.col(f"c{q}"))

    def out(c: Column, name: str) -> Column:
        return c.cast("double").alias(name)

    return ytd.select(
        *ACCOUNT_KEYS[:5],
        label_slug_spaced(F.col("txt_account")).alias("txt_account"),
        out(F.col("c1"), "Q1"),
        out(later(2) - F.col("c1"), "Q2"),
        out(later(2), "Q2_cumulative"),
        out(later(3) - later(2), "Q3"),
        out(later(3), "Q3_cumulative"),
        out(later(4) - later(3), "Q4"),
        out(later(4), "Q4_cumulative"),
        *also,
    )


def cash_flow_table(itr: DataFrame, dfp: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return cash_flow_accounts(itr, dfp, also).select(*TABLE_COLUMNS, *also)


def cash_flow_quarterly(
    itr: DataFrame, dfp: DataFrame, own_year: bool = False, also: Sequence[str] = ()
) -> DataFrame:
    """Seven measures per company, year and quarter.

    Quarter ends are pinned to one year whatever the row's year; ``own_year``
    dates each quarter in its own year, which is what later joins need.
    """
    accounts = cash_flow_accounts(itr, dfp, also)

    def measure(target: str, q: int) -> Column:
        test = cash_flow_test(target)
        return F.expr(f"cast(sum(case when {test} then cast(Q{q} as {MONEY_SQL}) end) as double)")

    # All 28 sums in one aggregation, then four rows per company-year.
    wide = accounts.groupBy(*COMPANY_KEYS, *also).agg(*[
        measure(t, q).alias(f"m{i}q{q}") for q in QUARTERS for i, t in enumerate(CASH_FLOW_AMOUNTS)
    ])
    rows = [
        x for q in QUARTERS
        for x in (F.lit(q), *[F.col(f"m{i}q{q}") for i in range(len(CASH_FLOW_AMOUNTS))])
    ]
    stacked = wide.select(
        *COMPANY_KEYS, *also, F.stack(F.lit(4), *rows).alias("dt_quarter", *CASH_FLOW_AMOUNTS)
    )
    year, quarter = F.col("dt_year"), F.col("dt_quarter")
    end = quarter_end(year, quarter) if own_year else quarter_end_pinned(quarter)
    return stacked.withColumn("dt_fim_exerc", end).select(
        *CASH_FLOW_KEYS, *CASH_FLOW_AMOUNTS, *also
    )
