"""Monitoring: does each chart report the accounts it should?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerwave.operators import charts
from ledgerwave.operators.statements import line_keys, types_found, unfold_types
from ledgerwave.sources.schemas import INCOME_KEYS


def account_coverage(lines: DataFrame) -> DataFrame:
    """Per period, chart and expected account: companies, and how many report it.

    ``lines`` are cleaned income lines. They are folded once per company-period
    into one flag per expected account; only those rows are counted.
    """
    raw_keys = line_keys(INCOME_KEYS)
    expected = sorted({item for items in charts.COVERAGE.values() for item in items})
    flag = {item: f"f{i}" for i, item in enumerate(expected)}
    per_company = unfold_types(lines.groupBy(*raw_keys).agg(
        *types_found(charts.INCOME, raw_keys),
        *[F.expr(f"coalesce(max({charts.covers(i)}), false)").alias(flag[i]) for i in expected],
    ))
    counted = per_company.groupBy("dt_year", "dt_quarter", "cat_type_dre").agg(
        F.count(F.lit(1)).alias("n_companies"),
        *[F.expr(f"count_if({flag[i]})").alias(flag[i]) for i in expected],
    )
    rows = ", ".join(
        f"if(cat_type_dre = '{kind}', "
        f"named_struct('id_account', '{item}', 'n_reporting', {flag[item]}), null)"
        for kind, items in charts.COVERAGE.items() for item in items
    )
    return counted.selectExpr(
        "dt_year", "dt_quarter", "cat_type_dre", "n_companies",
        f"inline(array_compact(array({rows})))",
    )
