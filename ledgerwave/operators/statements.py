"""Statement lines -> one wide row per company, period and chart type.

The chart of a company is decided by its own lines, and one company-period may
match several charts: each match yields a row. Instead of joining the lines
back to their types (which repeats every line once per type), the lines are
aggregated once per company-period, with one conditional sum per (chart,
amount); the types found are then unfolded from that single small row. The only
shuffle of line-sized data is the map-side-combined aggregation, so a company
holding a third of all lines costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwave.functions.calendar import exercise_months, iso_date
from ledgerwave.functions.money import MONEY_SQL, exact, scaled
from ledgerwave.functions.text import label_slug, tax_id_digits, transliterate
from ledgerwave.operators import charts
from ledgerwave.operators.columns import lower_names, rename_catalog
from ledgerwave.sources.schemas import (
    BALANCE_KEYS, CASH_FLOW_AMOUNTS, CASH_FLOW_KEYS, CASH_FLOW_NAMES, INCOME_KEYS, STATEMENT_NAMES,
)

CURRENT_EXERCISE = "ÚLTIMO"
ANNUAL_MONTHS, QUARTERLY_MONTHS = 12, 3


def current_exercise(lines: DataFrame) -> DataFrame:
    """Drop the prior-year comparison lines that every file repeats."""
    return lines.filter(F.col("ordem_exerc") == CURRENT_EXERCISE)


def clean_lines(
    lines: DataFrame,
    months: int | None = None,
    fill_label: bool = False,
    label_codes: list[str] | None = None,
) -> DataFrame:
    """Current lines with typed dates, period, unit-scale value and label key.

    ``months`` keeps exercises of that length only; the other accumulated
    exercises in the same file would count a quarter twice. ``label_codes``
    builds the label key for those account codes alone (null elsewhere), where
    no rule reads it on other lines.
    """
    df = current_exercise(lower_names(lines))
    dates = [c for c in ("dt_refer", "dt_ini_exerc", "dt_fim_exerc") if c in df.columns]
    df = df.withColumns({c: iso_date(F.col(c)) for c in dates})
    if months is not None:
        df = df.filter(exercise_months(F.col("dt_ini_exerc"), F.col("dt_fim_exerc")) == months)
    label = F.coalesce(F.col("ds_conta"), F.lit("")) if fill_label else F.col("ds_conta")
    code, key = F.trim(F.col("cd_conta")), label_slug(label)
    return df.withColumns({
        "dt_year": F.year("dt_refer"),
        "dt_quarter": F.quarter("dt_refer"),
        "vl_conta": scaled(F.col("vl_conta"), F.col("escala_moeda")),
        "cd_conta": code,
        "ds_conta": key if label_codes is None else F.when(code.isin(label_codes), key),
    })


def line_keys(keys: list[str]) -> list[str]:
    """Key names as the raw lines carry them."""
    raw = {new: old for old, new in STATEMENT_NAMES.items()}
    return [raw.get(k, k) for k in keys if k != "cat_type_dre"]


def types_found(chart: charts.Chart, keys: list[str]) -> list[Column]:
    """One flag per chart type: some line of the group points to it.

    A group with a null key never finds its type, as an equality join on those
    keys would not either.
    """
    whole_key = " and ".join(f"{k} is not null" for k in keys)
    return [
        F.expr(f"max({whole_key} and ({chart.type_of_line()}) <=> '{rule.chart}')")
        .alias(f"is_{rule.chart}")
        for rule in chart.types
    ]


def unfold_types(df: DataFrame) -> DataFrame:
    """One row per chart type found; one untyped row where none was."""
    found = ", ".join(f"if(is_{c}, '{c}', null)" for c in charts.CHARTS)
    return df.withColumn(
        "cat_type_dre", F.expr(f"explode_outer(array_compact(array({found})))")
    ).drop(*[f"is_{c}" for c in charts.CHARTS])


def chart_types(
    lines: DataFrame, chart: charts.Chart, keys: list[str], also: Sequence[str] = ()
) -> DataFrame:
    """Company-periods with each chart type they match (null when none)."""
    raw_keys = line_keys(keys)
    return unfold_types(lines.groupBy(*raw_keys, *also).agg(*types_found(chart, raw_keys)))


Deal = Callable[[DataFrame], DataFrame]


def wide_statement(
    lines: DataFrame, chart: charts.Chart, keys: list[str], deal: Deal | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Cleaned lines -> keys, chart type and the chart's amounts.

    ``also`` names further keys, such as the year of the source file: statements of
    all files are made in one pass and never mix the lines of two files.
    ``deal`` lays the rows out for a bucketed table; the last aggregation then
    happens inside that layout instead of in an exchange of its own.
    """
    raw_keys = line_keys(keys)
    kinds = [*charts.CHARTS, None]
    tests = {(t, k): chart.test_for(t, k) for t in chart.targets for k in kinds}
    # Charts that take the same lines share one sum.
    sums = {test: f"s{i}" for i, test in enumerate(dict.fromkeys(filter(None, tests.values())))}
    partial = lines.groupBy(*raw_keys, *also).agg(
        *types_found(chart, raw_keys),
        *[F.expr(f"sum(case when {test} then cast(vl_conta as {MONEY_SQL}) end)").alias(name)
          for test, name in sums.items()],
    )

    def amount(target: str) -> str:
        picked = {k: sums.get(tests[target, k], f"cast(null as {MONEY_SQL})") for k in kinds}
        cases = " ".join(
            f"when '{k}' then {picked[k]}" for k in charts.CHARTS if picked[k] != picked[None]
        )
        return f"case cat_type_dre {cases} else {picked[None]} end as {target}"

    typed = unfold_types(partial).selectExpr(
        *raw_keys, *also, "cat_type_dre", *[amount(t) for t in chart.targets]
    ).withColumnsRenamed(STATEMENT_NAMES)
    # Two spellings of one tax id were two groups above and are one row here;
    # this aggregation sees one row per company-period, not lines.
    typed = typed.withColumn("id_cnpj", tax_id_digits(F.col("id_cnpj")))
    return (deal(typed) if deal else typed).groupBy(*keys, *also).agg(
        *[F.expr(f"cast(sum({t}) as double)").alias(t) for t in chart.targets]
    )


def typed_lines(
    lines: DataFrame, chart: charts.Chart, keys: list[str], also: Sequence[str] = ()
) -> DataFrame:
    """Cleaned lines with the chart type(s) of their company-period.

    The types side has one row per company-period; a company with very many
    lines is split by the adaptive skew join.
    """
    raw_keys = line_keys(keys)
    types = chart_types(lines, chart, keys, also).filter(F.col("cat_type_dre").isNotNull())
    df = lines.join(types, [*raw_keys, *also], "left").withColumnsRenamed(STATEMENT_NAMES)
    return df.withColumn("id_cnpj", tax_id_digits(F.col("id_cnpj")))


def income_statement(
    lines: DataFrame, annual: bool, deal: Deal | None = None, also: Sequence[str] = ()
) -> DataFrame:
    cleaned = clean_lines(lines, ANNUAL_MONTHS if annual else QUARTERLY_MONTHS, fill_label=True)
    return wide_statement(cleaned, charts.INCOME, INCOME_KEYS, deal, also)


def income_lines(lines: DataFrame, annual: bool, also: Sequence[str] = ()) -> DataFrame:
    cleaned = clean_lines(lines, ANNUAL_MONTHS if annual else QUARTERLY_MONTHS, fill_label=True)
    cleaned = cleaned.withColumn(
        "dt_months_exercise", exercise_months(F.col("dt_ini_exerc"), F.col("dt_fim_exerc"))
    )
    return typed_lines(cleaned, charts.INCOME, INCOME_KEYS, also)


def balance_lines(lines: DataFrame, chart: charts.Chart) -> DataFrame:
    """Balance sheets read labels only on the lines that decide the chart."""
    return clean_lines(lines, label_codes=sorted({rule.code for rule in chart.types}))


def balance_assets(
    lines: DataFrame, deal: Deal | None = None, also: Sequence[str] = ()
) -> DataFrame:
    cleaned = balance_lines(lines, charts.ASSETS)
    return wide_statement(cleaned, charts.ASSETS, BALANCE_KEYS, deal, also)


def balance_liabilities(
    lines: DataFrame, deal: Deal | None = None, also: Sequence[str] = ()
) -> DataFrame:
    cleaned = balance_lines(lines, charts.LIABILITIES)
    return wide_statement(cleaned, charts.LIABILITIES, BALANCE_KEYS, deal, also)


def cash_flow_lines(lines: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Current cash-flow lines; their period follows the end of the exercise."""
    df = current_exercise(rename_catalog(lines, CASH_FLOW_NAMES))
    end = iso_date(F.col("dt_fim_exerc"))
    return df.select(
        "id_cvm",
        tax_id_digits(F.col("id_cnpj")).alias("id_cnpj"),
        "txt_company_name",
        end.alias("dt_fim_exerc"),
        F.year(end).alias("dt_year"),
        F.quarter(end).alias("dt_quarter"),
        "id_account",
        "txt_account",
        exact(scaled(F.col("amt_account"), F.col("escala_moeda"))).alias("amt_account"),
        *also,
    )


def cash_flow_annual(lines: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Annual cash flow: seven measures per company and exercise end."""
    df = cash_flow_lines(lines, also)
    label = F.lower(transliterate(F.coalesce(F.col("txt_account"), F.lit(""))))
    df = df.withColumn("txt_account", label)
    return df.groupBy(*CASH_FLOW_KEYS, *also).agg(*[
        F.expr(f"cast(sum(case when {charts.cash_flow_test(t)} then amt_account end) as double)")
        .alias(t)
        for t in CASH_FLOW_AMOUNTS
    ])
