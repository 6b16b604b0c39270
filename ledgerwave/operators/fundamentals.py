"""Statements joined with each other and with period-end prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerwave.functions.text import tax_id_digits
from ledgerwave.operators.prices import price_period_end
from ledgerwave.sources.schemas import FUNDAMENTALS_COLUMNS, UNSUPPLIED_AMOUNTS

PERIOD_KEYS = ["id_cvm", "id_cnpj", "txt_company_name", "dt_year", "dt_quarter", "dt_fim_exerc"]
TYPED_KEYS = [*PERIOD_KEYS, "cat_type_dre"]


def fundamentals_join(
    income: DataFrame, assets: DataFrame, liabilities: DataFrame, cash_flow: DataFrame
) -> DataFrame:
    """Income rows with the balance of the same chart type and the cash flow.

    All years at once. The keys include the period, so no company gathers more
    than its own few periods in one join key. Tables bucketed by company and year
    (``sources.buckets``) are joined as they lie, without exchange.
    """
    extra = ["dt_ini_exerc", "dt_refer", "processed_at"]
    return (
        income.drop("dt_ini_exerc", "dt_refer")
        .join(assets.drop(*extra), TYPED_KEYS, "left")
        .join(liabilities.drop(*extra), TYPED_KEYS, "left")
        .join(cash_flow.drop("processed_at"), PERIOD_KEYS, "left")
    )


def _with_company(df: DataFrame, clean: bool) -> DataFrame:
    return df.withColumn("id", tax_id_digits(F.col("id_cnpj")) if clean else F.col("id_cnpj"))


def _period_prices(prices: DataFrame) -> DataFrame:
    return price_period_end(prices).withColumnRenamed("id_cnpj", "id").drop("dt_date")


def fundamentals_price(
    fundamentals: DataFrame, prices: DataFrame, how: str = "left", clean: bool = True
) -> DataFrame:
    """Each company-period with the period-end price of every ticker it has.

    ``clean=False`` takes tax ids as they are, where they are digits already (all
    statement tables): a bucketed table then keeps its layout in the join.
    """
    return _with_company(fundamentals, clean).join(
        _period_prices(prices), ["id", "dt_year", "dt_quarter"], how
    )


def fundamentals_price_inner(
    income: DataFrame, assets: DataFrame, liabilities: DataFrame, prices: DataFrame
) -> DataFrame:
    """Draft integration: statements of one processing day, priced periods only."""
    keys = ["id_cvm", "id_cnpj", "txt_company_name", "dt_year", "dt_quarter", "processed_at"]

    def amounts(df: DataFrame) -> DataFrame:
        return df.select(*keys, *[c for c in df.columns if c.startswith("amt_")])

    joined = (
        amounts(income)
        .join(amounts(assets), keys, "left")
        .join(amounts(liabilities), keys, "left")
    )
    return fundamentals_price(joined, prices, how="inner", clean=False)


def with_profit_measures(df: DataFrame) -> DataFrame:
    """Broad and restricted profit before and after an estimated tax."""
    pretax = F.col("amt_earnings_before_income_tax_and_social_contribution")
    equity = F.col("amt_equity_equivalence")
    ebit = pretax + F.abs(F.col("amt_financial_expenses"))
    rate = F.try_divide(
        F.abs(F.col("amt_income_tax_social_contribution_on_profit")), F.abs(pretax) + F.abs(equity)
    )
    tax = rate * ebit
    return df.withColumns({
        "ebit_amplo": ebit,
        "provisao_ircs_ampla": tax + equity,
        "nopat_amplo": ebit - (tax + equity),
        "ebit_restrit": ebit - F.col("amt_financial_income") + equity,
        "provisao_ircs_restrita": tax,
    })


def integrated_fundamentals(
    income: DataFrame, assets: DataFrame, liabilities: DataFrame, cash_flow: DataFrame,
    prices: DataFrame,
) -> DataFrame:
    """The integrated table: 58 columns and the derived profit measures.

    Amounts that no statement supplies are typed nulls.
    """
    df = fundamentals_price(
        fundamentals_join(income, assets, liabilities, cash_flow), prices, clean=False
    ).withColumns({c: F.lit(None).cast("double") for c in UNSUPPLIED_AMOUNTS})
    df = df.withColumn("dt_fim_exerc", F.col("dt_fim_exerc").cast("string"))
    return with_profit_measures(df.select(*FUNDAMENTALS_COLUMNS))
