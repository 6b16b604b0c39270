"""Company register, security register and the ticker universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerwave.functions.calendar import iso_date
from ledgerwave.functions.text import strip_accents, tax_id_digits
from ledgerwave.operators.columns import rename_catalog
from ledgerwave.sources.schemas import COMPANY_REGISTER_NAMES, SECURITY_REGISTER_NAMES

# Fixed values.
EXCHANGE = "bolsa"
LISTED_KINDS = ["acoes ordinarias", "acoes preferenciais", "units"]
TICKER_SUFFIX = ".SA"
UNIT_MARK, COMMON_MARK, PREFERRED_MARK = "11", "3", "4"
MIN_TICKER_LENGTH = 5


def _typed_register(
    df: DataFrame, names: dict[str, str], plain: list[str], lower: list[str], ints: list[str],
    also: Sequence[str],
) -> DataFrame:
    """Rename, then type every column in one projection.

    ``plain`` texts lose accents and read empty instead of null; ``lower`` ones
    are lower-cased; ``dt_`` columns that are not ints are ISO dates.
    """
    df = rename_catalog(df, names)
    out = []
    for name in names.values():
        c = F.col(name)
        if name == "id_cnpj":
            c = tax_id_digits(c)
        elif name in ints:
            c = c.try_cast("int")
        elif name.startswith("dt_"):
            c = iso_date(c)
        if name in plain:
            c = strip_accents(F.coalesce(c, F.lit("")))
        if name in lower:
            c = F.lower(c)
        out.append(c.alias(name))
    return df.select(*out, *also)


def register_company(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    plain = ["cat_sector", "text_sector", "txt_company_name"]
    return _typed_register(
        df, COMPANY_REGISTER_NAMES,
        plain=plain,
        lower=[*plain, "cat_cvm_register_situation", "cat_situation_issuer", "cat_country_origin"],
        ints=["dt_month_fiscal_end", "dt_year_fiscal_end"],
        also=also,
    )


def register_security(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    plain = ["text_market", "cat_governance_segmentation", "cat_stock_type", "cat_type_market"]
    return _typed_register(
        df, SECURITY_REGISTER_NAMES, plain=plain, lower=plain, ints=["qty_version"], also=also
    )


def listed_tickers(*registers: DataFrame) -> DataFrame:
    """Distinct live exchange tickers of typed security registers."""
    df = registers[0]
    for other in registers[1:]:
        df = df.unionByName(other)
    ticker = F.upper(F.col("id_ticker"))
    return (
        df.filter(
            (F.length("id_ticker") >= MIN_TICKER_LENGTH)
            & (F.col("cat_type_market") == EXCHANGE)
            & F.col("cat_stock_type").isin(LISTED_KINDS)
            & F.col("dt_end_listing").isNull()
        )
        .select("id_cnpj", ticker.alias("id_ticker"),
                F.concat(ticker, F.lit(TICKER_SUFFIX)).alias("ticker_list"))
        .distinct()
    )


def expand_units(tickers: DataFrame) -> DataFrame:
    """A unit ticker also stands for its common and its preferred share.

    Every occurrence of the unit mark is replaced, in both columns.
    """
    ticker, listed = F.col("id_ticker"), F.col("ticker_list")

    def version(mark: str):
        return F.when(ticker.contains(UNIT_MARK), F.struct(
            F.replace(ticker, F.lit(UNIT_MARK), F.lit(mark)).alias("id_ticker"),
            F.replace(listed, F.lit(UNIT_MARK), F.lit(mark)).alias("ticker_list"),
        ))

    versions = F.array_compact(F.array(
        F.struct("id_ticker", "ticker_list"), version(COMMON_MARK), version(PREFERRED_MARK)
    ))
    return tickers.select("id_cnpj", F.inline(versions)).distinct()


def ticker_universe(*registers: DataFrame) -> DataFrame:
    return expand_units(listed_tickers(*registers))
