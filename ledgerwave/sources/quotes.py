"""Daily quotes as a provider delivers them: one row per date, one column per
(field, ticker)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerwave.sources.schemas import QUOTE_FIELDS, TICKER_REGISTRY

SEPARATOR = "|"


def tickers_of(wide: DataFrame) -> list[str]:
    """Tickers that a wide quote table has columns for."""
    return sorted({c.split(SEPARATOR, 1)[1] for c in wide.columns if SEPARATOR in c})


def quotes_long(
    wide: DataFrame,
    tickers: list[str] | None = None,
    date: str = "Date",
    fields: dict[str, str] = QUOTE_FIELDS,
) -> DataFrame:
    """One row per date and ticker with at least one quoted field.

    One array per field, with a place per ticker; the arrays are unfolded together,
    a narrow step: nothing is shuffled and nothing has to be pivoted back. The plan
    has a handful of expressions however many tickers there are. Without
    ``tickers`` they are read from the column names.
    """
    tickers = tickers_of(wide) if tickers is None else tickers
    have = set(wide.columns)

    def places(field: str) -> str:
        names = [f"{field}{SEPARATOR}{t}" for t in tickers]
        return ", ".join(
            "cast(`{}` as double)".format(n.replace("`", "``")) if n in have else "cast(null as double)" for n in names
        )

    listed = ", ".join("'{}'".format(t.replace("\\", "\\\\").replace("'", "\\'")) for t in tickers)
    arrays = wide.selectExpr(
        f"`{date}` as date", f"array({listed}) as ticker_list",
        *[f"array({places(field)}) as {name}" for field, name in fields.items()],
    )
    names = ["ticker_list", *fields.values()]
    long = arrays.select("date", F.explode(F.arrays_zip(*names)).alias("q")).select("date", "q.*")
    return long.filter(F.coalesce(*[F.col(c) for c in fields.values()]).isNotNull())


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Ticker registry, from comma-separated text or parquet by extension."""
    if path.endswith(".csv"):
        return spark.read.schema(TICKER_REGISTRY).option("header", True).csv(path)
    return spark.read.schema(TICKER_REGISTRY).parquet(path)


def attach_registry(quotes: DataFrame, registry: DataFrame) -> DataFrame:
    """Company and ticker ids of each quote, null where the registry lacks it.

    No broadcast hint: the planner broadcasts the registry while its measured
    size allows and falls back to a shuffled join beyond that.
    """
    return quotes.join(registry, "ticker_list", "left")
