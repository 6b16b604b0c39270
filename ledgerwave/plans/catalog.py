"""Registered queries: every operator, run over star-schema tables.

Each query takes (spark, folder). Ratios and moving statistics are rounded here,
at the edge, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerwave.functions import calendar, text
from ledgerwave.functions.money import exact, sum_amount
from ledgerwave.operators import (
    cashflow, charts, columns, features as ft, fundamentals, prices, quality, quarters, registry,
    statements,
)
from ledgerwave.plans import feature_sets as fs, preprocess, standins as src
from ledgerwave.session import scratch_path, stored
from ledgerwave.sources import buckets, lake, quotes, schemas
from ledgerwave.streaming import appends

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROCESSED = "2024-01-31"
DAY_AFTER = "1998-06-16"
PERIOD = 20
STATE_KEPT = "1 day"
LONG_BLOCK = 5_000  # rows of an entity from which it is cut here
# Bars hold one row per company, ticker and calendar day, statements one per
# company and quarter: those entities are short however large the tables are.
SHORT = None


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(name: str, digits: int) -> Column:
    """Rounded, with negative zero turned into zero."""
    return F.expr(ft.round_sql(name, digits))


def feature_digits(names: list[str], mean_digits: int = 6) -> dict[str, int]:
    """Decimals by kind of feature."""
    digits = {
        "pct_": 6, "amt_beta_": 6, "amt_IFR_": 4, "amt_avg_": mean_digits, "amt_std_": 1,
        "amt_var_": -3,
    }
    return {name: d for name in names for prefix, d in digits.items() if name.startswith(prefix)}


def round_features(df: DataFrame, mean_digits: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(c, d) for c, d in feature_digits(df.columns, mean_digits).items()})


# --- sources and sinks -------------------------------------------------------

@query
def scan_delimited(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines-csv")
    lines = src.statement_lines(spark, folder, "income", annual=False)
    (
        lines.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    df = lake.scan_delimited(spark, path, schemas.STATEMENT_LINES)
    return columns.lower_names(df).select(
        "cnpj_cia", "dt_refer", "denom_cia", "cd_conta", "ds_conta", "vl_conta"
    )


@query
def scan_file_year(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "files-by-year")
    orders = src.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"),
        F.year("o_orderdate").alias("file_year"),
    )
    writer = orders.hint("rebalance", F.col("file_year")).write
    writer.option("header", True).option("sep", ";").partitionBy("file_year").csv(path)
    df = lake.scan_delimited_text(spark, f"{path}/*", ["o_orderkey", "o_totalprice"])
    return lake.with_file_year(df).groupBy("dt_file_year").agg(
        F.count(F.lit(1)).alias("n_lines"),
        sum_amount(F.col("o_totalprice")).alias("amt_total"),
    )


@query
def multi_year_union(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "income")
    lake.write_table(_income(spark, folder, annual=True), path, partition_by=["dt_year"])
    return lake.scan_years(spark, path, range(1990, 2000), schemas.INCOME_WIDE).select(
        "id_cvm", "dt_year", "cat_type_dre", "amt_sales_revenue", "amt_net_profit"
    )


@query
def scan_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Statement files in which some lines have an amount or a version that is no
    number: lines that parse and, raw, lines that do not."""
    path, code = scratch_path(spark, "broken-csv"), F.col("CD_CONTA")
    lines = src.statement_lines(spark, folder, "income", annual=False).withColumns({
        "VL_CONTA": F.when(code == "3.05", "n/d").otherwise(F.col("VL_CONTA").cast("string")),
        "VERSAO": F.when(code == "3.08", "v2").otherwise(F.col("VERSAO").cast("string")),
    })
    writer = lines.select(*schemas.STATEMENT_LINES.names).write.option("header", True)
    writer.option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    good, bad = lake.scan_with_quarantine(
        spark, path, schemas.STATEMENT_LINES, scratch_path(spark, "quarantine")
    )
    return good.select(
        F.lit(False).alias("is_corrupt"), F.col("CD_CVM").alias("cd_cvm"), F.col("CD_CONTA").alias("cd_conta"),
        F.col("VL_CONTA").alias("vl_conta"), F.lit(None).cast("string").alias("raw"),
    ).unionByName(bad.select(
        F.lit(True).alias("is_corrupt"), F.lit(None).cast("string").alias("cd_cvm"),
        F.lit(None).cast("string").alias("cd_conta"), F.lit(None).cast("double").alias("vl_conta"),
        F.regexp_replace(lake.CORRUPT, ";(-?[0-9.E]+)?;S$", ";;S").alias("raw"),
    ))


@query
def missing_years(spark: SparkSession, folder: str) -> DataFrame:
    """Annual income of which two yearly tables exist, and quarterly income of
    which none does: all typed columns, rows of the years there are."""
    root = scratch_path(spark, "yearly")
    income = stored(_income(spark, folder, annual=True), "income")
    for year in (1994, 1996):
        lake.write_table(income.filter(F.col("dt_year") == year), f"{root}/pp_dfp_dre_{year}.parquet")
    years = range(1990, 2000)
    some = lake.scan_yearly_files(spark, root, "dfp_dre", years, schemas.INCOME_WIDE)
    none = lake.scan_years(spark, f"{root}/pp_itr_dre", years, schemas.INCOME_WIDE)
    return some.unionByName(none)


@query
def preprocess_lake(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text files of all kinds and years through one run, and a second run
    over some years of one kind; rows and amounts of every table and slice."""
    root = scratch_path(spark, "lake")
    raw, processed = f"{root}/raw", f"{root}/processed"
    src.raw_files(spark, folder, raw)
    folders = preprocess.Lake(raw, processed)
    tables = preprocess.preprocess_lake(spark, folders, range(1990, 2024), PROCESSED)
    preprocess.preprocess_lake(spark, folders, (1995, 1996), PROCESSED, ["dfp_dre"])
    each = []
    for table in tables:
        df = spark.read.parquet(table)
        amounts = [c for c in df.columns if c.startswith("amt_") or c in ("vl_conta", "Q1", "Q2", "Q3", "Q4")]
        total = sum((F.coalesce(exact(F.col(c)), F.lit(0).cast("decimal(20,2)")) for c in amounts), F.lit(0))
        each.append(df.groupBy(preprocess.FILE_YEAR).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(total).cast("double").alias("amt_total")
        ).withColumn("table_name", F.lit(table.rsplit("/pp_", 1)[1])))
    return reduce(DataFrame.unionByName, each)


@query
def sink_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "prices")
    days = src.daily_prices(spark, folder).withColumn("dt_year", F.year("dt_date"))
    broken = days.withColumn("amt_adj_close", F.when(F.col("dt_year") != 1997, F.col("amt_adj_close")))
    lake.write_table(broken, path, partition_by=["dt_year"], sort_by=["id_ticker", "dt_date"])
    lake.write_table(
        days.filter(F.col("dt_year") == 1997), path, partition_by=["dt_year"], skip_empty=True
    )
    lake.write_table(days.filter(F.col("dt_year") == 1900), path, ["dt_year"], skip_empty=True)
    return spark.read.parquet(path).select("dt_date", "id_ticker", "amt_adj_close", "dt_year")


@query
def price_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two files that share their days, the second holding other tickers and a
    repeated delivery; partitioned by month to keep the number of files low."""
    path = scratch_path(spark, "prices")
    days = src.daily_prices(spark, folder).withColumn(
        "dt_month", F.trunc("dt_date", "month")
    ).select(*schemas.PRICE_COLUMNS, "dt_month")
    first = F.crc32("id_ticker") % 2 == 0
    keys = ["dt_date", "id_cnpj", "id_ticker"]
    lake.append_days(days.filter(first), path, "dt_month", keys)
    lake.append_days(days.filter(~first).unionByName(days), path, "dt_month", keys)
    return spark.read.parquet(path).select("dt_date", "id_ticker", "amt_adj_close", "qty_volume")


@query
def price_append_stream(spark: SparkSession, folder: str) -> DataFrame:
    source = f"{folder}/events*.parquet"
    schema = spark.read.parquet(source).schema
    target = scratch_path(spark, "events")
    for delivery in ("first", "second"):
        stream = appends.landing_stream(spark, source, schema).select(
            "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("dt_date")
        )
        checkpoint = scratch_path(spark, f"checkpoint-{delivery}")
        appends.append_prices(stream, target, checkpoint, ["event_id", "dt_date"], "dt_date")
    return spark.read.parquet(target).select(
        "event_id", "user_id", "event_type", "value", F.col("dt_date").cast("date").alias("dt_date")
    )


@query
def stream_dedupe_state(spark: SparkSession, folder: str) -> DataFrame:
    """Events in two deliveries, the second of all events after a restart from the
    checkpoint. State is kept for a day of event time: repeated events within it
    are dropped, and so are events behind the watermark of the first delivery."""
    landing, target, checkpoint = (scratch_path(spark, x) for x in ("landing", "events", "checkpoint"))
    events = src.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    for delivery in (events.filter(F.col("event_id") % 3 != 0), events):
        delivery.write.mode("append").parquet(landing)
        appends.append_new_events(
            appends.landing_stream(spark, landing, events.schema), target, checkpoint, ["event_id"], "ts", STATE_KEPT
        )
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query
def quotes_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    wide, tickers = src.wide_quotes(spark, folder)
    return quotes.quotes_long(wide, tickers)


@query
def quotes_many_tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Tickers taken from the columns of a wide table of many, as delivered."""
    delivered = stored(src.many_quotes(spark, folder), "wide-quotes")
    return quotes.quotes_long(delivered, fields={"High": "high", "Low": "low"})


@query
def quotes_attach_registry(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.attach_registry(
        quotes_unpivot(spark, folder), src.ticker_registry(spark, folder)
    ).select("date", "ticker_list", "id_cnpj", "id_ticker", "adj_close")


@query
def typed_quotes(spark: SparkSession, folder: str) -> DataFrame:
    linked = quotes.attach_registry(
        quotes_unpivot(spark, folder), src.ticker_registry(spark, folder)
    )
    return prices.typed_quotes(linked)


# --- projections, filters, casts ---------------------------------------------

@query
def rename_catalog(spark: SparkSession, folder: str) -> DataFrame:
    register = src.security_register(spark, folder)
    names = {**schemas.SECURITY_REGISTER_NAMES, "not_there": "ignored"}
    return columns.rename_catalog(register, names)


@query
def stamp_processed_at(spark: SparkSession, folder: str) -> DataFrame:
    return columns.stamp_processed_at(src.table(spark, folder, "supplier"), PROCESSED)


@query
def statement_current_only(spark: SparkSession, folder: str) -> DataFrame:
    lines = columns.lower_names(src.statement_lines(spark, folder, "income", annual=True))
    return statements.current_exercise(lines).select("cd_cvm", "dt_refer", "cd_conta", "vl_conta")


@query
def statement_exercise_months(spark: SparkSession, folder: str) -> DataFrame:
    lines = columns.lower_names(
        src.statement_lines(spark, folder, "income", annual=False).unionByName(
            src.statement_lines(spark, folder, "income", annual=True)
        )
    )
    start, end = (calendar.iso_date(F.col(c)) for c in ("dt_ini_exerc", "dt_fim_exerc"))
    return (
        lines.groupBy(start.alias("dt_ini_exerc"), end.alias("dt_fim_exerc"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .withColumn("dt_months_exercise",
                    calendar.exercise_months(F.col("dt_ini_exerc"), F.col("dt_fim_exerc")))
    )


@query
def scale_currency(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = statements.clean_lines(src.statement_lines(spark, folder, "income", annual=True))
    return cleaned.groupBy("cd_cvm", "escala_moeda").agg(
        sum_amount(F.col("vl_conta")).alias("amt_total")
    )


@query
def null_fill(spark: SparkSession, folder: str) -> DataFrame:
    register = src.company_register(spark, folder)
    filled = columns.fill_text(register, ["Situacao_Emissor"])
    return filled.select("ID_Documento", "Situacao_Emissor", "Pais_Origem")


@query
def null_fill_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Texts, whole numbers and doubles with nulls and NaN, filled by column type."""
    key = F.col("doc_id")
    holes = src.table(spark, folder, "documents").select(
        "doc_id", F.when(key % 3 != 0, F.col("lang")).alias("lang"), F.when(key % 4 != 0, F.col("source")).alias("source"),
        F.when(key % 5 != 0, F.col("n_chars")).alias("n_chars"),
        F.when(key % 7 == 0, float("nan")).when(key % 2 == 0, F.col("n_chars") / 4).alias("amt_quarter"),
    )
    return columns.fill_by_type(holes)


@query
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return columns.null_profile(
        columns.lower_names(src.statement_lines(spark, folder, "income", annual=False))
    )


@query
def price_day_filter(spark: SparkSession, folder: str) -> DataFrame:
    days = src.daily_prices(spark, folder)
    return prices.price_day_filter(days, DAY_AFTER, date="dt_date").select(
        "dt_date", "id_ticker", "amt_adj_close", "amt_high", "amt_low", "amt_open"
    )


@query
def sorted_output(spark: SparkSession, folder: str) -> DataFrame:
    return src.daily_prices(spark, folder).orderBy("dt_date", "id_ticker").select(
        "dt_date", "id_ticker", "amt_adj_close"
    )


# --- scalar functions --------------------------------------------------------

def _document_text(spark: SparkSession, folder: str, clean: Callable[[Column], Column]) -> DataFrame:
    cleaned = clean(F.col("text"))
    documents = src.spread(src.table(spark, folder, "documents"))
    return documents.select("doc_id", cleaned.alias("t")).select(
        "doc_id", F.md5("t").alias("txt_hash"), F.char_length("t").cast("long").alias("n_chars")
    )


@query
def label_slug(spark: SparkSession, folder: str) -> DataFrame:
    return _document_text(spark, folder, text.label_slug)


@query
def label_slug_spaced(spark: SparkSession, folder: str) -> DataFrame:
    return _document_text(spark, folder, text.label_slug_spaced)


@query
def strip_accents(spark: SparkSession, folder: str) -> DataFrame:
    return _document_text(spark, folder, text.strip_accents)


@query
def text_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return src.table(spark, folder, "conversations").select(
        "conv_id", "turn", text.text_pattern(F.col("text")).alias("txt_pattern")
    )


@query
def taxid_digits(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return src.table(spark, folder, "customer").select(
        "c_custkey", text.tax_id_digits(src.company_id(key)).alias("id_cnpj")
    )


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    register = src.company_register(spark, folder)
    return register.select(
        F.col("ID_Documento").alias("id_document"),
        calendar.iso_date(F.col("Data_Referencia")).alias("dt_refer"),
        calendar.iso_date(F.col("Data_Registro_CVM")).alias("dt_cvm_register"),
    )


@query
def period_columns(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return src.table(spark, folder, "orders").groupBy(
        F.year(day).alias("dt_year"), F.quarter(day).alias("dt_quarter")
    ).agg(F.count(F.lit(1)).alias("n_orders"))


@query
def quarter_bounds(spark: SparkSession, folder: str) -> DataFrame:
    year, quarter = F.col("dt_year"), F.col("dt_quarter")
    end = calendar.quarter_end(year, quarter)
    return period_columns(spark, folder).select(
        "dt_year", "dt_quarter",
        end.alias("dt_quarter_end"),
        calendar.quarter_end_pinned(quarter).alias("dt_quarter_end_pinned"),
        calendar.quarter_start(end).alias("dt_two_months_before"),
    )


# --- registers ---------------------------------------------------------------

@query
def register_company(spark: SparkSession, folder: str) -> DataFrame:
    df = registry.register_company(src.company_register(spark, folder))
    return df.withColumn("text_sector", F.md5("text_sector"))


@query
def register_security(spark: SparkSession, folder: str) -> DataFrame:
    return registry.register_security(src.security_register(spark, folder))


def _registers(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [
        registry.register_security(src.security_register(spark, folder, half)) for half in (0, 1)
    ]


@query
def ticker_universe(spark: SparkSession, folder: str) -> DataFrame:
    return registry.ticker_universe(*_registers(spark, folder))


@query
def ticker_units(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.upper("p_brand")
    tickers = src.table(spark, folder, "part").select(
        F.col("p_type").alias("id_cnpj"), brand.alias("id_ticker"),
        F.concat(brand, F.lit(registry.TICKER_SUFFIX)).alias("ticker_list"),
    ).distinct()
    return registry.expand_units(tickers)


# --- statements --------------------------------------------------------------

def _income(spark: SparkSession, folder: str, annual: bool) -> DataFrame:
    return statements.income_statement(
        src.statement_lines(spark, folder, "income", annual), annual
    )


def _cash_flow(spark: SparkSession, folder: str, annual: bool) -> DataFrame:
    annual_lines = src.cash_flow_filings(spark, folder, annual=True)
    if annual:
        return statements.cash_flow_annual(annual_lines)
    quarterly = src.cash_flow_filings(spark, folder, annual=False)
    return cashflow.cash_flow_quarterly(quarterly, annual_lines, own_year=True)


@query
def classify_chart(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.statement_lines(spark, folder, "assets", annual=False)
    cleaned = statements.balance_lines(lines, charts.ASSETS)
    return statements.chart_types(cleaned, charts.ASSETS, schemas.BALANCE_KEYS)


@query
def income_statement(spark: SparkSession, folder: str) -> DataFrame:
    return _income(spark, folder, annual=False)


@query
def income_statement_annual(spark: SparkSession, folder: str) -> DataFrame:
    return _income(spark, folder, annual=True)


@query
def income_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.statement_lines(spark, folder, "income", annual=False)
    return statements.income_lines(lines, annual=False).select(
        "id_cvm", "id_cnpj", "txt_company_name", "dt_refer", "dt_fim_exerc", "dt_year",
        "dt_quarter", "cd_conta", "ds_conta", "vl_conta", "cat_type_dre", "dt_months_exercise",
    )


@query
def balance_assets(spark: SparkSession, folder: str) -> DataFrame:
    return statements.balance_assets(src.statement_lines(spark, folder, "assets", annual=False))


@query
def balance_liabilities(spark: SparkSession, folder: str) -> DataFrame:
    return statements.balance_liabilities(
        src.statement_lines(spark, folder, "liabilities", annual=False)
    )


@query
def cash_flow_annual(spark: SparkSession, folder: str) -> DataFrame:
    return _cash_flow(spark, folder, annual=True)


def _cash_flow_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        src.cash_flow_filings(spark, folder, annual=False),
        src.cash_flow_filings(spark, folder, annual=True),
    )


@query
def cash_flow_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    return cashflow.cash_flow_quarterly(*_cash_flow_pair(spark, folder))


@query
def cash_flow_quarterly_own_year(spark: SparkSession, folder: str) -> DataFrame:
    return cashflow.cash_flow_quarterly(*_cash_flow_pair(spark, folder), own_year=True)


@query
def cash_flow_table(spark: SparkSession, folder: str) -> DataFrame:
    return cashflow.cash_flow_table(*_cash_flow_pair(spark, folder))


@query
def account_coverage(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.statement_lines(spark, folder, "income", annual=False)
    return quality.account_coverage(
        statements.clean_lines(lines, statements.QUARTERLY_MONTHS, fill_label=True)
    )


# --- quarters ----------------------------------------------------------------

def _income_pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Quarterly and annual income as stored tables, as the jobs leave them.

    The quarter operators read each table more than once; stored, the lines
    behind it are aggregated once (statement features at sf0.1: 31 s, against 46 s
    where the readers share exchanges only).
    """
    itr, dfp = (
        stored(columns.stamp_processed_at(_income(spark, folder, annual), PROCESSED), "income")
        for annual in (False, True)
    )
    return itr, dfp


@query
def complete_years(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.complete_years(*_income_pair(spark, folder))


@query
def last_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.last_quarter(*_income_pair(spark, folder))


@query
def last_quarter_legacy(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.last_quarter_legacy(*_income_pair(spark, folder))


@query
def income_union(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.income_union(*_income_pair(spark, folder))


@query
def income_union_legacy(spark: SparkSession, folder: str) -> DataFrame:
    """The union that takes the older fourth quarter: eight amounts, no type."""
    return quarters.income_union(*_income_pair(spark, folder), legacy=True)


def _filings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as filings: many ties per company and quarter."""
    day = F.col("l_shipdate").cast("date")
    return src.table(spark, folder, "lineitem").select(
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("id_cnpj"),
        F.year(day).alias("dt_year"), F.quarter(day).alias("dt_quarter"),
        F.when(F.col("l_discount") > 0, F.date_add(day, (F.col("l_linenumber") % 2).cast("int")))
        .alias("dt_fim_exerc"),
        "l_partkey", "l_extendedprice",
    )


@query
def dedupe_subset(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.dedupe_subset(
        _filings(spark, folder), ["id_cnpj", "dt_year", "dt_quarter", "dt_fim_exerc"]
    )


@query
def dedupe_running_count(spark: SparkSession, folder: str) -> DataFrame:
    return quarters.dedupe_running_count(_filings(spark, folder))


# --- window features ---------------------------------------------------------

def _bars(spark: SparkSession, folder: str) -> DataFrame:
    return fs.price_base(src.daily_prices(spark, folder)).select(
        "id_cnpj", "ticker", "date", "dt_year", "dt_quarter", "adj_close", "high_price",
        "low_price", "amplitude_close_high_price",
    )


def _on_bars(spark: SparkSession, folder: str, *wanted: ft.Feature) -> DataFrame:
    bars = _bars(spark, folder).select("id_cnpj", "ticker", "date", "adj_close", "low_price")
    done = ft.with_features(bars, list(wanted), fs.PRICE_KEYS, fs.PRICE_ORDER, SHORT)
    return round_features(done.drop("low_price"))


@query
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(
        spark, folder, ft.lag_feature("adj_close", 1, "d"),
        ft.lag_feature("adj_close", 5, period_text="1w"),
    )


@query
def pct_change(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.pct_change("adj_close", 5, "d"))


@query
def rolling_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.moving("adj_close", PERIOD, "mean"))


@query
def rolling_std(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.moving("adj_close", PERIOD, "std"))


@query
def rolling_var(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.moving("adj_close", PERIOD, "var"))


@query
def rolling_min(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.moving("adj_close", PERIOD, "min"))


@query
def rolling_max(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.moving("adj_close", PERIOD, "max"))


@query
def rolling_beta(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.beta("adj_close", PERIOD))


@query
def rolling_beta_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.beta("adj_close", PERIOD, fixed=True))


@query
def broke_high(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.broke_high("adj_close", PERIOD))


@query
def broke_low(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(
        spark, folder, ft.broke_low("low_price", PERIOD),
        ft.broke_low("low_price", PERIOD, fixed=True),
    )


@query
def ifr(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.ifr("adj_close", PERIOD))


@query
def ifr_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, ft.ifr("adj_close", PERIOD, fixed=True))


@query
def features_long_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Windows over five entities that hold a fifth of all rows each."""
    events = src.table(spark, folder, "events").select(
        "event_type", "ts", "event_id", (F.col("value") * 100).alias("value")
    ).withColumn("value", F.floor("value").cast("double"))
    wanted = [
        ft.lag_feature("value", 3, "d"), ft.pct_change("value", 5, "d"),
        ft.moving("value", PERIOD, "mean"), ft.moving("value", PERIOD, "max"),
        ft.broke_high("value", PERIOD), ft.ifr("value", 10),
    ]
    done = ft.with_features(events, wanted, ["event_type"], ["ts", "event_id"], LONG_BLOCK)
    return round_features(done.drop("ts"))


def _price_features(spark: SparkSession, folder: str, wanted: list[ft.Feature]) -> DataFrame:
    digits = feature_digits([f.name for f in wanted])
    return ft.with_features(_bars(spark, folder), wanted, fs.PRICE_KEYS, fs.PRICE_ORDER, SHORT, digits)


@query
def price_features_1(spark: SparkSession, folder: str) -> DataFrame:
    return _price_features(spark, folder, fs.price_features_1())


@query
def price_features_2(spark: SparkSession, folder: str) -> DataFrame:
    return _price_features(spark, folder, fs.price_features_2())


@query
def income_features(spark: SparkSession, folder: str) -> DataFrame:
    union = income_union(spark, folder).select(
        "id_cvm", "dt_year", "dt_quarter", *fs.STATEMENT_VARIABLES
    )
    return round_features(fs.with_income_features(union, SHORT), mean_digits=4)


# --- integration -------------------------------------------------------------

def _statements(spark: SparkSession, folder: str, annual: bool) -> list[DataFrame]:
    """Income, assets, liabilities and cash flow as bucketed tables, as the
    co-partition job leaves them."""
    def lines(kind: str) -> DataFrame:
        return src.statement_lines(spark, folder, kind, annual)

    made = {
        "income": statements.income_statement(lines("income"), annual, buckets.deal),
        "assets": statements.balance_assets(lines("assets"), buckets.deal),
        "liabilities": statements.balance_liabilities(lines("liabilities"), buckets.deal),
    }
    out = [
        buckets.write_bucketed(df, scratch_path(spark, f"bucketed-{kind}"), dealt=True)
        for kind, df in made.items()
    ]
    flow = buckets.write_bucketed(
        _cash_flow(spark, folder, annual), scratch_path(spark, "bucketed-cash-flow")
    )
    return [*out, flow]


@query
def price_period_end(spark: SparkSession, folder: str) -> DataFrame:
    return prices.price_period_end(src.daily_prices(spark, folder))


@query
def fundamentals_join(spark: SparkSession, folder: str) -> DataFrame:
    return fundamentals.fundamentals_join(*_statements(spark, folder, annual=True))


@query
def fundamentals_price(spark: SparkSession, folder: str) -> DataFrame:
    income = _income(spark, folder, annual=False).select(
        "id_cvm", "id_cnpj", "dt_year", "dt_quarter", "cat_type_dre", "amt_net_profit"
    )
    return fundamentals.fundamentals_price(income, src.daily_prices(spark, folder))


@query
def fundamentals_price_inner(spark: SparkSession, folder: str) -> DataFrame:
    three = [
        columns.stamp_processed_at(df, PROCESSED)
        for df in _statements(spark, folder, annual=False)[:3]
    ]
    return fundamentals.fundamentals_price_inner(*three, src.daily_prices(spark, folder)).select(
        "id", "id_ticker", "id_cvm", "txt_company_name", "dt_year", "dt_quarter", "processed_at",
        "amt_adj_close", "amt_dividends", "amt_sales_revenue", "amt_net_profit",
        "amt_cash_and_cash_equivalents", "amt_total_assets", "amt_net_equity",
        "amt_total_liabilities",
    )


PROFIT = [
    "ebit_amplo", "provisao_ircs_ampla", "nopat_amplo", "ebit_restrit", "provisao_ircs_restrita",
]


@query
def fundamentals_profit(spark: SparkSession, folder: str) -> DataFrame:
    done = fundamentals.with_profit_measures(_income(spark, folder, annual=True))
    return done.select(
        "id_cvm", "dt_year", "cat_type_dre", *[rounded(c, 2).alias(c) for c in PROFIT]
    )


def _integrated(spark: SparkSession, folder: str, annual: bool) -> DataFrame:
    done = fundamentals.integrated_fundamentals(
        *_statements(spark, folder, annual), src.daily_prices(spark, folder)
    )
    return done.withColumns({c: rounded(c, 2) for c in PROFIT})


@query
def fundamentals_annual(spark: SparkSession, folder: str) -> DataFrame:
    return _integrated(spark, folder, annual=True)


@query
def fundamentals_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    return _integrated(spark, folder, annual=False)
