"""Statement lines, registers and prices derived from the star-schema tables.

The registered queries run on whatever star-schema folder they are given. This
module shapes those tables like the domain's inputs: suppliers are companies,
line items are account lines and trades, ship dates are periods. Everything is
a narrow projection or a map-side-combined aggregation over ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerwave.session import drop_shuffles
from ledgerwave.sources import lake
from ledgerwave.sources.runs import Files

# Account lines by statement; one list per kind of company (general, bank,
# insurer, unclassifiable). The first entry of each decides the chart.
ACCOUNTS: dict[str, list[list[tuple[str, str | None]]]] = {
    "income": [
        [
            ("3.01", "Receita de Venda de Bens e/ou Serviços"),
            ("3.02", "Custo dos Bens e/ou Serviços Vendidos"),
            ("3.03", "Resultado Bruto"),
            ("3.04", "Despesas/Receitas Operacionais"),
            ("3.04.01", "Despesas com Vendas"),
            ("3.04.02", "Despesas Gerais e Administrativas"),
            ("3.04.03", "Perdas pela Não Recuperabilidade de Ativos"),
            ("3.04.04", "Outras Receitas Operacionais"),
            ("3.04.05", "Outras Despesas Operacionais"),
            ("3.04.06", "Resultado de Equivalência Patrimonial"),
            ("3.05", "Resultado Antes do Resultado Financeiro e dos Tributos"),
            ("3.06", "Resultado Financeiro"),
            ("3.06.01", "Receitas Financeiras"),
            ("3.06.02", "Despesas Financeiras"),
            ("3.07", "Resultado Antes dos Tributos sobre o Lucro"),
            ("3.08", "Imposto de Renda e Contribuição Social sobre o Lucro"),
            ("3.11", "Lucro/Prejuízo Consolidado do Período"),
        ],
        [
            ("3.01", "Receitas da Intermediação Financeira"),
            ("3.02", "Despesas da Intermediação Financeira"),
            ("3.03", "Resultado Bruto Intermediação Financeira"),
            ("3.04", "Outras Despesas/Receitas Operacionais"),
            ("3.05", "Resultado Antes dos Tributos sobre o Lucro"),
            ("3.06", "Imposto de Renda e Contribuição Social sobre o Lucro"),
            ("3.09", "Lucro/Prejuízo Consolidado do Período"),
            ("3.11", "Lucro/Prejuízo Consolidado do Período"),
        ],
        [
            ("3.01", "Receitas das Operações"),
            ("3.02", " Outras Receitas/Despesas Operacionais "),
            ("3.03", "Custo de Serviços Prestados"),
            ("3.05", "Resultado Antes do Resultado Financeiro e dos Tributos"),
            ("3.06", "Resultado de Equivalência Patrimonial"),
            ("3.07", "Resultado Antes dos Tributos sobre o Lucro"),
            ("3.08", "Imposto de Renda e Contribuição Social sobre o Lucro"),
            ("3.13", "Lucro/Prejuízo Consolidado do Período"),
        ],
        [
            ("3.01", "Rendas Diversas"),
            ("3.06", None),
            ("3.11", "Lucro/Prejuízo Consolidado do Período"),
        ],
    ],
    "assets": [
        [
            ("1.01", "Ativo Circulante"), ("1", "Ativo Total"),
            ("1.01.01", "Caixa e Equivalentes de Caixa"), ("1.02", "Ativo Não Circulante"),
            ("1.02.02", "Investimentos"), ("1.02.03", "Imobilizado"), ("1.02.04", "Intangível"),
        ],
        [
            ("1.01", "Caixa e Equivalentes de Caixa"), ("1", "Ativo Total"),
            ("1.02", "Ativos Financeiros"), ("1.05", "Investimentos"), ("1.06", "Imobilizado"),
            ("1.07", "Intangível"),
        ],
        [
            ("1.01.01", "Caixa e Equivalentes de Caixa"), ("1", "Ativo Total"),
            ("1.01", "Ativo Circulante Segurador"), ("1.02", "Ativo Não Circulante"),
            ("1.02.02", "Investimentos"), ("1.02.03", "Imobilizado"), ("1.02.04", "Intangível"),
        ],
        [("1.01", "Disponibilidades"), ("1", "Ativo Total"), ("1.02", None)],
    ],
    "liabilities": [
        [
            ("2.01", "Passivo Circulante"), ("2", "Passivo Total"),
            ("2.02", "Passivo Não Circulante"), ("2.02.01", "Empréstimos e Financiamentos"),
            ("2.03", "Patrimônio Líquido Consolidado"),
        ],
        [
            ("2.01", "Passivos Financeiros ao Valor Justo através do Resultado"),
            ("2", "Passivo Total"), ("2.03", "Provisões"),
            ("2.07", "Patrimônio Líquido Consolidado"),
        ],
        [
            ("2.02.01", "Passivo Exigível a Longo Prazo"), ("2", "Passivo Total"),
            ("2.01", "Passivo Circulante Segurador"), ("2.02", "Passivo Não Circulante"),
            ("2.03", "Patrimônio Líquido Consolidado"),
        ],
        [("2.01", "Obrigações"), ("2", "Passivo Total"), ("2.03", None)],
    ],
    "cash_flow": [[
        ("6.01", "Caixa Líquido Atividades Operacionais"),
        ("6.01.01", "Caixa Gerado nas Operações"),
        ("6.01.01.02", "Depreciação e Amortização"),
        ("6.01.01.03", "Depreciações de Direito de Uso"),
        ("6.02", "Caixa Líquido Atividades de Investimento"),
        ("6.03", "Caixa Líquido Atividades de Financiamento"),
        ("6.04", "Variação Cambial s/ Caixa e Equivalentes"),
        ("6.05", "Aumento (Redução) de Caixa e Equivalentes"),
        ("6.05.02", "Saldo Final de Caixa e Equivalentes"),
        ("6.01.02", None),
    ]] * 4,
}

CURRENT, PRIOR = "ÚLTIMO", "PENÚLTIMO"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a small table over the cores before per-row text work.

    A small file arrives in fewer tasks than there are cores. Tables that
    arrive in at least one task per core stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def company_id(supplier: Column) -> Column:
    """Punctuated tax id of a supplier."""
    digits = F.lpad(supplier.cast("string"), 10, "0")
    return F.concat(
        F.substring(digits, 1, 4), F.lit("."), F.substring(digits, 5, 3), F.lit("."),
        F.substring(digits, 8, 3), F.lit("/0001-"),
        F.lpad((supplier % 97).cast("string"), 2, "0"),
    )


def _account_index(kind: str, pick: Column, supplier: Column) -> Column:
    """Place of the account that ``pick`` points to in the list of all of a kind."""
    sizes = [len(accounts) for accounts in ACCOUNTS[kind]]
    start, others, offset = F.lit(0), F.lit(1), 0
    for company_kind, size in enumerate(sizes):
        mine = supplier % 4 == company_kind
        start, others = F.when(mine, offset).otherwise(start), F.when(mine, size - 1).otherwise(others)
        offset += size
    index = start + F.when(F.col("l_linenumber") == 1, 1).otherwise(2 + pick % others)
    return index.cast("int")


def _account_text(kind: str, index: Column, part: int) -> Column:
    """Code (part 0) or label (part 1) of an account."""
    values = [a[part] for accounts in ACCOUNTS[kind] for a in accounts]
    # One constant array and one lookup keep the generated code small.
    literals = ", ".join("null" if v is None else f"'{v}'" for v in values)
    return F.element_at(F.expr(f"array({literals})"), index)


def _line_parts(spark: SparkSession, folder: str, kind: str, annual: bool) -> DataFrame:
    """What statement lines are made of, without their text: company, dates, place of
    the account, value and two marks."""
    df = spread(table(spark, folder, "lineitem"))
    year, quarter = F.year("l_shipdate"), F.quarter("l_shipdate")
    supplier, number = F.col("l_suppkey"), F.col("l_linenumber")
    if not annual:
        df = df.filter(quarter < 4)
    last_month = F.lit(12) if annual else quarter * 3
    end = F.last_day(F.make_date(year, last_month, F.lit(1)))
    odd = F.col("l_discount") >= 0.09
    if annual:
        start = F.make_date(year, F.when(odd, 7).otherwise(1), F.lit(1))
    else:
        start = F.make_date(year, F.when(odd, 1).otherwise(quarter * 3 - 2), F.lit(1))
    pick = F.col("l_partkey") + number
    value = (
        F.when((F.col("l_tax") == 0.08) & (number == 6), F.lit(None))
        .when(F.col("l_quantity") == 1, 0.0)
        .when(number % 3 == 2, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
    )
    return df.select(
        supplier.alias("supplier"), start.alias("start"), end.alias("end"),
        _account_index(kind, pick, supplier).alias("account"), value.alias("value"),
        F.coalesce(F.col("l_linestatus") == "O", F.lit(False)).alias("is_thousands"),
        F.coalesce(F.col("l_returnflag") == "R", F.lit(False)).alias("is_prior"),
    )


def _line_text(parts: DataFrame, kind: str, *also: str) -> DataFrame:
    """Parts of lines under the file schema's names."""
    supplier, end, account = F.col("supplier"), F.col("end").cast("string"), F.col("account")
    columns = {
        "CNPJ_CIA": company_id(supplier),
        "DT_REFER": end,
        "VERSAO": F.lit(1),
        "DENOM_CIA": F.concat(F.lit("Companhia "), supplier.cast("string")),
        "CD_CVM": F.lpad(supplier.cast("string"), 10, "0"),
        "GRUPO_DFP": F.lit("DF Consolidado"),
        "MOEDA": F.lit("REAL"),
        "ESCALA_MOEDA": F.when(F.col("is_thousands"), "MIL").otherwise("UNIDADE"),
        "ORDEM_EXERC": F.when(F.col("is_prior"), PRIOR).otherwise(CURRENT),
        "DT_INI_EXERC": F.col("start").cast("string"),
        "DT_FIM_EXERC": end,
        "CD_CONTA": _account_text(kind, account, 0),
        "DS_CONTA": _account_text(kind, account, 1),
        "VL_CONTA": F.col("value"),
        "ST_CONTA_FIXA": F.lit("S"),
    }
    if kind in ("assets", "liabilities"):
        del columns["DT_INI_EXERC"]
    return parts.select(*[c.alias(n) for n, c in columns.items()], *also)


def statement_lines(spark: SparkSession, folder: str, kind: str, annual: bool) -> DataFrame:
    """Raw statement lines under the file schema's names.

    Quarterly files hold quarters 1-3, some lines as year to date; annual files
    hold every line, some with a half-year exercise. Lines of returned items
    play the prior-year comparison.
    """
    return _line_text(_line_parts(spark, folder, kind, annual), kind)


def _filing_parts(spark: SparkSession, folder: str, annual: bool) -> DataFrame:
    """Parts of cash-flow lines, each account once per company and period. Company,
    day and account stand for all the texts made of them, so only they are exchanged."""
    lines = _line_parts(spark, folder, "cash_flow", annual)
    codes = F.array(*[F.lit(a[0]) for accounts in ACCOUNTS["cash_flow"] for a in accounts])
    # The lists repeat their accounts: the first place of the code stands for all.
    first = F.array_position(codes, _account_text("cash_flow", F.col("account"), 0)).cast("int")
    cents = F.col("value").cast("decimal(20,2)")
    return lines.groupBy("supplier", "end", first.alias("account"), "is_prior").agg(
        F.sum(cents).cast("double").alias("value"),
        # UNIDADE comes after MIL.
        F.min("is_thousands").alias("is_thousands"),
        F.min("start").alias("start"),
    )


def cash_flow_filings(spark: SparkSession, folder: str, annual: bool) -> DataFrame:
    """Cash-flow lines with each account once per company and period."""
    lines = _line_text(_filing_parts(spark, folder, annual), "cash_flow")
    last = ["VL_CONTA", "ESCALA_MOEDA", "DT_INI_EXERC"]
    return lines.select(*[c for c in lines.columns if c not in last], *last)


def daily_prices(spark: SparkSession, folder: str) -> DataFrame:
    """One row per company, ticker and day, in whole cents.

    An entity has at most one row per calendar day, however large the tables.
    """
    supplier = F.col("l_suppkey")
    ticker = F.concat(
        F.lit("TK"), supplier.cast("string"),
        F.when((supplier % 5 == 0) & (F.col("l_partkey") % 2 == 0), "4").otherwise("3"),
    )
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("double")
    trades = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("dt_date"), "l_suppkey", ticker.alias("id_ticker"),
        cents.alias("p"), F.col("l_quantity").alias("q"), "l_tax", "l_linenumber",
    )
    days = trades.groupBy("dt_date", "l_suppkey", "id_ticker").agg(
        F.sum(F.col("p") * F.col("q")).alias("pq"), F.sum("q").alias("q"), F.sum("p").alias("sp"),
        F.count(F.lit(1)).alias("n"), F.max("p").alias("hi"), F.min("p").alias("lo"),
        F.max("l_tax").alias("tax"), F.max("l_linenumber").alias("splits"),
    )
    weighted = F.floor(F.col("pq") / F.col("q")).cast("double")
    return days.select(
        "dt_date",
        F.regexp_replace(company_id(supplier), "[./-]", "").alias("id_cnpj"),
        "id_ticker",
        weighted.alias("amt_adj_close"),
        (weighted + 1).alias("amt_close"),
        F.col("hi").alias("amt_high"),
        F.col("lo").alias("amt_low"),
        F.floor(F.col("sp") / F.col("n")).cast("double").alias("amt_open"),
        F.col("q").alias("qty_volume"),
        (F.col("tax") * 50).alias("amt_dividends"),
        F.col("splits").cast("double").alias("cat_stock_splits"),
    )


def wide_quotes(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Quotes in the provider's shape: a column per (field, ticker)."""
    tickers = ["F", "O", "P"]
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    aggregates = []
    for t in tickers:
        mine = F.col("o_orderstatus") == t
        own, own_key = F.when(mine, price), F.when(mine, key)
        for field, value in {
            "Adj Close": F.max_by(own, own_key), "Close": F.max_by(own, own_key),
            "Dividends": F.min(own) / 1000, "High": F.max(own), "Low": F.min(own),
            "Open": F.min_by(own, own_key),
            "Stock Splits": F.count_if(mine & (price > 300000)).cast("double"),
            "Volume": F.nullif(F.count(own).cast("double"), F.lit(0.0)),
        }.items():
            aggregates.append(F.when(F.count_if(mine) > 0, value).alias(f"{field}|{t}"))
    daily = table(spark, folder, "orders").groupBy(
        F.col("o_orderdate").cast("date").cast("string").alias("Date")
    ).agg(*aggregates)
    return daily, tickers


def many_quotes(spark: SparkSession, folder: str, tickers: int = 250) -> DataFrame:
    """Wide quotes of many tickers: suppliers in turn, two fields each."""
    trades = table(spark, folder, "lineitem").groupBy(
        F.col("l_shipdate").cast("date").cast("string").alias("Date"), (F.col("l_suppkey") % tickers).alias("t")
    ).agg(F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"))
    daily = trades.groupBy("Date").agg(
        *[F.map_from_entries(F.collect_list(F.struct("t", c))).alias(c) for c in ("high", "low")]
    )
    columns = ["Date"] + [
        f"{c}[cast({k} as bigint)] as `{name}|T{k}`" for k in range(tickers) for name, c in (("High", "high"), ("Low", "low"))
    ]
    return daily.selectExpr(*columns)


def ticker_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Registry of all nations; two of them are listed under quoted symbols."""
    key = F.col("n_nationkey")
    listed = F.when(key == 0, "F").when(key == 1, "O").otherwise(F.concat(F.lit("N"), key.cast("string")))
    return table(spark, folder, "nation").select(
        company_id(key.cast("bigint")).alias("id_cnpj"),
        F.concat(F.lit("ORD"), listed).alias("id_ticker"),
        listed.alias("ticker_list"),
    )


def company_register(spark: SparkSession, folder: str) -> DataFrame:
    """Register forms: one per document, whose accented text it carries, with the
    name of the supplier of that number where there is one."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("doc_id"), "s_name")
    d = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    key = F.col("doc_id")
    day = F.date_add(F.lit("2000-01-01").cast("date"), (key % 3000).cast("int")).cast("string")
    return d.join(s, "doc_id", "left").select(
        company_id(key).alias("CNPJ_Companhia"),
        F.when(key % 7 == 0, "").otherwise(day).alias("Data_Referencia"),
        key.cast("string").alias("ID_Documento"),
        F.lit("1").alias("Versao"),
        F.col("s_name").alias("Nome_Empresarial"),
        day.alias("Data_Constituicao"),
        F.when(key % 11 == 0, "sem data").otherwise(day).alias("Data_Registro_CVM"),
        F.lit("ATIVO").alias("Situacao_Registro_CVM"),
        day.alias("Data_Situacao_Registro_CVM"),
        F.col("source").alias("Setor_Atividade"),
        F.col("text").alias("Descricao_Atividade"),
        F.when(key % 3 == 0, "Fase Operacional").alias("Situacao_Emissor"),
        day.alias("Data_Situacao_Emissor"),
        F.when(key % 5 == 0, "x").otherwise("31").alias("Dia_Encerramento_Exercicio_Social"),
        (1 + key % 12).cast("string").alias("Mes_Encerramento_Exercicio_Social"),
        F.col("lang").alias("Pais_Origem"),
    )


SECURITY_KINDS = ["Ações Ordinárias", "Ações Preferenciais", "Units", "Debêntures"]


def security_register(spark: SparkSession, folder: str, half: int | None = None) -> DataFrame:
    """Security forms: one per part; ``half`` takes parts of one parity, so the
    two halves make two registers to be united."""
    p = table(spark, folder, "part")
    key = F.col("p_partkey")
    if half is not None:
        p = p.filter(key % 2 == half)
    kinds = F.array(*[F.lit(k) for k in SECURITY_KINDS])
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)
    return p.select(
        company_id(key % 500).alias("CNPJ_Companhia"),
        key.cast("string").alias("ID_Documento"),
        F.col("p_size").cast("string").alias("Versao"),
        F.lit("2022-01-01").alias("Data_Referencia"),
        F.element_at(kinds, (1 + F.col("p_size") % 4).cast("int")).alias("Valor_Mobiliario"),
        F.lit("").alias("Sigla_Classe_Acao_Preferencial"),
        F.concat(F.substring("p_type", 1, 3), number).alias("Codigo_Negociacao"),
        F.when(key % 10 == 0, "Balcão").otherwise("Bolsa").alias("Mercado"),
        F.lit("B3").alias("Sigla_Entidade_Administradora"),
        F.when(key % 9 != 0, "Bolsa, Balcão e Mercadorias").alias("Entidade_Administradora"),
        F.lit("Nível 1").alias("Segmento"),
        F.lit("2001-02-03").alias("Data_Inicio_Negociacao"),
        F.lit(None).cast("string").alias("Data_Fim_Negociacao"),
        F.lit("2001-02-03").alias("Data_Inicio_Listagem"),
        F.when(key % 6 == 0, "2020-01-01").alias("Data_Fim_Listagem"),
    )


RAW_STATEMENTS = {"dre": "income", "bpa": "assets", "bpp": "liabilities"}


FILE_YEAR = "file_year"


def _by_file(parts: DataFrame) -> DataFrame:
    """Parts of lines in the order in which each task writes them: year by year and,
    as published files are, company by company, which also packs best."""
    year = F.substring(F.col("end").cast("string"), 1, 4).try_cast("int")
    return parts.withColumn(FILE_YEAR, year).sortWithinPartitions(
        FILE_YEAR, "supplier", "end", "is_prior", "account"
    )


def raw_files(spark: SparkSession, folder: str, root: str) -> None:
    """The published files of all kinds: one Latin-1 text file per kind and year,
    named as ``lake.FILE_STEM`` says. The text is packed, and lines go to their files
    from where they are read: no exchange holds a second copy of them."""
    made = {}
    for annual, kind in ((False, "itr"), (True, "dfp")):
        for part, statement in RAW_STATEMENTS.items():
            lines = _by_file(_line_parts(spark, folder, statement, annual))
            made[f"{kind}_{part}"] = _line_text(lines, statement, FILE_YEAR)
        filings = _by_file(_filing_parts(spark, folder, annual))
        made[f"{kind}_dfc"] = _line_text(filings, "cash_flow", FILE_YEAR)
    text = F.regexp_replace("Descricao_Atividade", "[\r\n]", " ")
    made["fca_aberta_geral"] = company_register(spark, folder).withColumns({
        "Descricao_Atividade": text, FILE_YEAR: F.substring("Data_Constituicao", 1, 4),
    })
    made["fca_valor_mobiliario"] = security_register(spark, folder).withColumn(
        FILE_YEAR, F.concat(F.lit("202"), F.col("Versao").cast("int") % 3)
    )
    files = Files(spark, root)
    for kind, df in made.items():
        aside = f"{root}/_{kind}"
        (
            df.write.partitionBy(FILE_YEAR)
            .option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("compression", "gzip").csv(aside)
        )
        drop_shuffles(spark)
        for name in files.children(aside):
            if name.startswith(f"{FILE_YEAR}="):
                year = name.removeprefix(f"{FILE_YEAR}=")
                files.move(f"{aside}/{name}", f"{root}/{lake.FILE_STEM[kind]}_{year}.csv")
