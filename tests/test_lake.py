import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import columns, fundamentals, prices, registry
from ledgerwave.plans import analytics
from ledgerwave.plans.preprocess import Lake, preprocess
from ledgerwave.session import scratch_path
from ledgerwave.sources import lake, quotes, schemas
from ledgerwave.streaming import appends

HEADER = ";".join(f.name for f in schemas.STATEMENT_LINES.fields)
BALANCE = ";".join(f.name for f in schemas.BALANCE_LINES.fields)


def line(code, label, value, start, end, refer=None):
    start = f"{start};" if start else ""
    return (f"01.234.567/0001-89;{refer or end};1;ACME;0001;g;REAL;UNIDADE;ÚLTIMO;{start}{end};"
            f"{code};{label};{value};S")


@pytest.fixture(scope="module")
def company(spark, tmp_path_factory):
    """One company's 2021 filings as published files, pre-processed."""
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    raw.mkdir()
    ends = ["2021-03-31", "2021-06-30", "2021-09-30", "2021-12-31"]
    starts = ["2021-01-01", "2021-04-01", "2021-07-01", "2021-10-01"]
    sales, profit = "Receita de Venda de Bens e/ou Serviços", "Lucro/Prejuízo do Período"

    def put(name, header, rows):
        (raw / name).write_text("\n".join([header, *rows, ""]), encoding="iso-8859-1")

    put("itr_cia_aberta_DRE_con_2021.csv", HEADER, [
        line(c, n, v * (i + 1), starts[i], ends[i])
        for i in range(3) for c, n, v in (("3.01", sales, 10), ("3.11", profit, 1))
    ])
    put("dfp_cia_aberta_DRE_con_2021.csv", HEADER, [
        line("3.01", sales, 100, "2021-01-01", ends[3]),
        line("3.11", profit, 10, "2021-01-01", ends[3]),
        "not;a;full;line",
    ])
    put("itr_cia_aberta_DFC_MI_con_2021.csv", HEADER, [
        line("6.01", "Caixa Líquido", v, "2021-01-01", ends[i]) for i, v in enumerate((5, 12, 9))
    ])
    put("dfp_cia_aberta_DFC_MI_con_2021.csv", HEADER, [
        line("6.01", "Caixa Líquido", 20, "2021-01-01", ends[3])
    ])
    for kind, code, label in (("BPA", "1.01", "Ativo Circulante"),
                              ("BPP", "2.01", "Passivo Circulante")):
        put(f"itr_cia_aberta_{kind}_con_2021.csv", BALANCE,
            [line(code, label, 7, None, e) for e in ends[:3]])
        put(f"dfp_cia_aberta_{kind}_con_2021.csv", BALANCE, [line(code, label, 8, None, ends[3])])
    names = [*schemas.SECURITY_REGISTER_NAMES, "extra"]
    put("fca_cia_aberta_valor_mobiliario_2021.csv", ";".join(n.title() for n in names), [
        "01.234.567/0001-89;9;2;2021-05-01;Ações Ordinárias;;acme3;Bolsa;;;Nível 1;;;;;x"
    ])
    put("fca_cia_aberta_geral_2021.csv", ";".join(schemas.COMPANY_REGISTER_NAMES), [
        "01.234.567/0001-89;2021-05-01;1;1;Ácme;;;ATIVO;;;Atuação;;;31;x;Brasil"
    ])
    folders = Lake(str(raw), str(root / "processed"))
    for kind in ("fca_aberta_geral", "fca_valor_mobiliario", "dfp_dre", "itr_dre", "dfp_bpa",
                 "itr_bpa", "dfp_bpp", "itr_bpp", "dfp_dfc", "itr_dfc", "itr_dfc_table"):
        preprocess(spark, folders, kind, [2020, 2021], "2022-02-01")
    return folders


def test_preprocessed_tables(spark, company):
    complete = spark.read.parquet(company.table("itr_dre_complete"))
    got = {r.dt_quarter: (r.amt_sales_revenue, r.amt_net_profit) for r in complete.collect()}
    assert got == {1: (10, 1), 2: (20, 2), 3: (30, 3), 4: (40, 4)}
    assert {str(r.processed_at) for r in complete.collect()} == {"2022-02-01"}
    assert "processed_at" not in spark.read.parquet(company.table("dfp_dfc")).columns
    lines = spark.read.parquet(company.table("itr_dre_ds_conta"))
    assert lines.filter("ds_conta = 'receitavendabens_eou_servicos'").count() == 3
    flow = spark.read.parquet(company.table("itr_dfc_table")).first()
    assert (flow.Q1, flow.Q2, flow.Q3, flow.Q4) == (5, 7, -3, 11)
    security = spark.read.parquet(company.table("fca_valor_mobiliario")).first()
    assert security.cat_stock_type == "acoes ordinarias" and security.qty_version == 2
    register = spark.read.parquet(company.table("fca_aberta_geral")).first()
    assert register.txt_company_name == "acme" and register.dt_month_fiscal_end is None


def test_running_a_kind_again_changes_nothing(spark, company):
    before = spark.read.parquet(company.table("dfp_dre")).collect()
    preprocess(spark, company, "dfp_dre", [2021], "2022-02-01")
    assert spark.read.parquet(company.table("dfp_dre")).collect() == before


def test_integrated_table(spark, company):
    day = dt.date
    quoted = spark.createDataFrame(
        [(day(2021, 3, 30), "01234567000189", "ACME3", 9.0), (day(2021, 3, 31), "01234567000189",
         "ACME3", 10.0), (day(2021, 4, 1), "01234567000189", "ACME3", 11.0)],
        "dt_date date, id_cnpj string, id_ticker string, amt_adj_close double",
    ).withColumn("amt_dividends", F.lit(0.0))
    df = analytics.fundamentals_table(spark, company, quoted, annual=False)
    assert df.columns[:58] == schemas.FUNDAMENTALS_COLUMNS
    got = {r.dt_quarter: (r.amt_adj_close, r.amt_current_assets, r.amt_current_liabilities,
                          r.amt_net_cash_operating_activities) for r in df.collect()}
    assert got == {1: (10, 7, 7, 5), 2: (11, 7, 7, 7), 3: (None, 7, 7, -3)}
    analytics.co_partition(spark, company, False, 3)
    again = analytics.fundamentals_table(spark, company, quoted, annual=False, bucketed=3)
    assert sorted(map(str, again.select(df.columns).collect())) == sorted(map(str, df.collect()))
    union = analytics.income_union(spark, company, range(2015, 2025))
    assert union.count() == 4
    features = analytics.income_features(union).orderBy("dt_quarter").collect()
    assert [r.amt_tot_amt_sales_revenue_1m_lag for r in features] == [None, 10, 20, 30]


def test_no_year_at_all_is_an_empty_typed_table(spark):
    nowhere = f"/tmp/nowhere-{uuid.uuid4().hex}"
    assert lake.scan_years(spark, nowhere, [2021], schemas.INCOME_WIDE).count() == 0
    assert lake.scan_yearly_files(spark, nowhere, "dfp_dre", [2021], schemas.INCOME_WIDE).count() == 0


def test_yearly_files_tolerate_missing_years(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "id_cvm string")
    df.write.parquet(str(tmp_path / "pp_dfp_dre_2021.parquet"))
    got = lake.scan_yearly_files(spark, str(tmp_path), "dfp_dre", range(2019, 2023), df.schema)
    assert [r.id_cvm for r in got.collect()] == ["a"]


def test_corrupt_lines_are_kept(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a;b\n1;x\nnone;y\n", encoding="iso-8859-1")
    schema = "a int, b string"
    from pyspark.sql.types import _parse_datatype_string
    df = lake.scan_delimited(spark, str(tmp_path), _parse_datatype_string(schema), True).cache()
    assert sorted((r.a or 0, r[lake.CORRUPT] or "") for r in df.collect()) == [(0, "none;y"), (1, "")]


PRICE_ROWS = [(dt.date(2021, 1, d), "c", t, float(d)) for d in (4, 5) for t in ("A", "B")]
PRICE_SCHEMA = "dt_date date, id_cnpj string, id_ticker string, amt_adj_close double"


def test_append_twice_is_append_once(spark):
    path = scratch_path(spark, "append")
    days = spark.createDataFrame(PRICE_ROWS, PRICE_SCHEMA)
    lake.append_days(days, path)
    lake.append_days(days.filter("day(dt_date) = 5").unionByName(days.filter("day(dt_date) = 5")), path)
    assert spark.read.parquet(path).count() == 4
    empty = scratch_path(spark, "empty")
    assert not lake.write_table(days.filter("false"), empty, skip_empty=True)


def test_stream_append_is_exactly_once(spark, tmp_path):
    keys = ["id_cnpj", "id_ticker", "dt_date"]
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    days = spark.createDataFrame(PRICE_ROWS, PRICE_SCHEMA)

    def drain(checkpoint):
        stream = appends.landing_stream(spark, landing, days.schema)
        appends.append_prices(stream, target, str(tmp_path / checkpoint), keys, "dt_date")
        return spark.read.parquet(target).count()

    days.filter("id_ticker = 'A'").write.parquet(landing)
    assert drain("one") == 2
    days.write.mode("append").parquet(landing)
    assert drain("one") == 4
    assert drain("one") == 4
    assert drain("lost") == 4


def test_stream_dedupe_with_bounded_state(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rows = spark.createDataFrame([(i % 50, dt.datetime(2021, 1, 1, 0, i % 50)) for i in range(100)],
                                 "id int, ts timestamp_ntz")
    rows.write.parquet(landing)
    stream = appends.dedupe_within(
        appends.landing_stream(spark, landing, rows.schema), ["id"], "ts", "1 day"
    )
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "ck")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 50


def test_ticker_universe(spark):
    none = None
    rows = [
        ("1", "PETR4", "bolsa", "acoes preferenciais", none), ("2", "sanb11", "bolsa", "units", none),
        ("3", "ABC", "bolsa", "acoes ordinarias", none),
        ("4", "VALE3", "balcao", "acoes ordinarias", none),
        ("5", "XYZW3", "bolsa", "acoes ordinarias", dt.date(2020, 1, 1)),
        ("6", "BOVA11", "bolsa", "debentures", none),
    ]
    df = spark.createDataFrame(rows, "id_cnpj string, id_ticker string, cat_type_market string, "
                                     "cat_stock_type string, dt_end_listing date")
    got = registry.ticker_universe(df.limit(3), df)
    assert sorted(r.id_ticker for r in got.collect()) == ["PETR4", "SANB11", "SANB3", "SANB4"]
    assert {r.ticker_list for r in got.collect()} == {"PETR4.SA", "SANB11.SA", "SANB3.SA", "SANB4.SA"}


def test_quotes(spark):
    wide = spark.createDataFrame(
        [("2021-01-04", 1.5, 2.0, 0.75), ("2021-01-05", None, 3.0, None)],
        "Date string, `Adj Close|X` double, `Adj Close|Y` double, `Dividends|X` double",
    )
    listed = spark.createDataFrame([("c", "XX3", "X")], schemas.TICKER_REGISTRY)
    long = quotes.attach_registry(quotes.quotes_long(wide, ["X", "Y"]), listed)
    assert long.count() == 3
    day = prices.typed_quotes(long, "2021-01-05").orderBy("id_ticker").collect()
    assert [(r.id_ticker, r.amt_adj_close, r.amt_dividends, r.amt_dividends_exact) for r in day] == [
        (None, 2.0, None, None), ("XX3", 1.5, 0, 0.75)]


def test_profit_measures(spark):
    df = spark.createDataFrame([(100.0, -20.0, -30.0, 10.0, 5.0)], ", ".join(f"{c} double" for c in (
        "amt_earnings_before_income_tax_and_social_contribution", "amt_financial_expenses",
        "amt_income_tax_social_contribution_on_profit", "amt_equity_equivalence",
        "amt_financial_income")))
    r = fundamentals.with_profit_measures(df).first()
    assert [round(r[c], 6) for c in ("ebit_amplo", "provisao_ircs_ampla", "nopat_amplo",
                                     "ebit_restrit", "provisao_ircs_restrita")] == \
        [120, 42.727273, 77.272727, 125, 32.727273]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r.column_name: r.n_null for r in columns.null_profile(df).collect()} == {"a": 1, "b": 2}


def test_second_file_of_a_day_adds_rows(spark):
    path = scratch_path(spark, "append")
    schema = "dt_date date, id_cnpj string, id_ticker string, amt_close double"
    day = dt.date(2021, 3, 5)
    for ticker in ("AAA", "BBB", "AAA"):
        lake.append_days(spark.createDataFrame([(day, "1", ticker, 1.0)], schema), path)
    assert sorted(r.id_ticker for r in spark.read.parquet(path).collect()) == ["AAA", "BBB"]


def test_files_keep_their_own_slices(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    names = list(schemas.COMPANY_REGISTER_NAMES)
    for year, dates in ((2021, ("2021-01-01", "2021-12-31", "")), (2022, ("2022-01-01", "2021-12-31", ""))):
        rows = [";".join([f"0{i}", d, *["1"] * (len(names) - 2)]) for i, d in enumerate(dates)]
        (raw / f"fca_cia_aberta_geral_{year}.csv").write_text("\n".join([";".join(names), *rows]), "latin-1")
    folders = Lake(str(raw), str(tmp_path / "processed"))
    for years in ([2021], [2022], [2019]):
        preprocess(spark, folders, "fca_aberta_geral", years, "2022-02-01")
    table = spark.read.parquet(folders.table("fca_aberta_geral"))
    assert {(r[0], r[1]) for r in table.groupBy("dt_file_year").count().collect()} == {(2021, 3), (2022, 3)}
