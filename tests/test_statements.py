import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import cashflow, columns, quality, quarters, statements
from ledgerwave.sources import schemas

ID = "01.234.567/0001-89"
LABELS = {
    "3.01": "Receita de Venda de Bens e/ou Serviços", "1.01": "Ativo Circulante",
    "1.01.01": "Caixa e Equivalentes de Caixa",
}


def lines(spark, rows, balance=False, **fixed):
    """rows: (code, value) or (code, value, overrides)."""
    base = {
        "CNPJ_CIA": ID, "DT_REFER": "2022-03-31", "VERSAO": 1, "DENOM_CIA": "ACME",
        "CD_CVM": "0001", "GRUPO_DFP": "g", "MOEDA": "REAL", "ESCALA_MOEDA": "MIL",
        "ORDEM_EXERC": "ÚLTIMO", "DT_INI_EXERC": "2022-01-01", "DT_FIM_EXERC": "2022-03-31",
        "ST_CONTA_FIXA": "S", **fixed,
    }
    schema = schemas.BALANCE_LINES if balance else schemas.STATEMENT_LINES
    out = []
    for code, value, *more in rows:
        row = {
            **base, "CD_CONTA": code, "DS_CONTA": LABELS.get(code, code),
            "VL_CONTA": None if value is None else float(value), **(more[0] if more else {}),
        }
        out.append(tuple(row[f.name] for f in schema.fields))
    return spark.createDataFrame(out, schema)


INCOME = [
    ("3.01", 100), ("3.02", -60), ("3.04.06", 2), ("3.06", -5), ("3.11", 7),
    ("3.01", 90, {"ORDEM_EXERC": "PENÚLTIMO"}),
]


def test_income_statement(spark):
    df = statements.income_statement(lines(spark, INCOME), annual=False)
    assert df.columns == schemas.INCOME_KEYS + schemas.INCOME_AMOUNTS
    (row,) = df.collect()
    assert row.id_cnpj == "01234567000189" and row.cat_type_dre == "type_01"
    assert (row.amt_sales_revenue, row.amt_cost_goods_and_services) == (100000.0, -60000.0)
    assert (row.amt_financial_results, row.amt_net_profit) == (-5000.0, 7000.0)
    assert row.amt_equity_equivalence == -3000.0
    assert row.amt_earnings_before_interest_and_taxes is None


@pytest.mark.parametrize("end", ["2022-06-30", "2022-09-30"])
def test_accumulated_exercises_are_left_out(spark, end):
    df = statements.income_statement(lines(spark, INCOME, DT_FIM_EXERC=end), annual=False)
    assert df.isEmpty()


def test_untyped_company_keeps_the_type_free_amount(spark):
    rows = [("3.06", 4), ("3.11", 9)]
    (row,) = statements.income_statement(lines(spark, rows), annual=False).collect()
    assert row.cat_type_dre is None and row.amt_net_profit is None
    assert row.amt_equity_equivalence == 4000.0


def test_null_key_finds_no_type_and_spellings_share_a_row(spark):
    unnamed = lines(spark, INCOME, DENOM_CIA=None)
    (row,) = statements.income_statement(unnamed, annual=False).collect()
    assert row.cat_type_dre is None and row.amt_equity_equivalence == -5000.0

    other = lines(spark, [("3.02", -1)], CNPJ_CIA="01234567000189")
    both = statements.income_statement(lines(spark, INCOME).unionByName(other), annual=False)
    kinds = {r.cat_type_dre: r.amt_cost_goods_and_services for r in both.collect()}
    assert kinds == {"type_01": -60000.0, None: None}


def test_assets_match_two_types(spark):
    rows = [("1", 500), ("1.01", 200), ("1.01.01", 50), ("1.02.04", 30)]
    df = statements.balance_assets(lines(spark, rows, balance=True, ESCALA_MOEDA="UNIDADE"))
    got = {
        r.cat_type_dre: (r.amt_total_assets, r.amt_current_assets,
                         r.amt_cash_and_cash_equivalents, r.amt_intangible)
        for r in df.collect()
    }
    assert got == {"type_01": (500, 200, 50, 30), "type_03": (500, 200, 50, None)}


def test_income_lines_repeat_per_type(spark):
    df = statements.income_lines(lines(spark, INCOME), annual=False)
    assert df.count() == 5 and {r.cat_type_dre for r in df.collect()} == {"type_01"}


def test_coverage_counts_companies(spark):
    cleaned = statements.clean_lines(lines(spark, INCOME), 3, fill_label=True)
    got = {r.id_account: (r.n_companies, r.n_reporting)
           for r in quality.account_coverage(cleaned).collect()}
    assert got["3.01"] == (1, 1) and got["3.05"] == (1, 0) and len(got) == 17


def wide(spark, rows):
    """rows: (quarter, sales, type)."""
    out = []
    for quarter, sales, kind in rows:
        end = {1: dt.date(2022, 3, 31), 2: dt.date(2022, 6, 30), 3: dt.date(2022, 9, 30),
               4: dt.date(2022, 12, 31)}[quarter]
        out.append((
            "1", "c", "ACME", end, end, end, 2022, quarter, kind, sales,
            *[None] * (len(schemas.INCOME_AMOUNTS) - 1),
        ))
    return spark.createDataFrame(out, schemas.INCOME_WIDE)


def fourth(spark, quarterly, annual, kind="type_01"):
    itr = wide(spark, [(i + 1, float(v), kind) for i, v in enumerate(quarterly)])
    dfp = wide(spark, [(4, annual, kind)])
    df = quarters.last_quarter(itr, dfp)
    assert df.count() >= len(quarterly)
    return [(r.amt_sales_revenue, r.dt_quarter, r.dt_fim_exerc) for r in df.collect()][
        len(quarterly):]


def test_fourth_quarter(spark):
    end = dt.date(2022, 12, 31)
    assert fourth(spark, [10, 20, 30], 100.0) == [(40.0, 4, end)]
    assert fourth(spark, [10, 20], 100.0) == []
    assert fourth(spark, [10, 20, 30], None) == [(-60.0, 4, end)]
    assert fourth(spark, [10, 20, 30], 100.0, kind=None) == [(40.0, None, None)]


def test_quarters_add_up_to_the_year_in_legacy_too(spark):
    itr = columns.stamp_processed_at(wide(spark, [(1, 10.0, "type_01")]), "2023-01-01")
    dfp = columns.stamp_processed_at(wide(spark, [(4, 100.0, "type_01")]), "2023-01-01")
    rows = quarters.last_quarter_legacy(itr, dfp).collect()
    assert sorted((r.dt_quarter, r.amt_sales_revenue) for r in rows) == [(1, 10.0), (4, 90.0)]


@pytest.mark.parametrize("ytd, want", [
    ([5, 12, 9, 20], [5, 7, -3, 11]),
    ([5, None, 9, 20], [5, None, None, 11]),
    ([None, 12, 9, 20], []),
])
def test_quarterly_cash_flow(spark, ytd, want):
    ends = ["2021-03-31", "2021-06-30", "2021-09-30", "2021-12-31"]
    rows = [("6.01", v, {"DT_FIM_EXERC": e}) for v, e in zip(ytd, ends) if v is not None]
    itr = lines(spark, [r for r in rows if not r[2]["DT_FIM_EXERC"].endswith("12-31")],
                ESCALA_MOEDA="UNIDADE")
    dfp = lines(spark, rows[-1:], ESCALA_MOEDA="UNIDADE")
    got = cashflow.cash_flow_quarterly(itr, dfp, own_year=True).orderBy("dt_quarter").collect()
    assert [r.amt_net_cash_operating_activities for r in got] == want
    if want:
        assert [str(r.dt_fim_exerc) for r in got] == ends
        pinned = cashflow.cash_flow_quarterly(itr, dfp).filter("dt_quarter = 1").first()
        assert str(pinned.dt_fim_exerc) == "2022-03-31"


def test_running_count_dedupe(spark):
    days = {"c": [1, 2, 2, 3], "d": [1, 1], "e": [1], None: [1], "f": [None, 1], "g": [None, None]}
    rows = [(k, 2022, 1, d and dt.date(2022, 1, d), i)
            for k, ds in days.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(
        rows, "id_cnpj string, dt_year int, dt_quarter int, dt_fim_exerc date, n int"
    )
    got = {(r.id_cnpj, r.dt_fim_exerc and r.dt_fim_exerc.day)
           for r in quarters.dedupe_running_count(df).collect()}
    assert got == {("c", 1), ("e", 1), ("f", None)}


def test_result_does_not_depend_on_order_or_partitions(spark):
    base = lines(spark, INCOME * 3)
    want = statements.income_statement(base, annual=False).collect()
    again = base.orderBy(F.rand(7)).repartition(3)
    assert statements.income_statement(again, annual=False).collect() == want
