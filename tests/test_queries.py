"""A cross-section of the registered queries against their SQL, and the contract."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract
from ledgerwave.plans import catalog, oracle
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "income_statement", "balance_liabilities", "cash_flow_table", "dedupe_running_count",
    "price_features_2", "features_long_entities", "ticker_units", "label_slug",
    "price_append_stream", "typed_quotes", "scan_quarantine", "missing_years", "stream_dedupe_state",
    "null_fill_by_type", "quotes_many_tickers", "income_union_legacy", "fundamentals_quarterly",
    "preprocess_lake",
]


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def test_every_query_has_sql():
    """The optional corpus queries have SQL where it can express them."""
    assert set(catalog.QUERIES) == set(oracle.sql())
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, engine, name):
    result, _ = compare(spark, engine, name, FOLDER)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert len(contract.entry(spark).columns) == 63
