"""Raw files -> pre-processed tables, one entry per kind of filing.

Each table is partitioned by the year of the source file. All years of a kind are
read in one scan and made in one job: the year comes from the file's name and goes
along as one more key. A run replaces only the slices of files that it finds; all
its tables are seen together or not at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerwave.operators import cashflow, columns, quarters, registry, statements
from ledgerwave.sources import lake, schemas
from ledgerwave.sources.runs import Files, Run, finish_runs

FILE_YEAR = "dt_file_year"
ALSO = (FILE_YEAR,)


@dataclass(frozen=True)
class Lake:
    """Folders of one lake; ``raw`` holds the published files."""

    raw: str
    processed: str

    def table(self, kind: str) -> str:
        return f"{self.processed}/pp_{kind}"

    def bucketed(self, kind: str) -> str:
        """The same rows laid out by company and year."""
        return f"{self.processed}/pb_{kind}"


def source_years(spark: SparkSession, lake_: Lake, kind: str, years: Iterable[int]) -> list[int]:
    """Those of ``years`` for which the kind has a file."""
    names = Files(spark, lake_.raw).matching(lake.raw_file_glob(lake_.raw, kind, years))
    return sorted({int(re.search(r"(\d{4})\.csv$", n)[1]) for n in names})


def _scan(spark: SparkSession, lake_: Lake, kind: str, years: list[int]) -> DataFrame:
    """Lines of all files of some years, with the year of their file."""
    if kind.startswith("fca_"):
        # Each register file names its own columns.
        each = [
            lake.with_file_year(lake.scan_delimited_text(spark, lake.raw_file_glob(lake_.raw, kind, [y])))
            for y in years
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    balance = kind.endswith(("bpa", "bpp"))
    schema = schemas.BALANCE_LINES if balance else schemas.STATEMENT_LINES
    path = lake.raw_file_glob(lake_.raw, kind, years)
    return lake.with_file_year(lake.scan_delimited(spark, path, schema))


# Each job names its tables and how to make them. They are made one after the
# other, so a later one may read an earlier one back instead of repeating it.
Tables = dict[str, Callable[[Run], DataFrame]]


def _one_table(make: Callable[..., DataFrame]):
    def tables(spark: SparkSession, lake_: Lake, kind: str, years: list[int]) -> Tables:
        return {kind: lambda run: make(_scan(spark, lake_, kind, years), also=ALSO)}

    return tables


def _income(spark: SparkSession, lake_: Lake, kind: str, years: list[int]) -> Tables:
    annual = kind == "dfp_dre"
    lines = _scan(spark, lake_, kind, years)
    schema = StructType([*schemas.INCOME_WIDE.fields, StructField(FILE_YEAR, IntegerType())])

    def made(run: Run, name: str) -> DataFrame:
        own = run.staged(f"pp_{name}", schema)
        if own is not None:
            return own
        return lake.scan_years(spark, lake_.table(name), years, schema, FILE_YEAR)

    out: Tables = {
        kind: lambda run: statements.income_statement(lines, annual, also=ALSO),
        f"{kind}_ds_conta": lambda run: statements.income_lines(lines, annual, also=ALSO),
    }
    if not annual:
        out["itr_dre_complete"] = lambda run: quarters.last_quarter(
            made(run, kind), made(run, "dfp_dre"), also=ALSO
        )
    return out


def _flow(spark: SparkSession, lake_: Lake, kind: str, years: list[int]) -> Tables:
    pair = _scan(spark, lake_, "itr_dfc", years), _scan(spark, lake_, "dfp_dfc", years)
    if kind == "itr_dfc_table":
        return {kind: lambda run: cashflow.cash_flow_table(*pair, also=ALSO)}
    return {
        kind: lambda run: cashflow.cash_flow_quarterly(*pair, also=ALSO),
        f"{kind}_own_year": lambda run: cashflow.cash_flow_quarterly(*pair, own_year=True, also=ALSO),
    }


# In the order in which a run makes them: quarterly income reads annual income.
JOBS = {
    "fca_aberta_geral": _one_table(registry.register_company),
    "fca_valor_mobiliario": _one_table(registry.register_security),
    "dfp_dre": _income,
    "itr_dre": _income,
    "dfp_bpa": _one_table(statements.balance_assets),
    "itr_bpa": _one_table(statements.balance_assets),
    "dfp_bpp": _one_table(statements.balance_liabilities),
    "itr_bpp": _one_table(statements.balance_liabilities),
    "dfp_dfc": _one_table(statements.cash_flow_annual),
    "itr_dfc": _flow,
    "itr_dfc_table": _flow,
}
# Kinds whose table carries no processing day.
UNSTAMPED = {"dfp_dfc"}
# Kinds that need the files of two kinds.
PAIRED = {"itr_dfc": "dfp_dfc", "itr_dfc_table": "dfp_dfc"}


def preprocess_lake(
    spark: SparkSession, lake_: Lake, years: Iterable[int], execution_date: str,
    kinds: Iterable[str] = tuple(JOBS),
) -> list[str]:
    """Run some kinds of filings, all by default, over some years; returns the
    tables written.

    Each source file is one slice of the table, named by the file's year and
    replaced as a whole: late-dated or undated rows of one file never touch the
    slice of another, and a file that has no rows any more empties its slice. A year
    without a file is left alone. All slices of the run appear together; a run that
    failed leaves the tables as they were.
    """
    finish_runs(spark, lake_.processed)
    years = list(years)
    run, written = Run(spark, lake_.processed), []
    for kind in kinds:
        found = source_years(spark, lake_, kind, years)
        if kind in PAIRED:
            found = [y for y in source_years(spark, lake_, PAIRED[kind], years) if y in found]
        if not found:
            continue
        for name, make in JOBS[kind](spark, lake_, kind, found).items():
            df = make(run)
            if kind not in UNSTAMPED:
                df = columns.stamp_processed_at(df, execution_date)
            if "dt_year" not in df.columns:
                df = df.withColumn("dt_year", F.year("dt_refer"))
            run.stage(df, f"pp_{name}", FILE_YEAR, found)
            written.append(lake_.table(name))
    run.commit()
    return written


def preprocess(
    spark: SparkSession, lake_: Lake, kind: str, years: Iterable[int], execution_date: str
) -> list[str]:
    """One kind of filing. Quarterly income reads the annual income table of the
    same years, so run ``dfp_dre`` first."""
    return preprocess_lake(spark, lake_, years, execution_date, [kind])
