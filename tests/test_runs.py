"""Runs that are seen whole, bucketed tables, quarantine, typed fills, wide quotes."""

import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import columns, fundamentals
from ledgerwave.plans import standins
from ledgerwave.plans.preprocess import Lake, preprocess, preprocess_lake
from ledgerwave.session import scratch_path
from ledgerwave.sources import buckets, lake, quotes, runs, schemas


def seen(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("y", "v").collect()))


@pytest.fixture
def root(spark):
    return scratch_path(spark, "lake")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "y int, v string")


def published(spark, root):
    run = runs.Run(spark, root)
    for table in ("a", "b"):
        run.stage(rows(spark, (1, "old"), (2, "old")), table, "y", [1, 2])
    run.commit()


def test_a_run_without_its_mark_leaves_nothing(spark, root):
    published(spark, root)
    run = runs.Run(spark, root)
    run.stage(rows(spark, (1, "new")), "a", "y", [1])
    runs.finish_runs(spark, root)  # the run died here; the next one cleans up
    assert seen(spark, f"{root}/a") == [(1, "old"), (2, "old")]
    assert runs.Files(spark, root).children(f"{root}/_runs") == []


def test_a_marked_run_is_finished_by_the_next(spark, root):
    published(spark, root)
    run = runs.Run(spark, root)
    run.stage(rows(spark, (1, "new")), "a", "y", [1])
    run.stage(rows(spark, (2, "new")), "b", "y", [1, 2])  # slice 1 has no rows any more
    run.mark()
    # Died in the middle of moving: one slice is in place already.
    runs.Files(spark, root).move(f"{run.path}/a/y=1", f"{root}/a/y=1")
    for _ in range(2):
        runs.finish_runs(spark, root)
        assert seen(spark, f"{root}/a") == [(1, "new"), (2, "old")]
        assert seen(spark, f"{root}/b") == [(2, "new")]


def register(folder, year, days):
    names = list(schemas.COMPANY_REGISTER_NAMES)
    lines = [";".join([f"0{i}", d, *["1"] * (len(names) - 2)]) for i, d in enumerate(days)]
    (folder / f"fca_cia_aberta_geral_{year}.csv").write_text("\n".join([";".join(names), *lines]), "latin-1")


def test_a_file_without_rows_empties_its_slice(spark, tmp_path):
    folders = Lake(str(tmp_path), str(tmp_path / "processed"))
    for year in (2020, 2021):
        register(tmp_path, year, ["2021-01-01"])
    assert len(preprocess_lake(spark, folders, range(2015, 2025), "2022-02-01", ["fca_aberta_geral"])) == 1
    register(tmp_path, 2021, [])
    preprocess(spark, folders, "fca_aberta_geral", [2021, 2022], "2022-02-01")
    table = spark.read.parquet(folders.table("fca_aberta_geral"))
    assert [tuple(r) for r in table.groupBy("dt_file_year").count().collect()] == [(2020, 1)]
    assert preprocess_lake(spark, folders, [1999], "2022-02-01") == []


def test_a_failing_run_changes_no_table(spark, tmp_path):
    folders = Lake(str(tmp_path), str(tmp_path / "processed"))
    register(tmp_path, 2021, ["2021-01-01"])
    preprocess(spark, folders, "fca_aberta_geral", [2021], "2022-02-01")
    register(tmp_path, 2021, ["2021-01-01"] * 3)
    (tmp_path / "fca_cia_aberta_valor_mobiliario_2021.csv").write_text("no;such;columns\n1;2;3\n", "latin-1")
    with pytest.raises(Exception):
        preprocess_lake(spark, folders, [2021], "2022-02-01", ["fca_aberta_geral", "fca_valor_mobiliario"])
    assert spark.read.parquet(folders.table("fca_aberta_geral")).count() == 1


def statement(spark, keys, amounts, n=40):
    rows_ = [
        (f"c{i % 7}", f"n{i % 7}", f"name {i % 7}", 2000 + i % 3, 1 + i % 4, f"type_0{1 + i % 2}", i) for i in range(n)
    ]
    df = spark.createDataFrame(
        rows_, "id_cvm string, id_cnpj string, txt_company_name string, dt_year int, dt_quarter int,"
        " cat_type_dre string, i int",
    ).dropDuplicates(["id_cvm", "dt_year", "dt_quarter", "cat_type_dre"])
    day = F.make_date("dt_year", F.col("dt_quarter") * 3, F.lit(28))
    df = df.withColumns({c: day for c in ("dt_refer", "dt_ini_exerc", "dt_fim_exerc")})
    return df.select(*keys, *[(F.col("i") * k).cast("double").alias(a) for k, a in enumerate(amounts, 1)])


def test_bucketed_statements_are_joined_as_they_lie(spark):
    made = [
        statement(spark, k, a) for k, a in (
            (schemas.INCOME_KEYS, schemas.INCOME_AMOUNTS), (schemas.BALANCE_KEYS, schemas.ASSET_AMOUNTS),
            (schemas.BALANCE_KEYS, schemas.LIABILITY_AMOUNTS),
        )
    ]
    flow = statement(spark, schemas.CASH_FLOW_KEYS, schemas.CASH_FLOW_AMOUNTS).dropDuplicates(schemas.CASH_FLOW_KEYS)
    made.append(flow)
    paths = [scratch_path(spark, "bucketed") for _ in made]
    tables = [buckets.write_bucketed(df, p, buckets=3) for df, p in zip(made, paths)]
    again = [buckets.read_bucketed(spark, p, t.schema, 3) for p, t in zip(paths, tables)]
    want = sorted(map(tuple, fundamentals.fundamentals_join(*made).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for four in (tables, again):
            joined = fundamentals.fundamentals_join(*four)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and not re.search(r"(?m)^[\s:+*()0-9-]*Exchange ", plan)
            assert sorted(map(tuple, joined.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_quarantine_takes_short_and_untyped_lines(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text("a;b\n1;é\nnone;y\n7\n2;x;more\n;\n", encoding="iso-8859-1")
    good, bad = lake.scan_with_quarantine(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"))
    assert sorted(((r.a or 0), r.b or "") for r in good.collect()) == [(0, ""), (1, "é")]
    assert sorted(map(tuple, bad.collect())) == [("2;x;more", "f.csv"), ("7", "f.csv"), ("none;y", "f.csv")]


def test_quarantine_of_clean_files_is_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    (tmp_path / "f.csv").write_text("a;b\n1;x\n", encoding="iso-8859-1")
    good, bad = lake.scan_with_quarantine(spark, str(tmp_path / "f.csv"), schema, str(tmp_path / "out"))
    assert good.count() == 1 and bad.count() == 0 and good.schema == schema


def test_fill_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None), ("x", 1.5, float("nan"), 2, True)],
        "s string, d double, n float, i int, flag boolean",
    )
    got = columns.fill_by_type(df, text="-", number=7).collect()
    assert [tuple(r) for r in got] == [("-", 7.0, 7.0, 7, None), ("x", 1.5, 7.0, 2, True)]
    assert columns.fill_by_type(df.select("flag")).collect()[0].flag is None


def test_two_thousand_tickers_are_planned_quickly(spark, tmp_path):
    names = [f"{f}|T{k}'`.{k}" for k in range(2000) for f in ("High", "Low", "Open", "Close")]
    wide = spark.range(3).selectExpr("cast(id as string) as Date", "cast(id as double) as v")
    quoted = [n.replace("`", "``") for n in names]
    wide.selectExpr("Date", *[f"v as `{n}`" for n in quoted[:8]]).write.parquet(str(tmp_path / "wide"))
    delivered = spark.read.parquet(str(tmp_path / "wide")).selectExpr("*", *[f"cast(null as double) as `{n}`" for n in quoted[8:]])
    begin = time.perf_counter()
    long = quotes.quotes_long(delivered)
    long._jdf.queryExecution().optimizedPlan()
    assert time.perf_counter() - begin < 5
    got = sorted((r.date, r.ticker_list, r.high, r.volume) for r in long.collect())
    assert got == sorted((str(d), f"T{k}'`.{k}", float(d), None) for d in range(3) for k in range(2))


def star(spark, folder):
    """A few line items, parts, suppliers and documents."""
    spark.range(400).selectExpr(
        "id as l_orderkey", "id % 7 + 1 as l_partkey", "if(id % 50 = 0, null, id % 9) as l_suppkey",
        "cast(id % 4 + 1 as int) as l_linenumber", "cast(id % 5 + 1 as double) as l_quantity",
        "if(id % 11 = 0, null, id * 1.25D) as l_extendedprice", "(id % 11) / 100D as l_discount",
        "(id % 9) / 100D as l_tax", "if(id % 3 = 0, 'R', 'N') as l_returnflag",
        "if(id % 2 = 0, 'O', 'F') as l_linestatus",
        "if(id % 40 = 0, null, cast(date_add(date'1995-01-05', cast(id * 2 as int)) as timestamp)) as l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(9).selectExpr("id as s_suppkey", "concat('S', id) as s_name").write.parquet(f"{folder}/supplier.parquet")
    spark.range(8).selectExpr(
        "id as p_partkey", "concat('Brand#', id) as p_brand", "'TYPE' as p_type", "cast(id as int) as p_size"
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(9).selectExpr(
        "id as doc_id", "'um; dois' as text", "'pt' as lang", "'web' as source"
    ).write.parquet(f"{folder}/documents.parquet")


def test_raw_files_are_packed_and_hold_every_line(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "raw")
    star(spark, folder)
    standins.raw_files(spark, folder, root)
    parts = [p.name for p in (tmp_path / "raw").glob("*.csv/part-*")]
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    made = {
        "itr_dre": standins.statement_lines(spark, folder, "income", False),
        "dfp_bpa": standins.statement_lines(spark, folder, "assets", True),
        "itr_dfc": standins.cash_flow_filings(spark, folder, False),
    }
    for kind, lines in made.items():
        schema = schemas.BALANCE_LINES if kind.endswith("bpa") else schemas.STATEMENT_LINES
        read = lake.scan_delimited(spark, lake.raw_file_glob(root, kind, range(1990, 2000)), schema)
        wanted = lines.filter("DT_REFER is not null").select(*[F.col(f.name).cast(f.dataType) for f in schema])
        assert read.count() == wanted.count() > 0
        assert read.exceptAll(wanted).isEmpty() and wanted.exceptAll(read).isEmpty()


def test_raw_files_and_filings_exchange_no_text(spark, tmp_path):
    folder = str(tmp_path / "in")
    star(spark, folder)
    plan = standins.cash_flow_filings(spark, folder, True)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(dealt) == 1 and "CNPJ_CIA" not in dealt[0] and "DENOM_CIA" not in dealt[0]
