import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import features as ft
from ledgerwave.plans import feature_sets as fs

DAY = dt.date(2020, 1, 1)


def series(spark, values, key="k"):
    rows = [(key, DAY + dt.timedelta(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, d date, v double")


def run(df, *features, max_rows=None):
    done = ft.with_features(df, list(features), ["k"], ["d"], max_rows)
    return done.orderBy("k", "d").collect()


def column(rows, name):
    return [None if r[name] is None else round(r[name], 6) for r in rows]


def test_documented_example(spark):
    rows = run(
        series(spark, [10.0, 12.0, 11.0, 13.0]), ft.pct_change("v", 1, "d"),
        ft.moving("v", 1, "mean"), ft.moving("v", 1, "std"), ft.broke_high("v", 2),
        ft.broke_low("v", 2), ft.broke_low("v", 2, fixed=True), ft.beta("v", 2), ft.ifr("v", 2),
    )
    assert column(rows, "pct_tx_v_1d") == [None, 0.2, -0.083333, 0.181818]
    assert column(rows, "amt_avg_v_1") == [10, 11, 11.5, 12]
    assert column(rows, "amt_std_v_1") == [None, 1.414214, 0.707107, 1.414214]
    assert column(rows, "cat_v_broke_high_2") == [0, 1, 0, 1]
    assert column(rows, "cat_v_broke_low_2") == [0, 1, 1, 1]
    assert column(rows, "cat_v_broke_low_2_fixed") == [0, 0, 0, 0]
    assert column(rows, "amt_beta_v_3") == [None, 2.0, None, 2.0]
    assert column(rows, "amt_IFR_v_2") == [None, None, None, 47.619048]


def test_change_through_zero(spark):
    rows = run(series(spark, [-4.0, 2.0, 0.0, 5.0]), ft.pct_change("v", 1, "d"))
    assert column(rows, "pct_tx_v_1d") == [None, 1.5, -1.0, None]


def test_names():
    assert ft.lag_feature("v", 1, "m").name == "amt_tot_v_1m_lag"
    assert ft.lag_feature("v", 4, period_text="1y").name == "amt_tot_v_1y_lag"
    assert ft.pct_change("v", 4, period_text="1y").name == "pct_tx_v_1y"
    assert len(fs.price_features_1()) == 96
    assert len(fs.price_features_2()) == 55
    assert len(fs.income_features()) == 75


def noisy(n, seed=5):
    rng = random.Random(seed)
    return [None if rng.random() < 0.05 else round(rng.uniform(-50, 200), 2) for _ in range(n)]


ALL = [
    *[ft.moving("v", n, m) for n in (3, 30, 77) for m in ("mean", "std", "var", "min", "max")],
    ft.beta("v", 30), ft.broke_high("v", 40), ft.broke_low("v", 33), ft.ifr("v", 30),
]


def close(a, b):
    if a is None or b is None or not isinstance(a, float):
        return a == b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7)


def same(left, right, features):
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for f in features:
            assert close(a[f.name], b[f.name]), (f.name, a, b)


def test_long_frames_equal_brute_force(spark):
    values = noisy(150)
    rows = run(series(spark, values), *[ft.moving("v", 77, m) for m in ("mean", "std", "var", "min", "max")])
    rows = sorted(rows, key=lambda r: r.d)
    for i, r in enumerate(rows):
        frame = [v for v in values[max(0, i - 77) : i + 1] if v is not None]
        mean = sum(frame) / len(frame) if frame else None
        var = sum((v - mean) ** 2 for v in frame) / (len(frame) - 1) if len(frame) > 1 else None
        want = {
            "avg": mean, "var": var, "std": None if var is None else math.sqrt(var),
            "min": min(frame, default=None), "max": max(frame, default=None),
        }
        for measure, value in want.items():
            assert close(r[f"amt_{measure}_v_77"], value), (i, measure)


def test_long_entities_are_cut_without_changing_results(spark):
    rng = random.Random(3)
    rows = []
    for key, n in (("hot", 900), ("small", 40), (None, 500)):
        day = 0
        for i in range(n):
            # Dense stretches, gaps, and days far apart.
            day += rng.choice([1, 1, 1, 1, 40])
            rows.append((key, DAY + dt.timedelta(day), round(rng.uniform(1, 100), 2)))
    df = spark.createDataFrame(rows, "k string, d date, v double").repartition(3)
    features = [ft.moving("v", n, "mean") for n in (5, 60)] + [ft.ifr("v", 12), ft.beta("v", 20)]
    features += [ft.lag_feature("v", 50, "d"), ft.pct_change("v", 3, "d")]
    cut = run(df, *features, max_rows=100)
    assert len(cut) == len(rows)
    same(cut, run(df, *features), features)


def test_lookback_longer_than_a_block(spark):
    df = series(spark, noisy(200, seed=9))
    features = [ft.moving("v", 90, "mean"), ft.lag_feature("v", 120, "d")]
    same(run(df, *features, max_rows=30), run(df, *features), features)


def test_moving_bounds(spark):
    rows = run(series(spark, noisy(120)), ft.moving("v", 30, "min"), ft.moving("v", 30, "max"))
    assert all(r.amt_min_v_30 <= r.v <= r.amt_max_v_30 for r in rows if r.v is not None)


@pytest.mark.parametrize("features", [fs.price_features_1(), fs.price_features_2()])
def test_one_exchange_and_one_sort(spark, features):
    schema = "id_cnpj string, ticker string, date date, adj_close double, high_price double, " \
        "low_price double, amplitude_close_high_price double"
    df = spark.createDataFrame([], schema).repartition(2)
    done = ft.with_features(df, features, fs.PRICE_KEYS, fs.PRICE_ORDER, None)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"(?m)^[\s:+-]*Sort ", plan)) == 1


def test_strength_index_recovers_from_nan(spark):
    rows = [("a", i, float("nan") if i == 50 else 10.0 + (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    for n in (10, 30):
        out = ft.with_features(df, [ft.ifr("v", n)], ["k"], ["i"], None)
        assert out.filter(F.isnan(f"amt_IFR_v_{n}")).count() == 0


def test_long_entities_with_text_order_ties_and_many_blocks(spark):
    from ledgerwave.operators.series import over_series

    rng = random.Random(4)
    rows = [("hot", "a" if i % 10 else f"b{i:05d}", i, round(rng.uniform(1, 100), 2)) for i in range(4000)]
    rows += [(None, f"c{i:03d}", i, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d string, i int, v double").repartition(3)
    features = [ft.moving("v", 20, "mean"), ft.lag_feature("v", 30, "d")]
    cut, whole = (
        sorted(map(str, ft.with_features(df, features, ["k"], ["d", "i"], n).selectExpr(
            "k", "d", "i", "v", *[f"round({f.name}, 6)" for f in features]
        ).collect())) for n in (200, None)
    )
    assert cut == whole and len(cut) == len(rows)

    sizes = []

    def measured(data, series):
        sizes.extend(r["count"] for r in data.groupBy("k", "_block").count().collect())
        return data

    many = spark.range(30_000).selectExpr("'x' as k", "cast(id % 10 = 0 as int) as d", "id as i")
    assert over_series(many, ["k"], ["d", "i"], 7, measured, 100).count() == 30_000
    assert len(sizes) == 300 and max(sizes) <= 107


def odd_series(spark):
    """Nulls, NaN, infinities, zeros and constant stretches; entities of every length,
    one of them null."""
    rng = random.Random(11)
    odd = [None, None, math.nan, math.inf, -math.inf, 0.0, 0.0, -0.0, 1e12, 1e-12]
    rows = []
    for key, n in (("long", 230), ("clean", 90), (None, 47), ("two", 2), ("one", 1), ("none", 6), ("flat", 50)):
        for i in range(n):
            value = rng.choice(odd) if rng.random() < 0.08 else rng.uniform(-20, 300)
            value = {"none": None, "flat": 0.1, "clean": rng.uniform(1, 9)}.get(key, value)
            rows.append((key, dt.datetime(2020, 1, 1) + dt.timedelta(i), value, rng.uniform(1, 5), f"t{i}"))
    schema = "k string, d timestamp, v double, w double, label string"
    return spark.createDataFrame(rows, schema).repartition(3)


EVERY = [
    *[ft.moving("v", n, m) for n in (1, 5, 60) for m in ("mean", "std", "var", "min", "max")],
    *[ft.pct_change(x, n, "d") for x in ("v", "w") for n in (1, 40)], ft.lag_feature("v", 3, "d"),
    *[ft.beta("v", n) for n in (2, 30)], *[ft.broke_high(x, n) for x in ("v", "w") for n in (1, 33)],
    *[ft.broke_low("v", n, fixed=f) for n in (2, 33) for f in (False, True)],
    *[ft.ifr(x, n) for x in ("v", "w") for n in (2, 25)],
]


@pytest.mark.parametrize("max_rows", [None, 40])
def test_batches_give_the_bits_of_native_frames(spark, monkeypatch, max_rows):
    df = odd_series(spark)
    done = []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        for least in (0, 10**9):
            monkeypatch.setattr(ft, "LONG_FRAMES", least)
            made = ft.with_features(df, EVERY, ["k"], ["d"], max_rows)
            assert ("MapInArrow" in made._jdf.queryExecution().executedPlan().toString()) == (least == 0)
            done.append((made.dtypes, sorted(
                [[(str(r.k), r.d)] + [0.0 if v == 0 else str(v) for v in r] for r in made.collect()],
                key=lambda r: r[0],
            )))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert done[0] == done[1]


def test_rounding_in_batches_is_that_of_sql(spark):
    import numpy as np

    from ledgerwave.operators.frames import Values, rounded

    rng = random.Random(2)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 0.5, -0.5, 1.5, 2.5, 0.0000005, -0.0000015]
    values += [0.285, 1.005, 2.675, 1.0078125, 1234.0234375, 499.9999999, 500.0, 1500.0, -2500.0, 4.5e15, 1e300]
    values += [1e-300, 123456789012.3456785, -987654321.5, 2.0**51 + 0.5, 0.49999999999999994, -1e-9]
    values += [rng.uniform(-10, 10) * 10.0 ** rng.randint(-8, 14) for _ in range(2000)]
    values += [k / 128 for k in range(-300, 300)] + [k / 20 for k in range(-100, 100)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    known = np.array([v is not None for v in values])
    data = np.array([0.0 if v is None else v for v in values])
    for digits in (6, 4, 1, 0, -3):
        wanted = [r[0] for r in df.select(F.expr(ft.round_sql("v", digits))).collect()]
        with np.errstate(all="ignore"):
            got = rounded(Values(data, known), digits)
        got = [float(x) if k else None for x, k in zip(got.data, got.known)]
        assert list(map(str, got)) == list(map(str, wanted)), digits


def test_long_price_frames_are_read_in_batches(spark):
    """A native frame of 361 rows feeds each of them anew to each statistic, row by row."""
    schema = "id_cnpj string, ticker string, date date, adj_close double, high_price double, " \
        "low_price double, amplitude_close_high_price double"
    df = spark.createDataFrame([], schema)
    for features in (fs.price_features_1(), fs.price_features_2()):
        done = ft.with_features(df, features, fs.PRICE_KEYS, fs.PRICE_ORDER, None)
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "stddev_samp" not in plan and "avg(" not in plan
