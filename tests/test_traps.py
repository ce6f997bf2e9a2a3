"""Semantics traps (T1-T17, D1) on tiny literal frames with hand results."""

from pyspark.sql import functions as F

from kestrel.functions.expr import clipped_log, finite, ordinal_bin, range_flag, safe_div, to_number
from kestrel.operators import prep
from kestrel.operators.correlation import corr_matrix, greedy_prune
from kestrel.operators.quantiles import quantiles


def test_right_closed_bins_and_range_flag(spark):
    df = spark.createDataFrame([(300.0,), (300.0001,), (None,), (0.25,)], "x double")
    out = df.select(ordinal_bin("x", [300.0, 600.0]).alias("b"), range_flag("x", 0.25, 2.0).alias("f")).collect()
    assert [r.b for r in out] == [0.0, 1.0, None, 0.0]
    assert [r.f for r in out] == [0.0, 0.0, 0.0, 1.0]


def test_safe_division_and_clipped_log(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (-3.0, 2.0), (1e308, 1e-308)], "a double, b double")
    out = df.select(safe_div("a", "b").alias("q"), clipped_log("a").alias("l")).collect()
    assert out[0].q is None and out[1].q is None and out[3].q is None   # zero, missing, overflow
    assert out[2].q == -1.5
    assert out[1].l is None and out[2].l == 0.0                          # missing stays missing; clip at 0


def test_finite_and_numeric_coercion(spark):
    df = spark.createDataFrame([("abc",), (" 1.5 ",), ("1e3",), ("nan",), ("inf",), ("1d",), (None,)], "s string")
    got = [r.v for r in df.select(to_number(F.col("s")).alias("v")).collect()]
    assert got == [None, 1.5, 1000.0, None, None, None, None]
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "x double")
    assert [r.y for r in nan.select(finite("x").alias("y")).collect()] == [None, None, 2.0]


def test_exact_median_and_population_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    med = quantiles(df, ["x"], [0.5]).first()["value"]
    assert med == 2.5
    model = prep.Scaler().fit(df)
    assert abs(model.get("scales")["x"] - 1.118033988749895) < 1e-12


def test_quantiles_match_numpy_with_ties(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=300), np.full(50, 0.5), rng.integers(0, 5, 100).astype(float)])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(vals)], "x double, g int")
    got = {(r["g"], r["prob"]): r["value"] for r in quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9], by=["g"]).collect()}
    for g in range(3):
        sub = vals[np.arange(len(vals)) % 3 == g]
        for q in [0.1, 0.25, 0.5, 0.9]:
            assert abs(got[(g, q)] - np.quantile(sub, q)) < 1e-9


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, None), (4.0, 5.0, 8.0)], "a double, c double, b double")
    rows = {(r.a, r.b): r for r in corr_matrix(df, ["a", "c", "b"]).collect()}
    assert rows[("a", "c")].r is None
    assert abs(rows[("a", "b")].r - 1.0) < 1e-12 and rows[("a", "b")].n == 3   # pairwise complete


def test_greedy_pruner_follows_the_code():
    # a ~ b (b less missing -> a dropped), then the dropped a still removes c;
    # tie in missing share drops the later column.
    cols = ["a", "b", "c", "d"]
    pairs = [(0, 1, 0.99), (0, 2, 0.98), (2, 3, 0.99)]
    miss = {"a": 0.3, "b": 0.1, "c": 0.3, "d": 0.3}
    kept, dropped = greedy_prune(cols, pairs, miss, 0.97)
    assert dropped == {"a": "b", "c": "a"}
    assert kept == ["b", "d"]


def test_column_pruner_thresholds(spark):
    rows = [(float(i), None if i < 7 else 1.0, 1.0 if i else 2.0) for i in range(10)]
    df = spark.createDataFrame(rows, "keep double, gappy double, const double")
    dec = {r.column: r.reason for r in prep.prune_decisions(df).collect()}
    assert dec == {"keep": "kept", "gappy": "missing", "const": "kept"}   # 0.9 share < 0.999
    const = spark.createDataFrame([(1.0,)] * 1000 + [(2.0,)], "c double")
    assert prep.prune_decisions(const).first().reason == "dominant"
