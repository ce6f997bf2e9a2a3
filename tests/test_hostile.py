"""NULL classes, NaN, infinities, text in numeric columns, skewed values, restarts."""

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from kestrel.functions import features as fe
from kestrel.operators import metrics as mt
from kestrel.operators import ml, prep
from kestrel.operators import split as sp
from kestrel.operators.bounded import join_on
from kestrel.operators.correlation import corr_matrix, greedy_prune
from kestrel.operators.profile import log_histogram, missing_fraction
from kestrel.operators.quantiles import quantiles
from kestrel.operators.running import running_totals
from kestrel.session import checkpoint_dir
from kestrel.sources.tables import read_delimited, read_result, read_table, write_result

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def classed(spark):
    return spark.createDataFrame([(i, None if i % 3 == 0 else "ab"[i % 2], float(i)) for i in range(30)], "k long, label string, x double")


def test_null_class_rows_stay_in_every_split_and_sampler(spark, classed):
    assert sp.stratified_folds(classed, "label", ["k"], 5).count() == 30
    split = sp.stratified_split(classed, "label", ["k"], 0.2)
    assert split.count() == 30 and split.where("split = 'test'").count() == 6 and split.where("label IS NULL AND split = 'test'").count() == 2
    weights = sp.class_weights(classed, "label")
    assert weights.where("weight IS NULL").count() == 0 and weights.count() == 30
    assert sp.oversample(classed, "label", ["k"]).where("label IS NULL").count() == 10
    assert sp.undersample(classed, "label", ["k"]).where("label IS NULL").count() == 10
    assert log_histogram(classed, "x", "label").where("label IS NULL").agg(F.sum("n")).first()[0] == 9     # x = 0 has no logarithm


def test_null_group_keeps_its_scores(spark):
    df = spark.createDataFrame([("g", 1, 0.9), ("g", 0, 0.1), (None, 1, 0.8), (None, 0, 0.3), ("g", None, 0.5), ("g", 1, NAN)], "grp string, y int, s double")
    auc = {r.grp: r.roc_auc for r in mt.roc_auc(mt.score_table(df, ["s"], "y", ["grp"], classes=[1]), ["grp"]).collect()}
    assert auc == {"g": 1.0, None: 1.0}


def test_one_outlier_does_not_gather_the_scores(spark):
    rng = np.random.default_rng(0)
    s = np.append(1 - 10 ** -rng.uniform(0, 12, 20_000), 0.0)
    df = spark.createDataFrame([(float(v), 1) for v in np.unique(s)], "s double, n long").withColumn("g", F.lit("one"))
    out = running_totals(df.repartition(4), ["g"], "s", {"upto": "n"}, totals={"all": "n"})
    rows = sorted((r.s, r.upto, r.all) for r in out.collect())
    assert [u for _, u, _ in rows] == list(range(1, len(rows) + 1)) and {a for *_, a in rows} == {len(rows)}
    dealt = df.repartitionByRange(64, "g", "s").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert dealt < 0.1 * len(rows)


@pytest.mark.parametrize("values", [
    [1.0, NAN, 3.0], [1.0, INF, -INF, 2.0], [10.0 ** e for e in range(-300, 299, 9)], [-1.5e308, 1.5e308], [], [None], [7.0] * 5000 + [8.0],
    [float(x) for x in np.exp(np.random.default_rng(5).normal(size=6000) * 60)]])
def test_quantiles_on_any_distribution(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)
    got = {r.prob: r.value for r in quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0]).collect()}
    x = np.array([v for v in values if v is not None and np.isfinite(v)])
    for q, v in got.items():
        if not len(x):
            assert v is None
        else:
            lo, hi = np.sort(x)[[int(np.floor(q * (len(x) - 1))), int(np.ceil(q * (len(x) - 1)))]]
            assert lo <= v <= hi and (lo != hi or v == lo)


def test_quantiles_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert {r.g: r.value for r in quantiles(df, ["v"], [0.5], by=["g"]).collect()} == {None: 2.0, "a": 5.0}


def test_derivation_takes_nan_infinity_and_text(spark):
    df = spark.createDataFrame([(NAN, "12.5", 1.0), (INF, "abc", 2.0), (-INF, " 20 ", 3.0), (150.0, None, None)],
                               "koi_teq double, koi_period string, koi_prad double")
    rows = fe.engineer(df).collect()
    assert [r.teq_class for r in rows] == [None, 4.0, None, 0.0]
    assert [r.period_class for r in rows] == [2.0, None, 2.0, None]
    assert [r.prad_class for r in rows] == [1.0, 2.0, 3.0, None]


def test_nan_is_missing_in_statistics(spark):
    df = spark.createDataFrame([(NAN, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, NAN)], "a double, b double")
    assert {r.column: r.missing_frac for r in missing_fraction(df).collect()} == {"a": 0.25, "b": 0.25}
    holes = spark.createDataFrame([(None, 1.0), (NAN, None), (1.0, None), (2.0, None)], "a double, b double")
    assert {r.column: r.missing_frac for r in missing_fraction(holes).collect()} == {"a": 0.5, "b": 0.75}
    assert corr_matrix(df, ["a", "b"]).first().r == pytest.approx(1.0)
    scaled = prep.Scaler().fit(df)
    assert scaled.get("means")["a"] == 3.0


def test_sides_constant_on_the_shared_rows_have_no_correlation(spark):
    rng = np.random.default_rng(1)
    rows = [(0.1 + 1e6, float(v), None) for v in rng.normal(size=50)] + [(float(v), None, 0.3) for v in rng.normal(size=50)]
    rows += [(0.1 + 1e6, 5.5e5, 0.3)] * 20
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None and got[("b", "c")] is None


def test_pruner_limit_below_one_half_is_exact(spark):
    df = spark.createDataFrame([(1.0,)] * 45 + [(float(i + 2),) for i in range(55)], "x double")
    assert prep.prune_decisions(df, dominant_limit=0.4).first().reason == "dominant"
    assert prep.prune_decisions(df, dominant_limit=0.5).first().reason == "kept"


def test_greedy_pass_equals_the_full_triangle():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        names = [f"c{i}" for i in range(n)]
        r = {(i, j): float(rng.uniform(-1, 1)) for i in range(n) for j in range(i + 1, n)}
        miss = {c: float(rng.integers(0, 3)) / 4 for c in names}
        gone = set()
        for i in range(n):                                          # the rule, on the whole triangle
            if names[i] in gone:
                continue
            for j in range(i + 1, n):
                if names[j] not in gone and abs(r[(i, j)]) > 0.6:
                    gone.add(names[j] if miss[names[j]] >= miss[names[i]] else names[i])
        kept, _ = greedy_prune(names, [(i, j, v) for (i, j), v in r.items()], miss, 0.6)
        assert kept == [c for c in names if c not in gone]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("x", 20), ("y", 30)], "k string, w int")
    assert sorted((str(r.k), r.v, r.w) for r in join_on(a, b, ["k"]).collect()) == [("None", 1, 10), ("x", 2, 20)]


def test_weighted_three_class_fits(spark):
    e = ml.with_vector(read_table(spark, SF, "embeddings").withColumn("label", F.col("label") % 3), "embedding")
    weighted = sp.class_weights(e, "label")
    for name in ("boosted", "svm"):
        model = ml.make_estimator(name, 3, 64, ml.QUICK[name], weight="weight").fit(weighted)
        assert ml.scored_frame(model, e, 3, ["vec_id"]).count() == e.count()
    with pytest.raises(ValueError):
        ml.make_estimator("mlp", 3, 64, weight="weight")


def test_boosting_stops_early_on_validation_rows(spark):
    e = ml.with_vector(read_table(spark, SF, "embeddings").withColumn("label", F.col("label") % 2), "embedding")
    marked = ml.with_validation(e, ["vec_id"])
    share = marked.where(ml.VALIDATION).count() / e.count()
    assert 0.05 < share < 0.3
    model = ml.make_estimator("boosted", 2, 64, {**ml.QUICK["boosted"], "maxIter": 40}, validation=ml.VALIDATION).fit(marked)
    assert model.getNumTrees < 40


def test_search_space_kinds():
    import random
    rng = random.Random(1)
    space = {"a": ("int", 10, 50, 20), "b": ("float", 0.5, 0.6), "c": ("log", 1e-4, 1e2), "d": ("choice", ["x", "y"])}
    draws = [ml.draw_params(space, rng) for _ in range(300)]
    assert {d["a"] for d in draws} == {10, 30, 50} and {d["d"] for d in draws} == {"x", "y"}
    assert all(0.5 <= d["b"] <= 0.6 for d in draws) and sum(d["c"] < 0.1 for d in draws) > 100


def test_result_round_trips(spark):
    base = os.path.join(checkpoint_dir(spark), f"rt-{uuid.uuid4().hex}")
    df = spark.createDataFrame([(1, "a,b", 0.5), (2, None, None)], "k int, t string, x double")
    for fmt in ("parquet", "csv", "json"):
        write_result(df, f"{base}/{fmt}", fmt)
        back = read_result(spark, f"{base}/{fmt}", fmt)
        assert sorted((r.k, r.t, r.x) for r in back.collect()) == [(1, "a,b", 0.5), (2, None, None)]
    write_result(df, f"{base}/part", partition_by=["k"])
    assert read_result(spark, f"{base}/part").where("k = 2").count() == 1
    typed = read_delimited(spark, f"{base}/csv", df.schema)
    assert typed.schema == df.schema and typed.count() == 2


def test_stream_restart_in_another_context_scores_every_file(tmp_path):
    """Two applications one after the other over the same folders: nothing is lost or scored twice."""
    import subprocess
    import sys
    script = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from kestrel.operators import ml
from kestrel.session import get_spark
from kestrel.sources.tables import read_table
from kestrel.streaming.scoring import read_scored, score_stream
spark = get_spark("local[2]", shuffle_partitions=2)
run, base = int(sys.argv[1]), {str(tmp_path)!r}
e = read_table(spark, {SF!r}, "embeddings").withColumn("label", F.col("label") % 3)
if run == 0:
    Pipeline(stages=[ml.ArrayToVector(inputCol="embedding"), ml.make_estimator("forest", 3, 64, {{"numTrees": 2, "maxDepth": 3}})]).fit(e).write().save(base + "/model")
e.where(F.col("vec_id") % 2 == run).write.parquet(f"{{base}}/in/part{{run}}")
score_stream(spark, base + "/model", base + "/in/*", base + "/out", e.schema, ["a", "b", "c"], base + "/progress", keep=["vec_id"]).awaitTermination()
got = read_scored(spark, base + "/out")
print("SCORED", got.count(), got.select("vec_id").distinct().count(), e.count())
"""
    for run in (0, 1):
        out = subprocess.run([sys.executable, "-c", script, str(run)], capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]
    scored, distinct, total = map(int, out.stdout.split("SCORED")[1].split())
    assert scored == distinct == total
