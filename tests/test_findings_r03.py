"""Tests for the findings of round 3."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import attribution as at
from kestrel.operators import metric_index as mi
from kestrel.operators import neighbors as nb
from kestrel.operators import prep


# ---- F1, F11: permutation importance -------------------------------------------------------------------

def _weighted_f1(y, pred, k=3):
    out = 0.0
    for c in range(k):
        tp, support, said = ((y == c) & (pred == c)).sum(), (y == c).sum(), (pred == c).sum()
        out += support * (2 * tp / (support + said) if support + said else 0.0)
    return out / len(y)


def test_every_repeat_has_a_shuffle_of_its_own(spark, monkeypatch):
    draw = np.random.default_rng(3)
    n, repeats, seed = 157, 4, 42
    a, b = draw.normal(size=n), draw.normal(size=n)
    y = np.where(a + 0.3 * b > 0.5, 2, np.where(a > -0.5, 1, 0))
    df = spark.createDataFrame([(i, int(y[i]), float(a[i]), float(b[i])) for i in range(n)], "id long, label int, a double, b double")
    scorer = lambda d: F.when(F.col("a") + 0.3 * F.col("b") > 0.5, 2).when(F.col("a") > -0.5, 1).otherwise(0)       # noqa: E731
    predict = lambda u, v: np.where(u + 0.3 * v > 0.5, 2, np.where(u > -0.5, 1, 0))       # noqa: E731
    order = lambda r, s: sorted(range(n), key=lambda i: (hashlib.md5(f"{i}|{r}|{s}".encode()).hexdigest(), i))       # noqa: E731
    drops = {"a": [], "b": []}
    for r in range(repeats):
        from_ = np.empty(n, int)
        from_[order(r, seed)] = order(r, seed + 1)
        base = _weighted_f1(y, predict(a, b))
        drops["a"].append(base - _weighted_f1(y, predict(a[from_], b)))
        drops["b"].append(base - _weighted_f1(y, predict(a, b[from_])))
    plans, real = {}, at.materialize

    def seen(frame, purpose="table"):
        plans[purpose] = frame._jdf.queryExecution().executedPlan().toString()
        return real(frame, purpose)

    monkeypatch.setattr(at, "materialize", seen)
    got = {r.feature: r for r in at.permutation_importance(df, "id", "label", ["a", "b"], 3, scorer, repeats, seed).collect()}
    for f, d in drops.items():
        assert abs(got[f].importance_mean - np.mean(d)) < 1e-12 and abs(got[f].importance_std - np.std(d)) < 1e-12
    # the rows of all repeats meet in a shuffle; only the bucket offsets of the two ranks are broadcast
    assert plans["importance-scores"].count("SortMergeJoin") == 1


# ---- F8 to F10, F12 to F15: nearest neighbours ---------------------------------------------------------

def _plain_nearest(q, qk, r, rk, k, exclude_self, bound=None):
    out = []
    for i in range(len(q)):
        found = []
        for j in range(len(r)):
            d = 0.0
            for a, b in zip(q[i].tolist(), r[j].tolist()):
                d += (a - b) * (a - b)
            if np.isfinite(d) and not (exclude_self and qk[i] == rk[j]) and (bound is None or not d > bound[i]):
                found.append((d, rk[j], j))
        out += [(i, j, d) for d, _, j in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("kind", ["plain", "copies", "far", "huge", "missing"])
def test_nearest_is_exact(kind):
    draw = np.random.default_rng(8)
    r = draw.normal(size=(300, 5)).round(1)
    if kind == "copies":
        r[40:240] = r[3]                                  # one vector fills most of the block
    if kind == "far":
        r = r * 1e-3 + 1e6                                # the product rounds away most of the distance
    if kind == "huge":
        r = r * 1e160
    if kind == "missing":
        r[::7, 2], r[5, 1] = np.nan, np.inf
    keys = draw.permutation(300) * 3
    q, qk = np.concatenate([r[:80], draw.normal(size=(10, 5))]), np.concatenate([keys[:80], np.arange(10) * 3 + 1])
    for bound in (None, np.where(np.arange(90) % 2, np.nan, 0.5), np.full(90, 0.3)):
        for exclude in (True, False):
            got = list(zip(*(x.tolist() for x in nb.nearest(q, qk, r, keys, 4, exclude, bound))))
            assert got == _plain_nearest(q, qk, r, keys, 4, exclude, bound)


def test_rows_without_a_vector_take_no_part(spark):
    rows = [(i, [float(i), 1.0]) for i in range(6)] + [(9, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted(tuple(r) for r in nb.knn_join(df, df, "id", "v", 1).collect())
    assert got == [(0, 1, 1.0, 1), (1, 0, 1.0, 1), (2, 1, 1.0, 1), (3, 2, 1.0, 1), (4, 3, 1.0, 1), (5, 4, 1.0, 1)]


def test_rings_do_not_grow_with_the_rows(spark, monkeypatch):
    made, real = [], mi._rings
    monkeypatch.setattr(mi, "_rings", lambda placed, rows: made.append(real(placed, rows)) or made[-1])
    draw = np.random.default_rng(2)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(draw.normal(size=(900, 3)).tolist())], "id long, v array<double>")
    got = mi.pivot_knn_join(df, df, "id", "v", 3, pivots=4, block_rows=8)[0]
    assert made[0].count() <= 4 * (mi.RINGS + 1)
    same = nb.knn_join(df, df, "id", "v", 3)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, same.collect()))


# ---- F18, F20: mutual information ----------------------------------------------------------------------

def test_rows_are_unpivoted_once(spark):
    df = spark.createDataFrame([(i, f"c{i % 3}", float(i % 7), float(i % 3)) for i in range(90)], "id long, label string, a double, b double")
    found = at.mutual_information(df, ["a", "b"], "label", 10)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.feature: r.mi for r in found.collect()}
    assert abs(got["b"] - np.log(3)) < 1e-12 and got["a"] < 0.2


def test_jitter_is_drawn_once(spark, monkeypatch):
    plans, real = {}, at.materialize

    def seen(frame, purpose="table"):
        plans[purpose] = frame._jdf.queryExecution().optimizedPlan().toString()
        return real(frame, purpose)

    monkeypatch.setattr(at, "materialize", seen)
    df = spark.createDataFrame([(i, i % 2, float(i % 7)) for i in range(60)], "id long, label int, a double")
    assert at.mutual_information_knn(df, "id", ["a"], "label").count() == 1
    assert "md5" in plans["jittered"] and "md5" not in plans["neighbours"]


# ---- F2, F4, F5, F7, F16, F17: the preprocessor --------------------------------------------------------

def test_dominant_values_are_found_wherever_they_lie(spark):
    # all other values at the start, so that the first batches have other majorities; 4,000 rows, 0.1 % = 4 rows
    rows = [(7.0 if i < 4 else 1.0, 7.0 if i < 5 else 1.0, 2.0 if i % 5 else None, float(i), "3" if i >= 4 else "x1") for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e string").repartition(3)
    conf, batch = spark.conf, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = {r["column"]: r["reason"] for r in prep.prune_decisions(df).collect()}
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == {"a": "dominant", "b": "kept", "c": "dominant", "d": "kept", "e": "dominant"}
    assert {r["column"]: r["reason"] for r in prep.prune_decisions(df, dominant_limit=0.6).collect()} == got | {"b": "dominant"}


# ---- F3: compare_imbalance ------------------------------------------------------------------------------

def test_only_rows_that_can_seed_a_sample_ask_for_neighbours(spark, monkeypatch):
    draw = np.random.default_rng(4)
    labels = [0] * 90 + [1] * 25 + [None] * 12
    df = spark.createDataFrame([(i, y, draw.normal(size=3).tolist()) for i, y in enumerate(labels)], "id long, y int, x array<double>")
    whole = {r.id: (r.ratio, r.weight, r.n_synthetic) for r in nb.adasyn_density(df, "id", "x", "y").collect()}
    some = {r.id: (r.ratio, r.weight, r.n_synthetic) for r in nb.adasyn_density(df, "id", "x", "y", short_only=True).collect()}
    assert len(whole) == 127 and some == {i: v for i, v in whole.items() if i >= 90}
    assert all(v[2] == 0 for i, v in whole.items() if i < 90)
    asked, real = [], nb.knn_join

    def seen(queries, *args, **options):
        asked.append({r.id for r in queries.select("id").collect()})
        return real(queries, *args, **options)

    monkeypatch.setattr(nb, "knn_join", seen)
    made = nb.adasyn(df, "id", "x", "y").groupBy("seed_key").count().collect()
    assert {r["seed_key"]: r["count"] for r in made} == {i: v[2] for i, v in whole.items() if v[2]}
    per_class = nb.smote(df, "id", "x", "y").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in per_class} == {1: 65, None: 78}
    # every row of the largest class was asked for before, four times over
    assert asked[0] == set(range(90, 127)) and asked[1] == {i for i, v in whole.items() if v[2]} and asked[2] == set(range(90, 127))


def test_resampled_rows_are_made_once_for_a_fit(spark):
    from kestrel.operators import experiments as ex
    draw = np.random.default_rng(5)
    df = spark.createDataFrame([(i, int(i % 4 == 0), draw.normal(size=2).tolist()) for i in range(80)], "id long, y int, x array<double>")
    plan = ex.FoldPlan(df, "y", 2, "id", 2, features="x")
    made = spark.sparkContext.accumulator(0)

    def sampler(train):
        def passed(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch
        rows = train.select("y", "x")
        return rows.mapInArrow(passed, rows.schema)

    ex.family_arm(plan, "logistic", {"maxIter": 3}, sampler)(0, plan.part(0, True))
    assert made.value == 40


# ---- F6: forest_interval --------------------------------------------------------------------------------

def _rings(n, seed):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 5))
    return x, (x[:, 0] ** 2 + x[:, 1] ** 2 > 1.4).astype(int) + (x[:, 2] > 1)


def test_a_tree_without_draws_separates_its_rows():
    from kestrel.operators import forest as fo
    draw = np.random.default_rng(2)
    x = np.unique(draw.integers(0, 32, (600, 4)), axis=0).astype(np.uint8)
    y, one = draw.integers(0, 3, len(x)), np.ones(len(x))
    t = fo.grow(x, y, one, one, 3, 4, 1, 60, draw)
    stats = np.array([np.bincount(y[[r for r in range(len(x)) if _leaf(t, x[r]) == leaf]], minlength=3) for leaf in np.flatnonzero(t["feature"] == -1)])
    assert (stats == t["stats"][t["feature"] == -1]).all() and ((stats > 0).sum(axis=1) == 1).all()
    shallow = fo.grow(x, y, one, one, 3, 4, 20, 4, draw)
    assert (shallow["stats"].sum(axis=1) >= 20).all() and len(shallow["feature"]) <= 31
    # the first cut is the best of all cuts
    gini = lambda c: (c ** 2).sum() / c.sum() if c.sum() else 0.0       # noqa: E731
    best = max(gini(np.bincount(y[m], minlength=3)) + gini(np.bincount(y[~m], minlength=3)) for f in range(4) for b in range(31) for m in [x[:, f] <= b])
    assert abs(t["gain"][0] - (best - gini(np.bincount(y, minlength=3)))) < 1e-9


def _leaf(t, row):
    at = 0
    while t["feature"][at] != -1:
        at = t["left"][at] if row[t["feature"][at]] <= t["bin"][at] else t["right"][at]
    return at


@pytest.mark.parametrize("local", [65_536, 300])
def test_deep_forest_learns_saves_and_agrees_with_its_interval(spark, monkeypatch, local):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.functions import vector_to_array

    from kestrel.operators import forest as fo
    from kestrel.operators import ml
    from kestrel.operators.scoring import forest_interval
    from kestrel.session import checkpoint_dir
    monkeypatch.setattr(fo, "LOCAL_ROWS", local)             # 300: the upper levels are grown from sums
    x, y = _rings(1500, 1)
    df = ml.with_vector(spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(1500)], "id long, label int, x array<double>"), "x")
    est = ml.make_estimator("forest", 3, 5, {"numTrees": 30})
    assert isinstance(est, fo.DeepForest)                    # Spark's own was used for any depth before
    model = Pipeline(stages=[est]).fit(df)
    path = f"{checkpoint_dir(spark)}/deep-{local}-{np.random.default_rng().integers(1 << 60)}"
    model.write().save(path)
    u, v = _rings(800, 2)
    test = ml.with_vector(spark.createDataFrame([(i, u[i].tolist()) for i in range(800)], "id long, x array<double>"), "x")
    p = {r.id: np.array(r.p) for r in PipelineModel.load(path).transform(test).select("id", vector_to_array("probability").alias("p")).collect()}
    assert np.mean([p[i].argmax() == v[i] for i in range(800)]) > 0.88 and max(abs(q.sum() - 1) for q in p.values()) < 1e-9
    forest = model.stages[0].forest()
    assert len(forest.roots) == 30
    inner = np.flatnonzero(forest.feature != -1)
    assert np.allclose(forest.cover[inner], forest.cover[forest.left[inner]] + forest.cover[forest.right[inner]])
    assert (forest.cover[forest.feature == -1] >= 2).all()
    shares = forest.value[forest.leaves(u)] * 30
    got = {r.id: r for r in forest_interval(model.stages[0], test, keep=["id"]).collect()}
    assert len(got) == 800
    for i, r in got.items():
        mine = shares[i, :, r.pred]
        assert r.pred == p[i].argmax() and abs(r.member_mean - mine.mean()) < 1e-9 and abs(r.member_std - mine.std()) < 1e-9
        assert abs(r.confidence_low - max(0, mine.mean() - 1.96 * mine.std())) < 1e-9
    gains = model.stages[0].gains(5)
    assert abs(sum(gains) - 1) < 1e-9 and min(gains[:3]) > max(gains[3:])


# ---- F19: compare_models (its nearest neighbours) --------------------------------------------------------

@pytest.mark.parametrize("copies", [1, 60])
def test_nearest_orders_a_part_of_the_block_and_is_exact(monkeypatch, copies):
    draw = np.random.default_rng(6)
    r = np.repeat(draw.normal(size=(900 // copies, 4)).round(1), copies, axis=0)
    rk, q = draw.permutation(len(r)) + 5, r[::7].copy()
    qk = rk[::7].copy()
    widest, real = [], np.partition
    monkeypatch.setattr(nb, "PROBE", 32, raising=False)
    monkeypatch.setattr(np, "partition", lambda a, *rest, **options: widest.append(a.shape[1]) or real(a, *rest, **options))
    for exclude_self in (True, False):
        rows, cols, dist = nb.nearest(q, qk, r, rk, 6, exclude_self)
        assert list(zip(rows, cols, dist)) == _plain_nearest(q, qk, r, rk, 6, exclude_self)
    assert max(widest) == 32                  # the whole block was ordered before


# ---- F16: score_partial (the preprocessor's passes) ------------------------------------------------------

def _wide(spark, n=40_000, parts=3):
    u = lambda s: F.rand(s)       # noqa: E731
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("key"), (u(1) * 7 + 1e9).alias("far"), F.when(u(2) > 0.3, F.randn(3)).alias("gaps"), F.when(u(4) > 0.7, u(5)).alias("rare"),
        F.lit(3.25).alias("same"), F.when(F.col("id") < 39, F.lit(1.0)).otherwise(F.lit(2.0)).alias("nearly"),
        F.when(F.col("id") < 42, F.lit(1.0)).otherwise(F.lit(2.0)).alias("enough"), F.floor(u(6) * 4).alias("few"),
        F.when(F.col("id") % 9 == 0, F.lit("n/a")).otherwise((F.col("id") % 101).cast("string")).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit(float("inf"))).otherwise(F.randn(7)).alias("half"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") > 30_000, F.col("id") * 1.0).alias("late")).withColumn("twin", F.col("gaps") * -2 + 1).withColumn("other", F.col("few") + F.col("far") - 1e9)


def test_the_preprocessor_is_fitted_from_two_passes_that_store_nothing(spark, monkeypatch):
    from pyspark.ml import Pipeline
    rows = _wide(spark)
    made = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    pre = prep.build_preprocessor(target="label", passthrough=["key"])
    one_by_one = Pipeline(stages=pre.getStages()).fit(rows).stages
    stored, real = [], type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda df, *a, **k: stored.append(df) or real(df, *a, **k))
    got = pre.fit(rows.mapInArrow(passed, rows.schema)).stages
    assert not stored and made.value <= 2 * 40_000               # all rows were stored twice over before
    assert got[2].get("columns") == one_by_one[2].get("columns") and "enough" in got[2].get("columns") and "nearly" not in got[2].get("columns")
    assert got[3].get("columns") == one_by_one[3].get("columns") and got[3].get("droppedBy") == one_by_one[3].get("droppedBy") == {"twin": "gaps"}
    assert got[4].get("medians") == one_by_one[4].get("medians") and len(got[4].get("medians")) == 7
    for name in ("means", "scales"):
        assert got[5].get(name) == pytest.approx(one_by_one[5].get(name), rel=1e-8, abs=1e-12)
    exact = np.std([r.x for r in rows.selectExpr("far - 1e9 AS x").collect()])                 # an offset costs no digits
    assert got[5].get("scales")["far"] == pytest.approx(exact, rel=1e-13)


def test_medians_are_exact_where_the_draws_mislead(spark):
    from kestrel.operators.facts import Facts
    num = _wide(spark).select("far", "gaps", F.col("few").cast("double").alias("few"))
    facts = Facts(num)
    want = {c: num.selectExpr(f"percentile({c}, 0.5)").first()[0] for c in num.columns}
    assert facts.quantiles(num.columns) == want
    for lo, hi, inside in ((-9e9, -8e9, 10.0), (9e9, 9.1e9, 10.0), (-9e9, 9e9, 1e12)):
        for c, r in facts.column.items():
            facts.column[c] = {**(r if isinstance(r, dict) else r.asDict()), "lo": lo, "hi": hi, "inside": inside}
        assert facts.quantiles(num.columns) == want


def test_few_and_no_rows_fit(spark):
    pre = prep.build_preprocessor(target="label")
    rows = spark.createDataFrame([(1.0, None), (2.0, 5.0), (4.0, 6.0)], "a double, b double")
    got = pre.fit(rows).stages
    assert got[4].get("medians") == {"a": 2.0, "b": 5.5} or got[3].get("droppedBy") == {"b": "a"}
    assert pre.fit(rows.limit(0)).stages[2].get("columns") == []


def test_wide_projections_are_compiled_on_any_session(spark):
    from kestrel.functions.features import engineer
    from kestrel.session import METHOD_CAP
    df = spark.createDataFrame([(1.0,)], "koi_period double")
    before = spark.conf.get(METHOD_CAP)
    try:
        spark.conf.unset(METHOD_CAP)
        engineer(df)
        assert spark.conf.get(METHOD_CAP) == "8000"
        spark.conf.set(METHOD_CAP, "9000")
        engineer(df)
        assert spark.conf.get(METHOD_CAP) == "9000"
    finally:
        spark.conf.set(METHOD_CAP, before)


def test_a_derivation_runs_once_a_row(spark):
    from kestrel.functions.features import engineer
    df = spark.range(50).selectExpr("id * 1.5D AS koi_period", "id - 3D AS koi_depth")
    got = engineer(df)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LOG1P") == 2         # 4 before: once in its finite test
    assert got.columns == ["koi_period", "koi_depth", "koi_period_log", "koi_depth_log", "period_class"]
    for r in got.collect():
        assert abs(r.koi_period_log - np.log1p(r.koi_period)) < 1e-12 and abs(r.koi_depth_log - np.log1p(max(r.koi_depth, 0))) < 1e-12
