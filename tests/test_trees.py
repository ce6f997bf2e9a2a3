"""Softmax booster, flat forests and exact tree Shapley values against plain versions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import trees as tr
from kestrel.operators.boosting import SoftmaxBoosting, SoftmaxBoostingModel
from kestrel.session import checkpoint_dir


def table(spark, x, y, **more):
    rows = [(i, [None if v is None else float(v) for v in r], int(t), *[m[i] for m in more.values()]) for i, (r, t) in enumerate(zip(x.tolist(), y))]
    kinds = "".join(f", {n} {'double' if isinstance(v[0], float) else 'boolean'}" for n, v in more.items())
    return spark.createDataFrame(rows, "id long, features array<double>, label int" + kinds)


def probabilities(model, df):
    rows = model.transform(df).select("id", vector_to_array("probability").alias("p"), "prediction").orderBy("id").collect()
    return np.array([r["p"] for r in rows]), np.array([r["prediction"] for r in rows])


# ---- the same booster, one tree and one threshold at a time ------------------------------------

def plain_booster(x, y, k, rounds, step, depth, least, l2, most=31, w=None):
    n, outputs = len(x), 1 if k == 2 else k
    w = np.ones(n) if w is None else w
    prior = np.array([w[y == c].sum() for c in range(k)]) / w.sum()
    raw = np.tile(np.log(prior[1:] / prior[0]) if k == 2 else np.log(prior), (n, 1))
    for _ in range(rounds):
        if outputs == 1:
            prob = 1 / (1 + np.exp(-raw))
        else:
            prob = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
        for c in range(outputs):
            target = y == (1 if outputs == 1 else c)
            g, h = w * (prob[:, c] - target), w * prob[:, c] * (1 - prob[:, c])
            leaves = [np.arange(n)]
            frontier = [0]
            for _level in range(depth):
                found = []
                for at in frontier:
                    rows, best = leaves[at], (0.0, None)
                    for f in range(x.shape[1]):
                        for t in np.unique(x[rows, f])[:-1]:
                            left = x[rows, f] <= t
                            a, b = rows[left], rows[~left]
                            if min(len(a), len(b)) < least or min(h[a].sum(), h[b].sum()) < 1e-3:
                                continue
                            gain = sum(g[r].sum() ** 2 / (h[r].sum() + l2) for r in (a, b)) - g[rows].sum() ** 2 / (h[rows].sum() + l2)
                            if gain > best[0] + 1e-9:
                                best = gain, (a, b)
                    if best[1] is not None:
                        found.append((best[0], at, best[1]))
                room = most - len(leaves)
                frontier = []
                for _, at, (a, b) in sorted(found, key=lambda s: -s[0])[:room]:
                    leaves[at] = a
                    leaves.append(b)
                    frontier += [at, len(leaves) - 1]
                if not frontier:
                    break
            for rows in leaves:
                raw[rows, c] -= step * g[rows].sum() / (h[rows].sum() + l2)
    if outputs == 1:
        p = 1 / (1 + np.exp(-raw))
        return np.concatenate([1 - p, p], axis=1)
    return np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)


def planted(n, k, seed):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, 40, (n, 5)) / 4.0
    y = (x[:, 0] + 2 * x[:, 1] > 14).astype(int) + (x[:, 2] > 6) * (k > 2)
    flip = draw.random(n) < 0.1
    return x, np.where(flip, draw.integers(0, k, n), y)


@pytest.mark.parametrize("k, weighted", [(3, False), (2, False), (3, True)])
def test_booster_equals_a_plain_one(spark, k, weighted):
    x, y = planted(500, k, 7 + k)
    w = np.random.default_rng(1).uniform(0.5, 2, 500) if weighted else None
    df = table(spark, x, y, **({"weight": w.tolist()} if weighted else {})).repartition(3)
    settings = dict(maxIter=7, stepSize=0.3, maxDepth=3, minInstancesPerNode=5, l2=1.5, validationShare=0.0)
    model = SoftmaxBoosting(**settings, **({"weightCol": "weight"} if weighted else {})).fit(df)
    got, pred = probabilities(model, df)
    want = plain_booster(x, y, k, 7, 0.3, 3, 5, 1.5, w=w)
    assert model.rounds == 7 and np.abs(got - want).max() < 1e-9
    assert (pred == got.argmax(axis=1)).all()


def test_booster_keeps_the_largest_gains_within_the_leaf_limit(spark):
    x, y = planted(400, 3, 3)
    df = table(spark, x, y)
    model = SoftmaxBoosting(maxIter=2, stepSize=0.5, maxDepth=4, maxLeaves=5, minInstancesPerNode=4, validationShare=0.0).fit(df)
    got, _ = probabilities(model, df)
    assert np.abs(got - plain_booster(x, y, 3, 2, 0.5, 4, 4, 1.0, most=5)).max() < 1e-9


def test_booster_stops_early_with_three_classes_and_is_saved(spark):
    draw = np.random.default_rng(0)
    x, y = draw.normal(size=(600, 4)), draw.integers(0, 3, 600)           # noise: the validation loss soon rises
    aside = (np.arange(600) % 4 == 0).tolist()
    df = table(spark, x, y, aside=aside)
    model = SoftmaxBoosting(maxIter=60, stepSize=0.5, maxDepth=4, minInstancesPerNode=5, patience=4, validationIndicatorCol="aside").fit(df)
    best = int(np.argmin(model.losses))
    assert model.rounds == best and len(model.losses) == best + 5 < 60
    p = probabilities(model, df)[0][np.array(aside)]
    held = y[np.array(aside)]
    assert math.isclose(-np.log(p[np.arange(len(held)), held]).mean(), model.losses[best], rel_tol=1e-9)
    path = f"{checkpoint_dir(spark)}/booster-{draw.integers(1 << 60)}"
    model.write().save(path)
    assert (probabilities(SoftmaxBoostingModel.load(path), df)[0] == probabilities(model, df)[0]).all()


def test_booster_with_missing_values_copies_and_unlabelled_rows(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 3))
    x[:, 2] = 1.0                                                          # a constant
    y = (x[:, 0] > 0).astype(int)
    x[:150, 0] = np.where(y[:150] == 1, np.nan, x[:150, 0])                # missing values tell the class
    df = table(spark, x, y).unionByName(table(spark, x[:50], y[:50]).withColumn("label", F.lit(None).cast("int")))
    model = SoftmaxBoosting(maxIter=30, stepSize=0.3, maxDepth=3, minInstancesPerNode=5, subsamplingRate=0.8, featureShare=0.7).fit(df)
    got, pred = probabilities(model, table(spark, x, y))
    assert (pred == y).mean() > 0.97 and np.abs(got.sum(axis=1) - 1).max() < 1e-9
    with pytest.raises(ValueError):
        SoftmaxBoosting().fit(df.where("label is null"))


# ---- flat forests --------------------------------------------------------------------------------

def fitted_forest(spark, n_trees, depth, seed=5):
    x, y = planted(400, 3, seed)
    df = table(spark, x, y).withColumn("features", array_to_vector("features"))
    model = RandomForestClassifier(numTrees=n_trees, maxDepth=depth, minInstancesPerNode=2, seed=3).fit(df)
    return df, model, tr.spark_forest(model, f"{checkpoint_dir(spark)}/forest-{np.random.default_rng().integers(1 << 60)}", spark)


def test_hundreds_of_trees_equal_spark_in_one_stage(spark):
    df, model, forest = fitted_forest(spark, 400, 12)
    assert len(forest.roots) == 400
    got = tr.class_interval(forest, df, "features", ["id"], 1.96)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    p, _ = probabilities(model, df)
    rows = {r["id"]: r for r in got.collect()}
    assert all(abs(rows[i]["member_mean"] - p[i].max()) < 1e-9 and rows[i]["pred"] == p[i].argmax() for i in range(len(p)))
    x = np.array([r["x"] for r in df.select(vector_to_array("features").alias("x")).limit(1).collect()])
    one = [t.predictProbability(df.first()["features"]).toArray() for t in model.trees]
    first = rows[df.first()["id"]]
    assert math.isclose(first["member_std"], np.std([q[first["pred"]] for q in one]), abs_tol=1e-9)
    assert np.abs(forest.total(x)[0] - np.mean(one, axis=0)).max() < 1e-9


def test_a_single_spark_tree(spark):
    x, y = planted(300, 3, 9)
    df = table(spark, x, y).withColumn("features", array_to_vector("features"))
    model = DecisionTreeClassifier(maxDepth=4).fit(df)
    forest = tr.spark_forest(model, f"{checkpoint_dir(spark)}/tree-{np.random.default_rng().integers(1 << 60)}", spark)
    assert np.abs(forest.total(x) - probabilities(model, df)[0]).max() < 1e-9


# ---- Shapley values -------------------------------------------------------------------------------

def enumerated(forest, row):
    """Shapley values by all subsets of features."""
    f_n = len(row)

    def value(node, known):
        f = forest.feature[node]
        if f == tr.LEAF:
            return forest.value[node]
        left, right = forest.left[node], forest.right[node]
        if f in known:
            return value(left if forest.goes_left(row[f], forest.threshold[node]) else right, known)
        return (forest.cover[left] * value(left, known) + forest.cover[right] * value(right, known)) / forest.cover[node]

    v = {s: sum(value(r, set(s)) for r in forest.roots) for k in range(f_n + 1) for s in itertools.combinations(range(f_n), k)}
    phi = np.zeros((f_n, forest.outputs))
    for s, base in v.items():
        for f in set(range(f_n)) - set(s):
            phi[f] += math.factorial(len(s)) * math.factorial(f_n - len(s) - 1) / math.factorial(f_n) * (v[tuple(sorted((*s, f)))] - base)
    return phi


def test_tree_shapley_equals_all_subsets_of_eight_features(spark):
    draw = np.random.default_rng(8)
    x = draw.integers(0, 12, (500, 8)) / 3.0
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 1)).astype(int) + (x[:, 2] + x[:, 3] > 5)
    df = table(spark, x, y).withColumn("features", array_to_vector("features"))
    forest = tr.spark_forest(RandomForestClassifier(numTrees=5, maxDepth=7, seed=1).fit(df),
                             f"{checkpoint_dir(spark)}/shap-{draw.integers(1 << 60)}", spark)
    got = {(r["id"], r["class"], r["feature"]): r["phi"] for r in tr.shapley_trees(forest, df, "id", "features").collect()}
    assert len(got) == 500 * 3 * 8
    for i in (0, 17, 401):
        want = enumerated(forest, x[i])
        assert max(abs(got[i, c, f"f{j}"] - want[j, c]) for c in range(3) for j in range(8)) < 1e-9
    total = np.array([[sum(got[i, c, f"f{j}"] for j in range(8)) for c in range(3)] for i in range(500)])
    assert np.abs(total - (forest.total(x) - forest.expected())).max() < 1e-9


def test_booster_shapley_adds_up_to_the_raw_scores(spark):
    x, y = planted(300, 3, 2)
    x[::7, 1] = np.nan
    df = table(spark, x, y)
    model = SoftmaxBoosting(maxIter=6, stepSize=0.3, maxDepth=4, minInstancesPerNode=4, validationShare=0.0).fit(df)
    forest, base = model.forest()
    phi = tr.shapley_matrix([tr.LeafPath(p, forest.value[leaf]) for r in forest.roots.tolist() for leaf, p in forest.paths(r) if p], x, 3, True)
    assert np.abs(phi.sum(axis=1) - (forest.total(x) - forest.expected())).max() < 1e-9
    assert np.abs(phi[3] - enumerated(forest, x[3])).max() < 1e-9 and np.abs(phi[7] - enumerated(forest, x[7])).max() < 1e-9
