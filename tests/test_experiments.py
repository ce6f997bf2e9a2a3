"""Fold plans, comparisons, halving, early-stopped perceptron and the metric store."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kestrel.operators import experiments as ex
from kestrel.operators import metric_store as ms
from kestrel.operators import mlp, prep
from kestrel.session import checkpoint_dir


def table(spark, n=300, seed=1, leak=False):
    draw = np.random.default_rng(seed)
    y = draw.integers(0, 3, n)
    rows = [(i, int(c), float(c + draw.normal()), float(draw.normal()), float(c) if leak else 0.0) for i, c in enumerate(y)]
    return spark.createDataFrame(rows, "id long, label int, a double, b double, koi_score double")


def test_a_fold_is_prepared_from_its_training_rows_alone(spark):
    df = table(spark)
    plan = ex.FoldPlan(df, "label", 3, "id", folds=3, preprocessor=lambda: prep.build_preprocessor(derive=False, target="label", passthrough=["label", "fold", "id"]))
    seen = 0
    for f in range(3):
        train, test = plan.part(f, True), plan.part(f, False)
        values = np.array([r.x for r in train.collect()])
        assert "koi_score" not in plan.names[f] and values.shape[1] == len(plan.names[f]) == plan.width[f]
        assert np.abs(values.mean(axis=0)).max() < 1e-9               # scaled by the training rows
        assert np.abs(np.array([r.x for r in test.collect()]).mean(axis=0)).max() > 1e-6
        assert {r.id for r in train.select("id").collect()}.isdisjoint({r.id for r in test.select("id").collect()})
        seen += test.count()
    assert seen == 300
    card = ex.compare_models(plan, ["tree", "knn"], {"knn": {"neighbors": 9}})
    rank = {r.model: r["rank"] for r in card.collect()}
    assert rank["prior"] == 3 and set(rank) == {"tree", "knn", "prior"}
    with pytest.raises(ValueError):
        ex.FoldPlan(df, "label", 3)


def test_search_halves_its_trials_and_repeats(spark):
    plan = ex.FoldPlan(table(spark), "label", 3, "id", folds=3, features=["a", "b"])
    space = {"maxDepth": ("int", 1, 6), "minInstancesPerNode": ("int", 1, 30)}
    found = {r.trial: r for r in ex.search(plan, "tree", 6, space).collect()}
    assert sorted(r.folds for r in found.values()) == [1, 1, 1, 2, 3, 3] or sorted(r.folds for r in found.values()) == [1, 1, 1, 3, 3, 3] \
        or sorted(r.folds for r in found.values()).count(3) == 2
    assert sorted(r["rank"] for r in found.values() if r.finished) == [1, 2]
    first = max((r for r in found.values() if r.folds == 1), key=lambda r: r.objective)
    assert all(r.objective <= r.val_f1 for r in found.values()) and first["rank"] is None
    again = {r.trial: r.params for r in ex.search(plan, "tree", 6, space, halving=False).collect()}
    assert again == {t: r.params for t, r in found.items()} and set(json.loads(again[0])) == set(space)


def test_every_search_family_fits(spark):
    plan = ex.FoldPlan(table(spark, 150), "label", 3, "id", folds=2, features=["a", "b"])
    from kestrel.operators import ml
    for family, space in ml.SEARCH_SPACES.items():
        params = ex.draw_trials(space, 1)[0] | ({"numTrees": 3} if family == "forest" else {"maxIter": 2})
        card, _ = ex.evaluate(plan, {family: ex.family_arm(plan, family, params)}, folds=[0])
        assert 0 <= card.first()["accuracy"] <= 1


def test_leaks_pay_and_framings_line_up(spark):
    df = table(spark, leak=True).withColumn("y", F.col("label"))
    pre = lambda keep: prep.build_preprocessor(derive=False, target="label", keep=keep, passthrough=["y", "part"])       # noqa: E731
    got = {r.arm: r for r in ex.leakage_benchmark(df.drop("id"), "y", 3, F.col("a") > 2, pre, ["koi_score"], params={"maxIter": 20}).collect()}
    assert got["with_leakage"].leaks_kept and not got["leakage_free"].leaks_kept
    assert got["with_leakage"].premium > 0.1 and got["leakage_free"].premium == 0 and got["with_leakage"].n == got["leakage_free"].n
    scored = spark.createDataFrame([(0, 0, 0.6, 0.4), (1, 1, 0.2, 0.8), (1, 0, 0.7, 0.3)], "y int, pred int, p_0 double, p_1 double")
    three = scored.withColumn("p_2", F.lit(0.0))
    t = {r.framing: r for r in ex.framings_table({"two": (scored, 2), "three": (three, 3)}).collect()}
    assert set(t) == {"two", "three"} and t["two"].accuracy == t["three"].accuracy == pytest.approx(2 / 3)


def test_importances_of_spark_trees_and_of_the_booster(spark):
    from kestrel.operators import ml
    df = table(spark).withColumn("features", array_to_vector(F.array("a", "b")))
    for family, params in (("forest", {"numTrees": 4, "maxDepth": 3}), ("boosted", {"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 5})):
        rows = ex.native_importance(ml.make_estimator(family, 3, 2, params).fit(df), ["a", "b"], spark).collect()
        assert [r["rank"] for r in rows] == [1, 2] and rows[0].feature == "a" and sum(r.importance for r in rows) == pytest.approx(1)


def test_perceptron_stops_early_and_keeps_its_best_weights(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 2))
    y = (x[:, 0] > 0).astype(int)
    aside = [bool(i % 4 == 0) for i in range(300)]
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), aside[i]) for i in range(300)], "id long, x array<double>, label int, aside boolean")
    df = df.withColumn("features", array_to_vector("x"))
    model, losses = mlp.fit_mlp(df, [2, 5, 2], max_iter=200, steps=5, patience=3, tol=1e-3, validation="aside")
    assert len(losses) < 40                                        # before the last step: a separable set
    # improvements below ``tol`` don't count, so the kept epoch is within it of the best
    assert mlp.log_loss(model, df.where("aside"), "label") <= min(losses) + 1e-3 + 1e-12
    plain, none = mlp.fit_mlp(df, [2, 5, 2], max_iter=20, steps=10, validation_share=0.0)
    assert none == [] and plain.transform(df).where("prediction = label").count() > 270
    heavy, _ = mlp.fit_mlp(df, [2, 5, 2], max_iter=60, steps=10, alpha=0.05, validation_share=0.0)
    light, _ = mlp.fit_mlp(df, [2, 5, 2], max_iter=60, steps=10, alpha=0.0, validation_share=0.0)
    assert np.abs(heavy.weights.toArray()).mean() < np.abs(light.weights.toArray()).mean()


def test_metric_store_appends_and_reads_the_latest(spark):
    store = f"{checkpoint_dir(spark)}/store-{np.random.default_rng().integers(1 << 60)}"
    assert ms.run_summary(spark, store, "r").count() == 0
    wide = spark.createDataFrame([("x", 0.5, 1.0), ("y", None, 2.0)], "framing string, f1 double, gap double")
    ms.record(ms.long_form(wide, F.col("framing"), {"f1": "f1_weighted", "gap": "gap"}), store, "r")
    ms.record(ms.long_form(wide.where("framing = 'x'").withColumn("f1", F.lit(0.75)), "x", {"f1": "f1_weighted"}), store, "r")
    ms.record(ms.long_form(wide, "z", ["f1"]).limit(1), store, "other")
    got = {(r.metric, r.framing): r.value for r in ms.run_summary(spark, store, "r").collect()}
    assert got == {("f1_weighted", "x"): 0.75, ("gap", "x"): 1.0, ("gap", "y"): 2.0, ("f1_weighted", "y"): None}
