"""Tests of the changes that answer the findings of round 4."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from kestrel.llm import components as cc
from kestrel.llm import simhash
from kestrel.operators import attribution as at
from kestrel.operators import experiments as ex
from kestrel.operators import metric_index as mi
from kestrel.operators import ml
from kestrel.plans import suite_models


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """Physical plans of all tables that the SimHash operator writes, before they run."""
    seen, plain = [], simhash.written

    def noted(df, purpose):
        seen.append((purpose, plan_of(df)))
        return plain(df, purpose)

    monkeypatch.setattr(simhash, "written", noted)
    monkeypatch.setattr(cc, "written", noted)
    return seen


@pytest.mark.parametrize("drop", [False, True], ids=["op7", "pipeline"])
def test_no_side_of_a_simhash_join_passes_the_driver(spark, plans, drop):
    # 64 rows a fingerprint, sized by Spark like one
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.md5(F.concat(F.floor(F.col("id") / 2), F.lit(w)).cast("string"))
                                                                                   for w in "abcdefgh"]).alias("text"))
    out = (simhash.drop_near_duplicates if drop else simhash.simhash_near_duplicates)(docs)
    assert out.count() == (300 if drop else 600)
    joins = [p for p in plans if "Join" in p[1]]
    assert {"simhash-rooted", "cc-low", "cc-step"} <= {purpose for purpose, _ in joins}
    assert [purpose for purpose, plan in joins if "Broadcast" in plan] == []


def test_shuffles_meet_a_bounded_number_of_rows_at_once(spark, monkeypatch):
    # all repeats of all rows were ranked and joined at once
    rows = spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("y"), F.sin("id").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    scorer = lambda d: F.when(F.col("a") > 0, 0).when(F.col("b") > 3, 1).otherwise(2)       # noqa: E731
    ask = lambda: sorted(map(tuple, at.permutation_importance(rows, "id", "y", ["a", "b"], 3, scorer, repeats=4).collect()))       # noqa: E731
    whole, sizes, plain = ask(), [], at.exact_rank
    monkeypatch.setattr(at, "exact_rank", lambda df, *a, **b: sizes.append(df.count()) or plain(df, *a, **b))
    monkeypatch.setattr(at, "AT_ONCE", 200, raising=False)
    for new, old in zip(ask(), whole):
        assert new[0] == old[0] and new[1:] == pytest.approx(old[1:])
    assert len(whole) == 2 and max(sizes) == 180 and sum(sizes) == 2 * 4 * 90


def test_hashed_join_copies_vectors_a_few_tables_at_a_time(spark, monkeypatch):
    # every vector was written as doubles once a table and probe
    draw = np.random.default_rng(5)
    x = draw.normal(size=(60, 4)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    written, asked, put, join = [], [], mi.materialize, mi.knn_join
    monkeypatch.setattr(mi, "AT_ONCE", 500, raising=False)
    monkeypatch.setattr(mi, "materialize", lambda df, purpose: written.append((purpose, put(df, purpose))) or written[-1][1])
    monkeypatch.setattr(mi, "knn_join", lambda q, r, *a, **b: asked.append(q.count()) or join(q, r, *a, **b))
    found = {(r["qkey"], r["nn_rank"]): (r["rkey"], r["dist2"]) for r in mi.hashed_knn_join(rows, rows, "id", "v", 2, tables=4, bits=3, seed=9).collect()}
    planes = np.random.default_rng(9).normal(size=(12, 4))
    side = ((x.astype(float) - x.astype(float).mean(axis=0)) @ planes.T > 0).reshape(60, 4, 3)
    meets = ((side[:, None] != side[None]).sum(axis=3) <= 1).any(axis=2)
    dist = ((x.astype(float)[:, None] - x.astype(float)[None]) ** 2).sum(axis=2)
    for i in range(60):
        near = sorted((dist[i, j], j) for j in range(60) if j != i and meets[i, j])[:2]
        assert [found.get((i, n + 1), (None,))[0] for n in range(len(near))] == [j for _, j in near]
        assert [found[i, n + 1][1] for n in range(len(near))] == pytest.approx([d for d, _ in near])
    assert asked == [480, 480]
    assert [(df.count(), dict(df.dtypes)["v"]) for purpose, df in written if purpose == "knn-hashed"] == [(60, "array<float>")]


def test_compare_models_fits_the_zoo_as_it_stands(spark, monkeypatch):
    # a few rounds, trees and iterations were passed by name
    asked = {}
    monkeypatch.setattr(ex, "compare_models", lambda plan, families, params=None, prior=True: asked.update(families=families, params=params or {}, prior=prior))
    suite_models.compare_models(spark, SF)
    assert asked["families"] == suite_models.FAMILIES and asked["prior"]
    assert [f for f in asked["families"] if any(ml.ZOO_DEFAULTS.get(f, {}).get(k, v) != v for k, v in asked["params"].get(f, {}).items())] == []


def test_a_plan_of_large_folds_writes_no_copy_of_them(spark, monkeypatch):
    # every fold of every arm was written with all its features, and the table twice more
    k = suite_models._k_keyed(spark, SF).limit(500).withColumn("fold", F.col("fold") % 2).persist()
    plan = lambda: ex.FoldPlan(k, "y", 3, folds=2, fold_col="fold", preprocessor=suite_models._prepared())       # noqa: E731
    rows = lambda p: [sorted((r["y"], r["fold"], *[round(v, 9) for v in r["x"]]) for r in p.part(1, train).collect()) for train in (True, False)]       # noqa: E731
    stored, purposes, put = rows(plan()), [], ex.materialize
    monkeypatch.setattr(ex, "materialize", lambda df, purpose: purposes.append(purpose) or put(df, purpose))
    monkeypatch.setattr(ex, "STORED_BYTES", 1000, raising=False)
    large = plan()
    assert rows(large) == stored and sum(map(len, stored)) == 500
    assert purposes == [] and large.threads == 1
    k.unpersist()
