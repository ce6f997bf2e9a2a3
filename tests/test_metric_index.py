"""Exact kNN with pruning and the hashed join against the blocked join; kNN mutual information and
permutation importance against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import attribution as at
from kestrel.operators import metric_index as mi
from kestrel.operators import ml
from kestrel.operators import neighbors as nb


def vectors(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")


def clustered(n, clusters, dim, seed, spread=0.05):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dim))
    return centres[draw.integers(clusters, size=n)] + spread * draw.normal(size=(n, dim))


def rows(df):
    return sorted((r.qkey, r.nn_rank, r.rkey, r.dist2) for r in df.collect())


def test_pivot_join_returns_the_exact_rows_and_compares_few_pairs(spark):
    df = vectors(spark, clustered(3000, 30, 8, 1))
    found, counts = mi.pivot_knn_join(df, df, "id", "vec", 5, pivots=40, block_rows=64)
    assert rows(found) == rows(nb.knn_join(df, df, "id", "vec", 5))
    c = counts.first()
    assert (c.queries, c.refs) == (3000, 3000) and c.compared < 0.2 * 3000 * 3000


def test_pivot_join_with_copies_ties_and_two_tables(spark, monkeypatch):
    monkeypatch.setattr(mi, "GROUP_QUERIES", 50)                       # many groups meet a ring
    draw = np.random.default_rng(2)
    x = draw.integers(0, 3, (400, 3)).astype(float)                      # 27 points: ties everywhere
    x[:150] = 1.0                                                        # a third are copies of one row
    refs, queries = vectors(spark, x), vectors(spark, draw.integers(0, 4, (60, 3)).astype(float), 10_000)
    found, _ = mi.pivot_knn_join(queries, refs, "id", "vec", 7, exclude_self=False, pivots=9, block_rows=16)
    assert rows(found) == rows(nb.knn_join(queries, refs, "id", "vec", 7, exclude_self=False))
    own, _ = mi.pivot_knn_join(refs, refs, "id", "vec", 4, pivots=5, block_rows=32)
    assert rows(own) == rows(nb.knn_join(refs, refs, "id", "vec", 4))


def test_pivot_join_of_small_and_empty_tables(spark):
    few = vectors(spark, [[0.0, 1.0], [0.0, 2.0], [5.0, 5.0]])
    found, _ = mi.pivot_knn_join(few, few, "id", "vec", 10, pivots=2)
    assert rows(found) == rows(nb.knn_join(few, few, "id", "vec", 10)) and found.count() == 6
    found, counts = mi.pivot_knn_join(few, few.limit(0), "id", "vec", 3)
    assert found.count() == 0 and counts.first().compared == 0
    assert mi.pivot_knn_join(few.limit(0), few, "id", "vec", 3)[0].count() == 0
    nulls = few.unionByName(spark.createDataFrame([(9, None)], "id long, vec array<double>"))
    assert rows(mi.pivot_knn_join(nulls, nulls, "id", "vec", 2)[0]) == rows(nb.knn_join(few, few, "id", "vec", 2))


def test_hashed_join_reaches_its_recall(spark):
    df = vectors(spark, clustered(2000, 40, 16, 3, spread=0.2))
    exact = {(r.qkey, r.rkey) for r in nb.knn_join(df, df, "id", "vec", 10).collect()}
    close = mi.hashed_knn_join(df, df, "id", "vec", 10)
    got = rows(close)
    assert len({(q, r) for q, _, r, _ in got} & exact) >= 0.9 * len(exact)
    x = {r.id: np.array(r.vec) for r in df.collect()}
    q, _, r, d = got[17]
    assert math.isclose(d, ((x[q] - x[r]) ** 2).sum(), rel_tol=1e-12) and len({(q, n) for q, n, _, _ in got}) == len(got)


# ---- mutual information -----------------------------------------------------------------------------

def psi(n):
    return sum(1 / i for i in range(1, n)) - 0.57721566490153286


def plain_information(values, labels, k):
    keep = [i for i, c in enumerate(labels) if labels.count(c) > 1]
    values, labels = [values[i] for i in keep], [labels[i] for i in keep]
    total = [0.0, 0.0, 0.0]
    for i, (v, c) in enumerate(zip(values, labels)):
        own = sorted(abs(v - w) for j, (w, d) in enumerate(zip(values, labels)) if d == c and j != i)
        kk = min(k, len(own))
        radius = own[kk - 1]
        inside = max(1, sum(v - radius < w < v + radius for w in values))
        total = [t + x for t, x in zip(total, (psi(kk), psi(len(own) + 1), psi(inside)))]
    n = len(values)
    return max(0.0, psi(n) + (total[0] - total[1] - total[2]) / n)


def jittered(key, feature, v, most):
    import hashlib
    u = int(hashlib.md5(f"{key}|{feature}|42".encode()).hexdigest()[:13], 16) / (1 << 52)
    return v + most * 1e-7 * u


def test_knn_information_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    n = 240
    y = draw.choice(4, n, p=[0.5, 0.3, 0.19, 0.01]).tolist()
    y[0] = 9                                                               # a class of one row
    a, b = [float(v + draw.normal()) for v in y], [float(v) for v in draw.integers(0, 4, n)]        # continuous; ties
    table = spark.createDataFrame([(i, int(y[i]), a[i], b[i] if i % 11 else None, float("nan") if i % 2 else 0.0) for i in range(n)],
                                  "id long, y int, a double, b double, c double")
    got = {r.feature: r for r in at.mutual_information_knn(table, "id", ["a", "b"], "y", bucket_rows=20).collect()}
    for name, values in (("a", a), ("b", [v if i % 11 else None for i, v in enumerate(b)])):
        most = max(abs(v) for v in values if v is not None)
        live = [(jittered(i, name, v, most), y[i]) for i, v in enumerate(values) if v is not None]
        assert math.isclose(got[name].mi, plain_information(*map(list, zip(*live)), 3), abs_tol=1e-9) and got[name].estimator == "knn_3"
    assert got["a"].mi > 0.2 > got["b"].mi and got["a"].n == n - 1
    assert [r.feature for r in at.mutual_information_knn(table.limit(0), "id", ["a"], "y").collect()] == []


def test_digamma(spark):
    got = spark.range(1, 60).select(at.digamma(F.col("id")).alias("p"), "id").collect()
    assert max(abs(r.p - psi(r.id)) for r in got) < 1e-10


# ---- permutation importance ----------------------------------------------------------------------------

def test_importance_of_a_fitted_pipeline(spark):
    draw = np.random.default_rng(6)
    y = draw.integers(0, 3, 300)
    rows_ = [(i, int(c), float(c + 0.1 * draw.normal()), float(draw.normal())) for i, c in enumerate(y)]
    df = spark.createDataFrame(rows_, "id long, label int, good double, noise double")
    model = ml.fit_final(df, 3, "forest", features=["good", "noise"], params={"numTrees": 5, "maxDepth": 4})
    found = at.permutation_importance(df, "id", "label", ["good", "noise"], 3, model, repeats=3)
    got = {r.feature: r for r in found.collect()}
    assert got["good"].importance_mean > 0.4 and abs(got["noise"].importance_mean) < 0.05
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan                                           # nothing is ranked a repeat


@pytest.mark.parametrize("n", [1, 2, 12, 997, 30030])
def test_shifts_are_bijections(n):
    for r in range(4):
        a, b = at.shift_of(r, n, 42)
        assert len({(a * i + b) % n for i in range(n)}) == n
