"""Invariants of random / iterative operators and brute-force cross-checks."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF
from kestrel.operators import metrics as mt
from kestrel.operators import split as sp
from kestrel.operators.neighbors import knn_join
from kestrel.sources.tables import read_table


def test_exact_rank_is_a_permutation_per_class(spark):
    o = read_table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    r = sp.exact_rank(o, ["o_orderstatus"], ["o_orderkey"])
    chk = r.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                                         F.countDistinct("rank").alias("d")).collect()
    for c in chk:
        assert c.lo == 1 and c.hi == c.n == c.d


def test_stratified_split_quotas(spark):
    o = read_table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    s = sp.stratified_split(o, "o_orderstatus", ["o_orderkey"], 0.2)
    n = o.count()
    n_test = s.filter(F.col("split") == "test").count()
    assert n_test == int(np.ceil(0.2 * n))
    per = s.groupBy("o_orderstatus").agg(F.avg((F.col("split") == "test").cast("double")).alias("share")).collect()
    assert all(abs(p.share - 0.2) < 0.01 for p in per)


def test_resampling_touches_training_rows_only(spark):
    o = read_table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    folds = sp.stratified_folds(o, "o_orderstatus", ["o_orderkey"], 5).drop("rank")
    out = sp.resample_train_only(folds, "fold", 0, "o_orderstatus", ["o_orderkey"])
    held = out.filter(F.col("fold") == 0)
    assert held.count() == folds.filter(F.col("fold") == 0).count()
    assert held.filter(F.col("copy") != 1).count() == 0
    counts = [r["count"] for r in out.filter(F.col("fold") != 0).groupBy("o_orderstatus").count().collect()]
    assert len(set(counts)) == 1                                   # every class at the majority count


def test_auc_and_ap_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 5) / 5 + y * 0.1                # heavy ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    st = mt.score_table(df, ["s"], "y", classes=[1])
    auc = mt.roc_auc(st).first().roc_auc
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12
    ap = mt.average_precision(st).first().average_precision
    order = sorted(set(s), reverse=True)
    tot, prev_r = 0.0, 0.0
    for t in order:
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        rec = tp / (y == 1).sum()
        tot += (rec - prev_r) * tp / (tp + fp)
        prev_r = rec
    assert abs(ap - tot) < 1e-12


def test_knn_join_matches_numpy(spark):
    e = read_table(spark, SF, "embeddings")
    got = knn_join(e, e, "vec_id", "embedding", 3, block_rows=64)
    pdf = e.toPandas()
    X = np.stack(pdf.embedding.to_numpy()).astype("float64")
    ids = pdf.vec_id.to_numpy()
    d = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = {(ids[i], ids[j]) for i in range(len(ids)) for j in np.argsort(d[i], kind="stable")[:3]}
    have = {(r.qkey, r.rkey) for r in got.collect()}
    assert have == want


def test_sampled_shapley_sums_to_score_difference(spark):
    from pyspark.ml.functions import vector_to_array

    from kestrel.operators import ml
    from kestrel.operators.attribution import shapley_sampled
    e = read_table(spark, SF, "embeddings").withColumn("label", F.col("label") % 3)
    model = ml.make_estimator("forest", 3, 64, {"numTrees": 5, "maxDepth": 3}).fit(ml.with_vector(e, "embedding"))
    phi = shapley_sampled(e, "vec_id", "embedding", model, 64, 3, permutations=2)
    tot = phi.groupBy("vec_id", "class").agg(F.sum("phi").alias("s"))
    mean = [r.m for r in e.select(F.posexplode("embedding").alias("j", "x")).groupBy("j").agg(F.avg("x").alias("m")).orderBy("j").collect()]
    ref = spark.createDataFrame([(0, mean)], "vec_id long, embedding array<double>")
    f_ref = model.transform(ml.with_vector(ref, "embedding")).select(vector_to_array("probability").alias("p")).first().p
    f_x = model.transform(ml.with_vector(e, "embedding")).select("vec_id", vector_to_array("probability").alias("p"))
    chk = tot.join(f_x, "vec_id").select((F.col("s") - (F.col("p")[F.col("class")] - F.lit(0.0))).alias("s_minus_fx"), "class").collect()
    for r in chk:
        assert abs(r.s_minus_fx + f_ref[r["class"]]) < 1e-9


def test_forest_interval_mean_is_forest_probability(spark):
    from pyspark.ml.functions import vector_to_array

    from kestrel.operators import ml
    from kestrel.operators.scoring import forest_interval
    e = ml.with_vector(read_table(spark, SF, "embeddings").withColumn("label", F.col("label") % 3), "embedding")
    model = ml.make_estimator("forest", 3, 64, {"numTrees": 6, "maxDepth": 4}).fit(e)
    iv = forest_interval(model, e, keep=["vec_id"])
    p = model.transform(e).select("vec_id", vector_to_array("probability").alias("p"))
    rows = iv.join(p, "vec_id").select(F.abs(F.col("member_mean") - F.col("p")[F.col("pred")]).alias("d"),
                                       "confidence_low", "confidence_high").collect()
    assert max(r.d for r in rows) < 1e-9
    assert all(0.0 <= r.confidence_low <= r.confidence_high <= 1.0 for r in rows)
