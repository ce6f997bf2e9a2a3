"""Queries for X1, X2, X4-X7."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import attribution as at
from ..operators import ml
from ..operators import trees as tr
from ..session import checkpoint_dir
from ..sources.tables import read_table
from .fixtures import K_FEATURES, O_FEATURES, O_WEIGHTS, k_sql, k_table, o_pred, o_pred_sql, o_score_sql, o_sql, o_table
from .registry import query, r
from .suite_metrics import sql_averaged, sql_per_class

K = f"WITH k AS ({k_sql()})"
O = f"WITH o AS ({o_sql()})"


def _u(parts):
    return "\nUNION ALL\n".join(parts)


def _mi_sql(bins=10):
    long = _u([f"SELECT label, '{c}' AS feature, {c} AS v FROM k WHERE {c} IS NOT NULL" for c in K_FEATURES])
    return (K + f""", l AS ({long}),
d AS (SELECT feature, v, count(*) AS c FROM l GROUP BY ALL),
rk AS (SELECT feature, v, coalesce(sum(c) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_less,
       sum(c) OVER (PARTITION BY feature) AS n FROM d),
b AS (SELECT l.feature, l.label, CAST(floor({float(bins)!r} * rk.n_less / rk.n) AS INTEGER) AS bin, rk.n FROM l JOIN rk ON l.feature = rk.feature AND l.v = rk.v),
j AS (SELECT feature, bin, label, count(*) AS nxy, max(n) AS n FROM b GROUP BY ALL),
t AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, bin) AS nx, sum(nxy) OVER (PARTITION BY feature, label) AS ny FROM j)
SELECT feature, {r('sum((CAST(nxy AS DOUBLE) / n) * ln(CAST(nxy AS DOUBLE) * n / (CAST(nx AS DOUBLE) * ny)))')} AS mi,
  CAST(max(n) AS BIGINT) AS n, 'equal_frequency_{bins}' AS estimator FROM t GROUP BY feature""")


@query("mutual_information", _mi_sql())
def q_mutual_information(spark, sf):
    return at.mutual_information(k_table(spark, sf), K_FEATURES, "label", 10)


def _mi_knn_sql(k=3, seed=42):
    long = _u([f"SELECT o_orderkey, y, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM o WHERE {c} IS NOT NULL" for c in O_FEATURES])
    psi = lambda n: (f"(ln({n} + 6.0) - 0.5 / ({n} + 6.0) - 1.0 / (12.0 * pow({n} + 6.0, 2)) + 1.0 / (120.0 * pow({n} + 6.0, 4)) "      # noqa: E731
                     f"- 1.0 / (252.0 * pow({n} + 6.0, 6)) + 1.0 / (240.0 * pow({n} + 6.0, 8)) - ({' + '.join(f'1.0 / ({n} + {i}.0)' for i in range(6))}))")
    steps = ", ".join(f"abs(v - {f}(v, {i}) OVER w)" for i in range(1, k + 1) for f in ("lag", "lead"))
    return (O + f""", l AS ({long}),
z AS (SELECT o_orderkey, y, feature, v + CASE WHEN max(abs(v)) OVER (PARTITION BY feature) > 0 THEN max(abs(v)) OVER (PARTITION BY feature) ELSE 1.0 END * 1e-7
      * (CAST(CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), feature, '{seed}')), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0) AS v FROM l),
c AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS nc FROM z QUALIFY nc > 1),
d AS (SELECT feature, v, nc, least({k}, nc - 1) AS k, list_sort(list_filter([{steps}], lambda x: x IS NOT NULL)) AS s FROM c
      WINDOW w AS (PARTITION BY feature, y ORDER BY v, o_orderkey)),
e AS (SELECT feature, nc, k, v, v - s[k] + 0.0 AS low, v + s[k] + 0.0 AS high FROM d),
t AS (SELECT feature, v, max(upto) AS upto FROM (SELECT feature, v + 0.0 AS v, row_number() OVER (PARTITION BY feature ORDER BY v) AS upto FROM c) GROUP BY ALL),
m AS (SELECT e.*, greatest(coalesce(hi.upto, 0) - coalesce(lo.upto, 0), 1) AS m FROM e ASOF LEFT JOIN t lo ON e.feature = lo.feature AND e.low >= lo.v
      ASOF LEFT JOIN t hi ON e.feature = hi.feature AND e.high > hi.v)
SELECT feature, {r(f"greatest(0.0, {psi('count(*)')} + avg({psi('k')}) - avg({psi('nc')}) - avg({psi('m')}))")} AS mi, count(*) AS n, 'knn_{k}' AS estimator
FROM m GROUP BY feature""")


@query("mutual_information_knn", _mi_knn_sql())
def q_mutual_information_knn(spark, sf):
    """X1 by nearest neighbours, on the features of orders."""
    return at.mutual_information_knn(o_table(spark, sf), "o_orderkey", O_FEATURES, "y")


def _h(seed):
    return f"md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(repeat AS VARCHAR), '{seed}'))"


def _perm_sql(repeats=10, seed=42):
    dcols = ", ".join(f"{f} AS d_{f}" for f in O_FEATURES)
    longs = []
    for f in O_FEATURES:
        cols = [f"d_{g}" if g == f else g for g in O_FEATURES]
        longs.append(f"SELECT o_orderkey, y, repeat, '{f}' AS feature, {o_pred_sql(cols)} AS pred FROM j")
    scored = "(" + _u(longs) + ")"
    f1 = sql_averaged(sql_per_class(scored, 3, ["feature", "repeat"]), ["feature", "repeat"])
    base = sql_averaged(sql_per_class(f"(SELECT y, {o_pred_sql()} AS pred FROM o)", 3))
    return (O + f""", rep AS (SELECT o.*, g.repeat FROM o, (SELECT unnest(range(0, {repeats})) AS repeat) g),
a AS (SELECT *, row_number() OVER (PARTITION BY repeat ORDER BY {_h(seed)}, o_orderkey, repeat) AS pos FROM rep),
b AS (SELECT repeat, row_number() OVER (PARTITION BY repeat ORDER BY {_h(seed + 1)}, o_orderkey, repeat) AS pos, {dcols} FROM rep),
j AS (SELECT a.*, {', '.join(f'b.d_{f}' for f in O_FEATURES)} FROM a JOIN b ON a.repeat = b.repeat AND a.pos = b.pos),
f AS ({f1}), bf AS ({base})
SELECT feature, {r('avg(bf.f1_weighted - f.f1_weighted)')} AS importance_mean, {r('stddev_pop(bf.f1_weighted - f.f1_weighted)')} AS importance_std
FROM f, bf GROUP BY feature""")


@query("permutation_importance", _perm_sql())
def q_permutation_importance(spark, sf):
    return at.permutation_importance(o_table(spark, sf), "o_orderkey", "y", O_FEATURES, 3, lambda d: o_pred(), repeats=10)


def _phi_sql():
    return _u([f"SELECT o_orderkey, {c} AS class, '{f}' AS feature, {w[j]!r} * ({f} - (SELECT avg({f}) FROM o)) AS phi FROM o"
               for c, w in O_WEIGHTS.items() for j, f in enumerate(O_FEATURES)])


def _phi(spark, sf):
    return at.shapley_linear(o_table(spark, sf), "o_orderkey", O_FEATURES, O_WEIGHTS)


@query("shapley_linear", O + f", p AS ({_phi_sql()}) SELECT o_orderkey, class, feature, {r('phi')} AS phi FROM p")
def q_shapley_linear(spark, sf):
    return _phi(spark, sf)


@query("shap_global", O + f", p AS ({_phi_sql()}), m AS (SELECT class, feature, avg(abs(phi)) AS m FROM p GROUP BY ALL) "
       f"SELECT feature, {r('avg(m)')} AS mean_abs_phi FROM m GROUP BY feature ORDER BY avg(m) DESC, feature LIMIT 20")
def q_shap_global(spark, sf):
    return at.shap_global(_phi(spark, sf), 20)


@query("shap_by_class", O + f""", p AS ({_phi_sql()}),
m AS (SELECT class, feature, avg(abs(phi)) AS mean_abs_phi, quantile_cont(phi, 0.25) AS q1, quantile_cont(phi, 0.5) AS median,
      quantile_cont(phi, 0.75) AS q3 FROM p GROUP BY ALL)
SELECT class, feature, {r('mean_abs_phi')} AS mean_abs_phi, CAST(row_number() OVER (PARTITION BY class ORDER BY mean_abs_phi DESC, feature) AS INTEGER) AS rank,
  {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3 FROM m QUALIFY rank <= 15""")
def q_shap_by_class(spark, sf):
    return at.shap_by_class(_phi(spark, sf), 15)


def _base_sql():
    return _u([f"SELECT {c} AS class, {o_score_sql(c, [f'(SELECT avg({f}) FROM o)' for f in O_FEATURES])} AS base_value"
               for c in O_WEIGHTS])


@query("shap_local", O + f""", p AS ({_phi_sql()}), bv AS ({_base_sql()}),
t AS (SELECT o_orderkey, class, sum(abs(phi)) AS s FROM p GROUP BY ALL),
best AS (SELECT o_orderkey, class FROM t QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY s DESC, class) = 1),
sel AS (SELECT p.* FROM p JOIN best ON p.o_orderkey = best.o_orderkey AND p.class = best.class)
SELECT sel.o_orderkey, sel.class, sel.feature, {r('sel.phi')} AS phi,
  CAST(row_number() OVER (PARTITION BY sel.o_orderkey ORDER BY abs(sel.phi) DESC, sel.feature) AS INTEGER) AS rank,
  {r('bv.base_value')} AS base_value FROM sel JOIN bv ON sel.class = bv.class QUALIFY rank <= 12""")
def q_shap_local(spark, sf):
    o = o_table(spark, sf)
    phi = at.shapley_linear(o, "o_orderkey", O_FEATURES, O_WEIGHTS)
    return at.shap_local(phi, "o_orderkey", at.linear_base(o, O_FEATURES, O_WEIGHTS), 12)


# A stated tree over two features of orders, cut at the features' means.
def _stated_cuts(spark, sf):
    o = o_table(spark, sf)
    f0, f1 = O_FEATURES[:2]
    return o, o.agg(F.avg(f0).alias("a"), F.avg(f1).alias("b")).first()


def _stated_sql():
    f0, f1 = O_FEATURES[:2]
    v = lambda *known: _stated_value(f0, f1, known)       # noqa: E731
    phi0 = f"0.5 * (({v(0)}) - ({v()})) + 0.5 * (({v(0, 1)}) - ({v(1)}))"
    phi1 = f"0.5 * (({v(1)}) - ({v()})) + 0.5 * (({v(0, 1)}) - ({v(0)}))"
    rest = "".join(f"\nUNION ALL SELECT o_orderkey, '{f}' AS feature, 0.0 AS phi FROM o" for f in O_FEATURES[2:])
    return (O + f""", c AS (SELECT avg({f0}) AS a, avg({f1}) AS b FROM o),
n AS (SELECT count(*) AS n, count(*) FILTER ({f0} <= a) AS nl, count(*) FILTER ({f0} <= a AND {f1} <= b) AS nll FROM o, c),
p AS (SELECT o_orderkey, '{f0}' AS feature, {phi0} AS phi FROM o, c, n UNION ALL SELECT o_orderkey, '{f1}', {phi1} FROM o, c, n{rest})
SELECT o_orderkey, feature, {r('phi')} AS phi FROM p""")


def _stated_value(f0, f1, known):
    """Value of the stated tree (leaves 1 and 5 on the left, 3 on the right) when the features in ``known`` are known."""
    inner = f"CASE WHEN {f1} <= b THEN 1.0 ELSE 5.0 END" if 1 in known else "(nll * 1.0 + (nl - nll) * 5.0) / nl"
    return f"CASE WHEN {f0} <= a THEN {inner} ELSE 3.0 END" if 0 in known else f"(nl * ({inner}) + (n - nl) * 3.0) / n"


@query("shapley_tree_stated", _stated_sql())
def q_shapley_tree_stated(spark, sf):
    """X4 for a stated tree: cuts at two means, covers counted over the table, so the values have a closed form."""
    o, cut = _stated_cuts(spark, sf)
    f0, f1 = O_FEATURES[:2]
    n = o.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(f0) <= cut["a"]).alias("nl"),
              F.count_if((F.col(f0) <= cut["a"]) & (F.col(f1) <= cut["b"])).alias("nll")).first()
    tree = {"feature": [0, 1, -1, -1, -1], "threshold": [cut["a"], cut["b"], 0.0, 0.0, 0.0], "left": [1, 2, 0, 0, 0], "right": [4, 3, 0, 0, 0],
            "cover": [n["n"], n["nl"], n["nll"], n["nl"] - n["nll"], n["n"] - n["nl"]], "value": [[0.0], [0.0], [1.0], [5.0], [3.0]]}
    rows = o.select("o_orderkey", F.array(*[F.col(f).cast("double") for f in O_FEATURES]).alias("x"))
    return tr.shapley_trees(tr.Forest.of([tree]), rows, "o_orderkey", "x", O_FEATURES).drop("class")


@query("shapley_forest", "SELECT vec_id, CAST(c.class AS INTEGER) AS class, CAST(64 AS BIGINT) AS n_features, CAST(0 AS DOUBLE) AS residual FROM embeddings, (VALUES (0), (1), (2)) AS c(class)")
def q_shapley_forest(spark, sf):
    """X4 exactly for a fitted forest on ``label % 3``: the values of a row add up to f(x) less the expected value."""
    from pyspark.ml.functions import vector_to_array
    e = ml.with_vector(read_table(spark, sf, "embeddings").withColumn("label", F.col("label") % 3), "embedding")
    model = ml.make_estimator("forest", 3, 64, ml.QUICK["forest"]).fit(e)
    forest = tr.spark_forest(model, f"{checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}", spark)
    total = tr.shapley_trees(forest, e, "vec_id", "features").groupBy("vec_id", "class").agg(F.sum("phi").alias("s"), F.count(F.lit(1)).alias("n_features"))
    base = F.array(*[F.lit(float(v)) for v in forest.expected()])
    fx = model.transform(e).select("vec_id", vector_to_array("probability").alias("p"))
    return total.join(fx, "vec_id").select("vec_id", "class", "n_features", F.round(F.col("s") - (F.col("p")[F.col("class")] - base[F.col("class")]), 6)
                                           .alias("residual"))


@query("shapley_sampled", "SELECT vec_id, CAST(c.class AS INTEGER) AS class, CAST(64 AS BIGINT) AS n_features, CAST(0 AS DOUBLE) AS residual FROM embeddings, (VALUES (0), (1), (2)) AS c(class)")
def q_shapley_sampled(spark, sf):
    """X4 by sampled feature orders for a small forest on ``label % 3``, two orders a row: the
    attributions of a row add up to f(x) - f(reference), so the residual is zero."""
    from pyspark.ml.functions import vector_to_array
    e = read_table(spark, sf, "embeddings").withColumn("label", F.col("label") % 3)
    model = ml.make_estimator("forest", 3, 64, ml.QUICK["forest"]).fit(ml.with_vector(e, "embedding"))
    phi = at.shapley_sampled(e, "vec_id", "embedding", model, 64, 3, permutations=2)
    total = phi.groupBy("vec_id", "class").agg(F.sum("phi").alias("s"), F.count(F.lit(1)).alias("n_features"))
    mean = [m["m"] for m in e.select(F.posexplode("embedding").alias("j", "x")).groupBy("j").agg(F.avg("x").alias("m")).orderBy("j").collect()]
    one = ml.with_vector(spark.createDataFrame([(mean,)], "embedding array<double>"), "embedding")
    ref = model.transform(one).select(vector_to_array("probability").alias("p")).first()["p"]
    fx = model.transform(ml.with_vector(e, "embedding")).select("vec_id", vector_to_array("probability").alias("p"))
    gap = F.col("p")[F.col("class")] - F.array(*[F.lit(v) for v in ref])[F.col("class")]
    return total.join(fx, "vec_id").select("vec_id", "class", "n_features", F.round(F.col("s") - gap, 6).alias("residual"))
