"""Queries for J2, M6, T-7, T-8 on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metric_index as mi
from ..operators import neighbors as nb
from ..sources.tables import read_table
from .registry import query, r

E3 = "(SELECT vec_id, label % 3 AS label, embedding FROM embeddings)"


def _emb(spark, sf, three=False):
    e = read_table(spark, sf, "embeddings")
    return e.withColumn("label", F.col("label") % 3) if three else e


def _d2(a="a", b="b"):
    x = f"(CAST({a}.embedding[i] AS DOUBLE) - CAST({b}.embedding[i] AS DOUBLE))"
    return f"list_sum(list_transform(range(1, len({a}.embedding) + 1), lambda i: {x} * {x}))"


def _nn_sql(k, src="embeddings", same=False):
    near = " AND a.label = b.label" if same else ""
    return (f"SELECT qid, rid, d, rn FROM (SELECT a.vec_id AS qid, b.vec_id AS rid, {_d2()} AS d, "
            f"row_number() OVER (PARTITION BY a.vec_id ORDER BY {_d2()}, b.vec_id) AS rn "
            f"FROM {src} a JOIN {src} b ON a.vec_id <> b.vec_id{near}) WHERE rn <= {k}")


@query("knn_join", f"SELECT qid AS qkey, rid AS rkey, {r('d')} AS dist2, CAST(rn AS INTEGER) AS nn_rank FROM ({_nn_sql(5)})")
def q_knn_join(spark, sf):
    e = _emb(spark, sf)
    return nb.knn_join(e, e, "vec_id", "embedding", 5)


@query("knn_join_pivots", f"SELECT qid AS qkey, rid AS rkey, {r('d')} AS dist2, CAST(rn AS INTEGER) AS nn_rank FROM ({_nn_sql(5)})")
def q_knn_join_pivots(spark, sf):
    """J2 through the metric index: the same rows, far rings passed over."""
    e = _emb(spark, sf)
    return mi.pivot_knn_join(e, e, "vec_id", "embedding", 5)[0]


@query("knn_hashed_recall", "SELECT count(*) AS queries, count(*) * 5 AS neighbours, true AS reached FROM embeddings")
def q_knn_hashed_recall(spark, sf):
    """J2 approximate: recall at 5 of the hashed join against the exact one, at least 0.9."""
    e = _emb(spark, sf)
    exact = nb.knn_join(e, e, "vec_id", "embedding", 5).select("qkey", "rkey")
    close = mi.hashed_knn_join(e, e, "vec_id", "embedding", 5).select("qkey", "rkey", F.lit(1).alias("hit"))
    met = exact.join(close, ["qkey", "rkey"], "left")
    return met.agg(F.countDistinct("qkey").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                   (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("reached"))


@query("knn_classify", f"""WITH nn AS ({_nn_sql(15)}),
v AS (SELECT nn.qid, e.label AS nlabel, count(*) AS votes FROM nn JOIN embeddings e ON nn.rid = e.vec_id GROUP BY ALL),
s AS (SELECT qid, nlabel, votes, CAST(votes AS DOUBLE) / sum(votes) OVER (PARTITION BY qid) AS share FROM v)
SELECT qid AS vec_id, nlabel AS pred, {r('share')} AS confidence FROM s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, nlabel) = 1""")
def q_knn_classify(spark, sf):
    return nb.knn_classify(_emb(spark, sf), "vec_id", "embedding", "label", 15)


DENSITY_SQL = f"""nn AS ({_nn_sql(5, E3)}),
e AS (SELECT * FROM {E3}),
ra AS (SELECT nn.qid, q.label, count_if(n.label <> q.label) / 5.0 AS ratio FROM nn JOIN e q ON nn.qid = q.vec_id JOIN e n ON nn.rid = n.vec_id GROUP BY ALL),
c AS (SELECT label, count(*) AS n_c, max(count(*)) OVER () AS n_max FROM e GROUP BY label),
w AS (SELECT ra.*, c.n_c, c.n_max, CASE WHEN sum(ratio) OVER (PARTITION BY ra.label) > 0 THEN ratio / sum(ratio) OVER (PARTITION BY ra.label) ELSE 0.0 END AS weight FROM ra JOIN c ON ra.label = c.label)"""


@query("adasyn_density", f"""WITH {DENSITY_SQL}
SELECT qid AS vec_id, label, {r('ratio')} AS ratio, {r('weight')} AS weight, CAST(round_even(weight * (n_max - n_c), 0) AS BIGINT) AS n_synthetic FROM w""")
def q_adasyn_density(spark, sf):
    return nb.adasyn_density(_emb(spark, sf, True), "vec_id", "embedding", "label", 5)


def _u01(tag):
    """Uniform number of (row, copy): the first 32 bits of an md5."""
    return f"CAST(('0x' || substr(md5(concat_ws('|', s.vec_id, s.j, '42', '{tag}')), 1, 8)) AS BIGINT) / 4294967296.0"


# seeds s(vec_id, label, j) -> synthetic rows on the way to one of the same-class neighbours
MADE_SQL = f"""same AS ({_nn_sql(5, E3, same=True)}),
nn_n AS (SELECT qid, count(*) AS n FROM same GROUP BY qid),
pick AS (SELECT s.vec_id, s.label, s.j, CAST(floor({_u01('nn')} * nn_n.n) + 1 AS INTEGER) AS k, {_u01('u')} AS u FROM s JOIN nn_n ON nn_n.qid = s.vec_id)
SELECT p.vec_id AS seed_key, p.j, p.label, same.rid AS rkey, round(p.u, 6) + 0.0 AS u,
list_transform(range(1, len(x.embedding) + 1), lambda i: round(CAST(x.embedding[i] AS DOUBLE) + p.u * (CAST(y.embedding[i] AS DOUBLE) - CAST(x.embedding[i] AS DOUBLE)), 6) + 0.0) AS embedding
FROM pick p JOIN same ON same.qid = p.vec_id AND same.rn = p.k JOIN embeddings x ON x.vec_id = p.vec_id JOIN embeddings y ON y.vec_id = same.rid"""


@query("smote", f"""WITH e AS (SELECT * FROM {E3}),
c AS (SELECT label, count(*) AS n_c, max(count(*)) OVER () - count(*) AS m FROM e GROUP BY label),
rk AS (SELECT e.vec_id, e.label, row_number() OVER (PARTITION BY e.label ORDER BY md5(concat_ws('|', CAST(e.vec_id AS VARCHAR), '42')), e.vec_id) AS rank, c.n_c, c.m
       FROM e JOIN c ON e.label = c.label),
s AS (SELECT vec_id, label, unnest(range(1, m // n_c + CASE WHEN rank <= m % n_c THEN 1 ELSE 0 END + 1)) AS j FROM rk),
{MADE_SQL}""")
def q_smote(spark, sf):
    """T-7 on the three groups ``label % 3`` of embeddings (4 : 3 : 3)."""
    return nb.smote(_emb(spark, sf, True), "vec_id", "embedding", "label", 5)


@query("adasyn", f"""WITH {DENSITY_SQL},
g AS (SELECT qid AS vec_id, label, CAST(round_even(weight * (n_max - n_c), 0) AS BIGINT) AS n FROM w),
s AS (SELECT vec_id, label, unnest(range(1, n + 1)) AS j FROM g WHERE n > 0),
{MADE_SQL}""")
def q_adasyn(spark, sf):
    return nb.adasyn(_emb(spark, sf, True), "vec_id", "embedding", "label", 5)
