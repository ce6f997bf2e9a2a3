"""Queries for T-1..T-6, T-9, T-10 (md5-ordered splits and samplers)."""

from __future__ import annotations

import numpy as np

from ..operators import split as sp
from ..sources.tables import read_table
from .registry import query

SEED = sp.SEED
LEARN_FRACTIONS = [float(x) for x in np.linspace(0.1, 1.0, 6)]


def _h(key: str) -> str:
    return f"md5(concat_ws('|', CAST({key} AS VARCHAR), '{SEED}'))"


def _rank_sql(src: str, label: str | None, key: str, cols: str) -> str:
    part = f"PARTITION BY {label} " if label else ""
    return f"SELECT {cols}, row_number() OVER ({part}ORDER BY {_h(key)}, {key}) AS rank FROM {src}"


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


SPLIT_SQL = f"""WITH c AS (SELECT o_orderstatus, count(*) AS n_class FROM orders GROUP BY 1),
t AS (SELECT sum(n_class) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n_class)) AS BIGINT) AS take FROM c),
q0 AS (SELECT c.o_orderstatus, (t.take * c.n_class) // t.n AS q0, (t.take * c.n_class) % t.n AS rem, t.take FROM c, t),
q AS (SELECT o_orderstatus, q0 + CASE WHEN row_number() OVER (ORDER BY rem DESC, o_orderstatus) <= take - (SELECT sum(q0) FROM q0) THEN 1 ELSE 0 END AS quota FROM q0),
r AS ({_rank_sql('orders', 'o_orderstatus', 'o_orderkey', 'o_orderkey, o_orderstatus')})
SELECT r.o_orderkey, r.o_orderstatus, r.rank, CASE WHEN r.rank <= q.quota THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.o_orderstatus = q.o_orderstatus"""


@query("stratified_split", SPLIT_SQL)
def q_stratified_split(spark, sf):
    return sp.stratified_split(_orders(spark, sf), "o_orderstatus", ["o_orderkey"], 0.20)


@query("stratified_folds", "SELECT o_orderkey, o_orderstatus, rank, CAST((rank - 1) % 5 AS INTEGER) AS fold FROM ("
       + _rank_sql("orders", "o_orderstatus", "o_orderkey", "o_orderkey, o_orderstatus") + ")")
def q_stratified_folds(spark, sf):
    return sp.stratified_folds(_orders(spark, sf), "o_orderstatus", ["o_orderkey"], 5)


@query("capped_sample", f"SELECT * FROM events ORDER BY {_h('event_id')}, event_id LIMIT 1000")
def q_capped_sample(spark, sf):
    return sp.capped_sample(read_table(spark, sf, "events"), ["event_id"], 1000)


@query("class_weights", """WITH c AS (SELECT quality, count(*) AS n_class FROM labels GROUP BY 1)
SELECT l.quality, l.doc_id, l.toxic, round(CAST((SELECT sum(n_class) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * c.n_class), 6) + 0.0 AS weight
FROM labels l JOIN c ON l.quality = c.quality""")
def q_class_weights(spark, sf):
    return sp.class_weights(read_table(spark, sf, "labels"), "quality")


OVER_SQL = f"""WITH c AS (SELECT quality, count(*) AS n_class, max(count(*)) OVER () AS n_max FROM labels GROUP BY 1),
r AS ({_rank_sql('labels', 'quality', 'doc_id', 'doc_id, quality, toxic')})
SELECT r.quality, r.doc_id, r.toxic, r.rank, CAST(g.copy AS BIGINT) AS copy
FROM r JOIN c ON r.quality = c.quality,
LATERAL (SELECT unnest(range(1, c.n_max // c.n_class + CASE WHEN r.rank <= c.n_max % c.n_class THEN 1 ELSE 0 END + 1)) AS copy) g"""


@query("oversample", OVER_SQL)
def q_oversample(spark, sf):
    return sp.oversample(read_table(spark, sf, "labels"), "quality", ["doc_id"])


@query("undersample", "SELECT * FROM (" + _rank_sql("labels", "quality", "doc_id", "doc_id, quality, toxic")
       + ") WHERE rank <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))")
def q_undersample(spark, sf):
    return sp.undersample(read_table(spark, sf, "labels"), "quality", ["doc_id"])


def _learning_sql():
    sizes = " UNION ALL ".join(f"SELECT {i} AS i, greatest(1, CAST(floor(CAST('{f!r}' AS DOUBLE) * n) AS BIGINT)) AS s FROM t"
                               for i, f in enumerate(LEARN_FRACTIONS))
    return (f"WITH t AS (SELECT count(*) AS n FROM orders), s0 AS ({sizes}), "
            f"s AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS i FROM (SELECT DISTINCT s FROM s0)), "
            f"r AS ({_rank_sql('orders', None, 'o_orderkey', 'o_orderkey, o_orderstatus')}) "
            f"SELECT r.o_orderkey, r.o_orderstatus, r.rank, CAST((SELECT min(i) FROM s WHERE r.rank <= s.s) AS INTEGER) AS first_subset FROM r")


@query("learning_subsets", _learning_sql())
def q_learning_subsets(spark, sf):
    return sp.learning_subsets(_orders(spark, sf), ["o_orderkey"], LEARN_FRACTIONS)


RESAMPLE_SQL = f"""WITH f AS (SELECT o_orderkey, o_orderstatus, CAST((rank - 1) % 5 AS INTEGER) AS fold FROM ({_rank_sql('orders', 'o_orderstatus', 'o_orderkey', 'o_orderkey, o_orderstatus')})),
tr AS (SELECT * FROM f WHERE fold <> 0),
c AS (SELECT o_orderstatus, count(*) AS n_class, max(count(*)) OVER () AS n_max FROM tr GROUP BY 1),
r AS ({_rank_sql('tr', 'o_orderstatus', 'o_orderkey', 'o_orderkey, o_orderstatus, fold')})
SELECT r.o_orderkey, r.o_orderstatus, r.fold, CAST(g.copy AS BIGINT) AS copy
FROM r JOIN c ON r.o_orderstatus = c.o_orderstatus,
LATERAL (SELECT unnest(range(1, c.n_max // c.n_class + CASE WHEN r.rank <= c.n_max % c.n_class THEN 1 ELSE 0 END + 1)) AS copy) g
UNION ALL SELECT o_orderkey, o_orderstatus, fold, CAST(1 AS BIGINT) AS copy FROM f WHERE fold = 0"""


@query("resample_train_only", RESAMPLE_SQL)
def q_resample_train_only(spark, sf):
    folds = sp.stratified_folds(_orders(spark, sf), "o_orderstatus", ["o_orderkey"], 5).drop("rank")
    out = sp.resample_train_only(folds, "fold", 0, "o_orderstatus", ["o_orderkey"])
    return out.select("o_orderkey", "o_orderstatus", "fold", "copy")
