"""Queries for A1-A18 (profiles, fitted statistics, the preprocessor)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep
from ..operators import profile as pr
from ..operators.correlation import corr_candidates, corr_matrix
from ..sources.tables import read_table
from .fixtures import K_FEATURES, W_COLUMNS, k_sql, k_table, w_table, W_SQL
from .registry import query, r
from .suite_rowwise import _num_sql

K = f"WITH k AS ({k_sql()})\n"
KT = f"WITH k AS ({k_sql(twin=True)})\n"
W = f"WITH w AS ({W_SQL})\n"
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---- A1 / A2 -----------------------------------------------------------------------

def _missing_sql(cols, src):
    return _union([f"SELECT '{c}' AS column, {i} AS pos, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
                   f"{r(f'(count(*) - count({c})) / count(*)', 'missing_frac')} FROM {src}" for i, c in enumerate(cols)])


@query("missing_fraction", W + "SELECT * FROM (" + _missing_sql(W_COLUMNS, "w") + ") ORDER BY missing_frac DESC, pos LIMIT 5")
def q_missing_fraction(spark, sf):
    return pr.missing_fraction(w_table(spark, sf), W_COLUMNS, top=5)


@query("missing_summary", W + "SELECT CAST(count_if(missing_frac > 0.6) AS BIGINT) AS n_over_threshold, "
       "CAST(count_if(missing_frac = 1.0) AS BIGINT) AS n_empty, CAST(count(*) AS BIGINT) AS n_columns FROM ("
       + _missing_sql(W_COLUMNS, "w") + ")")
def q_missing_summary(spark, sf):
    return pr.missing_summary(w_table(spark, sf), W_COLUMNS)


# ---- A3 / A4 ---------------------------------------------------------------------------

def _dominant_sql(cols, src, expr=lambda c: f"CAST({c} AS DOUBLE) + 0.0"):
    return _union([
        f"SELECT '{c}' AS column, {i} AS pos, CAST(coalesce(sum(cnt), 0) AS BIGINT) AS n_nonnull, "
        f"CAST(coalesce(max(cnt), 0) AS BIGINT) AS top_count, {r('max(cnt) / sum(cnt)', 'dominant_frac')} "
        f"FROM (SELECT {expr(c)} AS v, count(*) AS cnt FROM {src} WHERE {expr(c)} IS NOT NULL GROUP BY 1)"
        for i, c in enumerate(cols)])


@query("dominant_fraction", _dominant_sql(LI_NUM, "lineitem"))
def q_dominant_fraction(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return pr.dominant_fraction(li.select(*[(F.col(c).cast("double") + 0.0).alias(c) for c in LI_NUM]), LI_NUM)


def _w_num(c):
    return _num_sql(c) if c in ("lang", "source") else f"CAST({c} AS DOUBLE)"


WN = W + ", wn AS (SELECT " + ", ".join(f"{_w_num(c)} AS {c}" for c in W_COLUMNS) + " FROM w)\n"


@query("column_prune", WN + "SELECT m.column, m.pos, " + r("m.missing_frac", "missing_frac") + ", "
       "(reason = 'kept') AS keep, reason FROM (SELECT m.*, CASE WHEN m.missing_frac > 0.6 THEN 'missing' "
       "WHEN d.n_nonnull = 0 THEN 'empty' WHEN d.dominant_frac >= 0.999 THEN 'dominant' ELSE 'kept' END AS reason FROM ("
       + _missing_sql(W_COLUMNS, "wn") + ") m JOIN (" + _dominant_sql(W_COLUMNS, "wn") + ") d ON m.column = d.column) m")
def q_column_prune(spark, sf):
    w = w_table(spark, sf)
    return prep.prune_decisions(w, W_COLUMNS)


# ---- A5 / A6 -------------------------------------------------------------------------------

def _corr_sql(cols, src, pairs=None):
    parts = []
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            b = cols[j]
            if pairs is not None and (a, b) not in pairs:
                continue
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS i, {j} AS j, CAST(regr_count({a}, {b}) AS BIGINT) AS n, "
                         f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE greatest(-1.0, least(1.0, corr({a}, {b}))) END AS r FROM {src}")
    return _union(parts)


@query("corr_matrix", K + "SELECT a, b, i, j, n, " + r("r", "r") + " FROM (" + _corr_sql(K_FEATURES, "k") + ")")
def q_corr_matrix(spark, sf):
    return corr_matrix(k_table(spark, sf), K_FEATURES)


KT_COLS = K_FEATURES + ["koi_prad_twin"]


@query("corr_candidates", KT + "SELECT c.a, c.b, c.i, c.j, " + r("abs(c.r)", "abs_r") + ", " + r("ma.missing_frac", "miss_a")
       + ", " + r("mb.missing_frac", "miss_b") + " FROM (" + _corr_sql(KT_COLS, "k") + ") c JOIN ("
       + _missing_sql(KT_COLS, "k") + ") ma ON ma.column = c.a JOIN (" + _missing_sql(KT_COLS, "k")
       + ") mb ON mb.column = c.b WHERE abs(c.r) > 0.97")
def q_corr_candidates(spark, sf):
    return corr_candidates(k_table(spark, sf, twin=True), KT_COLS)


# ---- A7 / A8 ------------------------------------------------------------------------------

@query("median_impute", K + "SELECT label, " + ", ".join(
    r(f"coalesce({c}, (SELECT median({c}) FROM k))", c) for c in K_FEATURES) + " FROM k")
def q_median_impute(spark, sf):
    k = k_table(spark, sf)
    model = prep.MedianImputer().fit(k.select(*K_FEATURES))
    return model.transform(k)


@query("standard_scale", K + "SELECT label, " + ", ".join(
    r(f"({c} - (SELECT avg({c}) FROM k)) / (SELECT CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM k)", c)
    for c in K_FEATURES) + " FROM k")
def q_standard_scale(spark, sf):
    k = k_table(spark, sf)
    model = prep.Scaler().fit(k.select(*K_FEATURES))
    return model.transform(k)


# ---- A11-A18 ----------------------------------------------------------------------------------

CLASSES_WITH_ABSENT = ["A", "N", "R", "X"]


@query("class_distribution", "WITH t AS (SELECT count(*) AS total FROM lineitem), c AS (SELECT * FROM (VALUES "
       + ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES_WITH_ABSENT)) + ") v(class_pos, class)) "
       "SELECT CAST(c.class_pos AS INTEGER) AS class_pos, c.class, CAST((SELECT count(*) FROM lineitem WHERE l_returnflag = c.class) AS BIGINT) AS n, "
       + r("(SELECT count(*) FROM lineitem WHERE l_returnflag = c.class) / t.total", "share") + " FROM c, t")
def q_class_distribution(spark, sf):
    return pr.class_distribution(read_table(spark, sf, "lineitem"), "l_returnflag", CLASSES_WITH_ABSENT)


@query("duplicate_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST((SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS BIGINT) AS n_distinct, "
       "CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS BIGINT) AS n_duplicates FROM documents")
def q_duplicate_count(spark, sf):
    return pr.duplicate_count(read_table(spark, sf, "documents"), ["text", "lang"])


LI_DISTINCT = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"]


def _distinct_expr(c):
    return f"CAST({c} AS DOUBLE) + 0.0" if c in ("l_quantity", "l_discount") else c


@query("distinct_counts", _union([f"SELECT '{c}' AS column, {i} AS pos, CAST(count(DISTINCT {_distinct_expr(c)}) AS BIGINT) AS n_distinct, "
                                  f"count(DISTINCT {_distinct_expr(c)}) <= 1 AS is_constant FROM lineitem" for i, c in enumerate(LI_DISTINCT)]))
def q_distinct_counts(spark, sf):
    li = read_table(spark, sf, "lineitem")
    li = li.select(*[(F.col(c) + 0.0).alias(c) if c in ("l_quantity", "l_discount") else F.col(c) for c in LI_DISTINCT])
    return pr.distinct_counts(li, LI_DISTINCT)


def _mean_sql(c):
    """Sum of decimals, so that the mean doesn't depend on threads."""
    return (f"CASE WHEN max(abs({c})) < 1e14 AND max(abs({c})) >= 1e-3 THEN CAST(sum(CAST({c} AS DECIMAL(38,12))) AS DOUBLE) / count({c}) "
            f"ELSE avg({c}) END")


@query("describe", K + _union([
    f"SELECT '{c}' AS column, {i} AS pos, CAST(count({c}) AS BIGINT) AS count, {r(_mean_sql(c), 'mean')}, {r(f'stddev_samp({c})', 'std')}, "
    f"{r(f'min({c})', 'min')}, {r(f'median({c})', 'median')}, {r(f'max({c})', 'max')} FROM k" for i, c in enumerate(K_FEATURES)]))
def q_describe(spark, sf):
    return pr.describe(k_table(spark, sf), K_FEATURES)


LI_VAR = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _top_var_sql(n=3):
    var = _union([f"SELECT '{c}' AS column, {i} AS pos, var_samp({c}) AS variance FROM lineitem" for i, c in enumerate(LI_VAR)])
    allpairs = []
    for a in LI_VAR:
        for b in LI_VAR:
            if a != b:
                allpairs.append(f"SELECT '{a}' AS a, '{b}' AS b, CAST(regr_count({a}, {b}) AS BIGINT) AS n, "
                                f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE greatest(-1.0, least(1.0, corr({a}, {b}))) END AS r FROM lineitem")
    return (f"WITH v AS (SELECT \"column\" AS col, row_number() OVER (ORDER BY variance DESC, pos) - 1 AS rk FROM ({var}) WHERE variance IS NOT NULL), "
            f"t AS (SELECT * FROM v WHERE rk < {n}), p AS ({_union(allpairs)}) "
            f"SELECT p.a, p.b, CAST(ta.rk AS INTEGER) AS i, CAST(tb.rk AS INTEGER) AS j, p.n, {r('p.r', 'r')} FROM p JOIN t ta ON p.a = ta.col "
            f"JOIN t tb ON p.b = tb.col WHERE ta.rk < tb.rk")


@query("top_variance_corr", _top_var_sql(3))
def q_top_variance_corr(spark, sf):
    li = read_table(spark, sf, "lineitem")
    top = [row["column"] for row in pr.top_variance_columns(li, LI_VAR, 3).collect()]   # O(n) names
    return corr_matrix(li, top)


# Form bounds for the default inputs (own values: a parameter of the operator).
DEFAULT_BOUNDS = {"koi_period": (0.5, 400.0), "koi_teq": (100.0, 1000.0), "koi_prad": (0.5, 5.0), "koi_insol": (0.3, 1.0)}


@query("clipped_defaults", K + _union([
    f"SELECT '{c}' AS column, {r(f'median({c})', 'median')}, {r(f'least(greatest(median({c}), {lo}), {hi})', 'default_value')} FROM k"
    for c, (lo, hi) in DEFAULT_BOUNDS.items()]))
def q_clipped_defaults(spark, sf):
    return pr.clipped_medians(k_table(spark, sf), DEFAULT_BOUNDS)


@query("log_histogram", K + """, p AS (SELECT label, log10(koi_depth) AS x FROM k WHERE koi_depth IS NOT NULL AND koi_depth > 0),
g AS (SELECT label, min(x) AS lo, max(x) AS hi FROM p GROUP BY label),
b AS (SELECT p.label, CAST(CASE WHEN g.hi = g.lo THEN 0 ELSE least(floor((p.x - g.lo) / ((g.hi - g.lo) / 40.0)), 39) END AS INTEGER) AS bin
      FROM p JOIN g ON p.label = g.label)
SELECT b.label, b.bin, """ + r("g.lo + b.bin * (g.hi - g.lo) / 40.0", "edge_lo") + """, CAST(count(*) AS BIGINT) AS n
FROM b JOIN g ON b.label = g.label GROUP BY b.label, b.bin, g.lo, g.hi""")
def q_log_histogram(spark, sf):
    return pr.log_histogram(k_table(spark, sf), "koi_depth", "label", 40)


@query("class_quantiles", K + "SELECT label, CAST(count(koi_depth) AS BIGINT) AS n, " + ", ".join([
    r("min(koi_depth)", "min"), r("quantile_cont(koi_depth, 0.25)", "q1"), r("quantile_cont(koi_depth, 0.5)", "median"),
    r("quantile_cont(koi_depth, 0.75)", "q3"), r("max(koi_depth)", "max"),
    r("greatest(min(koi_depth), quantile_cont(koi_depth, 0.25) - 1.5 * (quantile_cont(koi_depth, 0.75) - quantile_cont(koi_depth, 0.25)))", "whisker_lo"),
    r("least(max(koi_depth), quantile_cont(koi_depth, 0.75) + 1.5 * (quantile_cont(koi_depth, 0.75) - quantile_cont(koi_depth, 0.25)))", "whisker_hi"),
]) + " FROM k WHERE koi_depth IS NOT NULL GROUP BY label")
def q_class_quantiles(spark, sf):
    return pr.class_quantiles(k_table(spark, sf), "koi_depth", "label")


# ---- A9 / A10: fitted preprocessor -------------------------------------------------------
# The columns the two pruners keep on K.  K is built from exact
# linear relations of lineitem columns, so the kept set is the same at every
# scale; the greedy pass itself is unit-tested.
A9_KEPT = ["koi_period", "koi_depth", "koi_depth_err1", "koi_ror", "koi_max_mult_ev", "koi_num_transits", "koi_steff",
           "koi_period_log", "koi_depth_log", "koi_model_snr_log", "koi_max_mult_ev_log", "koi_num_transits_log",
           "depth_snr", "snr_per_transit", "depth_ror_consistency", "koi_dicco_msky_sig", "koi_dikco_msky_sig",
           "koi_fwm_sra_sig", "prad_per_srad", "teq_class", "period_class", "prad_class", "in_habitable_zone"]
A10_KEPT = ["koi_period", "koi_depth", "koi_depth_err1", "koi_ror", "koi_max_mult_ev", "koi_num_transits", "koi_steff"]


def _prep_sql(cols, derive: bool) -> str:
    from .suite_rowwise import K_ALL, derived_sql
    d = dict(derived_sql(K_ALL)) if derive else {}
    f = "SELECT " + ", ".join(f"{d.get(c, c)} AS {c}" for c in cols) + " FROM k"
    i = "SELECT " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM f)) AS {c}" for c in cols) + " FROM f"
    out = ", ".join(r(f"({c} - (SELECT avg({c}) FROM i)) / (SELECT CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 "
                      f"ELSE stddev_pop({c}) END FROM i)", c) for c in cols)
    return K + f", f AS ({f}), i AS ({i}) SELECT {out} FROM i"


def _fit_transform(spark, sf, derive):
    k = k_table(spark, sf)
    model = prep.build_preprocessor(scale=True, derive=derive, target="label").fit(k)
    return model.transform(k)


@query("preprocess_fit_transform", _prep_sql(A9_KEPT, True))
def q_preprocess(spark, sf):
    return _fit_transform(spark, sf, True)


@query("preprocess_no_fe", _prep_sql(A10_KEPT, False))
def q_preprocess_no_fe(spark, sf):
    return _fit_transform(spark, sf, False)
