"""Queries for P1-P12 and F1-F14 (row-wise projections and filters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fe
from ..functions.expr import (binary_target, coerce_numeric, finite_only, label_decode, label_encode,
                              safe_div, to_number)
from ..operators import schema as sc
from ..operators.profile import class_distribution
from ..sources.tables import read_table
from .fixtures import K_CLASSES, K_FEATURES, k_sql, k_table, w_table, W_SQL
from .registry import query, r, sdiv

KOI = fe.KOI_PRESET
K = f"WITH k AS ({k_sql()})\n"
W = f"WITH w AS ({W_SQL})\n"

# Forbidden-column policy for lineitem used by the firewall queries.
LINEITEM_POLICY = {
    "identifiers": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "leakage": ["l_linestatus"],
    "metadata": ["l_shipdate", "l_comment"],
}
LINEITEM_TARGET = "l_returnflag"


# ---- SQL twins of the derivation (oracle side only) ------------------------

def _log_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END"


def _bin_sql(c: str, edges) -> str:
    parts = " ".join(f"WHEN {c} <= {float(e)!r} THEN {float(i)!r}" for i, e in enumerate(edges))
    return f"CASE WHEN {c} IS NULL THEN NULL {parts} ELSE {float(len(edges))!r} END"


def _flag_sql(c: str, lo: float, hi: float) -> str:
    return f"CAST(coalesce({c} BETWEEN {lo!r} AND {hi!r}, false) AS DOUBLE)"


def derived_sql(columns, preset=KOI) -> list[tuple[str, str]]:
    present = set(columns)

    def has(*roles):
        return all(preset.get(x) in present for x in roles)

    p = preset
    out = []
    for x in fe.LOG_ROLES:
        if has(x):
            out.append((f"{p[x]}_log", _log_sql(p[x])))
    if has("duration", "period"):
        out.append(("duty_cycle", sdiv(p["duration"], f"({p['period']} * 24.0)")))
    if has("depth", "depth_err1"):
        out.append(("depth_snr", sdiv(p["depth"], f"abs({p['depth_err1']})")))
    if has("model_snr", "num_transits"):
        n = p["num_transits"]
        out.append(("snr_per_transit", sdiv(p["model_snr"], f"(CASE WHEN {n} IS NOT NULL THEN sqrt(greatest({n}, 1.0)) END)")))
    if has("depth", "ror"):
        out.append(("depth_ror_consistency", sdiv(p["depth"], f"(pow({p['ror']}, 2) * 1000000.0)")))
    for x in fe.OFFSET_ROLES:
        if has(x, f"{x}_err"):
            out.append((f"{p[x]}_sig", sdiv(f"abs({p[x]})", f"abs({p[x + '_err']})")))
    if has("teq", "steff"):
        out.append(("teq_steff_ratio", sdiv(p["teq"], p["steff"])))
    if has("prad", "srad"):
        out.append(("prad_per_srad", sdiv(p["prad"], p["srad"])))
    if has("teq"):
        out.append(("teq_class", _bin_sql(p["teq"], fe.TEQ_EDGES)))
    if has("period"):
        out.append(("period_class", _bin_sql(p["period"], fe.PERIOD_EDGES)))
    if has("prad"):
        out.append(("prad_class", _bin_sql(p["prad"], fe.PRAD_EDGES)))
    if has("insol"):
        out.append(("in_habitable_zone", _flag_sql(p["insol"], *fe.HABITABLE_INSOL)))
    return out


def engineered_sql(columns, source: str = "k", drop_source: bool = False) -> str:
    """SELECT of input doubles + derived features over ``source`` (rounded)."""
    dropped = {KOI["sma"]} if drop_source else set()
    cols = [("label", "label")] if "label" in columns else []
    cols += [(c, r(c)) for c in columns if c != "label" and c not in dropped]
    cols += [(n, r(e)) for n, e in derived_sql(columns)]
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in cols) + f" FROM {source}"


K_ALL = ["label"] + K_FEATURES


def _k(spark, sf):
    return k_table(spark, sf)


def _derive_one(names):
    """Spark builder: K -> selected derived columns (label kept)."""
    def build(spark, sf):
        k = _k(spark, sf)
        d = dict(fe.derived_columns(k.select(*K_ALL)))
        return k.select("label", *[d[n].alias(n) for n in names])
    return build


def _derive_one_sql(names):
    d = dict(derived_sql(K_ALL))
    return K + "SELECT label, " + ", ".join(r(d[n], n) for n in names) + " FROM k"


# ---- flagship -------------------------------------------------------------------

def flagship(spark, sf):
    """K -> feature derivation -> distribution of period class per label."""
    feats = fe.engineer(k_table(spark, sf))
    classes = [float(i) for i in range(len(fe.PERIOD_EDGES) + 1)]
    return class_distribution(feats, "period_class", classes, by=["label"]).withColumnRenamed("class", "period_class")


FLAGSHIP_SQL = K + """, f AS (SELECT label, """ + _bin_sql("koi_period", fe.PERIOD_EDGES) + """ AS period_class FROM k),
t AS (SELECT label, count(*) AS total FROM f GROUP BY label),
c AS (SELECT * FROM (VALUES (0, 0.0), (1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)) v(class_pos, period_class))
SELECT t.label, CAST(c.class_pos AS INTEGER) AS class_pos, """ + r("c.period_class", "period_class") + """,
  CAST((SELECT count(*) FROM f WHERE f.label = t.label AND f.period_class = c.period_class) AS BIGINT) AS n,
  """ + r("(SELECT count(*) FROM f WHERE f.label = t.label AND f.period_class = c.period_class) / t.total", "share") + """
FROM t, c"""

query("flagship_period_mix", FLAGSHIP_SQL)(flagship)


# ---- P: schema, projection, filter ------------------------------------------------

@query("labelled_rows", W + "SELECT doc_id, quality, toxic FROM w WHERE quality IS NOT NULL")
def q_labelled_rows(spark, sf):
    return sc.labelled_rows(w_table(spark, sf), "quality").select("doc_id", "quality", "toxic")


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def q_dedup_rows(spark, sf):
    return sc.dedup_rows(read_table(spark, sf, "documents").select("text", "lang"))


@query("leakage_drop", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def q_leakage_drop(spark, sf):
    return sc.drop_forbidden(read_table(spark, sf, "lineitem"), LINEITEM_POLICY, LINEITEM_TARGET)


@query("leakage_drop_keep", "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus FROM lineitem")
def q_leakage_drop_keep(spark, sf):
    return sc.drop_forbidden(read_table(spark, sf, "lineitem"), LINEITEM_POLICY, LINEITEM_TARGET,
                             keep=["l_linestatus", "l_linenumber"])


def _num_sql(x: str) -> str:
    from ..functions.expr import NUMERIC_TEXT
    q = f"TRY_CAST(trim({x}) AS DOUBLE)"
    v = f"CASE WHEN regexp_matches({x}, '{NUMERIC_TEXT}') THEN {q} END"
    return f"(CASE WHEN isnan({v}) OR isinf({v}) THEN NULL ELSE {v} END)"


# Literal texts of the coercion check (from the fixture notes).
COERCE_LITERALS = ["abc", " 1.5 ", "1e3", "nan", "inf", "1d"]


@query("coerce_numeric", "SELECT o_orderkey, " + r(_num_sql("o_orderpriority"), "priority_num") + ", "
       + r(_num_sql("substring(o_orderpriority, 1, 1)"), "priority_digit") + ", "
       + ", ".join(r(_num_sql(f"'{v}'"), f"lit_{i}") for i, v in enumerate(COERCE_LITERALS)) + " FROM orders")
def q_coerce_numeric(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", to_number(F.col("o_orderpriority")).alias("priority_num"),
                    to_number(F.substring("o_orderpriority", 1, 1)).alias("priority_digit"),
                    *[to_number(F.lit(v)).alias(f"lit_{i}") for i, v in enumerate(COERCE_LITERALS)])


@query("coerce_numeric_props", "SELECT event_id, " + r(_num_sql("props"), "props_num") + ", "
       + r(_num_sql("regexp_extract(props, ':\\s*([^}]*)', 1)"), "props_value") + " FROM events")
def q_coerce_props(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", to_number(F.col("props")).alias("props_num"),
                    to_number(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("props_value"))


@query("coerce_numeric_text", "SELECT doc_id, " + r(_num_sql("text"), "text_num") + " FROM documents")
def q_coerce_text(spark, sf):
    d = read_table(spark, sf, "documents")
    return coerce_numeric(d.select("doc_id", "text")).withColumnRenamed("text", "text_num") \
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text_num")


PARTIAL = ["koi_period", "koi_depth", "koi_prad"]


@query("align_schema", K + "SELECT koi_period, koi_depth, koi_prad, CAST(NULL AS DOUBLE) AS koi_teq, "
       "CAST(NULL AS DOUBLE) AS koi_insol FROM k")
def q_align_schema(spark, sf):
    k3 = k_table(spark, sf).select("koi_depth", "koi_period", "koi_prad", "label")
    return sc.align_schema(k3, ["koi_period", "koi_depth", "koi_prad", "koi_teq", "koi_insol"])


@query("class_subset", "SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def q_class_subset(spark, sf):
    return sc.class_subset(read_table(spark, sf, "lineitem"), "l_returnflag", ["A", "R"])


@query("positive_complete", K + "SELECT label, koi_insol, koi_duration FROM k "
       "WHERE koi_insol IS NOT NULL AND koi_insol > 0 AND koi_duration IS NOT NULL AND koi_duration > 0")
def q_positive_complete(spark, sf):
    return sc.positive_complete(k_table(spark, sf), ["koi_insol", "koi_duration"]).select("label", "koi_insol", "koi_duration")


@query("preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_preview(spark, sf):
    return sc.preview(read_table(spark, sf, "orders"), ["o_orderkey"], 5)


_CODE_SQL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END"


@query("label_encode", f"SELECT l_orderkey, l_linenumber, l_returnflag, {_CODE_SQL} AS label_code FROM lineitem")
def q_label_encode(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", label_encode("l_returnflag", K_CLASSES).alias("label_code"))


@query("label_decode", f"SELECT l_orderkey, l_linenumber, CASE ({_CODE_SQL} + l_linenumber % 2) "
       "WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS label_text FROM lineitem")
def q_label_decode(spark, sf):
    li = read_table(spark, sf, "lineitem")
    code = label_encode("l_returnflag", K_CLASSES) + F.col("l_linenumber") % 2   # 3 is out of range -> NULL
    return li.select("l_orderkey", "l_linenumber", label_decode(code, K_CLASSES).alias("label_text"))


@query("binary_target", "SELECT l_orderkey, l_linenumber, CAST(l_returnflag <> 'A' AS INTEGER) AS is_real FROM lineitem")
def q_binary_target(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", binary_target("l_returnflag", "A").alias("is_real"))


_FIN_SPARK = {
    "ratio_raw": "CASE WHEN koi_depth_err1 = 0 THEN CASE WHEN koi_num_transits % 2 = 0 THEN double('inf') ELSE double('-inf') END "
                 "ELSE koi_depth / koi_depth_err1 END",
    "ror_raw": "CASE WHEN koi_ror = 0 THEN double('NaN') ELSE koi_ror END",
}
_FIN_DUCK = {
    "ratio_raw": "CASE WHEN koi_depth_err1 = 0 THEN CASE WHEN koi_num_transits % 2 = 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END "
                 "ELSE koi_depth / koi_depth_err1 END",
    "ror_raw": "CASE WHEN koi_ror = 0 THEN 'nan'::DOUBLE ELSE koi_ror END",
}


@query("finite_only", K + "SELECT label, " + ", ".join(
    r(f"CASE WHEN isnan({e}) OR isinf({e}) THEN NULL ELSE {e} END", n) for n, e in _FIN_DUCK.items()) + " FROM k")
def q_finite_only(spark, sf):
    k = k_table(spark, sf).select("label", *[F.expr(e).alias(n) for n, e in _FIN_SPARK.items()])
    return finite_only(k)


# ---- F: derivation -------------------------------------------------------------------

@query("safe_div", "SELECT l_orderkey, l_linenumber, " + r(sdiv("l_extendedprice", "(l_discount + 0.0)"), "price_per_discount")
       + " FROM lineitem")
def q_safe_div(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", safe_div("l_extendedprice", F.col("l_discount") + 0.0).alias("price_per_discount"))


_LOGS = [f"{KOI[x]}_log" for x in fe.LOG_ROLES]
_SIGS = [f"{KOI[x]}_sig" for x in fe.OFFSET_ROLES]
for _name, _cols in [
    ("clipped_log", _LOGS), ("duty_cycle", ["duty_cycle"]), ("depth_snr", ["depth_snr"]),
    ("snr_per_transit", ["snr_per_transit"]), ("depth_ror_consistency", ["depth_ror_consistency"]),
    ("offset_significance", _SIGS), ("teq_steff_ratio", ["teq_steff_ratio"]), ("prad_per_srad", ["prad_per_srad"]),
    ("teq_class", ["teq_class"]), ("period_class", ["period_class"]), ("prad_class", ["prad_class"]),
    ("in_habitable_zone", ["in_habitable_zone"]),
]:
    query(_name, _derive_one_sql(_cols))(_derive_one(_cols))


@query("drop_source", K + engineered_sql(K_ALL, drop_source=True))
def q_drop_source(spark, sf):
    return fe.engineer(k_table(spark, sf), drop_source=True)


@query("feature_engineer", K + engineered_sql(K_ALL))
def q_feature_engineer(spark, sf):
    return fe.FeatureEngineer().transform(k_table(spark, sf))


def _partial_sql() -> str:
    full = fe.feature_names(K_ALL)
    got = dict((n, e) for n, e in derived_sql(PARTIAL))
    cols = []
    for n in full:
        if n == "label":
            cols.append("CAST(NULL AS VARCHAR) AS label")
        elif n in PARTIAL:
            cols.append(r(n, n))
        elif n in got:
            cols.append(r(got[n], n))
        else:
            cols.append(f"CAST(NULL AS DOUBLE) AS {n}")
    return K + "SELECT " + ", ".join(cols) + " FROM k"


@query("feature_engineer_partial", _partial_sql())
def q_feature_engineer_partial(spark, sf):
    """a frame with three signal columns still derives what it can and
    is aligned to the full fitted column list (absent -> NULL)."""
    full = fe.feature_names(K_ALL)
    part = fe.engineer(k_table(spark, sf).select(*PARTIAL))
    out = sc.align_schema(part, full)
    return out.withColumn("label", F.col("label").cast("string"))
