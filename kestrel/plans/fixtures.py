"""Test-input projections of the driver tables, in Spark and in SQL.

K  KOI-shaped projection of ``lineitem`` (label + signal columns).
S  scored projection of ``lineitem`` (label code, class scores, prediction).
W  ``documents LEFT JOIN labels`` plus empty / constant / rare columns.

The SQL text is the DuckDB twin of each projection; both sides compute the
same IEEE doubles.  ``l_discount`` and ``l_tax`` hold -0.0, so 0.0 is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import first_argmax, label_encode
from ..sources.tables import read_table

# Class order of the K/S label (l_returnflag).
K_CLASSES = ["A", "N", "R"]
N_MEMBERS = 7

# (name, SQL expression over lineitem) - identical text runs in Spark SQL and DuckDB.
K_COLUMNS: list[tuple[str, str]] = [
    ("label", "l_returnflag"),
    ("koi_period", "CAST(l_quantity * 10 AS DOUBLE)"),
    ("koi_teq", "CAST(l_quantity * 50 AS DOUBLE)"),
    ("koi_prad", "CAST(l_quantity * 0.25 AS DOUBLE)"),
    ("koi_insol", "CAST(nullif(l_discount + 0.0, 0.0) * 25 AS DOUBLE)"),
    ("koi_depth", "CAST(l_extendedprice AS DOUBLE)"),
    ("koi_depth_err1", "CAST(-((l_tax + 0.0) * 1000) AS DOUBLE)"),
    ("koi_duration", "CAST(nullif(l_quantity, 13.0) AS DOUBLE)"),
    ("koi_ror", "CAST(l_discount + 0.0 AS DOUBLE)"),
    ("koi_model_snr", "CAST(l_extendedprice / 100 - 100 AS DOUBLE)"),
    ("koi_max_mult_ev", "CAST(l_partkey AS DOUBLE)"),
    ("koi_num_transits", "CAST(l_linenumber - 1 AS DOUBLE)"),
    ("koi_sma", "CAST(nullif(l_tax + 0.0, 0.0) AS DOUBLE)"),
    ("koi_steff", "CAST(3000 + l_suppkey AS DOUBLE)"),
    ("koi_srad", "CAST(nullif(l_tax + 0.0, 0.01) * 10 AS DOUBLE)"),
    ("koi_dicco_msky", "CAST((l_discount + 0.0) - 0.05 AS DOUBLE)"),
    ("koi_dicco_msky_err", "CAST((l_tax + 0.0) - 0.04 AS DOUBLE)"),
    ("koi_dikco_msky", "CAST(-l_quantity AS DOUBLE)"),
    ("koi_dikco_msky_err", "CAST(l_linenumber AS DOUBLE)"),
    ("koi_fwm_sra", "CAST(l_extendedprice AS DOUBLE)"),
    ("koi_fwm_sra_err", "CAST(nullif(l_discount + 0.0, 0.0) AS DOUBLE)"),
    ("koi_fwm_sdec", "CAST(l_quantity AS DOUBLE)"),
    ("koi_fwm_sdec_err", "CAST(l_quantity AS DOUBLE)"),
]
K_TWIN = ("koi_prad_twin", "CAST(l_quantity * 0.5 AS DOUBLE)")
K_FEATURES = [n for n, _ in K_COLUMNS[1:]]


def _k_select(twin: bool) -> list[tuple[str, str]]:
    return K_COLUMNS + ([K_TWIN] if twin else [])


def k_table(spark: SparkSession, sf_dir: str, twin: bool = False) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(e).alias(n) for n, e in _k_select(twin)])


def k_sql(twin: bool = False) -> str:
    body = ",\n  ".join(f"{e} AS {n}" for n, e in _k_select(twin))
    return f"SELECT\n  {body}\nFROM lineitem"


# ---- S: scored projection -------------------------------------------------

def _weights_sql(m: int = 0) -> tuple[str, str, str]:
    return (
        f"(CAST(l_quantity AS BIGINT) + {m}) % 7 + 1",
        f"(l_partkey + {m}) % 5 + 1",
        f"(l_suppkey + {m}) % 3 + 1",
    )


def _probs_sql(m: int = 0) -> list[str]:
    w = _weights_sql(m)
    tot = f"CAST(({w[0]}) + ({w[1]}) + ({w[2]}) AS DOUBLE)"
    return [f"CAST({wk} AS DOUBLE) / {tot}" for wk in w]


# Fold of a scored row from its md5 (two hex digits -> 0..255 -> mod 5).
_HEX = "0123456789abcdef"
FOLD_SQL = ("((instr('0123456789abcdef', substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
            "CAST(l_partkey AS VARCHAR))), 1, 1)) - 1) * 16 + instr('0123456789abcdef', substr(md5(concat_ws('|', "
            "CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))), 2, 1)) - 1) % 5")


def s_table(spark: SparkSession, sf_dir: str, members: bool = False) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    h = F.md5(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                          F.col("l_partkey").cast("string")))
    digit = lambda i: F.instr(F.lit(_HEX), F.substring(h, i, 1)) - 1
    cols = [label_encode("l_returnflag", K_CLASSES).alias("y"), ((digit(1) * 16 + digit(2)) % 5).cast("int").alias("fold")]
    cols += [F.expr(e).alias(f"p_{k}") for k, e in enumerate(_probs_sql(0))]
    if members:
        for m in range(N_MEMBERS):
            cols.append(F.array(*[F.expr(e) for e in _probs_sql(m + 1)]).alias(f"member_{m}"))
    return li.select(*cols).withColumn("pred", first_argmax(["p_0", "p_1", "p_2"]))


def s_sql(members: bool = False) -> str:
    p = _probs_sql(0)
    cols = ["CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS y", f"CAST({FOLD_SQL} AS INTEGER) AS fold"]
    cols += [f"{e} AS p_{k}" for k, e in enumerate(p)]
    if members:
        for m in range(N_MEMBERS):
            cols.append("[" + ", ".join(_probs_sql(m + 1)) + f"] AS member_{m}")
    inner = "SELECT " + ", ".join(cols) + " FROM lineitem"
    pred = "CASE WHEN p_0 >= p_1 AND p_0 >= p_2 THEN 0 WHEN p_1 >= p_2 THEN 1 ELSE 2 END AS pred"
    return f"SELECT *, {pred} FROM ({inner})"


# ---- W: wide table with missing values ---------------------------------------

W_SQL = """SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic,
  CAST(NULL AS DOUBLE) AS empty_col, CAST(1.0 AS DOUBLE) AS const_col,
  CASE WHEN d.doc_id % 1000 = 0 THEN 1 ELSE 0 END AS rare_col
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def w_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = read_table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "n_chars", "lang", "source", "quality", "toxic",
        F.lit(None).cast("double").alias("empty_col"),
        F.lit(1.0).alias("const_col"),
        F.when(F.col("doc_id") % 1000 == 0, 1).otherwise(0).alias("rare_col"),
    )


W_COLUMNS = ["doc_id", "n_chars", "lang", "source", "quality", "toxic", "empty_col", "const_col", "rare_col"]


# ---- O: keyed numeric projection of ``orders`` (attribution fixtures) ------------

O_CLASSES = ["F", "O", "P"]
O_FEATURES = ["x_price", "x_cust", "x_day", "x_prio"]
O_COLUMNS: list[tuple[str, str]] = [
    ("o_orderkey", "o_orderkey"),
    ("y", "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END"),
    ("x_price", "o_totalprice / 1000.0"),
    ("x_cust", "CAST(o_custkey % 100 AS DOUBLE)"),
    ("x_day", "CAST(dayofmonth(o_orderdate) AS DOUBLE)"),
    ("x_prio", "TRY_CAST(substring(o_orderpriority, 1, 1) AS DOUBLE)"),
]
# Weights of the closed-form linear scorer, one row per class.
O_WEIGHTS: dict[int, list[float]] = {
    0: [0.02, 0.01, -0.03, 0.2],
    1: [-0.01, 0.02, 0.01, -0.1],
    2: [0.005, -0.01, 0.02, 0.05],
}


def o_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(*[F.expr(e).alias(n) for n, e in O_COLUMNS]).withColumn("y", F.col("y").cast("int"))


def o_sql() -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in O_COLUMNS) + " FROM orders"


def o_score(c: int):
    """Linear score of class c, left to right (same rounding as the SQL twin)."""
    out = F.lit(0.0)
    for w, f in zip(O_WEIGHTS[c], O_FEATURES):
        out = out + F.lit(w) * F.col(f)
    return out


def o_score_sql(c: int, cols=None) -> str:
    cols = cols or O_FEATURES
    return "(0.0 + " + " + ".join(f"{w!r} * {f}" for w, f in zip(O_WEIGHTS[c], cols)) + ")"


def o_pred(df=None):
    return first_argmax_expr([o_score(c) for c in range(3)])


def first_argmax_expr(cols):
    arr = F.array(*cols)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def o_pred_sql(cols=None) -> str:
    s = [o_score_sql(c, cols) for c in range(3)]
    return f"CASE WHEN {s[0]} >= {s[1]} AND {s[0]} >= {s[2]} THEN 0 WHEN {s[1]} >= {s[2]} THEN 1 ELSE 2 END"
