"""Queries for M1-M17, S4, X3, I2, I5.

A trained model's numbers have no SQL twin.  Each query therefore returns the contract of its operator
- which rows are scored, under which label, fold or setting - with flags that must hold (``valid``:
probabilities or scores in range and consistent), and its twin derives keys, counts and folds in SQL
from the whole table.  (The labels of ``embeddings`` carry no signal, so no score can be asked for.)  The tables with the numbers are
the functions of the same name without the ``q_`` prefix (``compare_models`` ...).

``embeddings`` has ten labels; the three-class queries use ``label % 3``, so every row takes part.
Queries fit with ``ml.QUICK`` settings, passed by name; the operators' defaults are the full ones, and
``compare_models`` fits these."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import label_encode
from ..operators import experiments as ex
from ..operators import ml
from ..operators import prep
from ..operators import split as sp
from ..operators.scoring import score_job, score_with_model
from ..operators.training import train_job
from ..session import checkpoint_dir, materialize
from ..sources.tables import read_table
from .fixtures import FOLD_SQL, K_CLASSES, K_COLUMNS
from .registry import query, r
from .suite_metrics import sql_scorecard

K3 = 3
PROBS = [f"p_{i}" for i in range(K3)]
CLASSES = ["c0", "c1", "c2"]
FOLDS = 5

# ---- SQL twins --------------------------------------------------------------------------

E_SQL = "e AS (SELECT vec_id, label % 3 AS label FROM embeddings)"
E_RANK = "r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', CAST(vec_id AS VARCHAR), '42')), vec_id) AS rank FROM e)"
# rows of the 20 % hold-out: largest-remainder quotas over the classes
HELD_SQL = f"""{E_SQL}, {E_RANK},
c AS (SELECT label, count(*) AS n FROM e GROUP BY label),
t AS (SELECT CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS BIGINT) AS take, sum(n) AS total FROM c),
q0 AS (SELECT label, (take * n) // total AS base, (take * n) % total AS rem, take FROM c, t),
q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= take - (SELECT sum(base) FROM q0) THEN 1 ELSE 0 END AS quota FROM q0),
held AS (SELECT r.vec_id, r.label FROM r JOIN q ON r.label = q.label WHERE r.rank <= q.quota)"""
HELD_VALID = f"WITH {HELD_SQL} SELECT vec_id, label, true AS valid FROM held"
K_FOLD = "k AS (SELECT l_returnflag AS label, CAST(" + FOLD_SQL + " AS INTEGER) AS fold FROM lineitem)"


# ---- fixtures -----------------------------------------------------------------------------

def _three(spark, sf) -> DataFrame:
    return read_table(spark, sf, "embeddings").withColumn("label", F.col("label") % 3)


def _emb3(spark, sf) -> DataFrame:
    return ml.with_vector(_three(spark, sf), "embedding")


def _holdout(df, key="vec_id", label="label"):
    s = materialize(sp.stratified_split(df, label, [key], 0.2), "holdout")
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


def _valid(k=K3):
    """Probabilities in [0, 1] that add up to 1, and a predicted class that has the largest."""
    p = [F.col(f"p_{i}") for i in range(k)]
    total = sum(p[1:], p[0])
    inside = p[0].between(0, 1 + 1e-9)
    for x in p[1:]:
        inside = inside & x.between(0, 1 + 1e-9)
    best = F.greatest(*p) if k > 1 else p[0]
    return F.coalesce(inside & (F.abs(total - 1) < 1e-6) & (F.array(*p)[F.col("pred")] == best), F.lit(False))


def _fit_one(name):
    def build(spark, sf):
        train, test = _holdout(_emb3(spark, sf))
        model = ml.make_estimator(name, K3, 64, ml.QUICK.get(name)).fit(train)
        return ml.scored_frame(model, test, K3, ["vec_id", "label"]).select("vec_id", "label", _valid().alias("valid"))
    return build


for _n in ["logistic", "tree", "forest", "boosted", "mlp", "svm"]:
    query(f"fit_{_n}", HELD_VALID)(_fit_one(_n))


def _in_range(cols):
    out = None
    for c in cols:
        x = F.col(c).between(0, 1 + 1e-9)
        out = x if out is None else out & x
    return F.coalesce(out, F.lit(False))


def _plan(spark, sf, folds=FOLDS) -> ex.FoldPlan:
    return ex.FoldPlan(_three(spark, sf), "label", K3, "vec_id", folds, features="embedding")


FAMILIES = ["logistic", "tree", "forest", "boosted", "mlp", "svm", "knn"]


def compare_models(spark, sf) -> DataFrame:
    """M8: seven families and the class shares x stratified folds; mean and std of five scores, seconds, rank."""
    return ex.compare_models(_plan(spark, sf), FAMILIES)


@query("compare_models", f"""WITH {E_SQL}, m(model) AS (VALUES {", ".join(f"('{f}')" for f in [*FAMILIES, "prior"])}),
c AS (SELECT count(*) AS n FROM e) SELECT model, CAST(5 AS BIGINT) AS n_folds, true AS valid, true AS ranked FROM m, c WHERE n > 0""")
def q_compare_models(spark, sf):
    t = compare_models(spark, sf)
    means = [f"{m}_mean" for m in ml.SCORES]
    return t.select("model", "n_folds", (_in_range(means) & (F.col("fit_s") >= 0)).alias("valid"), F.col("rank").between(1, 8).alias("ranked"))


PRIOR_SQL = f"""WITH {E_SQL}, {E_RANK}, f AS (SELECT label AS y, (rank - 1) % 5 AS fold FROM r),
sh AS (SELECT g.fold, count(*) FILTER (f.y = 0) / CAST(count(*) AS DOUBLE) AS p_0, count(*) FILTER (f.y = 1) / CAST(count(*) AS DOUBLE) AS p_1,
  count(*) FILTER (f.y = 2) / CAST(count(*) AS DOUBLE) AS p_2 FROM (SELECT DISTINCT fold FROM f) g JOIN f ON f.fold <> g.fold GROUP BY g.fold),
s AS (SELECT f.fold, f.y, sh.p_0, sh.p_1, sh.p_2, CASE WHEN p_0 >= p_1 AND p_0 >= p_2 THEN 0 WHEN p_1 >= p_2 THEN 1 ELSE 2 END AS pred FROM f JOIN sh ON f.fold = sh.fold),
c AS ({sql_scorecard("s", K3, PROBS, ["fold"])})
SELECT 'prior' AS model, count(*) AS n_folds, """ + ", ".join(f"{r(f'avg({m})')} AS {m}_mean, {r(f'stddev_pop({m})')} AS {m}_std" for m in ml.SCORES) + " FROM c"


@query("prior_baseline", PRIOR_SQL)
def q_prior_baseline(spark, sf):
    """M8's table for the arm whose numbers have a closed form: the class shares of each fold's training rows."""
    t = ex.compare_models(_plan(spark, sf), [])
    return t.select("model", "n_folds", *[f"{m}_{x}" for m in ml.SCORES for x in ("mean", "std")])


def _docs_labelled(spark, sf) -> DataFrame:
    """documents JOIN labels with text statistics as features (whole texts)."""
    d = read_table(spark, sf, "documents")
    lab = read_table(spark, sf, "labels")
    j = d.join(lab, "doc_id")
    t = F.col("text")
    feats = [F.log1p(F.col("n_chars").cast("double")), F.log1p(F.size(F.split(t, r"\s+")).cast("double")),
             (F.length(F.regexp_replace(t, "[^0-9]", "")) / F.greatest(F.length(t), F.lit(1))).cast("double"),
             (F.length(F.regexp_replace(t, "[^A-Z]", "")) / F.greatest(F.length(t), F.lit(1))).cast("double"),
             (F.length(F.regexp_replace(t, "[^\\n]", "")) / F.greatest(F.length(t), F.lit(1))).cast("double")]
    return j.select("doc_id", F.col("quality").alias("label"), F.array(*feats).alias("fvec"))


STRATEGIES = ex.STRATEGIES


def compare_imbalance(spark, sf) -> DataFrame:
    """M9: none / class weight / SMOTE / ADASYN / over / under, each applied to training folds only,
    logistic model; five scores by strategy, ranked."""
    plan = ex.FoldPlan(_docs_labelled(spark, sf), "label", 2, "doc_id", FOLDS, features="fvec")
    return ex.compare_imbalance(plan, "logistic", ml.QUICK["logistic"])


@query("compare_imbalance", "WITH s(strategy) AS (VALUES " + ", ".join(f"('{x}')" for x in STRATEGIES) + """),
n AS (SELECT count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT strategy, CAST(5 AS BIGINT) AS n_folds, true AS valid, true AS ranked FROM s, n WHERE n > 0""")
def q_compare_imbalance(spark, sf):
    t = compare_imbalance(spark, sf)
    return t.select("strategy", "n_folds", _in_range([f"{m}_mean" for m in ml.SCORES]).alias("valid"), F.col("rank").between(1, 6).alias("ranked"))


# A small forest space for the query; the full ranges are ``ml.SEARCH_SPACES``.
QUICK_SPACE = {"numTrees": ("int", 5, 30), "maxDepth": ("int", 2, 8), "minInstancesPerNode": ("int", 1, 8)}


draw_trials = ex.draw_trials


@query("search_trials", "SELECT trial, \"numTrees\", \"maxDepth\", \"minInstancesPerNode\", true AS valid FROM (VALUES " + ", ".join(
    f"({t}, {p['numTrees']}, {p['maxDepth']}, {p['minInstancesPerNode']})" for t, p in enumerate(draw_trials(QUICK_SPACE, 4)))
    + ') AS v(trial, "numTrees", "maxDepth", "minInstancesPerNode") WHERE (SELECT count(*) FROM embeddings) > 0')
def q_search_trials(spark, sf):
    """M10 over four trials of a small space, all folds."""
    t = ex.search(_plan(spark, sf), "forest", 4, QUICK_SPACE, halving=False)
    names = [F.get_json_object("params", f"$.{n}").cast("int").alias(n) for n in ("numTrees", "maxDepth", "minInstancesPerNode")]
    return t.select("trial", *names, (_in_range(["train_f1", "val_f1"]) & (F.col("objective") <= F.col("val_f1")) & F.col("finished")).alias("valid"))


@query("search_halving", "SELECT CAST(f AS INTEGER) AS folds, CAST(n AS BIGINT) AS trials, true AS valid FROM (VALUES (1, 4), (2, 2), (5, 2)) AS v(f, n) "
       "WHERE (SELECT count(*) FROM embeddings) > 0")
def q_search_halving(spark, sf):
    """M10 with successive halving over eight trials of the small space: four leave after the first fold, two after
    the second, two meet all five."""
    t = ex.search(_plan(spark, sf), "forest", 8, QUICK_SPACE)
    return t.groupBy("folds").agg(F.count(F.lit(1)).alias("trials"), F.min((F.col("finished") == (F.col("folds") == 5)) & F.col("val_f1").between(0, 1))
                                  .alias("valid"))


def _final_model(train):
    return ml.fit_final(train, K3, "forest", features="embedding", params=ml.QUICK["forest"])


@query("final_model", HELD_VALID)
def q_final_model(spark, sf):
    """One saved pipeline fitted on all training rows; the held-out rows scored by it."""
    train, test = _holdout(_three(spark, sf))
    path = _model_path(spark, "final")
    _final_model(train).write().overwrite().save(path)
    scored = score_with_model(PipelineModel.load(path), test, CLASSES, keep=["vec_id", "label"])
    return scored.withColumnsRenamed({f"p_c{i}": f"p_{i}" for i in range(K3)}).select("vec_id", "label", _valid().alias("valid"))


@query("train_job", f"""WITH {K_FOLD} SELECT part, n, true AS valid, CAST(9 AS BIGINT) AS n_cells FROM (
SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY 1)""")
def q_train_job(spark, sf):
    """The whole job: table with planted leaks -> firewall, A9, class weights, logistic model -> saved
    pipeline, scored rows and metric tables, read back."""
    k = materialize(_k_keyed(spark, sf, extra_leaks=True), "train-job")
    out = _model_path(spark, "job")
    pre = prep.build_preprocessor(target="label", passthrough=PT)
    card = train_job(k, out, K3, "logistic", F.col("fold") == 0, "y", pre, weight=True, params=ml.QUICK["logistic"], keep=["fold"])
    cells = spark.read.parquet(f"{out}/confusion").groupBy("part").agg(F.count(F.lit(1)).alias("n_cells"))
    return card.join(cells, "part").select("part", "n", _in_range(ml.SCORES).alias("valid"), "n_cells")


def _k_keyed(spark, sf, extra_leaks=False):
    """K with a hash fold (lineitem has no unique key) and optional planted leaks."""
    li = read_table(spark, sf, "lineitem")
    cols = [F.expr(e).alias(n) for n, e in K_COLUMNS] + [F.expr(FOLD_SQL.replace("VARCHAR", "STRING")).cast("int").alias("fold")]
    if extra_leaks:
        cols += [label_encode("l_returnflag", K_CLASSES).cast("double").alias("koi_score"),
                 (F.col("l_returnflag") == "A").cast("double").alias("koi_fpflag_nt")]
    return li.select(*cols).withColumn("y", label_encode("label", K_CLASSES))


PT = ["y", "fold"]


def _prep_fit(train, derive=True, keep=None, model="logistic", k=K3):
    """A9 (or A10) + classifier fitted on training rows; y/fold pass through."""
    pre = prep.build_preprocessor(scale=True, derive=derive, target="label", keep=keep, passthrough=PT).fit(train)
    names = prep.feature_names(pre)
    clf = ml.make_estimator(model, k, len(names), ml.QUICK.get(model), label="y").fit(ml.with_vector(pre.transform(train), names))
    return pre, names, clf


def _prep_score(pre, names, clf, df, k=K3):
    return ml.scored_frame(clf, ml.with_vector(pre.transform(df), names), k, ["y", "fold"])


def _prepared(**options):
    return lambda *keep: prep.build_preprocessor(scale=True, target="label", passthrough=["y", "fold", "part"],
                                                 keep=keep[0] if keep else None, **options)


def _binary_card(spark, sf, decided: bool):
    k = _k_keyed(spark, sf)
    if decided:   # P7: keep the decided classes, CONFIRMED-like 'R' vs FALSE-POSITIVE-like 'A'
        k = k.filter(F.col("label").isin("A", "R")).withColumn("y", (F.col("label") == "R").cast("int"))
    else:         # P11: REAL = not 'A'
        k = k.withColumn("y", (F.col("label") != "A").cast("int"))
    return ex.binary_framing(k, "y", F.col("fold") == 0, _prepared(), "boosted", ml.QUICK["boosted"])


BINARY_SQL = """SELECT part, n, true AS valid FROM (
SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part, CAST(count(*) AS BIGINT) AS n FROM k {where} GROUP BY 1)"""


def _binary_contract(spark, sf, decided):
    """Rows per part, all scores in range, the gap consistent with the train score."""
    ok = _in_range(["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]) & \
        (F.abs(F.col("overfit_gap") - (F.col("train_f1") - F.col("f1"))) < 1e-9)
    return _binary_card(spark, sf, decided).select("part", "n", ok.alias("valid"))


@query("binary_framing", f"WITH {K_FOLD} " + BINARY_SQL.format(where=""))
def q_binary_framing(spark, sf):
    """REAL vs FALSE POSITIVE -> A9 -> boosted trees -> E11."""
    return _binary_contract(spark, sf, False)


@query("decided_framing", f"WITH {K_FOLD} " + BINARY_SQL.format(where="WHERE label IN ('A', 'R')"))
def q_decided_framing(spark, sf):
    """Decided classes only -> binary -> A9 -> boosted trees -> E11."""
    return _binary_contract(spark, sf, True)


LEAKS = ["koi_score", "koi_fpflag_nt"]


def leakage_benchmark(spark, sf) -> DataFrame:
    """Same model with the firewall on vs with planted leak columns
    restored; premium = F1 with leakage - F1 without (J3)."""
    return ex.leakage_benchmark(_k_keyed(spark, sf, extra_leaks=True), "y", K3, F.col("fold") == 0, _prepared(), LEAKS, "logistic", ml.QUICK["logistic"])


@query("leakage_benchmark", f"""WITH {K_FOLD}, a(arm, leak_helps) AS (VALUES ('leakage_free', false), ('with_leakage', true))
SELECT arm, CAST((SELECT count(*) FROM k WHERE fold = 0) AS BIGINT) AS n, true AS valid, leak_helps FROM a""")
def q_leakage_benchmark(spark, sf):
    t = leakage_benchmark(spark, sf)
    return t.select("arm", "n", _in_range(["f1_weighted"]).alias("valid"), (F.col("premium") > 0).alias("leak_helps"))


def feature_ablation(spark, sf, folds: int = 3) -> DataFrame:
    """Cross-validation with vs without derived features; delta vs the
    without-arm.  Preprocessing is refitted inside each fold."""
    k = materialize(_k_keyed(spark, sf).withColumn("fold", F.col("fold") % folds), "ablation")
    plans = {arm: ex.FoldPlan(k, "y", K3, folds=folds, fold_col="fold", preprocessor=_prepared(derive=derive))
             for arm, derive in [("with_features", True), ("without_features", False)]}
    n = sum(plans["with_features"].part(f, False).count() for f in range(folds))
    return ex.feature_ablation(plans, "without_features", "logistic", ml.QUICK["logistic"]).withColumn("n", F.lit(n).cast("long"))


@query("feature_ablation", f"""WITH {K_FOLD}, a(arm) AS (VALUES ('with_features'), ('without_features'))
SELECT arm, CAST(3 AS BIGINT) AS n_folds, CAST((SELECT count(*) FROM k) AS BIGINT) AS n, true AS valid FROM a""")
def q_feature_ablation(spark, sf):
    t = feature_ablation(spark, sf)
    return t.select("arm", "n_folds", "n", _in_range(["f1_weighted_mean"]).alias("valid"))


LEARNING_FRACTIONS = [0.1, 0.28, 0.46, 0.64, 0.82, 1.0]


def learning_curve(spark, sf, fractions=tuple(LEARNING_FRACTIONS)) -> DataFrame:
    """Nested training sizes x stratified folds, logistic model.  ``n_train``: training rows over the folds."""
    plan = _plan(spark, sf)
    return ex.learning_curve(plan, ex.family_arm(plan, "logistic", ml.QUICK["logistic"]), fractions)


@query("learning_curve", f"""WITH {E_SQL}, {E_RANK}, f(train_fraction) AS (VALUES {", ".join(f"(CAST({x} AS DOUBLE))" for x in LEARNING_FRACTIONS)}),
n AS (SELECT g.range AS fold, (SELECT count(*) FROM r WHERE (rank - 1) % 5 <> g.range) AS n FROM range(5) g)
SELECT train_fraction, CAST(5 AS BIGINT) AS n_folds, CAST(sum(greatest(1, CAST(floor(train_fraction * n) AS BIGINT))) AS BIGINT) AS n_train, true AS valid
FROM f, n GROUP BY train_fraction""")
def q_learning_curve(spark, sf):
    t = learning_curve(spark, sf)
    return t.select("train_fraction", "n_folds", "n_train", _in_range(["train_mean", "val_mean"]).alias("valid"))


# Tree counts of the full curve.
VALIDATION_GRID = [100, 200, 400, 600, 800]
QUICK_GRID = [5, 10, 20]


def validation_curve(spark, sf, grid=tuple(VALIDATION_GRID), family: str = "forest", parameter: str = "numTrees") -> DataFrame:
    """One parameter over a grid x folds, train and validation F1."""
    return ex.validation_curve(_plan(spark, sf), family, parameter, grid, ml.QUICK.get(family))


@query("validation_curve", f"""SELECT v AS "numTrees", CAST(5 AS BIGINT) AS n_folds, true AS valid FROM (VALUES {", ".join(f"({v})" for v in QUICK_GRID)}) AS g(v)
WHERE (SELECT count(*) FROM embeddings) > 0""")
def q_validation_curve(spark, sf):
    """Three small tree counts."""
    t = validation_curve(spark, sf, QUICK_GRID)
    return t.select("numTrees", "n_folds", _in_range(["train_mean", "val_mean"]).alias("valid"))


def _model_path(spark, name):
    return f"{checkpoint_dir(spark)}/kestrel-models/{name}-{uuid.uuid4().hex}"


@query("model_round_trip", "SELECT vec_id, true AS same FROM embeddings")
def q_model_round_trip(spark, sf):
    """Save a fitted pipeline, load it back, same probabilities."""
    e = _three(spark, sf)
    model = _final_model(e)
    path = _model_path(spark, "forest")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    row = F.struct("pred", *[f"p_{c}" for c in CLASSES])
    a = score_with_model(model, e, CLASSES, keep=["vec_id"]).select("vec_id", row.alias("before"))
    b = score_with_model(again, e, CLASSES, keep=["vec_id"]).select("vec_id", row.alias("after"))
    return a.join(b, "vec_id").select("vec_id", (F.col("before") == F.col("after")).alias("same"))


def native_importance(spark, sf, top: int = 20) -> DataFrame:
    """The forest's own importances, the largest ``top``, as (rank, feature, importance)."""
    model = ml.make_estimator("forest", K3, 64, ml.QUICK["forest"]).fit(_emb3(spark, sf))
    return ex.native_importance(model, [f"emb_{i}" for i in range(64)], spark, top)


@query("native_importance", "SELECT CAST(range AS INTEGER) AS rank, true AS valid FROM range(1, 21) WHERE (SELECT count(*) FROM embeddings) > 0")
def q_native_importance(spark, sf):
    t = native_importance(spark, sf)
    return t.select("rank", F.col("importance").between(0, 1).alias("valid"))


@query("score_partial", f"WITH {K_FOLD} SELECT fold, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_valid FROM k GROUP BY fold")
def q_score_partial(spark, sf):
    """Rows that carry only three fitted columns go through the same path:
    firewall -> derivation -> alignment (absent -> NULL) -> imputation -> scaling."""
    k = _k_keyed(spark, sf)
    pre, names, clf = _prep_fit(k)
    part = k.select("koi_period", "koi_depth", "koi_prad", "y", "fold")
    scored = _prep_score(pre, names, clf, part)
    return scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(_valid()).alias("n_valid"))


@query("score_job", "SELECT vec_id, label, true AS valid FROM embeddings")
def q_score_job(spark, sf):
    """Batch job entry - saved model + input table path -> scored table.  The model knows three
    classes (``label % 3``); the table keeps its own labels."""
    path, out = _model_path(spark, "final"), _model_path(spark, "scored")
    _final_model(_three(spark, sf)).write().overwrite().save(path)
    score_job(spark, path, f"{sf.rstrip('/')}/embeddings.parquet", out, CLASSES, keep=["vec_id", "label"])
    scored = spark.read.parquet(out).withColumnsRenamed({f"p_c{i}": f"p_{i}" for i in range(K3)})
    return scored.select("vec_id", "label", _valid().alias("valid"))


@query("forest_interval", "SELECT vec_id, true AS valid FROM embeddings")
def q_forest_interval(spark, sf):
    """I3 on the full forest (400 trees): mean +- 1.96 population std of the winning
    class probability over the trees, clipped to [0, 1]."""
    from ..operators.scoring import forest_interval
    e = _emb3(spark, sf)
    model = ml.make_estimator("forest", K3, 64).fit(e)
    t = forest_interval(model, e, keep=["vec_id"])
    low, mean, high = F.col("confidence_low"), F.col("member_mean"), F.col("confidence_high")
    return t.select("vec_id", ((low >= 0) & (low <= mean + 1e-9) & (mean <= high + 1e-9) & (high <= 1) & (F.col("member_std") >= 0)).alias("valid"))
