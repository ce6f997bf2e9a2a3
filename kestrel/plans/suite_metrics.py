"""Queries for E1-E17, J3, J4 and I1, I3, I4 on the scored fixture S."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import metric_store as ms
from ..operators import metrics as m
from ..operators import scoring as sc
from ..operators.experiments import delta_table
from ..session import checkpoint_dir, materialize
from .fixtures import K_CLASSES, N_MEMBERS, s_sql, s_table
from .registry import query, r

S = f"WITH s AS ({s_sql()})"
SM = f"WITH s AS ({s_sql(members=True)})"
PROBS = ["p_0", "p_1", "p_2"]
K3 = 3


def _u(parts):
    return "\nUNION ALL\n".join(parts)


def _b(by):
    return (", ".join(by) + ", ") if by else ""


def _g(by, extra=""):
    cols = list(by) + ([extra] if extra else [])
    return (" GROUP BY " + ", ".join(cols)) if cols else ""


# ---- SQL generators (oracle side) ------------------------------------------------

def sql_per_class(src, k, by=(), y="y", pred="pred"):
    t = _u([f"SELECT {_b(by)}{c} AS class, count_if({y} = {c} AND {pred} = {c}) AS tp, count_if({y} = {c}) AS support, "
            f"count_if({pred} = {c}) AS predicted FROM {src}{_g(by)}" for c in range(k)])
    d = lambda x: f"CAST({x} AS DOUBLE)"
    den = "(2 * tp + (predicted - tp) + (support - tp))"
    return (f"SELECT {_b(by)}class, CASE WHEN predicted <> 0 THEN {d('tp')} / predicted ELSE 0.0 END AS precision, "
            f"CASE WHEN support <> 0 THEN {d('tp')} / support ELSE 0.0 END AS recall, "
            f"CASE WHEN {den} <> 0 THEN {d('2 * tp')} / {den} ELSE 0.0 END AS f1, CAST(support AS BIGINT) AS support, "
            f"CAST(predicted AS BIGINT) AS predicted FROM ({t})")


def sql_averaged(pc, by=()):
    ws = lambda x: f"CASE WHEN sum(support) <> 0 THEN sum({x} * support) / sum(support) ELSE 0.0 END"
    return (f"SELECT {_b(by)}{ws('precision')} AS precision_weighted, {ws('recall')} AS recall_weighted, {ws('f1')} AS f1_weighted, "
            f"avg(CASE WHEN support + predicted > 0 THEN f1 END) AS f1_macro FROM ({pc}){_g(by)}")


def sql_score_table(src, scores, by=(), y="y", classes=None):
    classes = list(range(len(scores))) if classes is None else classes
    sl = _u([f"SELECT {_b(by)}{y} AS __y, {c} AS class, CAST({s} AS DOUBLE) AS score FROM {src}" for c, s in zip(classes, scores)])
    part = ", ".join(list(by) + ["class"])
    st0 = f"SELECT {part}, score, count_if(__y = class) AS pos, count_if(__y <> class) AS neg FROM ({sl}) WHERE score IS NOT NULL GROUP BY {part}, score"
    w = f"PARTITION BY {part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return (f"SELECT {part}, score, pos, neg, CAST(sum(pos) OVER ({w}) AS BIGINT) AS tp, CAST(sum(neg) OVER ({w}) AS BIGINT) AS fp, "
            f"CAST(sum(pos) OVER (PARTITION BY {part}) AS BIGINT) AS P, CAST(sum(neg) OVER (PARTITION BY {part}) AS BIGINT) AS N FROM ({st0})")


def sql_auc(st, by=()):
    part = ", ".join(list(by) + ["class"])
    return (f"SELECT {part}, CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * ((N - fp) + 0.5 * neg)) / (max(P) * max(N)) END AS roc_auc, "
            f"max(P) AS n_pos FROM ({st}) GROUP BY {part}")


def sql_auc_weighted(st, by=()):
    return (f"SELECT {_b(by)}CASE WHEN count_if(roc_auc IS NULL) = 0 THEN sum(roc_auc * n_pos) / sum(n_pos) END AS roc_auc_ovr_weighted "
            f"FROM ({sql_auc(st, by)}){_g(by)}")


def sql_ap(st, by=()):
    part = ", ".join(list(by) + ["class"])
    return (f"SELECT {part}, CASE WHEN max(P) > 0 THEN sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / max(P) END AS average_precision "
            f"FROM ({st}) GROUP BY {part}")


def sql_scorecard(src, k, scores, by=()):
    acc = f"SELECT {_b(by)}avg(CAST(y = pred AS DOUBLE)) AS accuracy FROM {src}{_g(by)}"
    avg = sql_averaged(sql_per_class(src, k, by), by)
    auc = sql_auc_weighted(sql_score_table(src, scores, by), by)
    on = " AND ".join(f"a.{c} = b.{c}" for c in by) if by else "true"
    on2 = " AND ".join(f"a.{c} = c.{c}" for c in by) if by else "true"
    sel = ", ".join([f"a.{c}" for c in by] + ["a.accuracy", "b.precision_weighted", "b.recall_weighted", "b.f1_weighted",
                                               "b.f1_macro", "c.roc_auc_ovr_weighted"])
    return f"SELECT {sel} FROM ({acc}) a JOIN ({avg}) b ON {on} JOIN ({auc}) c ON {on2}"


def rr(sql, doubles):
    """Round the named double columns of a SELECT."""
    return "SELECT * REPLACE (" + ", ".join(f"{r(c)} AS {c}" for c in doubles) + f") FROM ({sql})"


# ---- E1-E4 ---------------------------------------------------------------------------------

def _s(spark, sf, members=False):
    return s_table(spark, sf, members)


@query("accuracy", S + rr("SELECT avg(CAST(y = pred AS DOUBLE)) AS accuracy FROM s", ["accuracy"]))
def q_accuracy(spark, sf):
    return m.accuracy(_s(spark, sf))


@query("per_class_scores", S + rr(sql_per_class("s", K3), ["precision", "recall", "f1"]))
def q_per_class(spark, sf):
    return m.per_class_scores(_s(spark, sf), K3)


@query("weighted_scores", S + rr(sql_averaged(sql_per_class("s", K3)), ["precision_weighted", "recall_weighted", "f1_weighted", "f1_macro"]))
def q_weighted(spark, sf):
    return m.averaged_scores(m.per_class_scores(_s(spark, sf), K3))


CONF_SQL = _u([f"SELECT {i} AS actual, {j} AS predicted, CAST(count_if(y = {i} AND pred = {j}) AS BIGINT) AS n FROM s"
               for i in range(K3) for j in range(K3)])


@query("confusion_matrix", S + rr(f"SELECT *, CASE WHEN sum(n) OVER (PARTITION BY actual) <> 0 THEN CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY actual) ELSE 0.0 END AS row_share FROM ({CONF_SQL})", ["row_share"]))
def q_confusion(spark, sf):
    return m.confusion(_s(spark, sf), K3)


# ---- E5-E10 ---------------------------------------------------------------------------------

ST = sql_score_table("s", PROBS)


@query("roc_auc_ovr", S + rr(sql_auc(ST), ["roc_auc"]))
def q_roc_auc(spark, sf):
    return m.roc_auc(m.score_table(_s(spark, sf), PROBS))


@query("roc_auc_weighted", S + rr(sql_auc_weighted(ST), ["roc_auc_ovr_weighted"]))
def q_roc_auc_weighted(spark, sf):
    return m.roc_auc_weighted(m.score_table(_s(spark, sf), PROBS))


@query("roc_points", S + rr(f"SELECT class, score AS threshold, CASE WHEN N <> 0 THEN CAST(fp AS DOUBLE) / N ELSE 0.0 END AS fpr, "
                            f"CASE WHEN P <> 0 THEN CAST(tp AS DOUBLE) / P ELSE 0.0 END AS tpr FROM ({ST})", ["threshold", "fpr", "tpr"]))
def q_roc_points(spark, sf):
    return m.roc_points(m.score_table(_s(spark, sf), PROBS))


@query("pr_points", S + rr(f"SELECT class, score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, "
                           f"CASE WHEN P <> 0 THEN CAST(tp AS DOUBLE) / P ELSE 0.0 END AS recall FROM ({ST})", ["threshold", "precision", "recall"]))
def q_pr_points(spark, sf):
    return m.pr_points(m.score_table(_s(spark, sf), PROBS))


@query("average_precision", S + rr(sql_ap(ST), ["average_precision"]))
def q_average_precision(spark, sf):
    return m.average_precision(m.score_table(_s(spark, sf), PROBS))


def _cal_sql():
    b = "CASE " + " ".join(f"WHEN p <= {e!r} THEN {i}" for i, e in enumerate(m.CALIBRATION_EDGES)) + f" ELSE {len(m.CALIBRATION_EDGES)} END"
    sl = _u([f"SELECT y, {i} AS class, {p} AS p FROM s" for i, p in enumerate(PROBS)])
    return rr(f"SELECT class, {b} AS bin, avg(p) AS mean_predicted, avg(CAST(y = class AS DOUBLE)) AS fraction_positive, "
              f"CAST(count(*) AS BIGINT) AS n FROM ({sl}) GROUP BY ALL", ["mean_predicted", "fraction_positive"])


@query("calibration_bins", S + _cal_sql())
def q_calibration(spark, sf):
    return m.calibration_bins(_s(spark, sf), PROBS)


# ---- E11-E17 -----------------------------------------------------------------------------------

BIN_SRC = "(SELECT CAST(y <> 0 AS INTEGER) AS y, CAST(pred <> 0 AS INTEGER) AS pred, 1.0 - p_0 AS score, " \
          "CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part FROM s)"


def _bin_sql():
    pc = f"SELECT * FROM ({sql_per_class(BIN_SRC, 2, ['part'])}) WHERE class = 1"
    acc = f"SELECT part, avg(CAST(y = pred AS DOUBLE)) AS accuracy FROM {BIN_SRC} GROUP BY part"
    st = sql_score_table(BIN_SRC, ["score"], ["part"], classes=[1])
    card = (f"SELECT a.part, a.accuracy, p.precision, p.recall, p.f1, u.roc_auc, v.average_precision FROM ({acc}) a "
            f"JOIN ({pc}) p ON a.part = p.part LEFT JOIN ({sql_auc(st, ['part'])}) u ON a.part = u.part "
            f"LEFT JOIN ({sql_ap(st, ['part'])}) v ON a.part = v.part")
    full = f"SELECT *, max(CASE WHEN part = 'train' THEN f1 END) OVER () AS train_f1 FROM ({card})"
    return rr(f"SELECT *, train_f1 - f1 AS overfit_gap FROM ({full})",
              ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision", "train_f1", "overfit_gap"])


def _binary_frame(s):
    return s.select((F.col("y") != 0).cast("int").alias("y"), (F.col("pred") != 0).cast("int").alias("pred"),
                    (F.lit(1.0) - F.col("p_0")).alias("score"),
                    F.when(F.col("fold") == 0, "test").otherwise("train").alias("part"))


@query("binary_scorecard", S + _bin_sql())
def q_binary_scorecard(spark, sf):
    return m.binary_scorecard(_binary_frame(_s(spark, sf)), "y", "pred", "score", "part")


CARD_COLS = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro", "roc_auc_ovr_weighted"]


@query("scorecard", S + rr(sql_scorecard("s", K3, PROBS), CARD_COLS))
def q_scorecard(spark, sf):
    return m.scorecard(_s(spark, sf), K3, PROBS)


def _members_long(spark, sf):
    s = _s(spark, sf, members=True)
    arr = F.explode(F.array(*[F.struct(F.lit(f"member_{i}").alias("model"), F.col(f"member_{i}").alias("pm"))
                              for i in range(N_MEMBERS)])).alias("x")
    long = s.select("y", "fold", arr).select("y", "fold", "x.model", "x.pm")
    return long.withColumn("pred", (F.array_position("pm", F.array_max("pm")) - 1).cast("int"))


MEMBERS_SQL = ("(SELECT y, fold, model, CASE WHEN pm[1] >= pm[2] AND pm[1] >= pm[3] THEN 0 WHEN pm[2] >= pm[3] THEN 1 ELSE 2 END AS pred FROM ("
               + _u([f"SELECT y, fold, 'member_{i}' AS model, member_{i} AS pm FROM s" for i in range(N_MEMBERS)]) + "))")
MODEL_F1 = f"SELECT model, f1_weighted FROM ({sql_averaged(sql_per_class(MEMBERS_SQL, K3, ['model']), ['model'])})"


@query("leaderboard", SM + rr(f"SELECT *, stddev_samp(f1_weighted) OVER () AS top_std FROM (SELECT model, f1_weighted, "
                              f"CAST(row_number() OVER (ORDER BY f1_weighted DESC, model) AS INTEGER) AS rank FROM ({MODEL_F1}) "
                              f"QUALIFY rank <= 3)", ["f1_weighted", "top_std"]))
def q_leaderboard(spark, sf):
    long = _members_long(spark, sf)
    f1 = m.averaged_scores(m.per_class_scores(long, K3, by=["model"]), ["model"]).select("model", "f1_weighted")
    return m.leaderboard(f1, "model", "f1_weighted", 3)


@query("error_breakdown", S + "SELECT y AS actual, pred AS predicted, CAST(count(*) AS BIGINT) AS n FROM s WHERE y <> pred GROUP BY ALL")
def q_error_breakdown(spark, sf):
    return m.error_breakdown(_s(spark, sf))


@query("confidence_histogram", S + """, c AS (SELECT greatest(p_0, p_1, p_2) AS confidence, y = pred AS correct FROM s),
g AS (SELECT correct, min(confidence) AS lo, max(confidence) AS hi FROM c GROUP BY correct),
b AS (SELECT c.correct, CAST(CASE WHEN g.hi = g.lo THEN 0 ELSE least(floor((c.confidence - g.lo) / ((g.hi - g.lo) / 20.0)), 19) END AS INTEGER) AS bin FROM c JOIN g ON c.correct = g.correct)
SELECT b.correct, b.bin, """ + r("g.lo + b.bin * (g.hi - g.lo) / 20.0", "edge_lo") + """, CAST(count(*) AS BIGINT) AS n FROM b JOIN g ON b.correct = g.correct GROUP BY b.correct, b.bin, g.lo, g.hi""")
def q_confidence_histogram(spark, sf):
    s = _s(spark, sf).select(F.greatest(*[F.col(p) for p in PROBS]).alias("confidence"), (F.col("y") == F.col("pred")).alias("correct"))
    return m.confidence_histogram(s, "confidence", "correct", 20)


FOLD_F1 = f"SELECT model, fold, f1_weighted FROM ({sql_averaged(sql_per_class(MEMBERS_SQL, K3, ['model', 'fold']), ['model', 'fold'])})"


@query("fold_summary", SM + rr(f"SELECT model, avg(f1_weighted) AS f1_weighted_mean, stddev_pop(f1_weighted) AS f1_weighted_std, "
                               f"CAST(count(*) AS BIGINT) AS n_folds FROM ({FOLD_F1}) GROUP BY model", ["f1_weighted_mean", "f1_weighted_std"]))
def q_fold_summary(spark, sf):
    long = _members_long(spark, sf)
    per_fold = m.averaged_scores(m.per_class_scores(long, K3, by=["model", "fold"]), ["model", "fold"])
    return m.fold_summary(per_fold, ["model"], "f1_weighted")


@query("baseline_delta", SM + rr(f"SELECT a.model, a.f1_weighted, b.f1_weighted AS baseline_f1, a.f1_weighted - b.f1_weighted AS delta "
                                 f"FROM ({MODEL_F1}) a JOIN (SELECT * FROM ({MODEL_F1}) WHERE model = 'member_0') b ON true",
                                 ["f1_weighted", "baseline_f1", "delta"]))
def q_baseline_delta(spark, sf):
    """Every arm against the one baseline row (a one-row broadcast)."""
    long = _members_long(spark, sf)
    f1 = m.averaged_scores(m.per_class_scores(long, K3, by=["model"]), ["model"]).select("model", "f1_weighted")
    base = f1.filter(F.col("model") == "member_0").select(F.lit(1).alias("__k"), F.col("f1_weighted").alias("baseline_f1"))
    return (f1.withColumn("__k", F.lit(1)).join(F.broadcast(base), "__k").drop("__k")
            .withColumn("delta", F.col("f1_weighted") - F.col("baseline_f1")))


# Three label framings of one scored table
def _framings(s):
    three = s.select(F.lit("three_class").alias("framing"), "y", "pred", "p_0", "p_1", "p_2")
    real = s.select(F.lit("real_vs_fp").alias("framing"), (F.col("y") != 0).cast("int").alias("y"),
                    (F.col("pred") != 0).cast("int").alias("pred"), F.col("p_0"), (F.lit(1.0) - F.col("p_0")).alias("p_1"),
                    F.lit(None).cast("double").alias("p_2"))
    dec = s.filter(F.col("y").isin(0, 2)).select(
        F.lit("decided").alias("framing"), (F.col("y") == 2).cast("int").alias("y"),
        (F.col("p_2") > F.col("p_0")).cast("int").alias("pred"), (F.col("p_0") / (F.col("p_0") + F.col("p_2"))).alias("p_0"),
        (F.col("p_2") / (F.col("p_0") + F.col("p_2"))).alias("p_1"), F.lit(None).cast("double").alias("p_2"))
    return three.unionByName(real).unionByName(dec)


FRAMINGS_SQL = ("(SELECT 'three_class' AS framing, y, pred, p_0, p_1, p_2 FROM s UNION ALL "
                "SELECT 'real_vs_fp', CAST(y <> 0 AS INTEGER), CAST(pred <> 0 AS INTEGER), p_0, 1.0 - p_0, CAST(NULL AS DOUBLE) FROM s UNION ALL "
                "SELECT 'decided', CAST(y = 2 AS INTEGER), CAST(p_2 > p_0 AS INTEGER), p_0 / (p_0 + p_2), p_2 / (p_0 + p_2), CAST(NULL AS DOUBLE) FROM s WHERE y IN (0, 2))")


@query("framings_table", S + rr(f"SELECT framing, accuracy, f1_weighted, roc_auc_ovr_weighted FROM ({sql_scorecard(FRAMINGS_SQL, K3, PROBS, ['framing'])})",
                                ["accuracy", "f1_weighted", "roc_auc_ovr_weighted"]))
def q_framings(spark, sf):
    fr = _framings(_s(spark, sf))
    return m.scorecard(fr, K3, PROBS, by=["framing"]).select("framing", "accuracy", "f1_weighted", "roc_auc_ovr_weighted")


def _run_summary_sql():
    card = sql_scorecard(FRAMINGS_SQL, K3, PROBS, ["framing"])
    parts = [f"SELECT '{c}' AS metric, framing, {c} AS value FROM ({card})" for c in CARD_COLS]
    parts.append(f"SELECT 'f1_class_' || CAST(class AS VARCHAR) AS metric, 'three_class' AS framing, f1 AS value FROM ({sql_per_class('s', K3)})")
    return rr(_u(parts), ["value"])


@query("run_summary", S + _run_summary_sql())
def q_run_summary(spark, sf):
    """One long (metric, framing, value) table of the run's numbers."""
    s = _s(spark, sf)
    card = m.scorecard(_framings(s), K3, PROBS, by=["framing"])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in CARD_COLS])).alias("x")
    long = card.select("framing", arr).select("x.metric", "framing", "x.value")
    pc = m.per_class_scores(s, K3).select(F.concat(F.lit("f1_class_"), F.col("class").cast("string")).alias("metric"),
                                          F.lit("three_class").alias("framing"), F.col("f1").alias("value"))
    return long.unionByName(pc)


STORED = ["accuracy", "f1_weighted", "f1_macro", "roc_auc_ovr_weighted"]


def _run_store_sql():
    """The same numbers, computed at once: framings, arms against the first member, train score and gap."""
    card = sql_scorecard(FRAMINGS_SQL, K3, PROBS, ["framing"])
    parts = [f"SELECT '{c}' AS metric, framing, {c} AS value FROM ({card})" for c in STORED]
    parts.append(f"SELECT 'f1_' || model AS metric, 'arms' AS framing, f1_weighted AS value FROM ({MODEL_F1})")
    parts.append(f"SELECT 'f1_' || a.model || '_delta', 'arms', a.f1_weighted - b.f1_weighted FROM ({MODEL_F1}) a "
                 f"JOIN (SELECT * FROM ({MODEL_F1}) WHERE model = 'member_0') b ON true")
    parted = sql_averaged(sql_per_class("(SELECT y, pred, CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS part FROM s)", K3, ["part"]), ["part"])
    for name, value in (("train_f1", "b.f1_weighted"), ("overfit_gap", "b.f1_weighted - a.f1_weighted")):
        parts.append(f"SELECT '{name}', 'three_class', {value} FROM ({parted}) a JOIN ({parted}) b ON a.part = 'test' AND b.part = 'train'")
    return rr(_u(parts), ["value"])


@query("run_store", SM + _run_store_sql())
def q_run_store(spark, sf):
    """E17 through the metric store: three jobs append their numbers (scorecards of the framings; arms against the first
    member; train score and gap), the summary of the run is read back."""
    store, run = f"{checkpoint_dir(spark)}/metric-store-{uuid.uuid4().hex}", "run"
    s = materialize(_s(spark, sf, members=True), "scored")
    ms.record(ms.long_form(m.scorecard(_framings(s), K3, PROBS, by=["framing"]), F.col("framing"), STORED), store, run)
    long = _members_long(spark, sf)
    f1 = m.averaged_scores(m.per_class_scores(long, K3, by=["model"]), ["model"]).select("model", "f1_weighted")
    ms.record(ms.arms_long(delta_table(f1, "model", "f1_weighted", "member_0"), "model", "f1_weighted", "delta", "f1", "arms"), store, run)
    part = F.when(F.col("fold") == 0, "test").otherwise("train")
    parts = m.averaged_scores(m.per_class_scores(s.withColumn("part", part), K3, by=["part"]), ["part"])
    both = parts.agg(F.max(F.when(F.col("part") == "train", F.col("f1_weighted"))).alias("train_f1"),
                     F.max(F.when(F.col("part") == "test", F.col("f1_weighted"))).alias("test_f1"))
    ms.record(ms.long_form(both.withColumn("overfit_gap", F.col("train_f1") - F.col("test_f1")), "three_class", ["train_f1", "overfit_gap"]), store, run)
    return ms.run_summary(spark, store, run)


# ---- I1, I3, I4 ------------------------------------------------------------------------------

@query("score_batch", S + rr("SELECT CASE pred WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS predicted_label, pred, "
                             "p_0 AS p_A, p_1 AS p_N, p_2 AS p_R, greatest(p_0, p_1, p_2) AS confidence FROM s",
                             ["p_A", "p_N", "p_R", "confidence"]))
def q_score_batch(spark, sf):
    s = _s(spark, sf)
    return sc.score_frame(s, F.array(*[F.col(p) for p in PROBS]), K_CLASSES)


def _interval_sql():
    xs = [f"member_{i}[pred + 1]" for i in range(N_MEMBERS)]
    mean = "((" + " + ".join(["0.0"] + xs) + f") / {float(N_MEMBERS)!r})"
    var = "((" + " + ".join(["0.0"] + [f"({x} - mean) * ({x} - mean)" for x in xs]) + f") / {float(N_MEMBERS)!r})"
    inner = f"SELECT pred, {mean} AS mean, {', '.join(f'member_{i}' for i in range(N_MEMBERS))} FROM s"
    return rr(f"SELECT pred, mean AS member_mean, sqrt({var}) AS member_std, least(1.0, greatest(0.0, mean - 1.96 * sqrt({var}))) AS confidence_low, "
              f"least(1.0, greatest(0.0, mean + 1.96 * sqrt({var}))) AS confidence_high FROM ({inner})",
              ["member_mean", "member_std", "confidence_low", "confidence_high"])


@query("ensemble_interval", SM + _interval_sql())
def q_ensemble_interval(spark, sf):
    s = _s(spark, sf, members=True)
    return sc.ensemble_interval(s, [f"member_{i}" for i in range(N_MEMBERS)], "pred")


@query("prediction_table", S + rr("SELECT CASE y WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS actual, "
                                  "CASE pred WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS predicted, p_0, p_1, p_2, "
                                  "greatest(p_0, p_1, p_2) AS confidence, y = pred AS correct FROM s", ["p_0", "p_1", "p_2", "confidence"]))
def q_prediction_table(spark, sf):
    return sc.prediction_table(_s(spark, sf), "y", "pred", PROBS, K_CLASSES)
