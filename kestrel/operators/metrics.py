"""Evaluation metrics as aggregations over a scored table.

Contract: a label code column ``y`` (0..k-1), a predicted code ``pred`` and one
score column per class.  Optional ``by`` columns (model, fold, framing ...)
evaluate many scorings in the same job.

Two primitives carry everything:

* ``confusion`` - one aggregate of k^2 conditional counts per group (no join
  against a class list, absent classes still get their cells);
* ``score_table`` - per (group, class, distinct score) positive/negative
  counts with running totals in descending score order (``running.py``: rows
  dealt by range, so no class is sorted on one task and no distribution of
  scores is hot).  Ties share one row, which makes AUC, AP and the curves
  exact under ties.  NaN scores are missing; a NULL label is a negative of
  every class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import finite
from .bounded import bounded, join_on
from .running import running_totals


def _safe(num, den):
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


# ---- confusion-based metrics ------------------------------------------------------

def confusion(df: DataFrame, k: int, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by..., actual, predicted, n, row_share) for all k^2 cells."""
    by = list(by)
    aggs = [F.count_if((F.col(y) == i) & (F.col(pred) == j)).alias(f"c_{i}_{j}") for i in range(k) for j in range(k)]
    g = (df.groupBy(*by) if by else df).agg(*aggs)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("actual"), F.lit(j).alias("predicted"), F.col(f"c_{i}_{j}").alias("n"))
                                for i in range(k) for j in range(k)])).alias("s")
    long = g.select(*by, cells).select(*by, "s.*")
    w = Window.partitionBy(*by, "actual")
    return long.withColumn("row_share", _safe(F.col("n"), F.sum("n").over(w)))


def per_class_scores(df: DataFrame, k: int, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """(by..., class, precision, recall, f1, support); 0 on zero division."""
    by = list(by)
    aggs = []
    for i in range(k):
        aggs += [F.count_if((F.col(y) == i) & (F.col(pred) == i)).alias(f"tp{i}"),
                 F.count_if(F.col(y) == i).alias(f"sup{i}"), F.count_if(F.col(pred) == i).alias(f"prd{i}")]
    g = (df.groupBy(*by) if by else df).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("class"), F.col(f"tp{i}").alias("tp"), F.col(f"sup{i}").alias("support"),
                                        F.col(f"prd{i}").alias("predicted")) for i in range(k)])).alias("s")
    t = g.select(*by, rows).select(*by, "s.*")
    fp = F.col("predicted") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    return t.select(*by, "class", _safe(F.col("tp"), F.col("predicted")).alias("precision"),
                    _safe(F.col("tp"), F.col("support")).alias("recall"),
                    _safe(2 * F.col("tp"), 2 * F.col("tp") + fp + fn).alias("f1"), "support", "predicted")


def averaged_scores(per_class: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted and macro averages; macro runs over classes seen
    in either the labels or the predictions."""
    by = list(by)
    seen = (F.col("support") + F.col("predicted")) > 0
    tot = F.sum("support")
    g = (per_class.groupBy(*by) if by else per_class)
    return g.agg(
        _safe(F.sum(F.col("precision") * F.col("support")), tot).alias("precision_weighted"),
        _safe(F.sum(F.col("recall") * F.col("support")), tot).alias("recall_weighted"),
        _safe(F.sum(F.col("f1") * F.col("support")), tot).alias("f1_weighted"),
        F.avg(F.when(seen, F.col("f1"))).alias("f1_macro"),
    )


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """E1."""
    g = df.groupBy(*by) if by else df
    return g.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


# ---- score-ordered metrics ---------------------------------------------------------

def score_table(df: DataFrame, scores: Sequence[str], y: str = "y", by: Sequence[str] = (),
                classes: Sequence[int] | None = None) -> DataFrame:
    """(by..., class, score, pos, neg, tp, fp, P, N): for each class (one-vs-
    rest on ``scores[class]``) and distinct score, tp/fp = positives /
    negatives with score >= this score."""
    by = list(by)
    classes = list(range(len(scores))) if classes is None else list(classes)
    long = df.select(*by, F.col(y).alias("__y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), finite(F.col(scores[i]).cast("double")).alias("score")) for i, c in enumerate(classes)
    ])).alias("s")).select(*by, "__y", "s.*").filter(F.col("score").isNotNull())
    part = by + ["class"]
    st = long.groupBy(*part, "score").agg(F.count_if(F.col("__y") == F.col("class")).alias("pos"),
                                          F.count_if(~F.col("__y").eqNullSafe(F.col("class"))).alias("neg"))
    return running_totals(st, part, "score", {"tp": "pos", "fp": "neg"}, descending=True, totals={"P": "pos", "N": "neg"})


def roc_auc(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """E5: per class, P(s+ > s-) + 0.5 P(s+ = s-) = exact tie-aware AUC;
    NULL when the class has no positives or no negatives."""
    part = list(by) + ["class"]
    neg_below = F.col("N") - F.col("fp")
    auc = F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))) / (F.first("P") * F.first("N"))
    return st.groupBy(*part).agg(F.when((F.first("P") > 0) & (F.first("N") > 0), auc).alias("roc_auc"),
                                 F.first("P").alias("n_pos"))


def roc_auc_weighted(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Prevalence-weighted OvR AUC; NULL if any class is absent."""
    a = roc_auc(st, by)
    g = a.groupBy(*by) if by else a
    return g.agg(F.when(F.count_if(F.col("roc_auc").isNull()) == 0,
                        F.sum(F.col("roc_auc") * F.col("n_pos")) / F.sum("n_pos")).alias("roc_auc_ovr_weighted"))


def roc_points(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(class, threshold, fpr, tpr) at every distinct score."""
    return st.select(*by, "class", F.col("score").alias("threshold"),
                     _safe(F.col("fp"), F.col("N")).alias("fpr"), _safe(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(class, threshold, precision, recall) at every distinct score."""
    return st.select(*by, "class", F.col("score").alias("threshold"),
                     (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), _safe(F.col("tp"), F.col("P")).alias("recall"))


def average_precision(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """sum_n (R_n - R_{n-1}) P_n = sum over scores pos/P * precision."""
    part = list(by) + ["class"]
    return st.groupBy(*part).agg(
        F.when(F.first("P") > 0, F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.first("P"))
        .alias("average_precision"))


# Uniform calibration edges as the library computes them (linspace(0, 1, 11)).
CALIBRATION_EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]


def calibration_bins(df: DataFrame, scores: Sequence[str], y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Per class, 10 right-closed uniform bins; mean score, positive
    share, count; empty bins are absent."""
    by = list(by)
    long = df.select(*by, F.col(y).alias("__y"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("class"), F.col(s).cast("double").alias("p")) for i, s in enumerate(scores)])).alias("s")) \
        .select(*by, "__y", "s.*")
    b = F.when(F.col("p") <= CALIBRATION_EDGES[0], F.lit(0))
    for i, e in enumerate(CALIBRATION_EDGES[1:], start=1):
        b = b.when(F.col("p") <= e, F.lit(i))
    b = b.otherwise(F.lit(len(CALIBRATION_EDGES)))
    return long.groupBy(*by, "class", b.alias("bin")).agg(
        F.avg("p").alias("mean_predicted"), F.avg((F.col("__y") == F.col("class")).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


def scorecard(df: DataFrame, k: int, scores: Sequence[str], y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy + weighted/macro scores + weighted OvR AUC, one row per group."""
    by = list(by)
    acc = accuracy(df, y, pred, by)
    avg = averaged_scores(per_class_scores(df, k, y, pred, by), by)
    auc = roc_auc_weighted(score_table(df, scores, y, by), by)
    if by:
        return join_on(join_on(acc, avg, by), auc, by)
    one = F.lit(1)
    return (acc.withColumn("__k", one).join(avg.withColumn("__k", one), "__k").join(auc.withColumn("__k", one), "__k").drop("__k"))


def binary_scorecard(df: DataFrame, y: str, pred: str, score: str, part: str) -> DataFrame:
    """Binary metrics (positive = 1) on each part (train/test), plus the
    train F1 and the overfit gap train F1 - test F1 on the test row."""
    pc = per_class_scores(df, 2, y, pred, [part]).filter(F.col("class") == 1).select(part, "precision", "recall", "f1")
    acc = accuracy(df, y, pred, [part])
    st = score_table(df, [score], y, [part], classes=[1])
    auc = roc_auc(st, [part]).select(part, "roc_auc")
    ap = average_precision(st, [part]).select(part, "average_precision")
    card = join_on(join_on(join_on(acc, pc, [part]), auc, [part], "left"), ap, [part], "left")
    w = Window.partitionBy()
    train_f1 = F.max(F.when(F.col(part) == "train", F.col("f1"))).over(w)
    return card.withColumn("train_f1", train_f1).withColumn("overfit_gap", F.col("train_f1") - F.col("f1"))


def fold_summary(scores: DataFrame, by: Sequence[str], metric: str) -> DataFrame:
    """Mean and population std of a per-fold score."""
    return scores.groupBy(*by).agg(F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std"),
                                   F.count(F.lit(1)).alias("n_folds"))


def leaderboard(scores: DataFrame, model: str, metric: str, top: int = 3) -> DataFrame:
    """Rank by metric (desc, model name as tie-break), top-n and the
    sample std of the top-n scores.  Runs on a per-model table."""
    w = Window.orderBy(F.col(metric).desc(), F.col(model))
    ranked = scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.withColumn("top_std", F.stddev_samp(metric).over(Window.partitionBy()))


def error_breakdown(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Wrong predictions by (actual, predicted), most frequent first."""
    return df.filter(F.col(y) != F.col(pred)).groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "actual", "predicted")


def confidence_histogram(df: DataFrame, confidence: str, correct: str, bins: int = 20) -> DataFrame:
    """Histogram of confidence for correct and wrong rows, each over its
    own [min, max] in ``bins`` equal bins (last bin closed)."""
    df = df.withColumn(confidence, finite(F.col(confidence).cast("double"))).filter(F.col(confidence).isNotNull())
    rng = bounded(df.groupBy(correct).agg(F.min(confidence).alias("lo"), F.max(confidence).alias("hi")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(confidence) - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    cnt = join_on(df, rng, [correct]).groupBy(correct, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return join_on(cnt, rng, [correct]).select(
        correct, "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("edge_lo"), "n")
