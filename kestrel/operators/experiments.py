"""M8-M10, M12-M17, X3, J3, J4 on any table: folds, arms and comparisons.

A ``FoldPlan`` fits one preprocessor a fold on that fold's training rows and stores the transformed table once, where
all folds' tables together stay within ``STORED_BYTES``; larger ones are transformed as they are read.  Every model, trial,
sampler and curve point of the fold reads these parts, so nothing learns from rows it is scored on and no preprocessor
is fitted twice.  The driver holds fitted models and score tables (arms x
folds rows); rows stay in Spark.  Arms run as concurrent Spark jobs from a few driver threads."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import metrics as mt
from . import ml
from .neighbors import adasyn, smote
from .prep import feature_names
from .split import SEED, class_weights, learning_sizes, learning_subsets, oversample, stratified_folds, undersample

THREADS = 3
STORED_BYTES = 1 << 30      # of the transformed tables of a plan, as doubles


def concurrently(fn: Callable, items, threads: int = THREADS) -> list:
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(fn, list(items)))


class FoldPlan:
    """Prepared folds of a table.

    ``label`` holds class codes 0..k-1.  Folds are stratified by an md5 order of ``key``, or named by ``fold_col``
    (0..folds-1).  ``preprocessor`` makes an unfitted pipeline (``prep.build_preprocessor``) whose passthrough holds
    ``label``, ``fold`` and ``key``; without it ``features`` names an array column or numeric columns.  A table whose
    folds are named is read where it lies: the caller writes what is dear to compute.

    A prepared table has a copy of all rows a fold, wider than the input.  Beyond ``STORED_BYTES`` no copy is written, and
    folds are fitted one after another, since a fit may hold its rows too."""

    def __init__(self, df: DataFrame, label: str, k: int, key: str | None = None, folds: int = 5, fold_col: str | None = None,
                 features: str | Sequence[str] | None = None, preprocessor: Callable | None = None, threads: int = THREADS):
        if fold_col is None:
            if key is None:
                raise ValueError("folds are made from a key, or named by a column")
            folded = stratified_folds(df, label, [key], folds).drop("rank")
        else:
            folded = df if fold_col == "fold" else df.withColumnRenamed(fold_col, "fold")
        self.k, self.key, self.folds, self.threads = k, key, folds, threads
        self.kept = [c for c in [key] if c]
        self.base = materialize(folded, "folds") if fold_col is None else folded
        if preprocessor is None:
            wide = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
            whole = materialize(self.base.select(*self.kept, F.col(label).alias("y"), "fold", wide.alias("x")), "fold-rows")
            self.names = {f: [features] if isinstance(features, str) else list(features) for f in range(folds)}
            self.tables = {f: whole for f in range(folds)}
        else:
            def prepare(f):
                fitted = preprocessor().fit(self.base.where(F.col("fold") != f))
                names = feature_names(fitted)
                rows = fitted.transform(self.base).select(*self.kept, F.col(label).alias("y"), "fold",
                                                          F.array(*[F.col(c).cast("double") for c in names]).alias("x"))
                return f, names, rows

            done = concurrently(prepare, range(folds), threads)
            self.names, self.tables = {f: n for f, n, _ in done}, {f: t for f, _, t in done}
            if 8 * self.base.count() * sum(map(len, self.names.values())) <= STORED_BYTES:
                self.tables = dict(concurrently(lambda f: (f, materialize(self.tables[f], "fold-rows")), range(folds), threads))
            else:
                self.threads = 1
        first = self.tables[0].select(F.size("x").alias("n")).first() if preprocessor is None else None
        self.width = {f: first["n"] if preprocessor is None and first else len(self.names[f]) for f in range(folds)}

    def part(self, fold: int, train: bool) -> DataFrame:
        """``key, y, fold, x, features`` of the training or the held-out rows of a fold."""
        rows = self.tables[fold].where(F.col("fold") != fold if train else F.col("fold") == fold)
        return rows.withColumn("features", array_to_vector("x"))


def family_arm(plan: FoldPlan, family: str, params: dict | None = None, sampler: Callable | None = None, weight: bool = False) -> Callable:
    """(fold, training rows) -> fitted model of the zoo; the sampler or the class weights touch training rows only."""
    def fit(fold: int, train: DataFrame):
        if family == "knn":
            return ml.KnnModel(train, plan.key, "x", "y", (params or {}).get("neighbors", 15), plan.k)
        if sampler is not None:
            # a fit reads its rows many times
            train = materialize(sampler(train).drop("features"), "sampled").withColumn("features", array_to_vector("x"))
        if weight:
            train = class_weights(train, "y")
        return ml.make_estimator(family, plan.k, plan.width[fold], params, "y", "weight" if weight else None).fit(train)

    return fit


class PriorModel:
    """The baseline to beat: every row gets the class shares of the training rows."""

    def __init__(self, train: DataFrame, k: int):
        seen = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(seen.values()) or 1
        self.shares = [seen.get(c, 0) / total for c in range(k)]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", array_to_vector(F.array(*[F.lit(float(s)) for s in self.shares])))


def prior_arm(plan: FoldPlan) -> Callable:
    return lambda fold, train: PriorModel(train, plan.k)


def evaluate(plan: FoldPlan, arms: dict[str, Callable], with_train: bool = False, folds: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(``model, fold, part`` and all scores, ``model, fold, fit_s, score_s``) of every arm on every fold."""
    probs = [f"p_{i}" for i in range(plan.k)]

    def run(job):
        name, fold = job
        train = plan.part(fold, True)
        began = time.time()
        model = arms[name](fold, train)
        fitted, out = time.time(), []
        for part, rows in [("test", plan.part(fold, False))] + ([("train", train)] if with_train else []):
            scored = ml.scored_frame(model, rows, plan.k, ["y"])
            out.append(materialize(scored.select(F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.lit(part).alias("part"), "y", *probs, "pred"),
                                   "scored"))
        return out, (name, fold, fitted - began, time.time() - fitted)

    done = concurrently(run, [(n, f) for n in arms for f in (range(plan.folds) if folds is None else folds)], plan.threads)
    scored = reduce(DataFrame.unionByName, [p for out, _ in done for p in out])
    card = materialize(mt.scorecard(scored, plan.k, probs, by=["model", "fold", "part"]), "scorecard")
    return card, plan.base.sparkSession.createDataFrame([t for _, t in done], "model string, fold int, fit_s double, score_s double")


def compare_models(plan: FoldPlan, families: Sequence[str], params: dict[str, dict] | None = None, prior: bool = True) -> DataFrame:
    """M8: mean and std over the folds of five scores, seconds and rank of each family (and of the class shares, ``prior``)."""
    arms = {n: family_arm(plan, n, (params or {}).get(n)) for n in families}
    return ml.summarize_cv(*evaluate(plan, arms | ({"prior": prior_arm(plan)} if prior else {})))


STRATEGIES = ["none", "class_weight", "smote", "adasyn", "random_over", "random_under"]


def sampler_for(strategy: str, key: str, neighbors: int = 5) -> Callable | None:
    """Training rows -> re-balanced training rows (``y, x``), on the prepared features."""
    def made(fn):
        def run(train):
            new = fn(train.select(key, "y", "x"), key, "x", "y", neighbors).select("y", F.col("x").cast("array<double>").alias("x"))
            return train.select("y", "x").unionByName(new)
        return run

    return {"smote": made(smote), "adasyn": made(adasyn), "random_over": lambda t: oversample(t, "y", [key]),
            "random_under": lambda t: undersample(t, "y", [key])}.get(strategy)


def compare_imbalance(plan: FoldPlan, family: str = "boosted", params: dict | None = None, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """M9: ``strategy`` in place of ``model``; each strategy re-balances training parts only."""
    arms = {s: family_arm(plan, family, params, sampler_for(s, plan.key), s == "class_weight") for s in strategies}
    return ml.summarize_cv(*evaluate(plan, arms)).withColumnRenamed("model", "strategy")


def draw_trials(space: dict, n: int, seed: int = SEED) -> list[dict]:
    rng = random.Random(seed)
    return [ml.draw_params(space, rng) for _ in range(n)]


def search(plan: FoldPlan, family: str, n_trials: int = 30, space: dict | None = None, seed: int = SEED, penalty: float = 0.5,
           halving: bool = True) -> DataFrame:
    """``trial, params`` (JSON) ``, folds, train_f1, val_f1, objective, finished, rank``: seeded random search scored by
    val - penalty * max(0, train - val), weighted F1.  With ``halving`` all trials meet the first fold, the better half
    (by the mean objective so far, ties to the earlier trial; at least two) the next, and so on; only finished
    trials have a rank.  The driver holds one row a trial and fold."""
    trials = draw_trials(space or ml.SEARCH_SPACES[family], n_trials, seed)
    live, scores = list(range(n_trials)), {t: [] for t in range(n_trials)}
    objective = lambda t: sum(v - penalty * max(0.0, tr - v) for tr, v in scores[t]) / len(scores[t])       # noqa: E731
    for fold in range(plan.folds):
        card, _ = evaluate(plan, {str(t): family_arm(plan, family, trials[t]) for t in live}, True, [fold])
        got = {(int(r["model"]), r["part"]): r["f1_weighted"] for r in card.select("model", "part", "f1_weighted").collect()}
        for t in live:
            scores[t].append((got[t, "train"], got[t, "test"]))
        if halving and fold + 1 < plan.folds:
            live = sorted(sorted(live, key=lambda t: (-objective(t), t))[:max(2, -(-len(live) // 2))])
    rows = [(t, json.dumps(trials[t], sort_keys=True), len(scores[t]), *(sum(s[i] for s in scores[t]) / len(scores[t]) for i in (0, 1)), objective(t),
             len(scores[t]) == plan.folds) for t in range(n_trials)]
    place = {r[0]: i + 1 for i, r in enumerate(sorted((r for r in rows if r[-1]), key=lambda r: (-r[5], r[0])))}
    return plan.base.sparkSession.createDataFrame(
        [(*r, place.get(r[0])) for r in rows],
        "trial int, params string, folds int, train_f1 double, val_f1 double, objective double, finished boolean, rank int")


def fitted_scores(df: DataFrame, label: str, k: int, held_out, family: str, preprocessor: Callable, params: dict | None = None,
                  part: str = "part") -> tuple[DataFrame, list[str]]:
    """(``y, part, p_*, pred`` of all rows, feature names): preprocessor and model fitted on the rows outside ``held_out``.
    ``preprocessor`` makes an unfitted pipeline that passes ``label`` and ``part`` through."""
    marked = materialize(df.withColumn(part, F.when(held_out, F.lit("test")).otherwise(F.lit("train"))), "parts")
    fitted = preprocessor().fit(marked.where(F.col(part) == "train"))
    names = feature_names(fitted)
    ready = ml.with_vector(fitted.transform(marked), names)
    model = ml.make_estimator(family, k, len(names), params, label).fit(ready.where(F.col(part) == "train"))
    return ml.scored_frame(model, ready, k, [label, part]).withColumnRenamed(label, "y"), names


def binary_framing(df: DataFrame, label: str, held_out, preprocessor: Callable, family: str = "boosted", params: dict | None = None) -> DataFrame:
    """E11 by part for a 0/1 ``label`` (the caller says which rows and which classes: P7, P11)."""
    scored, _ = fitted_scores(df, label, 2, held_out, family, preprocessor, params)
    scored = materialize(scored, "scored")
    card = mt.binary_scorecard(scored, "y", "pred", "p_1", "part")
    return card.join(scored.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "part")


def delta_table(scores: DataFrame, arm: str, metric: str, base: str) -> DataFrame:
    """``scores`` with ``delta`` = its ``metric`` less that of the row(s) whose ``arm`` is ``base`` (one row; null if absent)."""
    one = scores.where(F.col(arm) == base).agg(F.max(metric).alias("__base"))
    one = one.withColumn("__one", F.lit(1))
    return (scores.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one").withColumn("delta", F.col(metric) - F.col("__base"))
            .drop("__one", "__base"))


def framings_table(scored: dict[str, tuple[DataFrame, int]], y: str = "y", pred: str = "pred") -> DataFrame:
    """``framing`` and the scorecard of each scored table (table, classes; probabilities ``p_0`` ...)."""
    cards = [mt.scorecard(t, k, [f"p_{i}" for i in range(k)], y, pred).withColumn("framing", F.lit(name)) for name, (t, k) in scored.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cards)


def leakage_benchmark(df: DataFrame, label: str, k: int, held_out, preprocessor: Callable, leaks: Sequence[str], family: str = "logistic",
                      params: dict | None = None) -> DataFrame:
    """``arm, f1_weighted, n, n_features, leaks_kept, premium``: the same model with the firewall, and with ``leaks`` let
    through.  ``preprocessor(keep)`` makes the unfitted pipeline."""
    def arm(a):
        name, keep = a
        scored, names = fitted_scores(df, label, k, held_out, family, lambda: preprocessor(keep), params)
        test = materialize(scored.where("part = 'test'"), "scored")
        f1 = mt.averaged_scores(mt.per_class_scores(test, k)).first()["f1_weighted"]
        return name, f1, test.count(), len(names), sorted(set(leaks) & set(names)) == sorted(leaks)

    rows = concurrently(arm, [("leakage_free", []), ("with_leakage", list(leaks))])
    table = df.sparkSession.createDataFrame(rows, "arm string, f1_weighted double, n long, n_features int, leaks_kept boolean")
    return delta_table(table, "arm", "f1_weighted", "leakage_free").withColumnRenamed("delta", "premium")


def feature_ablation(plans: dict[str, FoldPlan], base: str, family: str = "boosted", params: dict | None = None) -> DataFrame:
    """``arm, f1_weighted_mean, f1_weighted_std, n_folds, delta``: the same folds prepared in several ways (with and without derived
    features); delta against ``base``."""
    cards = [evaluate(p, {arm: family_arm(p, family, params)})[0] for arm, p in plans.items()]
    card = reduce(DataFrame.unionByName, cards).where("part = 'test'").withColumnRenamed("model", "arm")
    return delta_table(mt.fold_summary(card, ["arm"], "f1_weighted"), "arm", "f1_weighted_mean", base)


def _train_and_val(card: DataFrame, by: str) -> DataFrame:
    pick = lambda part: F.when(F.col("part") == part, F.col("f1_weighted"))       # noqa: E731
    return card.groupBy(by).agg(F.avg(pick("train")).alias("train_mean"), F.stddev_pop(pick("train")).alias("train_std"),
                                F.avg(pick("test")).alias("val_mean"), F.stddev_pop(pick("test")).alias("val_std"),
                                F.countDistinct("fold").alias("n_folds"))


def learning_curve(plan: FoldPlan, arm: Callable, fractions: Sequence[float]) -> DataFrame:
    """``train_fraction, n_train`` and train and validation F1 over nested training subsets of every fold."""
    def fold(f):
        train, test, out = plan.part(f, True), plan.part(f, False), []
        nested = materialize(learning_subsets(train.drop("features"), [plan.key], list(fractions)), "subsets")
        last = len(learning_sizes(nested.count(), list(fractions))) - 1
        for i, fraction in enumerate(fractions):
            # fractions of a small fold that give the same size share a subset
            some = nested.where(F.col("first_subset") <= min(i, last)).withColumn("features", array_to_vector("x"))
            model = arm(f, some)
            for part, rows in (("train", some), ("test", test)):
                scored = ml.scored_frame(model, rows, plan.k, ["y"])
                out.append(materialize(scored.select(F.lit(fraction).alias("train_fraction"), F.lit(f).alias("fold"), F.lit(part).alias("part"), "y", "pred"),
                                       "curve"))
        return out

    scored = reduce(DataFrame.unionByName, [p for out in concurrently(fold, range(plan.folds), plan.threads) for p in out])
    by = ["train_fraction", "fold", "part"]
    card = mt.averaged_scores(mt.per_class_scores(scored, plan.k, by=by), by)
    sizes = scored.where("part = 'train'").groupBy("train_fraction").agg(F.count(F.lit(1)).alias("n_train"))
    return _train_and_val(card, "train_fraction").join(sizes, "train_fraction")


def validation_curve(plan: FoldPlan, family: str, parameter: str, grid: Sequence, params: dict | None = None) -> DataFrame:
    """Train and validation F1 for every value of one parameter."""
    card, _ = evaluate(plan, {str(v): family_arm(plan, family, {**(params or {}), parameter: v}) for v in grid}, True)
    kind = "int" if all(isinstance(v, int) for v in grid) else "double" if all(isinstance(v, (int, float)) for v in grid) else "string"
    return _train_and_val(card.withColumn(parameter, F.col("model").cast(kind)), parameter)


def native_importance(model, names: Sequence[str], spark, top: int = 20) -> DataFrame:
    """``rank, feature, importance`` (shares of the total) of a fitted Spark tree model or of the softmax booster (gain of
    all splits); model state, one value a feature."""
    own = model.gains(len(names)) if hasattr(model, "gains") else model.featureImportances.toArray()
    total = float(sum(own)) or 1.0
    rows = sorted(((n, float(v) / total) for n, v in zip(names, own)), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(i + 1, n, v) for i, (n, v) in enumerate(rows[:top])], "rank int, feature string, importance double")
