"""Model zoo, cross-validation, comparisons and curves on Spark ML.

Fits run as Spark ML jobs; the driver loops over (model x fold) only - a
handful of iterations, each a distributed fit - and every metric comes from
one grouped aggregation over the union of the scored folds.  Folds are the
md5 stratified folds (``split.stratified_folds``), cached once and shared by
every model.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics as mt
from .boosting import SoftmaxBoosting
from .forest import DeepForest
from .split import SEED, order_hash, stratified_folds

FEATURES = "features"
SHALLOW = 12            # levels up to which Spark's forest is used; deeper ones have too many nodes for its passes


def with_vector(df: DataFrame, features: str | Sequence[str], out: str = FEATURES) -> DataFrame:
    """Model boundary: an array column or a list of numeric columns -> vector."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features)))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


# The zoo's settings, as the reference fits them.  Spark's trees end at depth 30 (the
# reference's forest has no limit) and its SVM has no RBF kernel.  The boosters differ in settings alone.
ZOO_DEFAULTS: dict[str, dict] = {
    "logistic": {"maxIter": 2000, "regParam": 0.0},
    "tree": {"maxDepth": 12, "minInstancesPerNode": 5},
    "forest": {"numTrees": 400, "minInstancesPerNode": 2, "maxDepth": 30},
    "boosted": {"maxIter": 600, "stepSize": 0.06, "maxLeaves": 31, "maxDepth": 12, "minInstancesPerNode": 40, "l2": 1.0, "validationShare": 0.15,
                "patience": 20},
    "boosted_plain": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3, "maxLeaves": 8, "minInstancesPerNode": 1, "l2": 0.0, "validationShare": 0.0},
    "boosted_deep": {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "maxLeaves": 64, "minInstancesPerNode": 1, "l2": 1.0, "subsamplingRate": 0.9,
                     "featureShare": 0.9, "validationShare": 0.0},
    "boosted_wide": {"maxIter": 600, "stepSize": 0.05, "maxDepth": 16, "maxLeaves": 63, "minInstancesPerNode": 20, "l2": 0.0, "subsamplingRate": 0.9,
                     "featureShare": 0.9, "validationShare": 0.0},
    "boosted_even": {"maxIter": 600, "stepSize": 0.05, "maxDepth": 6, "maxLeaves": 64, "minInstancesPerNode": 1, "l2": 3.0, "validationShare": 0.0},
    "mlp": {"hidden": [128, 64], "maxIter": 400, "alpha": 1e-3, "validationShare": 0.1},
    "svm": {"maxIter": 100, "regParam": 0.01},
}
# Smaller settings for checks and benches; always passed by name, never a default.
QUICK: dict[str, dict] = {
    "logistic": {"maxIter": 30}, "forest": {"numTrees": 20, "maxDepth": 8}, "svm": {"maxIter": 20}, "mlp": {"maxIter": 40},
    "boosted": {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3, "minInstancesPerNode": 2},
}
VALIDATION = "__validation"
VALIDATION_SHARE = 0.15


def with_validation(df: DataFrame, keys: Sequence[str], share: float = VALIDATION_SHARE, seed: int = SEED) -> DataFrame:
    """Marks about ``share`` of the rows (by an md5 order of the keys) as boosting's early-stop rows."""
    u = F.conv(F.substring(order_hash(keys, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn(VALIDATION, u < share)


def make_estimator(name: str, k: int, n_features: int, params: dict | None = None, label: str = "label",
                   weight: str | None = None, validation: str | None = None):
    """One classifier of the zoo on (features, label[, weight]).

    ``validation`` names a boolean column of early-stop rows for boosting; without it the booster sets
    ``validationShare`` of the rows aside itself."""
    p = {**ZOO_DEFAULTS.get(name, {}), **(params or {})}
    common = {"featuresCol": FEATURES, "labelCol": label}
    if name == "mlp":
        if weight:
            raise ValueError("Spark's multilayer perceptron takes no row weights")
        return EarlyStoppedMlp([n_features, *p["hidden"], k], label, p)
    if name == "logistic":
        est = LogisticRegression(family="multinomial" if k > 2 else "binomial", maxIter=p["maxIter"], regParam=p["regParam"], **common)
    elif name == "tree":
        est = DecisionTreeClassifier(maxDepth=p["maxDepth"], minInstancesPerNode=p["minInstancesPerNode"], seed=SEED, **common)
    elif name == "forest" and p["maxDepth"] > SHALLOW:
        est = DeepForest(numTrees=p["numTrees"], minInstancesPerNode=p["minInstancesPerNode"], maxDepth=p["maxDepth"],
                         featureSubsetStrategy=p.get("featureSubsetStrategy", "auto"), numClasses=k, seed=SEED, **common)
    elif name == "forest":
        est = RandomForestClassifier(numTrees=p["numTrees"], minInstancesPerNode=p["minInstancesPerNode"],
                                     maxDepth=p["maxDepth"], featureSubsetStrategy=p.get("featureSubsetStrategy", "auto"), seed=SEED, **common)
    elif name.split("_")[0] == "boosted":
        est = SoftmaxBoosting(numClasses=k, seed=SEED, **p, **common)
        if validation:
            est.setValidationIndicatorCol(validation)
    elif name == "svm":   # linear kernel only (documented difference)
        est = LinearSVC(maxIter=p["maxIter"], regParam=p["regParam"], **common)
    else:
        raise ValueError(name)
    if weight:
        est.setWeightCol(weight)
    if name == "svm" and k > 2:
        est = OneVsRest(classifier=est, **common, **({"weightCol": weight} if weight else {}))
    return est


class EarlyStoppedMlp:
    """The perceptron of the zoo: ``mlp.fit_mlp`` behind an estimator's ``fit`` (the fitted model is Spark's own)."""

    def __init__(self, layers: list[int], label: str, params: dict):
        self.layers, self.label, self.params = layers, label, params

    def fit(self, df: DataFrame):
        from .mlp import fit_mlp
        p = self.params
        return fit_mlp(df, self.layers, self.label, FEATURES, p["alpha"], p["maxIter"], validation_share=p["validationShare"])[0]


def fit_final(train: DataFrame, k: int, model: str, label: str = "label", preprocessor=None, features: Sequence[str] | str | None = None,
              sampler: Callable | None = None, weight: bool = False, params: dict | None = None, keep: Sequence[str] = ()):
    """Preprocessor -> sampler or class weight (training rows only) -> classifier, as one
    ``PipelineModel`` without the sampler: what is saved scores rows that were never resampled.

    ``preprocessor``: an unfitted pipeline (A9 or A10) whose passthrough holds ``label`` and ``keep``;
    ``features`` names the columns to assemble, or one array column, where there is none."""
    from pyspark.ml import PipelineModel

    from .prep import feature_names
    from .split import class_weights
    stages = []
    if preprocessor is not None:
        fitted = preprocessor.fit(train)
        stages += fitted.stages
        train, features = fitted.transform(train), feature_names(fitted)
    if isinstance(features, str):
        size = len(train.select(features).first()[0])
        stages.append(ArrayToVector(inputCol=features))
    else:
        size = len(features)
        stages.append(VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep"))
    if sampler is not None:
        train = sampler(train)
    if weight:
        train = class_weights(train, label)
    clf = make_estimator(model, k, size, params, label, "weight" if weight else None)
    return PipelineModel([*stages, clf.fit(stages[-1].transform(train))])


def probability(scored: DataFrame, k: int) -> Column:
    """Class probabilities as an array.  OneVsRest and LinearSVC expose only
    margins: p_c = sigmoid(2 * margin_c), normalised over classes."""
    if "probability" in scored.columns:
        return vector_to_array(F.col("probability"))
    raw = vector_to_array(F.col("rawPrediction"))
    if k == 2:
        s = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * raw[1]))
        return F.array(F.lit(1.0) - s, s)
    sig = F.transform(raw, lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * x)))
    tot = F.aggregate(sig, F.lit(0.0), lambda a, x: a + x)
    return F.transform(sig, lambda x: x / tot)


def scored_frame(model, df: DataFrame, k: int, keep: Sequence[str]) -> DataFrame:
    """(keep..., p_0..p_{k-1}, pred) with pred = first argmax."""
    s = model.transform(df)
    p = s.select(*keep, probability(s, k).alias("__p"))
    return p.select(*keep, *[F.col("__p")[i].alias(f"p_{i}") for i in range(k)],
                    (F.array_position("__p", F.array_max("__p")) - 1).cast("int").alias("pred"))


def n_features(df: DataFrame) -> int:
    return len(df.select(FEATURES).first()[0])


def cross_validate(df: DataFrame, key: str, label: str, k: int, models: dict[str, Callable],
                   folds: int = 5, train_transform: Callable | None = None, with_train: bool = False,
                   train_transforms: dict[str, Callable] | None = None, parallelism: int = 3,
                   fold_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit every model on fold != f and score fold f (and, with
    ``with_train``, the training part).  ``models`` maps name -> function
    (train_df) -> fitted model (``fit_final`` fits the preprocessor and the
    sampler inside the fold); ``train_transform`` (or a per-model entry of
    ``train_transforms``, e.g. a sampler) touches only training rows.
    (model, fold) fits run as concurrent Spark jobs from ``parallelism``
    driver threads, like ``CrossValidator(parallelism=...)``.
    ``fold_col`` names folds made beforehand; else they are stratified.
    Returns (per-fold scorecard, timings)."""
    from concurrent.futures import ThreadPoolExecutor

    from ..session import materialize
    folded = materialize(df if fold_col else stratified_folds(df, label, [key], folds), "folds")
    if fold_col and fold_col != "fold":
        folded = folded.withColumnRenamed(fold_col, "fold")

    def run(name, f):
        fit = models[name]
        train = folded.filter(F.col("fold") != f)
        test = folded.filter(F.col("fold") == f)
        tt = (train_transforms or {}).get(name, train_transform)
        if tt is not None:
            train = tt(train)
        t0 = time.time()
        model = fit(train)
        t1 = time.time()
        out = []
        for part, d in [("test", test)] + ([("train", train)] if with_train else []):
            sc = scored_frame(model, d, k, [label]).select(
                F.lit(name).alias("model"), F.lit(f).alias("fold"), F.lit(part).alias("part"),
                F.col(label).alias("y"), *[f"p_{i}" for i in range(k)], "pred")
            out.append(materialize(sc, "scored"))
        return out, (name, f, t1 - t0, time.time() - t1)

    jobs = [(n, f) for n in models for f in range(folds)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(lambda a: run(*a), jobs))
    parts = [p for out, _ in results for p in out]
    times = [t for _, t in results]
    allp = reduce(DataFrame.unionByName, parts)
    probs = [f"p_{i}" for i in range(k)]
    card = materialize(mt.scorecard(allp, k, probs, by=["model", "fold", "part"]), "scorecard")
    tdf = df.sparkSession.createDataFrame(times, "model string, fold int, fit_s double, score_s double")
    return card, tdf


SCORES = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc_ovr_weighted"]


def summarize_cv(card: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """M8/M9 table: mean and population std over the folds of all five scores, mean fit / score
    seconds, ranked by weighted F1."""
    from pyspark.sql import Window
    test = card.filter(F.col("part") == "test")
    out = test.groupBy("model").agg(F.count(F.lit(1)).alias("n_folds"), *[x for m in SCORES for x in (
        F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))])
    if times is not None:
        out = out.join(times.groupBy("model").agg(F.avg("fit_s").alias("fit_s"), F.avg("score_s").alias("score_s")), "model")
    # one row a model
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.col("f1_weighted_mean").desc(), "model")))


def zoo_fitters(names: Sequence[str], k: int, nfeat: int, label: str = "label", weight: str | None = None,
                params: dict | None = None) -> dict[str, Callable]:
    out = {}
    for n in names:
        out[n] = (lambda n: lambda train: make_estimator(n, k, nfeat, (params or {}).get(n), label, weight).fit(train))(n)
    return out


def draw_params(space: dict, rng) -> dict:
    """One point of a search space.  Kinds of ranges: ``("int", lo, hi[, step])``, ``("float", lo, hi)``,
    ``("log", lo, hi)`` (log-uniform) and ``("choice", [...])``."""
    out = {}
    for name, (kind, *args) in space.items():
        if kind == "int":
            lo, hi, step = (*args, 1)[:3]
            out[name] = lo + step * rng.randint(0, (hi - lo) // step)
        elif kind == "float":
            out[name] = rng.uniform(*args)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        elif kind == "choice":
            out[name] = rng.choice(args[0])
        else:
            raise ValueError(kind)
    return out


# Search ranges by family.
SEARCH_SPACES: dict[str, dict] = {
    "forest": {"numTrees": ("int", 200, 800, 100), "maxDepth": ("int", 6, 30), "minInstancesPerNode": ("int", 1, 8),
               "featureSubsetStrategy": ("choice", ["sqrt", "log2", "0.5"])},
    "boosted": {"stepSize": ("log", 0.01, 0.15), "maxIter": ("int", 300, 900, 100), "maxLeaves": ("int", 8, 31), "minInstancesPerNode": ("int", 20, 200),
                "l2": ("log", 0.01, 30.0), "featureShare": ("float", 0.5, 1.0)},
    "boosted_deep": {"maxIter": ("int", 300, 900, 100), "stepSize": ("log", 0.01, 0.2), "maxDepth": ("int", 3, 10), "subsamplingRate": ("float", 0.6, 1.0),
                     "featureShare": ("float", 0.6, 1.0), "l2": ("log", 1e-3, 10.0), "minInstancesPerNode": ("int", 1, 10)},
    "boosted_wide": {"maxIter": ("int", 300, 1000, 100), "stepSize": ("log", 0.01, 0.2), "maxLeaves": ("int", 15, 150), "subsamplingRate": ("float", 0.6, 1.0),
                     "featureShare": ("float", 0.6, 1.0), "l2": ("log", 1e-3, 10.0), "minInstancesPerNode": ("int", 5, 60)},
    "boosted_even": {"maxIter": ("int", 300, 900, 100), "stepSize": ("log", 0.01, 0.2), "maxDepth": ("int", 4, 10), "l2": ("float", 1.0, 10.0)},
    "logistic": {"regParam": ("log", 1e-6, 1.0)},
}


def gap_objective(val: Column, train: Column, penalty: float = 0.5) -> Column:
    """Val - penalty * max(0, train - val)."""
    return val - F.lit(penalty) * F.greatest(F.lit(0.0), train - val)


def fit_pipeline(stages: list, df: DataFrame):
    return Pipeline(stages=stages).fit(df)


# ---- savable stages for whole-pipeline persistence (S4, I5) ---------------------------

from pyspark import keyword_only  # noqa: E402
from pyspark.ml import Transformer  # noqa: E402
from pyspark.ml.param.shared import HasInputCol, HasOutputCol  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class ArrayToVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Array column -> ML vector, as a pipeline stage (so it is saved with the model)."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=FEATURES):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if not self.isSet(self.outputCol):
            self._set(outputCol=FEATURES)

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(), array_to_vector(F.col(self.getInputCol())))


class KnnModel:
    """M6 inside the CV loop: scores rows by a vote of the k nearest
    training rows (exact blocked join); exposes a probability vector."""

    def __init__(self, train: DataFrame, key: str, vec: str, label: str, k: int, n_classes: int):
        self.train, self.key, self.vec, self.label, self.k, self.n = train, key, vec, label, k, n_classes

    def transform(self, df: DataFrame) -> DataFrame:
        from .neighbors import knn_join
        nn = knn_join(df, self.train, self.key, self.vec, self.k, exclude_self=False)
        lab = self.train.select(F.col(self.key).alias("rkey"), F.col(self.label).alias("__nl"))
        votes = nn.join(lab, "rkey").groupBy("qkey").agg(
            *[F.count_if(F.col("__nl") == c).alias(f"__v{c}") for c in range(self.n)], F.count(F.lit(1)).alias("__t"))
        prob = array_to_vector(F.array(*[F.col(f"__v{c}") / F.col("__t") for c in range(self.n)]))
        return df.join(votes.select(F.col("qkey").alias(self.key), prob.alias("probability")), self.key)
