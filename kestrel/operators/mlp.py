"""M5 with early stop and a weight penalty: Spark's multilayer perceptron in warm-started epochs.

Spark's perceptron has neither.  Here an epoch is a fit of a few steps that starts at the last weights; between
epochs the weights shrink by ``1 - alpha x steps`` (a decoupled L2 penalty) and the log loss of the early-stop
rows is measured by one aggregate.  Training ends when the loss has not improved by ``tol`` for ``patience``
epochs; the weights of the best epoch stay.  The driver holds the weights (model state) and one number an epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .split import SEED


def log_loss(model, rows: DataFrame, label: str) -> float:
    p = vector_to_array(F.col("probability"))[F.col(label).cast("int")]
    return model.transform(rows).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss")).first()["loss"]


def fit_mlp(df: DataFrame, layers: Sequence[int], label: str = "label", features: str = "features", alpha: float = 1e-3, max_iter: int = 400,
            steps: int = 10, patience: int = 10, tol: float = 1e-4, validation_share: float = 0.1, validation: str | None = None,
            seed: int = SEED) -> tuple[MultilayerPerceptronClassificationModel, list[float]]:
    """(model with the best epoch's weights, validation loss after each epoch).

    ``validation`` names a boolean column of early-stop rows; else about ``validation_share`` of the rows, drawn by a hash of their
    features (copies fall on one side).  Without such rows all ``max_iter`` steps run.  Rows without a label take no part."""
    if validation is None:
        # a vector is hashed by its values
        drawn = F.pmod(F.xxhash64(vector_to_array(F.col(features)), F.lit(seed)), F.lit(1_000_000)) < int(validation_share * 1_000_000)
    else:
        drawn = F.coalesce(F.col(validation), F.lit(False))
    rows = df.where(F.col(label).isNotNull()).select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"), drawn.alias("aside"))
    rows = materialize(rows, "mlp-rows")
    train, aside = rows.where(~F.col("aside")), rows.where("aside")
    watch, weights, best, losses, model = not aside.isEmpty(), None, None, [], None
    for epoch in range(-(-max_iter // steps)):
        size = min(steps, max_iter - epoch * steps)
        learner = MultilayerPerceptronClassifier(layers=list(layers), maxIter=size, seed=seed, labelCol="label", featuresCol="features", solver="l-bfgs")
        if weights is not None:
            learner.setInitialWeights(Vectors.dense(weights))
        model = learner.fit(train)
        weights = model.weights.toArray() * max(0.0, 1 - alpha * size)
        if not watch:
            continue
        losses.append(log_loss(model, aside, "label"))
        if best is None or losses[-1] < best[0] - tol:
            best = losses[-1], len(losses), model
        elif len(losses) - best[1] >= patience:
            break
    chosen = best[2] if best else model
    return chosen.setFeaturesCol(features), losses
