"""One training job from a table to a saved model, scored rows and metric tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_result, write_result
from . import metrics as mt
from . import ml
from .metric_store import long_form, record


def train_job(df: DataFrame, out_dir: str, k: int, model: str, holdout: Column, label: str = "y", preprocessor=None,
              features: Sequence[str] | str | None = None, sampler: Callable | None = None, weight: bool = False,
              params: dict | None = None, keep: Sequence[str] = (), store: str | None = None, run: str = "train_job",
              framing: str = "train") -> DataFrame:
    """Fit preprocessor and classifier on the rows outside ``holdout`` (``ml.fit_final``), save them as one
    pipeline, score all rows with the *saved* model and write, under ``out_dir``:

    ``model`` - the pipeline, ``scored`` - label, part, probabilities, prediction (and ``keep``),
    ``scorecard`` - the five scores, macro F1 and row count of each part, with the train score and the gap
    on the test row, ``per_class`` and ``confusion`` of each part.  With ``store``, the test scores, the train
    score, the gap and the F1 of each class are appended to that metric store (E17) under ``run`` and ``framing``.
    Returns the scorecard."""
    train = df.where(~holdout)
    fitted = ml.fit_final(train, k, model, label, preprocessor, features, sampler, weight, params)
    path = f"{out_dir.rstrip('/')}"
    fitted.write().overwrite().save(f"{path}/model")
    part = F.when(holdout, F.lit("test")).otherwise(F.lit("train"))
    marked = df.withColumn("__part", part) if preprocessor is None else df
    scored = ml.scored_frame(PipelineModel.load(f"{path}/model"), marked, k, [label, *keep, *(["__part"] if preprocessor is None else [])])
    scored = scored.withColumnRenamed("__part", "part") if preprocessor is None else scored.withColumn("part", part)
    write_result(scored.withColumnRenamed(label, "y"), f"{path}/scored")
    scored = read_result(df.sparkSession, f"{path}/scored")
    probs = [f"p_{i}" for i in range(k)]
    card = mt.scorecard(scored, k, probs, by=["part"]).join(scored.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "part")
    one = card.where("part = 'train'").select(F.lit("test").alias("part"), F.col("f1_weighted").alias("train_f1"))
    card = card.join(F.broadcast(one), "part", "left").withColumn("overfit_gap", F.col("train_f1") - F.col("f1_weighted"))
    write_result(card, f"{path}/scorecard")
    classes = mt.per_class_scores(scored, k, by=["part"])
    write_result(classes, f"{path}/per_class")
    if store is not None:
        test = [c for c in card.columns if c not in ("part", "n")]
        own = classes.where("part = 'test'").select(F.concat(F.lit("f1_class_"), F.col("class").cast("string")).alias("metric"),
                                                    F.lit(framing).alias("framing"), F.col("f1").alias("value"))
        record(long_form(read_result(df.sparkSession, f"{path}/scorecard").where("part = 'test'"), framing, test).unionByName(own), store, run)
    write_result(mt.confusion(scored, k, by=["part"]), f"{path}/confusion")
    return read_result(df.sparkSession, f"{path}/scorecard")
