"""Batch scoring.  One narrow stage: every fitted constant is a
literal of the projection, so scoring never shuffles."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import label_decode


def from_probability(prob: Column, classes: Sequence[str], keep: Sequence[str] = ()) -> list[Column]:
    """Columns of a scored row from a probability array: predicted label
    (first argmax on ties), p_<class>, confidence = max p."""
    pred = (F.array_position(prob, F.array_max(prob)) - 1).cast("int")
    out = [label_decode(pred, classes).alias("predicted_label"), pred.alias("pred")]
    out += [prob[i].alias(f"p_{c}") for i, c in enumerate(classes)]
    out.append(F.array_max(prob).alias("confidence"))
    return out


def score_frame(df: DataFrame, prob: Column, classes: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """I1/I2 given probabilities (a fitted model's ``probability`` through
    ``vector_to_array``, or any closed-form score)."""
    return df.select(*keep, *from_probability(prob, classes))


def score_with_model(model, df: DataFrame, classes: Sequence[str], keep: Sequence[str] = (),
                     prob_col: str = "probability") -> DataFrame:
    """``PipelineModel.transform`` then the scored-row projection.
    Rows that lack fitted columns are aligned by the preprocessor stages."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df)
    return score_frame(scored, vector_to_array(F.col(prob_col)), classes, keep)


def ensemble_interval(df: DataFrame, members: Sequence[str], pred: str, z: float = 1.96, keep: Sequence[str] = ()) -> DataFrame:
    """Mean +- z * population std over ensemble members of the winning
    class probability, clipped to [0, 1].  ``members`` are per-member
    probability arrays; the statistics are array expressions on the row -
    no long form, no groupBy, no shuffle."""
    win = F.array(*[F.col(m)[F.col(pred)] for m in members])
    n = float(len(members))
    mean = F.aggregate(win, F.lit(0.0), lambda a, x: a + x) / F.lit(n)
    out = df.select(*keep, pred, win.alias("__w"), mean.alias("member_mean"))
    var = F.aggregate(F.col("__w"), F.lit(0.0), lambda a, x: a + (x - F.col("member_mean")) * (x - F.col("member_mean"))) / F.lit(n)
    std = F.sqrt(var)
    return out.select(*keep, pred, "member_mean", std.alias("member_std"),
                      F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("member_mean") - z * std)).alias("confidence_low"),
                      F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("member_mean") + z * std)).alias("confidence_high"))


def prediction_table(df: DataFrame, y: str, pred: str, probs: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """I4: actual, predicted, p per class, confidence, correct."""
    return df.select(label_decode(F.col(y), classes).alias("actual"), label_decode(F.col(pred), classes).alias("predicted"),
                     *[F.col(p) for p in probs], F.greatest(*[F.col(p) for p in probs]).alias("confidence"),
                     (F.col(y) == F.col(pred)).alias("correct"))


def score_job(spark, model_path: str, input_path: str, output_path: str, classes: Sequence[str],
              keep: Sequence[str] = (), fmt: str = "parquet", schema=None) -> None:
    """Batch job entry (``spark-submit``): input table -> scored table.  CSV input is read with
    ``schema``, or with types inferred from the whole file."""
    from pyspark.ml import PipelineModel
    from ..sources.tables import read_delimited, write_result
    model = PipelineModel.load(model_path)
    df = spark.read.format(fmt).load(input_path) if fmt != "csv" else read_delimited(spark, input_path, schema)
    write_result(score_with_model(model, df, classes, keep), output_path)


def forest_interval(model, df: DataFrame, features: str = "features", keep: Sequence[str] = (), z: float = 1.96) -> DataFrame:
    """I3 for a fitted forest: ``keep, pred, member_mean, member_std, confidence_low, confidence_high``.  The winning
    class is that of the forest's own probability (first of the largest).  Spark's forests: all trees are evaluated
    together on each batch of rows, one narrow stage.  Deep forests: their trees are dealt out as well."""
    from ..session import checkpoint_dir
    from .forest import DeepForestModel, spread_interval
    from .trees import class_interval, spark_forest
    if isinstance(model, DeepForestModel):
        return spread_interval(model, df, features, keep, z)
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/forest-{uuid.uuid4().hex}"
    return class_interval(spark_forest(model, folder, df.sparkSession), df, features, keep, z)
