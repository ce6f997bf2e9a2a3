"""I5 over arriving files: Structured Streaming batch scoring.

New files under ``input_dir`` are scored by a saved ``PipelineModel`` and
appended to ``output_dir``; progress and file offsets live in ``checkpoint``, a
fixed shared folder that belongs to this stream.  It must be the same in every
run: the output's own log skips batches it knows, so a run with fresh offsets
would lose files.  With it a restarted or failed job resumes where it stopped.  Scoring is one narrow
projection per micro-batch (no state, no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.scoring import score_with_model


def score_stream(spark: SparkSession, model_path: str, input_dir: str, output_dir: str, schema: StructType,
                 classes: Sequence[str], checkpoint: str, keep: Sequence[str] = (),
                 available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the scoring stream; returns the ``StreamingQuery``.
    ``available_now`` processes what is there in bounded micro-batches and stops
    (a scheduled batch job); otherwise it runs continuously."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(model_path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(input_dir)
    scored = score_with_model(model, src, classes, keep)
    writer = scored.writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_scored(spark: SparkSession, output_dir: str) -> DataFrame:
    return spark.read.parquet(output_dir)
