"""An append-only store of a run's numbers, and the run summary read from it.

Every job appends rows (run, metric, framing, value); nothing is rewritten, so jobs of one run may write side by side, and
a job that is repeated adds its rows again.  The summary takes the latest value of each (metric, framing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run string, metric string, framing string, value double, written timestamp"


def record(rows: DataFrame, store: str, run: str) -> None:
    """Append ``metric, framing, value`` rows of a run."""
    rows.select(F.lit(run).alias("run"), F.col("metric").cast("string"), F.col("framing").cast("string"), F.col("value").cast("double"),
                F.current_timestamp().alias("written")).write.mode("append").parquet(store)


def long_form(table: DataFrame, framing, metrics: Sequence[str] | dict[str, str]) -> DataFrame:
    """``metric, framing, value`` from a wide table of numbers; ``framing``: a column or a literal text; ``metrics``: names, or
    column -> name in the store."""
    names = metrics if isinstance(metrics, dict) else {m: m for m in metrics}
    label = F.lit(framing) if isinstance(framing, str) else framing
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).cast("double").alias("value")) for c, n in names.items()]))
    return table.select(label.alias("framing"), pairs.alias("x")).select("x.metric", "framing", "x.value")


def arms_long(table: DataFrame, arm: str, value: str, delta: str, metric: str, framing: str) -> DataFrame:
    """An arms table (M14, M15) as ``<metric>_<arm>`` rows and ``<metric>_<arm>_delta`` rows."""
    rows = F.explode(F.array(F.struct(F.concat(F.lit(f"{metric}_"), F.col(arm)).alias("metric"), F.col(value).alias("value")),
                             F.struct(F.concat(F.lit(f"{metric}_"), F.col(arm), F.lit("_delta")).alias("metric"), F.col(delta).alias("value"))))
    return table.select(rows.alias("x")).select("x.metric", F.lit(framing).alias("framing"), "x.value")


def run_summary(spark: SparkSession, store: str, run: str) -> DataFrame:
    """``metric, framing, value`` of a run, the latest of each; empty for a run or a store that is not there."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema(SCHEMA).parquet(store)
    except AnalysisException:
        rows = spark.createDataFrame([], SCHEMA)
    return rows.where(F.col("run") == run).groupBy("metric", "framing").agg(F.max_by("value", "written").alias("value"))
