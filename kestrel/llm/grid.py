"""Blocks of queries against buckets of rows: the frame of the two exact searches.

Both sides are tables of a few large rows (a block holds up to some thousand queries, a bucket some
thousand vectors).  Every pair of a block and a bucket is one row of an equality join on (block,
bucket), so that no task holds more than a few pairs and a lost task repeats only these."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(rows with a dense number ``name`` in place of ``part, seq``, how many).  ``part`` is a task's
    number, ``seq`` counts from 0 inside it; only the row counts of the tasks are gathered (a row a task)."""
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    out = rows.join(F.broadcast(starts), rows["part"] == starts["of"])
    return out.withColumn(name, (F.col("start") + F.col("seq")).cast("int")).drop("part", "seq", "of", "start"), rows.count()


def pairs(blocks: DataFrame, n_blocks: int, buckets: DataFrame, n_buckets: int) -> DataFrame:
    """A row for every block and bucket, two to a task, long buckets first (column ``longest``)."""
    if not n_blocks or not n_buckets:
        return blocks.where(F.lit(False)).withColumn("bucket", F.lit(0)).join(buckets.where(F.lit(False)), "bucket")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))       # noqa: E731
    tasks = max(1, n_blocks * n_buckets // 2)
    left = blocks.withColumn("bucket", every(n_buckets)).repartition(tasks, "block", "bucket")
    right = buckets.withColumn("block", every(n_blocks)).repartition(tasks, "block", "bucket")
    return left.join(right, ["block", "bucket"]).sortWithinPartitions(F.desc("longest"))
