"""Streaming scoring: files arriving in a folder are scored exactly once."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF
from kestrel.operators import ml
from kestrel.session import checkpoint_dir
from kestrel.sources.tables import read_table
from kestrel.streaming.scoring import read_scored, score_stream


def test_stream_scores_each_file_once(spark):
    from pyspark.ml import Pipeline
    base = checkpoint_dir(spark)
    e = read_table(spark, SF, "embeddings").withColumn("label", F.col("label") % 3)
    model = Pipeline(stages=[ml.ArrayToVector(inputCol="embedding"), ml.make_estimator("forest", 3, 64, {"numTrees": 3})]).fit(e)
    mpath = os.path.join(base, f"m-{uuid.uuid4().hex}")
    model.write().save(mpath)
    inp, out = os.path.join(base, f"in-{uuid.uuid4().hex}"), os.path.join(base, f"out-{uuid.uuid4().hex}")
    e.filter(F.col("vec_id") % 2 == 0).write.parquet(os.path.join(inp, "part1"))
    q = score_stream(spark, mpath, os.path.join(inp, "*"), out, e.schema, ["c0", "c1", "c2"], out + "-progress", keep=["vec_id"])
    q.awaitTermination()
    e.filter(F.col("vec_id") % 2 == 1).write.parquet(os.path.join(inp, "part2"))
    q = score_stream(spark, mpath, os.path.join(inp, "*"), out, e.schema, ["c0", "c1", "c2"], out + "-progress", keep=["vec_id"])
    q.awaitTermination()
    got = read_scored(spark, out)
    assert got.count() == e.count()
    assert got.select("vec_id").distinct().count() == e.count()
