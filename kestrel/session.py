"""SparkSession construction and shared cluster settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


METHOD_CAP = "spark.sql.codegen.hugeMethodLimit"


def cap_methods(spark: SparkSession) -> None:
    """Wide projections run as single generated methods over HotSpot's 8,000 bytes unless the session caps them; such
    methods are never compiled, which costs some fifteen times as much a row.  A session that names a cap keeps it."""
    if spark.conf.get(METHOD_CAP, None) is None:
        spark.conf.set(METHOD_CAP, "8000")


def get_spark(master: str | None = None, app: str = "kestrel", shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with AQE on and the UI off.

    On a cluster the master and most settings come from ``spark-submit``; the
    values here only apply where nothing else set them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # generated methods over 8000 bytes are never JIT-compiled by HotSpot;
        # wide feature projections hit that, so fall back per subtree instead
        .config(METHOD_CAP, "8000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where it is unset, a local session (one machine, tests) gets a private folder; on a cluster that
    would be another folder on every machine, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc._jsc.sc().getCheckpointDir().get()
    if sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends and not when the driver happens to collect garbage.  For steps
    that write their result and run one after another; Spark before 4.1 has no such setting and keeps the files."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    if before is not None:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df, purpose: str = "table"):
    """``df`` written to the shared folder and read back: its lineage is cut, lost executors don't
    bring its work back, and nothing stays in executor memory."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
