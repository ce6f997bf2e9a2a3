"""Queries for S1-S3 (delimited scan and result sinks)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import read_delimited, read_table, write_result
from .registry import query

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("scan_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(count(*) AS BIGINT) AS n_rows, CAST(count({c}) AS BIGINT) AS n_nonnull FROM orders"
    for c in ORDERS_COLS))
def q_scan_profile(spark, sf):
    """S1 + S2: orders written as header CSV to the shared folder, scanned
    back with type inference over the whole file, then row and non-null
    counts per column (one aggregate)."""
    path = f"{checkpoint_dir(spark)}/kestrel-csv/orders-{uuid.uuid4().hex}"
    write_result(read_table(spark, sf, "orders"), path, fmt="csv")
    df = read_delimited(spark, path)
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in ORDERS_COLS])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_nonnull")) for c in ORDERS_COLS])).alias("s")
    return agg.select(F.col("__n").alias("n_rows"), arr).select("s.column", "n_rows", "s.n_nonnull")
