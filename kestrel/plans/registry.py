"""Registry of named queries: a Spark builder and (optionally) its SQL twin.

Results leave through ``finish``: floating columns are rounded to 6 places
(+0.0 folds -0.0), so Spark and the SQL oracle hash the same digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def finish(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append((F.round(F.col(f.name).cast("double"), DIGITS) + F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, (DoubleType, FloatType)):
            out.append(F.transform(F.col(f.name), lambda x: F.round(x.cast("double"), DIGITS) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r(expr: str, alias: str | None = None) -> str:
    """SQL twin of ``finish`` for one floating expression."""
    out = f"round(CAST({expr} AS DOUBLE), {DIGITS}) + 0.0"
    return f"{out} AS {alias}" if alias else out


def sdiv(num: str, den: str) -> str:
    """SQL twin of ``safe_div``."""
    q = f"(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE))"
    return f"(CASE WHEN CAST({den} AS DOUBLE) = 0 OR isnan({q}) OR isinf({q}) THEN NULL ELSE {q} END)"
