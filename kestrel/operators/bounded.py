"""Joins against small derived tables: NULL-safe, and broadcast only behind a checked size.

Tables whose size is fixed by parameters (column lists, one-row baselines) are
broadcast directly.  Tables derived from data - per-class counts, (class,
bucket) offsets - go through ``bounded``: the aggregated table is written to
the shared folder, which also cuts its lineage, and is broadcast when both its
rows and its bytes stay under a bound; otherwise it is left to a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    small = materialize(df, "bounded")
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(small) if size <= max_bytes and small.count() <= max_rows else small


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL meets NULL; the keys come out once, from ``left``."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        same = left[k].eqNullSafe(F.col(f"__r_{k}"))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])
