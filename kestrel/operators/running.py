"""Running totals in a given order without putting a group on one task.

Rows are dealt by range over (group, order), so every task gets about the same
number of rows whatever the distribution of the values; (group, task) totals - a
small table - give each task's start, and the window runs inside (group, task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bounded import bounded, join_on


def running_totals(df: DataFrame, part: Sequence[str], order: str, sums: dict[str, str], descending: bool = False,
                   inclusive: bool = True, totals: dict[str, str] | None = None) -> DataFrame:
    """Adds, for each ``out: column`` of ``sums``, the sum of ``column`` over the rows of the
    same ``part`` up to this one in ``order`` (this one too if ``inclusive``), and for each of
    ``totals`` the sum over the whole part.  ``order`` must be distinct inside a part."""
    part, totals = list(part), totals or {}
    by = F.col(order).desc() if descending else F.col(order).asc()
    dealt = materialize(df.repartitionByRange(*[F.col(p).asc() for p in part], by).withColumn("__pid", F.spark_partition_id()), "ranged")
    per = dealt.groupBy(*part, "__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in {*sums.values(), *totals.values()}])
    before = Window.partitionBy(*part).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    starts = per.select(*part, "__pid", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{out}") for out, c in sums.items()],
                        *[F.sum(f"__t_{c}").over(whole).alias(out) for out, c in totals.items()])
    inside = Window.partitionBy(*part, "__pid").orderBy(by).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    run = [(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__o_{out}")).alias(out) for out, c in sums.items()]
    return join_on(dealt, bounded(starts), part + ["__pid"]).select(*df.columns, *run, *totals)
