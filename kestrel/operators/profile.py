"""Column profiles and fitted statistics.

Everything here is one or two aggregation jobs with map-side partial
aggregation; the driver receives O(columns) or O(classes x bins) rows.
Wide profiles unpivot the table to (column, value) first so one job covers
all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import finite


def _known(df: DataFrame, c: str):
    """Column ``c`` with NaN and infinities as NULL if it holds floating numbers, else as it is."""
    return finite(F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)


def class_distribution(df: DataFrame, label: str, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of every class in fixed order; an absent class
    gets 0.  One aggregation (conditional counts per class), then unpivot -
    no join against the class list is needed."""
    by = list(by)
    aggs = [F.count_if(F.col(label) == F.lit(c)).alias(f"n{i}") for i, c in enumerate(classes)]
    g = (df.groupBy(*by) if by else df).agg(F.count(F.lit(1)).alias("total"), *aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(i).alias("class_pos"), F.lit(c).alias("class"), F.col(f"n{i}").alias("n"))
        for i, c in enumerate(classes)
    ])).alias("s")
    out = g.select(*by, "total", stack).select(*by, "s.class_pos", "s.class", "s.n", "total")
    return out.select(*by, "class_pos", "class", "n",
                      F.when(F.col("total") > 0, F.col("n") / F.col("total")).alias("share"))


def _stack(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Narrow unpivot to (by..., column, v) keeping NULLs."""
    by = list(by)
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("v")) for c in columns]))
    return df.select(*by, arr.alias("s")).select(*by, "s.column", "s.v")


def _positions(columns: Sequence[str]):
    return F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])


def missing_fraction(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """A1: (column, n_missing, missing_frac) from one global aggregate of
    counts of values that are neither NULL nor NaN (no shuffle of rows), ranked by fraction desc."""
    columns = list(df.columns) if columns is None else list(columns)
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    known = {c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.lit(1)) if c in floating else F.col(c) for c in columns}
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(known[c]).alias(f"__c{i}") for i, c in enumerate(columns)])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"), F.col(f"__c{i}").alias("nn"))
                              for i, c in enumerate(columns)])).alias("s")
    out = agg.select("__n", arr).select(
        "s.column", "s.pos", (F.col("__n") - F.col("s.nn")).alias("n_missing"),
        F.when(F.col("__n") > 0, (F.col("__n") - F.col("s.nn")) / F.col("__n")).alias("missing_frac"))
    out = out.orderBy(F.col("missing_frac").desc(), "pos")
    return out.limit(top) if top else out


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.60) -> DataFrame:
    """A2: number of columns above the missing threshold and fully empty."""
    mf = missing_fraction(df, columns)
    return mf.agg(F.count_if(F.col("missing_frac") > threshold).alias("n_over_threshold"),
                  F.count_if(F.col("missing_frac") == 1.0).alias("n_empty"),
                  F.count(F.lit(1)).alias("n_columns"))


def dominant_fraction(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3: share of the most frequent value among non-nulls, per column.
    unpivot -> (column, value) counts (partial agg map-side: a hot value is
    collapsed before the exchange) -> per column max / sum."""
    long = _stack(df, columns).filter(F.col("v").isNotNull())
    vc = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    per = vc.groupBy("column").agg(F.sum("c").alias("n_nonnull"), F.max("c").alias("top_count"),
                                   F.count(F.lit(1)).alias("n_distinct"))
    allc = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "column string, pos int")
    return (F.broadcast(allc).join(per, "column", "left")
            .select("column", "pos", F.coalesce("n_nonnull", F.lit(0)).alias("n_nonnull"),
                    F.coalesce("top_count", F.lit(0)).alias("top_count"),
                    (F.col("top_count") / F.col("n_nonnull")).alias("dominant_frac")))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows minus distinct rows (NULL-safe)."""
    sub = df.select(*(columns or df.columns))
    n = sub.agg(F.count(F.lit(1)).alias("n_rows"))
    d = sub.distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
    # both sides are one-row aggregates, joined on a constant key
    nn = n.select(F.lit(1).alias("k"), "n_rows")
    dd = d.select(F.lit(1).alias("k"), "n_distinct")
    return nn.join(dd, "k").select("n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column and a constant flag.
    Exact: unpivot -> distinct (column, value) -> count (one shuffle of the
    distinct pairs, partial dedup map-side).  ``approx`` uses HLL++ in one
    global aggregate instead (bounded state per column)."""
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c).alias(f"__d{i}") for i, c in enumerate(columns)])
        arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"), F.col(f"__d{i}").alias("n_distinct"))
                                  for i, c in enumerate(columns)])).alias("s")
        out = agg.select(arr).select("s.*")
    else:
        long = _stack(df, columns, dtype="string").filter(F.col("v").isNotNull())
        per = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
        allc = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(columns)], "column string, pos int")
        out = F.broadcast(allc).join(per, "column", "left").select("column", "pos", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
    return out.select("column", "pos", "n_distinct", (F.col("n_distinct") <= 1).alias("is_constant"))


LARGEST, SMALLEST = 1e14, 1e-3        # of a column's magnitude: 12 decimal places then hold 9 digits and a sum of 10^12 rows


def mean_by_decimals(column: str):
    """Mean from a sum of decimals (12 places), which no order of the rows changes; the floating mean for columns
    whose magnitude decimals don't suit."""
    size = F.max(F.abs(F.col(column)))
    total = F.try_sum(F.col(column).try_cast("decimal(38,12)")).cast("double")
    return F.when((size < LARGEST) & (size >= SMALLEST), total / F.count(column)).otherwise(F.avg(column))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact median, max per column.
    Moments in one global aggregate, the mean free of the rows' order; the median by exact selection."""
    from .quantiles import quantiles
    df = df.select(*[_known(df, c).alias(c) for c in columns])
    agg = df.agg(*[x for i, c in enumerate(columns) for x in (
        F.count(c).alias(f"n{i}"), mean_by_decimals(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
        F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"))])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"), F.col(f"n{i}").alias("count"),
                                       F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                                       F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                              for i, c in enumerate(columns)])).alias("s")
    mom = agg.select(arr).select("s.*")
    med = quantiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))
    return mom.join(F.broadcast(med), "column").select("column", "pos", "count", "mean", "std", "min", "median", "max")


def top_variance_columns(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """A15 (first half): columns ranked by sample variance, top n."""
    agg = df.agg(*[F.var_samp(_known(df, c)).alias(f"v{i}") for i, c in enumerate(columns)])
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("pos"), F.col(f"v{i}").alias("variance"))
                              for i, c in enumerate(columns)])).alias("s")
    return agg.select(arr).select("s.*").filter(F.col("variance").isNotNull()) \
        .orderBy(F.col("variance").desc(), "pos").limit(n)


def clipped_medians(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Per-column exact median clipped into [lo, hi] (form defaults)."""
    from .quantiles import quantiles
    cols = list(bounds)
    med = quantiles(df, cols, [0.5])
    b = df.sparkSession.createDataFrame([(c, float(lo), float(hi)) for c, (lo, hi) in bounds.items()],
                                        "column string, lo double, hi double")
    return med.join(F.broadcast(b), "column").select(
        "column", F.col("value").alias("median"),
        F.least(F.greatest(F.col("value"), F.col("lo")), F.col("hi")).alias("default_value"))


def log_histogram(df: DataFrame, column: str, label: str, bins: int = 40) -> DataFrame:
    """Histogram of log10 of the positive values, per class, ``bins``
    equal bins over each class's own [min, max]; the last bin is closed.
    One small aggregate for the ranges (broadcast back), one for the counts."""
    pos = df.withColumn(column, finite(F.col(column).cast("double"))).filter(F.col(column) > 0).select(label, F.log10(column).alias("x"))
    rng = pos.groupBy(label).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    from .bounded import bounded, join_on
    rng = bounded(rng)
    cnt = join_on(pos, rng, [label]).groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return join_on(cnt, rng, [label]).select(
        label, "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("edge_lo"), "n")


def class_quantiles(df: DataFrame, column: str, label: str) -> DataFrame:
    """Per-class min, q1, median, q3, max and Tukey whiskers (1.5 IQR,
    clipped to the data range) behind box/violin plots."""
    from .quantiles import quantiles
    known = finite(F.col(column).cast("double"))
    q = quantiles(df.filter(known.isNotNull()), [column], [0.0, 0.25, 0.5, 0.75, 1.0], by=[label])
    w = q.groupBy(label).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a)
                               for p, a in [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")]],
                             F.max("n").alias("n"))
    iqr = F.col("q3") - F.col("q1")
    return w.select(label, "n", "min", "q1", "median", "q3", "max",
                    F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr).alias("whisker_lo"),
                    F.least(F.col("max"), F.col("q3") + 1.5 * iqr).alias("whisker_hi"))
