"""T-1..T-6, T-9, T-10: splits, folds, samples and class re-balancing.

Library RNG streams cannot be reproduced on a cluster, so every random
choice is an order by ``md5(concat_ws('|', key..., seed))``: deterministic
under any partitioning and identical in DuckDB.

``exact_rank`` gives the 1-based position of each row inside its class in
that order without putting a class on one task: rows are bucketed by the
leading hex digits of the hash (order preserving), (class, bucket) counts
(a table of classes x 16^p rows, size checked) give running offsets, and
``row_number`` runs inside (class, bucket) only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bounded import bounded, join_on

SEED = 42
ROWS_PER_BUCKET = 200_000


def order_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _prefix_len(max_group: int) -> int:
    """Leading hex digits of the md5 so that a bucket holds about ``ROWS_PER_BUCKET`` rows at most."""
    return max(2, math.ceil(math.log(max(max_group, 1) / ROWS_PER_BUCKET, 16)))


def exact_rank(df: DataFrame, by: Sequence[str], keys: Sequence[str], seed: int = SEED,
               out: str = "rank", max_group: int | None = None) -> DataFrame:
    """Adds ``out`` = 1-based rank of the row within ``by`` in md5 order
    (key as tie-break).  ``max_group`` (largest group size) picks the prefix
    length; it is measured when not given."""
    by, keys = list(by), list(keys)
    if max_group is None:
        g = df.groupBy(*by).count() if by else df.groupBy().count()
        max_group = g.agg(F.max("count")).first()[0] or 0
    p = _prefix_len(max_group)
    digest = order_hash(keys, seed)                     # travels as 16 bytes, which sort like their digits
    h = df.withColumns({"__h": F.unhex(digest), "__b": F.substring(digest, 1, p)})
    counts = h.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__c"))
    wo = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("__off", F.sum("__c").over(wo) - F.col("__c")).drop("__c")
    wr = Window.partitionBy(*by, "__b").orderBy("__h", *keys)
    return (join_on(h, bounded(offsets), by + ["__b"])
            .withColumn(out, (F.row_number().over(wr) + F.col("__off")).cast("long"))
            .drop("__h", "__b", "__off"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def stratified_quotas(counts: DataFrame, label: str, total: int, take: int) -> DataFrame:
    """Exact per-class quotas summing to ``take``: floor(take * n_c / n), then
    one more for the largest remainders (ties by class value).  Runs on the
    class-count table only."""
    prod = F.lit(take).cast("decimal(38,0)") * F.col("n_class").cast("decimal(38,0)")
    base = counts.select(label, "n_class", F.floor(prod / F.lit(total)).cast("long").alias("q0"),
                         (prod % F.lit(total)).alias("rem"))
    short = take - (base.agg(F.sum("q0")).first()[0] or 0)
    w = Window.orderBy(F.col("rem").desc(), F.col(label))
    return base.withColumn("quota", F.col("q0") + (F.row_number().over(w) <= F.lit(short)).cast("long")) \
        .select(label, "n_class", "quota")


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_frac: float = 0.20, seed: int = SEED) -> DataFrame:
    """T-1: adds ``split`` in {'train','test'} with exact class quotas;
    n_test = ceil(test_frac * n)."""
    counts = class_counts(df, label).cache()
    n = counts.agg(F.sum("n_class")).first()[0] or 0
    take = math.ceil(test_frac * n)
    quotas = stratified_quotas(counts, label, n, take)
    mx = counts.agg(F.max("n_class")).first()[0] or 0
    ranked = exact_rank(df, [label], keys, seed, max_group=mx)
    out = join_on(ranked, bounded(quotas.select(label, "quota")), [label], "left") \
        .withColumn("split", F.when(F.col("rank") <= F.col("quota"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("quota")
    counts.unpersist()
    return out


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], k: int = 5, seed: int = SEED) -> DataFrame:
    """T-2: ``fold`` = (rank - 1) mod k inside each class."""
    return exact_rank(df, [label], keys, seed).withColumn("fold", ((F.col("rank") - 1) % k).cast("int"))


def capped_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """T-3: min(n, rows) rows without replacement; a per-partition top-n then
    one merge of at most partitions x n rows (TakeOrderedAndProject)."""
    return df.withColumn("__h", order_hash(keys, seed)).orderBy("__h", *keys).limit(n).drop("__h")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """T-4: balanced weight n / (k * n_c) per row (class table broadcast)."""
    counts = class_counts(df, label)
    w = Window.partitionBy()   # over the class table only
    wt = counts.select(label, "n_class", F.sum("n_class").over(w).alias("n"), F.count(F.lit(1)).over(w).alias("k")) \
        .select(label, (F.col("n") / (F.col("k") * F.col("n_class"))).alias("weight"))
    return join_on(df, bounded(wt), [label], "left")


def oversample(df: DataFrame, label: str, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """T-5: every class grown to the majority count.  Each row is repeated
    floor(n_max / n_c) times; the first (n_max mod n_c) rows in md5 order get
    one more copy.  Copies are cycles rather than draws with replacement.
    Adds ``copy`` (1-based).  NULL is a class.  One shuffle (the rank); copies are made in place."""
    counts = class_counts(df, label)
    w = Window.partitionBy()
    plan = counts.select(label, "n_class", F.max("n_class").over(w).alias("n_max"))
    ranked = exact_rank(df, [label], keys, seed)
    reps = (F.floor(F.col("n_max") / F.col("n_class")) + (F.col("rank") <= F.col("n_max") % F.col("n_class")).cast("long"))
    return (join_on(ranked, bounded(plan), [label])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), reps.cast("long"))))
            .drop("n_class", "n_max"))


def undersample(df: DataFrame, label: str, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """T-6: every class cut to the minority count (first rows in md5 order)."""
    counts = class_counts(df, label)
    n_min = counts.agg(F.min("n_class")).first()[0] or 0
    return exact_rank(df, [label], keys, seed).filter(F.col("rank") <= n_min)


def learning_sizes(n: int, fractions: Sequence[float]) -> list[int]:
    return sorted({max(1, int(f * n)) for f in fractions})


def learning_subsets(df: DataFrame, keys: Sequence[str], fractions: Sequence[float], seed: int = SEED) -> DataFrame:
    """T-9: nested training subsets, sizes floor(f * n); adds ``first_subset``
    = index of the smallest subset holding the row (subset i = rows with
    first_subset <= i)."""
    n = df.count()
    sizes = learning_sizes(n, fractions)
    ranked = exact_rank(df, [], keys, seed, max_group=n)
    idx = None
    for i, s in reversed(list(enumerate(sizes))):
        idx = F.when(F.col("rank") <= s, F.lit(i)) if idx is None else F.when(F.col("rank") <= s, F.lit(i)).otherwise(idx)
    return ranked.withColumn("first_subset", idx.cast("int"))


def resample_train_only(df: DataFrame, fold_col: str, holdout: int, label: str, keys: Sequence[str],
                        sampler=oversample, seed: int = SEED) -> DataFrame:
    """T-10: the sampler touches only rows with fold != holdout; held-out rows
    pass through unchanged (copy = 1).  Scoring paths never call a sampler."""
    train = df.filter(F.col(fold_col) != holdout)
    test = df.filter(F.col(fold_col) == holdout)
    res = sampler(train, label, keys, seed)
    if "copy" not in res.columns:
        res = res.withColumn("copy", F.lit(1).cast("long"))
    return res.select(*df.columns, "copy").unionByName(test.withColumn("copy", F.lit(1).cast("long")))
