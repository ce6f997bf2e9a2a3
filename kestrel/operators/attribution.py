"""Feature relevance and attribution as Spark jobs.

* X1 mutual information: equal-frequency bins from exact value ranks
  (ties share a bin), joint counts, sum p ln(p / (p_x p_y)); all features in
  one job over the unpivoted table.
  The nearest-neighbour estimator takes each row's distance to its k-th
  neighbour of the same class and counts the rows of any class inside it.
* X2 permutation importance: every repeat ranks the rows in two independent md5
  orders, and a row takes its values from the row of the same position in the
  other order.  A column expression or any fitted model scores the variants; the
  weighted-F1 drop is aggregated by (feature, repeat).
* X4 Shapley: exact for a linear scorer (w * (x - mean)) and for trees
  (``trees.py``); for any other model a sampled-permutation job: (row x
  permutation x position) exploded, scored by the model's own transform,
  differences along each permutation.
* X5-X7 are aggregations and windows over the long (key, class, feature, phi)
  table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffles_dropped
from . import metrics as mt
from .bounded import bounded, join_on
from .running import running_totals
from .split import SEED, exact_rank


def _unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns]))
    return df.select(*keep, arr.alias("s")).select(*keep, "s.feature", "s.v")


def value_ranks(long: DataFrame, part: Sequence[str], value: str = "v", weight: str | None = None) -> DataFrame:
    """(part..., v, c, n_less, n): per distinct value, how many values of the
    part are smaller (``running.py``: no part sorted on one task).
    ``weight`` names a count column when ``long`` is already aggregated."""
    d = long.groupBy(*part, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("c"))
    return running_totals(d, part, value, {"n_less": "c"}, inclusive=False, totals={"n": "c"}).select(*part, value, "c", "n_less", "n")


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """(feature, mi, n, estimator) ranked; natural log; equal-frequency
    bins floor(bins * n_less / n) over the non-null values of each feature."""
    # distinct (feature, value, label) counts first: every later step works on
    # that (map-side reduced) table, written once, never again on the rows
    long = _unpivot(df, features, [label]).filter(F.col("v").isNotNull())
    vl = materialize(long.groupBy("feature", "v", label).agg(F.count(F.lit(1)).alias("c")), "value-counts")
    ranks = value_ranks(vl, ["feature"], weight="c")
    binned = vl.join(ranks.select("feature", "v", "n_less", "n"), ["feature", "v"]) \
        .withColumn("bin", F.floor(F.lit(float(bins)) * F.col("n_less") / F.col("n")).cast("int"))
    joint = binned.groupBy("feature", "bin", label).agg(F.sum("c").alias("nxy"), F.first("n").alias("n"))
    w_x = Window.partitionBy("feature", "bin")
    w_y = Window.partitionBy("feature", label)
    t = joint.withColumn("nx", F.sum("nxy").over(w_x)).withColumn("ny", F.sum("nxy").over(w_y))
    d = lambda c: F.col(c).cast("double")  # noqa: E731  (counts as doubles: no long overflow at scale)
    term = (d("nxy") / d("n")) * F.log(d("nxy") * d("n") / (d("nx") * d("ny")))
    out = t.groupBy("feature").agg(F.sum(term).alias("mi"), F.first("n").alias("n"))
    return out.select("feature", "mi", "n", F.lit(f"equal_frequency_{bins}").alias("estimator"))


JITTER = 1e-7            # of a feature's largest magnitude: tells ties apart, far below its steps
BUCKET_ROWS = 50_000


def digamma(n: Column) -> Column:
    """psi(n) for n >= 1, to about 1e-11: six steps up, then the asymptotic series."""
    x = n.cast("double") + F.lit(6.0)
    near = sum((F.lit(1.0) / (n.cast("double") + F.lit(float(i))) for i in range(1, 6)), F.lit(1.0) / n.cast("double"))
    x2 = x * x
    series = F.log(x) - F.lit(0.5) / x - F.lit(1.0) / (F.lit(12.0) * x2) + F.lit(1.0) / (F.lit(120.0) * x2 * x2) \
        - F.lit(1.0) / (F.lit(252.0) * x2 * x2 * x2) + F.lit(1.0) / (F.lit(240.0) * x2 * x2 * x2 * x2)
    return series - near


def mutual_information_knn(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 3, seed: int = SEED,
                           bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """X1 by nearest neighbours: ``feature, mi, n, estimator``, natural log, at least 0.

    psi(n) + mean psi(k_i) - mean psi(n_class) - mean psi(m_i) over the rows with a value and a label, where k_i is k or
    one less than the class has rows, and m_i counts the rows of all classes strictly nearer than the k_i-th
    neighbour of the same class (the row itself included).  Classes of one row take no part.  Ties are parted by
    an md5 jitter of at most ``JITTER`` times the feature's largest magnitude.

    No class is sorted on one task: exact ranks come from range partitions, neighbours from buckets of consecutive
    ranks that share ``k`` rows with the next, and m_i from two look-ups in the running counts of the feature."""
    long = _unpivot(df, features, [key, label]).where(F.col("v").isNotNull() & ~F.isnan("v") & F.col(label).isNotNull())
    most = long.groupBy("feature").agg(F.max(F.abs("v")).alias("most"))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), "feature", F.lit(str(seed)))), 1, 13), 16, 10).cast("double")
    room = F.when(F.col("most") > 0, F.col("most")).otherwise(F.lit(1.0)) * F.lit(JITTER)
    parted = long.join(F.broadcast(most), "feature").withColumn("v", F.col("v") + room * (u / F.lit(float(1 << 52))))
    parted = materialize(parted, "jittered")              # read by the class counts, the range bounds and the ranks
    classes = parted.groupBy("feature", label).agg(F.count(F.lit(1)).alias("n_class"))
    kept = join_on(parted, bounded(classes.where("n_class > 1")), ["feature", label])
    kept = kept.select("feature", F.col(label).alias("class"), F.struct("v", key).alias("at"), "v", "n_class", F.lit(1).alias("one"))
    ranked = running_totals(kept, ["feature", "class"], "at", {"place": "one"}).withColumn("place", F.col("place") - 1)
    home = F.floor(F.col("place") / F.lit(bucket_rows))
    inside = F.col("place") % F.lit(bucket_rows)
    wide = ranked.withColumn("home", home).withColumn("bucket", F.explode(F.array_compact(F.array(
        home, F.when(inside < k, home - 1), F.when(inside >= bucket_rows - k, home + 1)))))
    order = Window.partitionBy("feature", "class", "bucket").orderBy("place")
    steps = [F.abs(F.col("v") - shift("v", i).over(order)) for i in range(1, k + 1) for shift in (F.lag, F.lead)]
    own_k = F.least(F.lit(k).cast("long"), F.col("n_class") - 1)
    near = (wide.withColumn("steps", F.array_sort(F.array_compact(F.array(*steps)))).where("bucket = home")
            .select("feature", "v", "n_class", own_k.alias("k"), F.get("steps", (own_k - 1).cast("int")).alias("radius")))
    near = materialize(near.select("feature", "n_class", "k", "v", (F.col("v") - F.col("radius") + 0.0).alias("low"),
                                   (F.col("v") + F.col("radius") + 0.0).alias("high")), "neighbours")
    marks = near.select("feature", (F.col("v") + 0.0).alias("at"), F.lit(1).alias("c"))
    for edge in ("low", "high"):
        marks = marks.unionByName(near.select("feature", F.col(edge).alias("at"), F.lit(0).alias("c")))
    marks = marks.groupBy("feature", "at").agg(F.sum("c").alias("c"))
    counts = materialize(running_totals(marks, ["feature"], "at", {"upto": "c"}), "counts")
    below = counts.select(F.col("feature").alias("f1"), F.col("at").alias("low"), F.col("upto").alias("below"))
    under = counts.select(F.col("feature").alias("f2"), F.col("at").alias("high"), (F.col("upto") - F.col("c")).alias("under"))
    met = near.join(below, (F.col("f1") == F.col("feature")) & (below["low"] == near["low"])) \
        .join(under, (F.col("f2") == F.col("feature")) & (under["high"] == near["high"]))
    inner = F.greatest(F.col("under") - F.col("below"), F.lit(1))
    out = met.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.avg(digamma(F.col("k"))).alias("pk"), F.avg(digamma(F.col("n_class"))).alias("pc"),
                                     F.avg(digamma(inner)).alias("pm"))
    return out.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("pk") - F.col("pc") - F.col("pm")).alias("mi"), "n",
                      F.lit(f"knn_{k}").alias("estimator"))


def shift_of(repeat: int, n: int, seed: int) -> tuple[int, int]:
    """(a, b) of the bijection i -> (a i + b) mod n of a repeat: a is the first number from 1 + h_a mod n on that has no divisor
    in common with n, b is h_b mod n; h are the first 32 bits of an md5.  For callers that want one rank for all
    repeats; ``permutation_importance`` ranks each."""
    h = lambda tag: int(hashlib.md5(f"{tag}|{repeat}|{seed}".encode()).hexdigest()[:8], 16)       # noqa: E731
    a = 1 + h("a") % n
    while math.gcd(a, n) != 1:
        a += 1
    return a, h("b") % n


AT_ONCE = 10_000_000     # rows, counted once a repeat, that are ranked and met at once


def permutation_importance(df: DataFrame, key: str, label: str, features: Sequence[str], k: int,
                           scorer, repeats: int = 10, seed: int = SEED) -> DataFrame:
    """Drop in weighted F1 when one feature is shuffled; mean and population std over ``repeats``.

    ``scorer`` is a fitted model (a ``PipelineModel`` too) that reads the columns ``features`` and adds a probability
    or raw prediction, or a function ``(df) -> Column`` that gives the predicted class code.  Each repeat has a shuffle
    of its own: two exact md5 ranks of its rows, met by a sort-merge join, so no side of it passes the driver
    however small its files look.  About ``AT_ONCE`` rows are shuffled at a time, a repeat at least: their scores (a row
    a feature and repeat) are written, and the files of their shuffle are gone before the next repeats begin.
    ``key`` is unique; an empty table gives no rows."""
    n = df.count()
    if not n:
        return df.sparkSession.createDataFrame([], "feature string, importance_mean double, importance_std double")

    def predicted(rows: DataFrame, keep: list[str]) -> DataFrame:
        if hasattr(scorer, "transform"):
            from .ml import scored_frame
            return scored_frame(scorer, rows, k, keep).select(*keep, "pred")
        return rows.withColumn("pred", scorer(rows)).select(*keep, "pred")

    base = materialize(df.select(key, F.col(label).alias("y"), *features), "importance-rows")
    base_f1 = mt.averaged_scores(mt.per_class_scores(predicted(base, ["y"]), k))
    by = ["feature", "repeat"]
    place = lambda rows, s: exact_rank(rows, ["repeat"], [key, "repeat"], s, out="place", max_group=n)       # noqa: E731

    def scores(first: int, last: int) -> DataFrame:
        every = base.withColumn("repeat", F.explode(F.sequence(F.lit(first), F.lit(last))))
        donors = place(every.drop("y"), seed + 1).select("repeat", "place", *[F.col(f).alias(f"__d_{f}") for f in features])
        joined = place(every, seed).hint("merge").join(donors, ["repeat", "place"])
        long = joined.select("*", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
        shuffled = long.select(key, "y", "repeat", "feature",
                               *[F.when(F.col("feature") == f, F.col(f"__d_{f}")).otherwise(F.col(f)).alias(f) for f in features])
        return materialize(mt.averaged_scores(mt.per_class_scores(predicted(shuffled, ["y", *by]), k, by=by), by), "importance-scores")

    step = max(1, AT_ONCE // n)
    with shuffles_dropped(df.sparkSession):
        f1 = reduce(DataFrame.unionByName, [scores(at, min(at + step, repeats) - 1) for at in range(0, repeats, step)])
    b1 = base_f1.select(F.lit(1).alias("__k"), F.col("f1_weighted").alias("base_f1"))
    drops = f1.withColumn("__k", F.lit(1)).join(F.broadcast(b1), "__k").withColumn("drop", F.col("base_f1") - F.col("f1_weighted"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))


def shapley_linear(df: DataFrame, key: str, features: Sequence[str], weights: dict[int, Sequence[float]]) -> DataFrame:
    """X4 for a linear scorer f_c(x) = sum_j w_cj x_j: phi_cj = w_cj (x_j - mean_j)
    exactly (means from one aggregate).  Long form (key, class, feature, phi)."""
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    arr = F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.lit(f).alias("feature"),
                 (F.lit(float(w[j])) * (F.col(f) - F.lit(means[f]))).alias("phi"))
        for c, w in weights.items() for j, f in enumerate(features)]))
    return df.select(key, arr.alias("s")).select(key, "s.class", "s.feature", "s.phi")


def linear_base(df: DataFrame, features: Sequence[str], weights: dict[int, Sequence[float]]) -> DataFrame:
    """Base value per class: f_c(mean)."""
    means = df.agg(*[F.avg(f).alias(f) for f in features])
    return means.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), sum((F.lit(float(w[j])) * F.col(f) for j, f in enumerate(features)), F.lit(0.0)).alias("base_value"))
        for c, w in weights.items()])).alias("s")).select("s.*")


def shapley_sampled(df: DataFrame, key: str, vec: str, model, n_features: int, n_classes: int,
                    permutations: int = 4, seed: int = SEED, prob_col: str = "probability") -> DataFrame:
    """X4 for any model: Monte Carlo over feature orders.  For each row and
    permutation, positions 0..F switch features from the reference (column
    means) to the row's values one by one in md5 order; the model scores all
    hybrids in one transform; phi of the feature switched at step k is the
    score difference of steps k and k-1, averaged over permutations.
    Invariant: sum_j phi_cj = f_c(x) - f_c(reference)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    mean = df.select(F.posexplode(vec).alias("j", "x")).groupBy("j").agg(F.avg("x").alias("m"))
    ref = [r["m"] for r in mean.orderBy("j").collect()]                        # O(features)
    ref_arr = F.array(*[F.lit(float(v)) for v in ref])
    rows = df.select(key, F.col(vec).cast("array<double>").alias("__x"))
    rows = rows.withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    # order of feature j in permutation p: rank of md5(key|p|j)
    order = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)),
                        lambda j: F.struct(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("perm").cast("string"),
                                                             j.cast("string"), F.lit(str(seed)))).alias("h"), j.alias("j")))
    rows = rows.withColumn("__order", F.transform(F.array_sort(order), lambda s: s["j"]))
    # inverse permutation once per (row, permutation), before the steps explode
    rows = rows.withColumn("__pos", F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)),
                                                lambda j: F.array_position(F.col("__order"), j) - 1))
    # one row a step, numbered; only (row, step) and the probabilities travel, not the order
    steps = rows.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n_features))))
    hybrid = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)),
                         lambda j: F.when(F.col("__pos")[j] < F.col("step"), F.col("__x")[j]).otherwise(ref_arr[j]))
    switched = F.when(F.col("step") > 0, F.element_at("__order", F.greatest(F.col("step"), F.lit(1))))
    following = F.when(F.col("step") < n_features, F.element_at("__order", F.least(F.col("step") + 1, F.lit(n_features))))
    feats = steps.select(key, switched.alias("j_in"), following.alias("j_out"), array_to_vector(hybrid).alias("features"))
    scored = model.transform(feats).select(key, "j_in", "j_out", vector_to_array(F.col(prob_col)).alias("__p"))
    # phi of the feature switched at a step: + the score after it, - the score before it; so each scored
    # hybrid adds to the feature that led to it and takes from the one that follows, and the sums
    # need no order (partial sums are combined before the shuffle)
    arr = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(j).alias("j"), (sign * F.col("__p")[c]).alias("d"))
                              for c in range(n_classes) for j, sign in (("j_in", 1.0), ("j_out", -1.0))]))
    long = scored.select(key, arr.alias("s")).select(key, "s.*").filter(F.col("j").isNotNull())
    return long.groupBy(key, "class", "j").agg((F.sum("d") / F.lit(float(permutations))).alias("phi")) \
        .select(key, "class", F.concat(F.lit("f"), F.col("j").cast("string")).alias("feature"), "phi")


def shap_global(phi: DataFrame, top: int = 20) -> DataFrame:
    """Mean |phi| over rows per (class, feature), then over classes."""
    per = phi.groupBy("class", "feature").agg(F.avg(F.abs("phi")).alias("m"))
    g = per.groupBy("feature").agg(F.avg("m").alias("mean_abs_phi"))
    return g.orderBy(F.col("mean_abs_phi").desc(), "feature").limit(top)


def shap_by_class(phi: DataFrame, top: int = 15) -> DataFrame:
    """Per class, the top features by mean |phi| with the quartiles of phi."""
    from .quantiles import quantiles
    q = quantiles(phi, ["phi"], [0.25, 0.5, 0.75], by=["class", "feature"])
    qw = q.groupBy("class", "feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a)
                                             for p, a in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    m = phi.groupBy("class", "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.partitionBy("class").orderBy(F.col("mean_abs_phi").desc(), "feature")
    ranked = m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.join(qw, ["class", "feature"])


def shap_local(phi: DataFrame, key: str, base: DataFrame, top: int = 12) -> DataFrame:
    """Per row, the class with the largest sum |phi| (ties: lowest class)
    and its top features by |phi|, with the class base value.  One grouping by row
    (classes x features entries); the choice and the ranking are array functions."""
    item = F.struct(F.col("class"), F.col("feature"), F.col("phi"))
    rows = phi.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("all"))
    total = lambda c: F.aggregate(F.filter("all", lambda x: x["class"] == c), F.lit(0.0), lambda s, x: s + F.abs(x["phi"]))
    ranked = F.array_sort(F.transform(F.array_distinct(F.transform("all", lambda x: x["class"])),
                                      lambda c: F.struct((-total(c)).alias("s"), c.alias("class"))))
    best = rows.withColumn("class", ranked[0]["class"])
    own = F.array_sort(F.transform(F.filter("all", lambda x: x["class"] == F.col("class")),
                                   lambda x: F.struct((-F.abs(x["phi"])).alias("s"), x["feature"].alias("feature"), x["phi"].alias("phi"))))
    out = best.select(key, "class", F.posexplode(F.slice(own, 1, top)).alias("pos", "x")).select(
        "class", key, "x.feature", "x.phi", (F.col("pos") + 1).alias("rank"))
    return out.join(F.broadcast(base), "class")
