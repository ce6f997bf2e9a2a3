"""The fitted preprocessor as Spark ML stages.

Each ``fit`` is one or two aggregation jobs whose O(columns) result is kept
in Params (so ``PipelineModel`` save/load works); each ``transform`` is one
projection with the fitted constants as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import finite, to_number
from ..functions.features import KOI_PRESET, FeatureEngineer
from .correlation import corr_matrix, greedy_prune
from .profile import dominant_fraction, missing_fraction
from .schema import KOI_POLICY, KOI_TARGET, drop_forbidden

MISSING_LIMIT = 0.60
DOMINANT_LIMIT = 0.999
CORR_LIMIT = 0.97
HEAVY_LIMIT = 0.75        # from this share on a value is the heaviest of the batches' majority values


def _p(name, doc, conv=None):
    return Param(Params._dummy(), name, doc, typeConverter=conv) if conv else Param(Params._dummy(), name, doc)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Shared helpers.  ``passthrough`` columns (keys, label codes, folds)
    travel through every stage unchanged and are excluded from every fit."""

    passthrough = Param(Params._dummy(), "passthrough", "columns carried through unchanged")

    def _init(self, defaults, kwargs):
        self._setDefault(passthrough=[], **defaults)
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def get(self, p):
        return self.getOrDefault(getattr(self, p))

    def _pt(self, df):
        return [c for c in self.get("passthrough") if c in df.columns]

    def _fit_input(self, df):
        pt = set(self._pt(df))
        return df.select(*[c for c in df.columns if c not in pt])

    def _with_pt(self, out_cols, df):
        extra = [F.col(c) for c in self._pt(df) if c not in set(x if isinstance(x, str) else "" for x in out_cols)]
        return df.select(*out_cols, *extra)


# ---- P3 as a stage -------------------------------------------------------------

class LeakageDropper(Transformer, _Stage):
    policy = _p("policy", "reason -> forbidden columns")
    target = _p("target", "label column, also dropped")
    keep = _p("keep", "forbidden columns to retain")

    @keyword_only
    def __init__(self, policy=None, target=None, keep=None, passthrough=None):
        super().__init__()
        self._init({"policy": KOI_POLICY, "target": KOI_TARGET, "keep": []}, self._input_kwargs)

    def _transform(self, df):
        pt = set(self._pt(df))
        kept = set(drop_forbidden(df, self.get("policy"), self.get("target"), self.get("keep")).columns)
        return df.drop(*[c for c in df.columns if c not in kept and c not in pt])


# ---- A4 column pruner ------------------------------------------------------------

def _heaviest(num: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The value that is the majority value of the batches with the most non-nulls, of every column with one."""
    def majorities(batches):
        for batch in batches:
            at, value, weight = [], [], []
            for i in range(batch.num_columns):
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                if not len(v):
                    continue
                middle = np.partition(v, len(v) // 2)[len(v) // 2]            # a majority value fills the middle
                if 2 * np.count_nonzero(v == middle) > len(v):
                    at, value, weight = [*at, i], [*value, middle], [*weight, len(v)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(value, pa.float64()), pa.array(weight, pa.int64())],
                                             names=["c", "v", "w"])

    met = num.select(*columns).mapInArrow(majorities, "c int, v double, w long").groupBy("c", "v").agg(F.sum("w").alias("w"))
    best = met.groupBy("c").agg(F.max_by("v", F.struct("w", "v")).alias("v"))                        # a row a column
    return {columns[r["c"]]: r["v"] for r in best.collect()}


def prune_decisions(df: DataFrame, columns: Sequence[str] | None = None, missing_limit: float = MISSING_LIMIT,
                    dominant_limit: float = DOMINANT_LIMIT) -> DataFrame:
    """Decision table (column, pos, missing_frac, keep, reason) after numeric
    coercion, from plain aggregates over all columns (no unpivot, no
    value-count shuffle).

    A value with a share L of a column's non-nulls is the majority value of all batches but those which hold at most
    2 (1 - L) of them; so above ``HEAVY_LIMIT`` it is the heaviest of the batches' majority values, wherever its
    rows lie.  Job 1: row count and non-null counts.  Job 2: that candidate of each column.  Job 3: how many values
    equal it.  The decision is exact.  For lower limits the exact value counts (A3) decide; the shares
    themselves are A3's table."""
    columns = list(df.columns) if columns is None else list(columns)
    exact = dominant_limit <= HEAVY_LIMIT
    types = {f.name: f.dataType for f in df.schema.fields}
    num = df.select(*[to_number(c, types[c]).alias(c) for c in columns])
    stats = num.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    n = stats["__n"]
    cand = {} if exact or not columns else _heaviest(num, columns)
    if exact:
        hits = {r["column"]: r["top_count"] for r in dominant_fraction(num, columns).collect()}
    else:
        hits = num.agg(*[F.count_if(F.col(c) == F.lit(v)).alias(c) for c, v in cand.items()]).first().asDict() if cand else {}
    rows = []
    for i, c in enumerate(columns):
        nn = stats[f"c{i}"]
        miss = (n - nn) / n if n else None
        reason = _reason(miss, nn, bool(nn) and (hits.get(c) or 0) / nn >= dominant_limit, missing_limit)
        rows.append((c, i, miss, reason == "kept", reason))
    return df.sparkSession.createDataFrame(rows, "column string, pos int, missing_frac double, keep boolean, reason string")


def _reason(miss: float | None, present: int, dominant: bool, missing_limit: float) -> str:
    return "missing" if miss is not None and miss > missing_limit else "empty" if present == 0 else "dominant" if dominant else "kept"


class ColumnPruner(Estimator, _Stage):
    missingLimit = _p("missingLimit", "drop if missing share exceeds", TypeConverters.toFloat)
    dominantLimit = _p("dominantLimit", "drop if top value share reaches", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, missingLimit=None, dominantLimit=None, passthrough=None):
        super().__init__()
        self._init({"missingLimit": MISSING_LIMIT, "dominantLimit": DOMINANT_LIMIT}, self._input_kwargs)

    def _fit(self, df):
        dec = prune_decisions(self._fit_input(df), None, self.get("missingLimit"), self.get("dominantLimit")).orderBy("pos").collect()
        return ColumnPrunerModel(columns=[r["column"] for r in dec if r["keep"]], passthrough=self.get("passthrough"))

    def fit_facts(self, facts, columns):
        limit = self.get("dominantLimit")
        dominant = {c: facts.dominant(c, limit) for c in columns}
        asked = {c: facts.heaviest(c) for c, known in dominant.items() if known is None}
        if asked:          # the pass could not tell: count the rows of the only candidates
            hits = facts.num.agg(*[F.count_if(F.col(c) == F.lit(v)).alias(c) for c, v in asked.items()]).first()
            dominant |= {c: hits[c] / facts.present(c) >= limit for c in asked}
        kept = [c for c in columns if _reason(facts.missing(c), facts.present(c), dominant[c], self.get("missingLimit")) == "kept"]
        return ColumnPrunerModel(columns=kept, passthrough=self.get("passthrough"))


class ColumnPrunerModel(Model, _Stage):
    columns = _p("columns", "surviving columns in order")

    @keyword_only
    def __init__(self, columns=None, passthrough=None):
        super().__init__()
        self._init({"columns": []}, self._input_kwargs)

    def _transform(self, df):
        """Coerce, re-add absent fitted columns as NULL, fixed order, drop extras."""
        types = {f.name: f.dataType for f in df.schema.fields}
        return self._with_pt([to_number(c, types[c]).alias(c) if c in types else F.lit(None).cast("double").alias(c)
                              for c in self.get("columns")], df)


# ---- A6 correlation pruner ---------------------------------------------------------

class CorrelationPruner(Estimator, _Stage):
    threshold = _p("threshold", "|r| above which one column of the pair goes", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, threshold=None, passthrough=None):
        super().__init__()
        self._init({"threshold": CORR_LIMIT}, self._input_kwargs)

    def _fit(self, df):
        df = self._fit_input(df)
        cols = list(df.columns)
        pairs = [(r["i"], r["j"], r["r"]) for r in corr_matrix(df, cols).filter(F.abs("r") > self.get("threshold")).collect()]
        miss = {r["column"]: r["missing_frac"] for r in missing_fraction(df, cols).collect()}
        return self._model(cols, pairs, miss)

    def fit_facts(self, facts, columns):
        pairs = [(r["i"], r["j"], r["r"]) for r in facts.correlation(columns).filter(F.abs("r") > self.get("threshold")).collect()]
        return self._model(columns, pairs, {c: facts.missing(c) for c in columns})

    def _model(self, cols, pairs, miss):
        kept, dropped = greedy_prune(cols, pairs, miss, self.get("threshold"))
        return CorrelationPrunerModel(columns=kept, droppedBy=dropped, passthrough=self.get("passthrough"))


class CorrelationPrunerModel(Model, _Stage):
    columns = _p("columns", "surviving columns")
    droppedBy = _p("droppedBy", "dropped column -> partner that removed it")

    @keyword_only
    def __init__(self, columns=None, droppedBy=None, passthrough=None):
        super().__init__()
        self._init({"columns": [], "droppedBy": {}}, self._input_kwargs)

    def _transform(self, df):
        present = set(df.columns)
        return self._with_pt([F.col(c) if c in present else F.lit(None).cast("double").alias(c) for c in self.get("columns")], df)

    def decisions(self, spark):
        d = self.get("droppedBy")
        cols = self.get("columns") + sorted(d)
        return spark.createDataFrame([(c, c not in d, d.get(c)) for c in cols], "column string, kept boolean, dropped_by string")


# ---- A7 median imputer, A8 scaler ---------------------------------------------------

class MedianImputer(Estimator, _Stage):
    """Exact median per column (selection, see ``quantiles``); ``approx``
    switches to ``percentile_approx`` for a single pass."""
    approx = _p("approx", "use percentile_approx", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, approx=None, passthrough=None):
        super().__init__()
        self._init({"approx": False}, self._input_kwargs)

    def _fit(self, df):
        df = self._fit_input(df)
        cols = list(df.columns)
        if self.get("approx"):
            row = df.agg(*[F.percentile_approx(c, 0.5, 100000).alias(c) for c in cols]).first()
            med = {c: row[c] for c in cols}
        else:
            from .quantiles import quantiles
            med = {r["column"]: r["value"] for r in quantiles(df, cols, [0.5]).collect()}
        return MedianImputerModel(medians={c: med.get(c) for c in cols}, passthrough=self.get("passthrough"))

    def fit_facts(self, facts, columns):
        return MedianImputerModel(medians=facts.quantiles(columns), passthrough=self.get("passthrough"))


class MedianImputerModel(Model, _Stage):
    medians = _p("medians", "column -> median")

    @keyword_only
    def __init__(self, medians=None, passthrough=None):
        super().__init__()
        self._init({"medians": {}}, self._input_kwargs)

    def _transform(self, df):
        m = self.get("medians")
        # a column with no observed value stays NULL (the library drops it; the pruner already has)
        return df.select(*[F.coalesce(F.col(c), F.lit(m[c]).cast("double")).alias(c) if c in m else F.col(c)
                           for c in df.columns])


class Scaler(Estimator, _Stage):
    """Centre and divide by the population std; a zero std divides by 1."""

    @keyword_only
    def __init__(self, passthrough=None):
        super().__init__()
        self._init({}, self._input_kwargs)

    def _fit(self, df):
        df = self._fit_input(df)
        cols = list(df.columns)
        known = {c: finite(F.col(c).cast("double")) for c in cols}
        row = df.agg(*[x for c in cols for x in (F.avg(known[c]).alias(f"m_{c}"), F.stddev_pop(known[c]).alias(f"s_{c}"))]).first()
        return ScalerModel(means={c: row[f"m_{c}"] for c in cols},
                           scales={c: (row[f"s_{c}"] if row[f"s_{c}"] else 1.0) for c in cols},
                           passthrough=self.get("passthrough"))

    def fit_facts(self, facts, columns, medians):
        """Mean and deviation of the imputed columns: the moments of what is present and the medians put in."""
        means, scales = {}, {}
        for c in columns:
            means[c], spread = facts.imputed(c, medians[c])
            scales[c] = spread or 1.0
        return ScalerModel(means=means, scales=scales, passthrough=self.get("passthrough"))


class ScalerModel(Model, _Stage):
    means = _p("means", "column -> mean")
    scales = _p("scales", "column -> population std (0 -> 1)")

    @keyword_only
    def __init__(self, means=None, scales=None, passthrough=None):
        super().__init__()
        self._init({"means": {}, "scales": {}}, self._input_kwargs)

    def _transform(self, df):
        m, s = self.get("means"), self.get("scales")
        return df.select(*[((F.col(c) - F.lit(m[c])) / F.lit(s[c])).alias(c) if c in m and m[c] is not None else F.col(c)
                           for c in df.columns])


# ---- A9 / A10 --------------------------------------------------------------------------

class PersistingPipeline(Pipeline):
    """``Pipeline`` whose statistics stages are fitted from the same sums: one pass over the rows before the column
    pruner (``facts``), one that lists what lies around the medians.  Firewall, derivation and coercion are
    projections and run once a pass; nothing is stored but the tasks' sums.  Stages in another order or with
    settings the sums don't answer are fitted one by one, as ``Pipeline`` does."""

    FROM_SUMS = (ColumnPruner, CorrelationPruner, MedianImputer, Scaler)

    def _fit(self, dataset):
        from pyspark.ml import PipelineModel
        stages = self.getStages()
        first = next((i for i, st in enumerate(stages) if isinstance(st, Estimator)), len(stages))
        asked = stages[first:]
        if not self._from_sums(asked):
            return super()._fit(dataset)
        df = dataset
        for st in stages[:first]:
            df = st.transform(df)
        return PipelineModel([*stages[:first], *self._fit_sums(asked, df)])

    def _from_sums(self, asked) -> bool:
        return (len(asked) >= 3 and [type(st) for st in asked] == list(self.FROM_SUMS[:len(asked)])
                and len({tuple(st.get("passthrough")) for st in asked}) == 1 and asked[0].get("dominantLimit") > HEAVY_LIMIT and not asked[2].get("approx"))

    @staticmethod
    def _fit_sums(asked, df):
        from .facts import Facts
        rows = asked[0]._fit_input(df)
        types = {f.name: f.dataType for f in rows.schema.fields}
        facts = Facts(rows.select(*[to_number(c, types[c]).alias(c) for c in rows.columns]))
        pruner = asked[0].fit_facts(facts, rows.columns)
        correlated = asked[1].fit_facts(facts, pruner.get("columns"))
        kept = correlated.get("columns")
        imputer = asked[2].fit_facts(facts, kept)
        return [pruner, correlated, imputer, *(st.fit_facts(facts, kept, imputer.get("medians")) for st in asked[3:])]


def build_preprocessor(scale: bool = True, derive: bool = True, policy=None, target=None, keep=None,
                       preset=None, passthrough=None) -> Pipeline:
    """Firewall -> derivation -> column pruner -> correlation pruner ->
    median imputer -> [scaler].  ``derive=False`` is the ablation arm (A10)."""
    pt = list(passthrough or [])
    stages = [LeakageDropper(policy=policy or KOI_POLICY, target=target or KOI_TARGET, keep=keep or [], passthrough=pt)]
    if derive:
        stages.append(FeatureEngineer(preset=preset or dict(KOI_PRESET)))
    stages += [ColumnPruner(passthrough=pt), CorrelationPruner(passthrough=pt), MedianImputer(passthrough=pt)]
    if scale:
        stages.append(Scaler(passthrough=pt))
    return PersistingPipeline(stages=stages)


def feature_names(model) -> list[str]:
    """Final feature names of a fitted preprocessor."""
    for st in reversed(model.stages):
        if isinstance(st, (CorrelationPrunerModel, ColumnPrunerModel)):
            return list(st.get("columns"))
    return []
