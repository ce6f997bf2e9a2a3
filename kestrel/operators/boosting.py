"""M4: histogram gradient boosting with softmax loss, L2 leaves and early stop, as a Spark ML stage.

* Features are cut once into at most 253 bins at the quantiles of the training rows (one aggregate); the
  binned rows are written as chunks (a byte a value) to the shared folder.
* A level of all class trees of a round is one aggregate: every task sums gradient, hessian and count by
  (class, node, feature, bin) in numpy, the sums meet by (class, node, block of features), and the best
  split of the block is found where they meet.  Only one row for each (class, node, block) reaches the driver.
* Scores are carried in the chunks and rewritten every ``REFRESH`` rounds; between, tasks add the few trees
  grown since.  The driver holds the trees and nothing else.
* The loss over the validation rows comes with the first aggregate of each round; training ends when it has
  not improved for ``patience`` rounds, and the model keeps the rounds up to the best one.

Trees grow level by level; where ``maxLeaves`` does not leave room for all splits of a level, those with the
largest gains are made.  Missing values have a bin of their own below all others, so they go left."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .trees import LEAF, Forest, matrix

EDGES = 252             # bins of a feature: one for missing values, one below each edge, one above
CHUNK = 8192            # rows of a chunk
BLOCK = 8               # features whose sums meet in one group
REFRESH = 5             # rounds between two rewrites of the carried scores
LEAST_HESSIAN = 1e-3
ACCURACY = 10_000       # of the quantiles that cut the bins
SPLIT = "tree int, node int, gain double, feature int, bin int, g double, h double, n double, gl double, hl double, nl double, loss array<double>"


def _param(name, doc, kind):
    return Param(Params._dummy(), name, doc, kind)


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol):
    maxIter = _param("maxIter", "most rounds", TypeConverters.toInt)
    stepSize = _param("stepSize", "learning rate", TypeConverters.toFloat)
    maxDepth = _param("maxDepth", "most levels of splits", TypeConverters.toInt)
    maxLeaves = _param("maxLeaves", "most leaves of a tree", TypeConverters.toInt)
    minInstancesPerNode = _param("minInstancesPerNode", "least training rows of a leaf", TypeConverters.toInt)
    l2 = _param("l2", "penalty on leaf values", TypeConverters.toFloat)
    subsamplingRate = _param("subsamplingRate", "share of rows a round", TypeConverters.toFloat)
    featureShare = _param("featureShare", "share of features a round", TypeConverters.toFloat)
    validationIndicatorCol = _param("validationIndicatorCol", "boolean column of early-stop rows", TypeConverters.toString)
    validationShare = _param("validationShare", "share of early-stop rows where no column names them; 0: none", TypeConverters.toFloat)
    patience = _param("patience", "rounds without a better validation loss before the end", TypeConverters.toInt)
    numClasses = _param("numClasses", "classes 0..k-1; 0: as many as the labels show", TypeConverters.toInt)
    seed = _param("seed", "of the row and feature draws", TypeConverters.toInt)

    def setWeightCol(self, value: str):
        return self._set(weightCol=value)

    def setValidationIndicatorCol(self, value: str):
        return self._set(validationIndicatorCol=value)

    def _defaults(self):
        self._setDefault(maxIter=600, stepSize=0.06, maxDepth=8, maxLeaves=31, minInstancesPerNode=40, l2=1.0, subsamplingRate=1.0,
                         featureShare=1.0, validationShare=0.15, patience=20, numClasses=0, seed=42, featuresCol="features", labelCol="label",
                         predictionCol="prediction", probabilityCol="probability")


def softmax(raw: np.ndarray) -> np.ndarray:
    """Class probabilities; one column of scores stands for two classes."""
    if raw.shape[1] == 1:
        p = 1 / (1 + np.exp(-raw))
        return np.concatenate([1 - p, p], axis=1)
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def best_split(g, h, n, l2: float, least: float):
    """(gain, bin, left sums) of the best cut of one node and feature, from sums by bin; none allowed: gain -inf.
    Rows of bins up to ``bin`` go left."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gt, ht, nt = g.sum(), h.sum(), n.sum()
    gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
    allowed = (nl >= least) & (nt - nl >= least) & (hl >= LEAST_HESSIAN) & (ht - hl >= LEAST_HESSIAN)
    gain = np.where(allowed, gain, -np.inf)
    at = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[at]), at, float(gl[at]), float(hl[at]), float(nl[at])) if len(gain) else (-math.inf, 0, 0.0, 0.0, 0.0)


class _Tree:
    """A tree while it grows: lists by node."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.g, self.h, self.n, self.gain = ([] for _ in range(8))

    def add(self, g, h, n) -> int:
        for column, value in zip((self.feature, self.bin, self.left, self.right, self.g, self.h, self.n, self.gain),
                                 (LEAF, 0, 0, 0, g, h, n, 0.0)):
            column.append(value)
        return len(self.feature) - 1

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The node every row has reached."""
        at = np.zeros(len(bins), np.int64)
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        rows = np.arange(len(bins)) if feature[0] != LEAF else np.arange(0)
        while len(rows):
            node = at[rows]
            at[rows] = np.where(bins[rows, feature[node]] <= cut[node], left[node], right[node])
            rows = rows[feature[at[rows]] != LEAF]
        return at

    def values(self, step: float, l2: float) -> np.ndarray:
        return -step * np.array(self.g) / (np.array(self.h) + l2)


class SoftmaxBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted classifier for labels 0..k-1; rows without a label take no part in training."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> SoftmaxBoostingModel:
        p = {q.name: self.getOrDefault(q) for q in self.params if self.hasDefault(q) or self.isSet(q)}
        rows = self._rows(df, p)
        if rows.isEmpty():
            raise ValueError("no labelled rows to learn from")
        k, priors = self._priors(rows, p["numClasses"])
        edges = bin_edges(rows)
        outputs = 1 if k == 2 else k
        with np.errstate(divide="ignore"):
            base = np.log(priors[1:] / priors[0]) if k == 2 else np.log(priors)
        base = np.maximum(base, -30.0)                    # a class without training rows
        chunks = materialize(_chunks(rows, edges, base), "boosting-chunks")
        grown, losses = self._rounds(chunks, p, outputs, edges)
        trees = []
        for one_round in grown:
            for c, tree in enumerate(one_round):
                value = np.zeros((len(tree.feature), outputs))
                value[:, c] = tree.values(p["stepSize"], p["l2"])
                cut = [float(edges[f][b - 1]) if f != LEAF and b else float(np.finfo(float).min) for f, b in zip(tree.feature, tree.bin)]
                trees.append({"feature": tree.feature, "threshold": cut, "left": tree.left, "right": tree.right, "cover": tree.n,
                              "value": value.tolist(), "gain": tree.gain})
        state = json.dumps({"classes": k, "base": base.tolist(), "trees": trees, "losses": losses})
        return self._copyValues(SoftmaxBoostingModel(state=state))

    def _rows(self, df: DataFrame, p: dict) -> DataFrame:
        from pyspark.sql.types import ArrayType
        features = F.col(p["featuresCol"])
        x = features.cast("array<double>") if isinstance(df.schema[p["featuresCol"]].dataType, ArrayType) else vector_to_array(features)
        weight = F.col(p["weightCol"]).cast("double") if "weightCol" in p else F.lit(1.0)
        # copies of a row fall on one side
        drawn = F.pmod(F.xxhash64(x, F.lit(p["seed"])), F.lit(1_000_000)) < int(p["validationShare"] * 1_000_000)
        aside = F.col(p["validationIndicatorCol"]) if "validationIndicatorCol" in p else drawn
        return df.where(F.col(p["labelCol"]).isNotNull()).select(
            x.alias("x"), F.col(p["labelCol"]).cast("int").alias("y"), weight.alias("w"), F.coalesce(aside, F.lit(False)).alias("aside"))

    @staticmethod
    def _priors(rows: DataFrame, classes: int):
        found = rows.groupBy("y").agg(F.sum(F.when(~F.col("aside"), F.col("w")).otherwise(0.0)).alias("w")).collect()
        k = max(2, classes, max(r["y"] for r in found) + 1)
        weight = np.zeros(k)
        for r in found:
            weight[r["y"]] = r["w"]
        if not weight.sum():
            raise ValueError("all rows are early-stop rows")
        return k, weight / weight.sum()

    @staticmethod
    def _rounds(chunks: DataFrame, p: dict, outputs: int, edges: list):
        """([trees of a round], validation losses): grown until the end or the early stop."""
        n_features, draw, rounds, fresh, losses = len(edges), np.random.default_rng(p["seed"]), [], [], []
        n_bins = max(len(e) for e in edges) + 2
        for turn in range(p["maxIter"] + 1):
            if turn == p["maxIter"] and not losses:           # nothing to measure after the last round
                break
            features = np.sort(draw.choice(n_features, max(1, round(p["featureShare"] * n_features)), replace=False))
            trees, frontier = [_Tree() for _ in range(outputs)], [[0] for _ in range(outputs)]
            for level in range(p["maxDepth"] if turn < p["maxIter"] else 1):
                found = _level(chunks, p, fresh, trees if level else None, frontier, features, n_bins, turn)
                if level == 0:
                    loss = next((r["loss"] for r in found if r["loss"]), None)
                    if loss and loss[1]:
                        losses.append(loss[0] / loss[1])
                    if turn == p["maxIter"] or losses and len(losses) - 1 - int(np.argmin(losses)) >= p["patience"]:
                        return rounds[:int(np.argmin(losses))] if losses else rounds, losses
                    for r in found:
                        if not r["loss"] and not trees[r["tree"]].feature:
                            trees[r["tree"]].add(r["g"], r["h"], r["n"])
                frontier = [_grown(tree, [r for r in found if r["tree"] == c and not r["loss"]], p["maxLeaves"]) for c, tree in enumerate(trees)]
                if not any(frontier):
                    break
            rounds.append(trees)
            fresh.append(trees)
            if len(fresh) == REFRESH:
                chunks, fresh = materialize(chunks.mapInArrow(_carried(fresh, p["stepSize"], p["l2"]), chunks.schema), "boosting-chunks"), []
        return rounds, losses


def _grown(tree: _Tree, found: list, most: int) -> list[int]:
    """Makes the best splits of a level; returns the new nodes."""
    best: dict[int, object] = {}
    for r in found:
        if r["gain"] > 0 and (r["node"] not in best or (r["gain"], -r["feature"]) > (best[r["node"]]["gain"], -best[r["node"]]["feature"])):
            best[r["node"]] = r
    leaves, new = sum(f == LEAF for f in tree.feature), []
    for r in sorted(best.values(), key=lambda r: (-r["gain"], r["node"]))[:max(0, most - leaves)]:
        node = r["node"]
        tree.feature[node], tree.bin[node], tree.gain[node] = r["feature"], r["bin"], r["gain"]
        tree.left[node] = tree.add(r["gl"], r["hl"], r["nl"])
        tree.right[node] = tree.add(r["g"] - r["gl"], r["h"] - r["hl"], r["n"] - r["nl"])
        new += [tree.left[node], tree.right[node]]
    return new


def bin_edges(rows: DataFrame, most: int = EDGES) -> list[np.ndarray]:
    """Upper edges of every feature's bins: quantiles of its values in the training rows (at most ``most``)."""
    width = len(rows.select("x").first()["x"])
    cuts = F.array(*[F.lit((i + 1) / (most + 1)) for i in range(most)])
    known = [F.when(~F.isnan(F.col("x")[j]), F.col("x")[j]) for j in range(width)]
    found = rows.where(~F.col("aside")).agg(*[F.percentile_approx(v, cuts, F.lit(ACCURACY)).alias(f"e{j}") for j, v in enumerate(known)],
                                            *[F.max(v).alias(f"m{j}") for j, v in enumerate(known)]).first()
    edges = [np.unique(np.array(found[f"e{j}"] or [], np.float64)) for j in range(width)]
    return [e[e < found[f"m{j}"]] if len(e) else e for j, e in enumerate(edges)]          # nothing lies above the largest value


def _chunks(rows: DataFrame, edges: list, base: np.ndarray) -> DataFrame:
    names = ["n", "x", "y", "w", "aside", "raw"]

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                x = matrix(part.column(0))
                # bin 0 holds missing values, bin 1 + i those up to edge i
                bins = np.stack([np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v)) for v, e in zip(x.T, edges)], axis=1).astype(np.uint8)
                y, w, aside = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
                raw = np.broadcast_to(base, (len(y), len(base))).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(y)], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in
                                                       (bins, y.astype(np.int32), w.astype(np.float64), aside.astype(np.uint8), raw)]], names=names)

    return rows.mapInArrow(pack, "n int, x binary, y binary, w binary, aside binary, raw binary")


def _open(row: dict, fresh: list, step: float, l2: float):
    """Arrays of a chunk, its scores with the trees of the rounds ``fresh`` added."""
    n = row["n"]
    x, y = np.frombuffer(row["x"], np.uint8).reshape(n, -1), np.frombuffer(row["y"], np.int32)
    w, aside = np.frombuffer(row["w"], np.float64), np.frombuffer(row["aside"], np.uint8).astype(bool)
    raw = np.frombuffer(row["raw"], np.float64).reshape(n, -1).copy()
    for trees in fresh:
        for c, tree in enumerate(trees):
            raw[:, c] += tree.values(step, l2)[tree.route(x)]
    return x, y, w, aside, raw


def _carried(fresh: list, step: float, l2: float):
    def run(batches):
        for batch in batches:
            raw = [_open(row, fresh, step, l2)[4].tobytes() for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(raw, pa.binary())], names=batch.schema.names)

    return run


def _level(chunks: DataFrame, p: dict, fresh: list, trees: list | None, frontier: list, features: np.ndarray, n_bins: int, turn: int) -> list:
    """Best split of every open node and block of features, and, at the first level, the sums of the validation loss."""
    step, l2, least, rate, seed = (p[k] for k in ("stepSize", "l2", "minInstancesPerNode", "subsamplingRate", "seed"))
    blocks = [features[i:i + BLOCK] for i in range(0, len(features), BLOCK)]

    def sums(batches):
        total = {(c, node): np.zeros((len(features), n_bins, 3)) for c, nodes in enumerate(frontier) for node in nodes}
        loss = np.zeros(2)
        for batch in batches:
            for row in batch.to_pylist():
                x, y, w, aside, raw = _open(row, fresh, step, l2)
                prob = softmax(raw)
                if trees is None and aside.any():
                    chosen = np.maximum(prob[np.arange(len(y)), y], 1e-300)
                    loss += [-(w * np.log(chosen))[aside].sum(), w[aside].sum()]
                used = ~aside
                if rate < 1:
                    used &= np.random.default_rng([seed, turn, len(y), int(y.sum()), int(x[0].astype(int).sum())]).random(len(y)) < rate
                for c, nodes in enumerate(frontier):
                    q = prob[:, 1] if raw.shape[1] == 1 else prob[:, c]
                    target = y == (1 if raw.shape[1] == 1 else c)
                    g, h = w * (q - target), w * q * (1 - q)
                    at = trees[c].route(x) if trees is not None else np.zeros(len(y), np.int64)
                    for node in nodes:
                        mine = np.flatnonzero(used & (at == node))
                        into = total[c, node]
                        for i, f in enumerate(features.tolist()):
                            b = x[mine, f]
                            for j, v in enumerate((g, h, None)):
                                into[i, :, j] += np.bincount(b, None if v is None else v[mine], n_bins)
        keys = [(c, node, i) for c, node in total for i in range(len(blocks))]
        sent = [total[c, node][i * BLOCK:(i + 1) * BLOCK].tobytes() for c, node, i in keys]
        if loss[1]:
            keys.append((-1, 0, 0))
            sent.append(loss.tobytes())
        yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.int32()) for i in range(3)], pa.array(sent, pa.binary())],
                                         names=["tree", "node", "block", "sums"])

    def choose(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, node, block = (k.as_py() for k in key)
        total = 0
        for batch in batches:                              # a task's sums at a time
            for blob in batch.column(batch.schema.get_field_index("sums")):
                total = total + np.frombuffer(blob.as_buffer(), np.float64)
        if tree < 0:
            values = [tree, node, 0.0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, total.tolist()]
        else:
            total = total.reshape(-1, n_bins, 3)
            found = [(*best_split(*s.T, l2, least), int(f)) for s, f in zip(total, blocks[block])]
            gain, cut, gl, hl, nl, feature = max(found, key=lambda x: (x[0], -x[5]))
            g, h, n = total[0].sum(axis=0).tolist()
            values = [tree, node, gain, feature, cut, g, h, n, gl, hl, nl, []]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 6, pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=[x.split()[0] for x in SPLIT.split(", ")])

    met = chunks.mapInArrow(sums, "tree int, node int, block int, sums binary").groupBy("tree", "node", "block")
    return met.applyInArrow(choose, SPLIT).collect()


class SoftmaxBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted booster: adds ``probability`` and ``prediction`` (first largest)."""

    state = _param("state", "classes, base scores, trees and validation losses, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, state=None):
        super().__init__()
        self._defaults()
        self._set(**({"state": state} if state is not None else {}))

    def _read(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    @property
    def rounds(self) -> int:
        s = self._read()
        return len(s["trees"]) // len(s["base"])

    @property
    def getNumTrees(self) -> int:
        """Trees of all rounds and outputs (named like that of Spark's tree ensembles)."""
        return len(self._read()["trees"])

    @property
    def losses(self) -> list[float]:
        """Validation loss before each round and after the last."""
        return self._read()["losses"]

    def gains(self, n_features: int) -> list[float]:
        """Gain of all splits on each feature."""
        out = [0.0] * n_features
        for tree in self._read()["trees"]:
            for feature, gain in zip(tree["feature"], tree["gain"]):
                if feature != LEAF:
                    out[feature] += gain
        return out

    def forest(self) -> tuple[Forest, np.ndarray]:
        """(trees that add up to the raw scores, base scores)."""
        s = self._read()
        trees = s["trees"] or [{"feature": [LEAF], "threshold": [0.0], "left": [0], "right": [0], "cover": [1.0], "value": [[0.0] * len(s["base"])]}]
        return Forest.of(trees, missing_left=True), np.array(s["base"])

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.sql.types import ArrayType
        forest, base = self.forest()
        features = self.getOrDefault(self.featuresCol)

        @F.pandas_udf("array<double>")
        def score(x):
            import pandas as pd
            out = []
            for at in range(0, len(x), 2048):
                part = x.iloc[at:at + 2048]
                out += list(softmax(forest.total(np.stack(part.to_numpy()).astype(np.float64)) + base))
            return pd.Series(out, index=x.index, dtype=object)

        wide = F.col(features).cast("array<double>") if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(F.col(features))
        p = "__probability"
        best = (F.array_position(p, F.array_max(p)) - 1).cast("double")
        out = df.withColumn(p, score(wide))
        return out.withColumn(self.getOrDefault(self.predictionCol), best).withColumn(self.getOrDefault(self.probabilityCol), array_to_vector(p)).drop(p)
