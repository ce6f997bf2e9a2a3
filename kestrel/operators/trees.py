"""Fitted trees as flat node arrays: hundreds of trees in one vectorised pass over Arrow batches.

Used by the softmax booster (M4), the forest interval (I3) and the exact tree Shapley values (X4).
A ``Forest`` is model state: its size is that of the trees, whatever the rows.  Every job here is
narrow: rows are scored where they lie."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

LEAF = -1
ROWS = 2048             # rows of a batch that are scored at once


@dataclass
class Forest:
    """Nodes of all trees behind each other.

    ``feature`` (-1: a leaf), ``threshold`` (a row goes left if its value is at most that), ``left``,
    ``right`` (node numbers), ``cover`` (weight of the training rows that reached the node), ``value``
    (nodes x outputs), ``roots``.  A missing value goes left if ``missing_left``, else right."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    missing_left: bool = False

    @classmethod
    def of(cls, trees: Sequence[dict], missing_left: bool = False) -> Forest:
        """From one dict of lists a tree (node numbers inside the tree, root first)."""
        sizes = np.array([len(t["feature"]) for t in trees])
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1] if len(trees) else np.zeros(0, np.int64)
        put = lambda name, kind: np.concatenate([np.asarray(t[name], kind) for t in trees])       # noqa: E731
        shift = np.repeat(starts, sizes)
        return cls(put("feature", np.int64), put("threshold", np.float64), put("left", np.int64) + shift, put("right", np.int64) + shift,
                   put("cover", np.float64), np.concatenate([np.asarray(t["value"], np.float64) for t in trees]), starts, missing_left)

    @property
    def outputs(self) -> int:
        return self.value.shape[1]

    def goes_left(self, x: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        return ~(x > threshold) if self.missing_left else x <= threshold

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf numbers, rows x trees."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row, tree = np.nonzero(self.feature[at] != LEAF)
        while len(row):
            node = at[row, tree]
            left = self.goes_left(x[row, self.feature[node]], self.threshold[node])
            node = np.where(left, self.left[node], self.right[node])
            at[row, tree] = node
            inner = self.feature[node] != LEAF
            row, tree = row[inner], tree[inner]
        return at

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' values, rows x outputs."""
        return self.value[self.leaves(x)].sum(axis=1) if len(self.roots) else np.zeros((len(x), self.outputs))

    def expected(self) -> np.ndarray:
        """Sum over the trees of the cover-weighted mean of the leaf values."""
        out = np.zeros(self.outputs)
        for root in self.roots.tolist():
            leaves = [leaf for leaf, _ in self.paths(root)]
            out += (self.cover[leaves] / self.cover[root]) @ self.value[leaves]
        return out

    def paths(self, root: int):
        """(leaf, [(feature, threshold, went left, share of the parent's cover)]) of every leaf under ``root``."""
        open_, done = [(root, [])], []
        while open_:
            node, path = open_.pop()
            if self.feature[node] == LEAF:
                done.append((node, path))
                continue
            for child, left in ((self.left[node], True), (self.right[node], False)):
                step = (int(self.feature[node]), float(self.threshold[node]), left, float(self.cover[child] / self.cover[node]))
                open_.append((int(child), [*path, step]))
        return done


def spark_forest(model, folder: str, spark: SparkSession) -> Forest:
    """The nodes of a fitted Spark forest or tree, from its saved form under ``folder`` (a new path); values
    are class shares of the leaves, divided by the number of trees so that they add up to probabilities."""
    model.write().save(folder)
    saved = spark.read.parquet(f"{folder}/data")
    single = "treeID" not in saved.columns
    saved = saved.select(F.lit(0).alias("tree") if single else F.col("treeID").alias("tree"), "*" if single else "nodeData.*")
    rows = saved.select("tree", "id", "impurityStats", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
                        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("split.numCategories").alias("kinds"))
    trees: dict[int, list] = {}
    for r in rows.toLocalIterator():              # model state, not data
        if r["leftChild"] >= 0 and r["kinds"] >= 0:
            raise ValueError("splits over categories are not supported")
        trees.setdefault(r["tree"], []).append(r)
    out = []
    for nodes in trees.values():
        nodes.sort(key=lambda r: r["id"])
        leaf = [r["leftChild"] < 0 for r in nodes]
        stats = np.array([r["impurityStats"] for r in nodes], np.float64)
        cover = stats.sum(axis=1)
        out.append({"feature": [LEAF if end else r["feature"] for r, end in zip(nodes, leaf)],
                    "threshold": [0.0 if end else r["threshold"] for r, end in zip(nodes, leaf)],
                    "left": [max(r["leftChild"], 0) for r in nodes], "right": [max(r["rightChild"], 0) for r in nodes],
                    "cover": cover, "value": stats / cover[:, None] / len(trees)})
    return Forest.of(out)


# ---- rows -----------------------------------------------------------------------------------

def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows x width."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def over_rows(df: DataFrame, vec: str, keep: Sequence[str], fields: list[StructField], fn: Callable) -> DataFrame:
    """``keep`` and what ``fn(rows x features)`` returns (an array a field, rows in order); ``vec`` is an array
    or a vector column."""
    wide = F.col(vec).cast("array<double>") if isinstance(df.schema[vec].dataType, ArrayType) else vector_to_array(F.col(vec))
    rows = df.select(*keep, wide.alias("__x"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made = fn(matrix(part.column(part.num_columns - 1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*part.schema.names[:-1], *[f.name for f in fields]])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *fields]))


def class_interval(forest: Forest, df: DataFrame, vec: str, keep: Sequence[str], z: float) -> DataFrame:
    """Mean and population std over the trees of the winning class's probability (class of the largest mean,
    the first on ties), with mean +- z std clipped to [0, 1]."""
    n_trees = len(forest.roots)

    def fn(x):
        shares = forest.value[forest.leaves(x)] * n_trees           # rows x trees x classes
        pred = shares.mean(axis=1).argmax(axis=1)
        mine = np.take_along_axis(shares, pred[:, None, None], axis=2)[:, :, 0]
        mean, std = mine.mean(axis=1), mine.std(axis=1)
        return [pa.array(pred.astype(np.int32)), *map(pa.array, (mean, std, np.clip(mean - z * std, 0, 1), np.clip(mean + z * std, 0, 1)))]

    fields = [StructField("pred", IntegerType())] + [StructField(n, DoubleType()) for n in
                                                    ("member_mean", "member_std", "confidence_low", "confidence_high")]
    return over_rows(df, vec, keep, fields, fn)


# ---- exact Shapley values ---------------------------------------------------------------------

class LeafPath:
    """One leaf's conditions, a feature at a time: the interval its value must lie in, and the share of
    the cover that follows the path when the feature is unknown."""

    def __init__(self, path: list, value: np.ndarray):
        merged: dict[int, list] = {}
        for feature, threshold, left, share in path:
            low, high, known = merged.get(feature, (-np.inf, np.inf, 1.0))
            merged[feature] = [low, min(high, threshold), known * share] if left else [max(low, threshold), high, known * share]
        self.features = np.array(list(merged), np.int64)
        self.low, self.high, self.share = (np.array([m[i] for m in merged.values()]) for i in range(3))
        self.value = value
        n = len(merged)
        # |S|! (n - |S| - 1)! / n! by size of S
        self.weight = np.array([np.exp(_log_factorial(s) + _log_factorial(n - s - 1) - _log_factorial(n)) for s in range(n)])

    def factors(self, meets: np.ndarray) -> np.ndarray:
        """phi / value for each row of ``meets`` (patterns x features of the path)."""
        one, share, n = meets.astype(float), self.share, len(self.features)
        # coefficients of prod_j (share_j + one_j t); subsets by size
        whole = np.zeros((len(meets), n + 1))
        whole[:, 0] = 1.0
        for j in range(n):
            whole[:, 1:] = whole[:, 1:] * share[j] + whole[:, :-1] * one[:, j:j + 1]
            whole[:, 0] *= share[j]
        # the same product without feature j: divided by (share_j + t), or by share_j
        rest = np.empty((len(meets), n, n))
        carry = np.zeros((len(meets), n))
        for s in range(n, 0, -1):
            carry = whole[:, s, None] - share[None, :] * carry
            rest[:, :, s - 1] = carry
        rest = np.where(meets[:, :, None], rest, whole[:, None, :n] / share[None, :, None])
        return (one - share) * (rest @ self.weight)


def _log_factorial(n: int) -> float:
    return float(np.log(np.arange(1, n + 1)).sum())


def shapley_matrix(paths: list[LeafPath], x: np.ndarray, outputs: int, missing_left: bool = False) -> np.ndarray:
    """Path-dependent Shapley values, rows x features x outputs."""
    out = np.zeros((*x.shape, outputs))
    for p in paths:
        mine = x[:, p.features]
        if missing_left:
            meets = ~(mine > p.high) & ((mine > p.low) | np.isneginf(p.low))
        else:
            meets = ((mine <= p.high) | np.isposinf(p.high)) & ~(mine <= p.low)
        patterns, which = np.unique(np.packbits(meets, axis=1), axis=0, return_inverse=True)
        patterns = np.unpackbits(patterns, axis=1, count=len(p.features)).astype(bool)
        out[:, p.features, :] += p.factors(patterns)[which.ravel()][:, :, None] * p.value
    return out


def shapley_trees(forest: Forest, df: DataFrame, key: str, vec: str, names: Sequence[str] | None = None) -> DataFrame:
    """X4 for trees: ``key, class, feature, phi``, exactly the Shapley values of the game in which unknown
    features follow both branches by training cover.  Narrow; for every row and class the values add
    up to f(x) - ``forest.expected()``.  Features no tree asks for have phi 0 and are returned, too."""
    paths = [LeafPath(path, forest.value[leaf]) for root in forest.roots.tolist() for leaf, path in forest.paths(root) if path]
    wide = F.col(vec).cast("array<double>") if isinstance(df.schema[vec].dataType, ArrayType) else vector_to_array(F.col(vec))
    rows, outputs, left = df.select(F.col(key), wide.alias("__x")), forest.outputs, forest.missing_left

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column(1))
                phi = shapley_matrix(paths, x, outputs, left)
                n, f = x.shape
                labels = pa.array(list(names) if names is not None else [f"f{j}" for j in range(f)])
                for c in range(outputs):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(np.repeat(np.arange(n), f))), pa.array(np.full(n * f, c, np.int32)),
                         labels.take(pa.array(np.tile(np.arange(f), n))), pa.array(phi[:, :, c].ravel())], names=[key, "class", "feature", "phi"])

    return rows.mapInArrow(run, StructType([rows.schema.fields[0], StructField("class", IntegerType()), StructField("feature", StringType()),
                                            StructField("phi", DoubleType())]))
