"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams of the letters of a text (everything else counts as one
space), weighted by inverse document frequency over all learnable documents and scaled to unit
length.  Weights are trained by follow-the-regularised-leader (FTRL-Proximal) with an elastic-net
penalty, which leaves most of them exactly zero; a temperature fitted on rows kept out of the
training makes the probabilities honest."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, smallest_hashes, unused

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
BLOCK = 1 << 18            # characters of one text handled at once
GROUP = 64                 # documents scored by one matrix product
UNDECIDED = "und"


@functools.lru_cache(1)
def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or 32 (a space) for anything but letters."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(text: str) -> np.ndarray:
    """Folded code points with runs of non-letters as one space; one space at each end."""
    codes = letter_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def buckets(codes: np.ndarray) -> np.ndarray:
    """Hashed n-grams of a run of code points, all orders together."""
    out, rolled = [], np.zeros(len(codes), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        rolled = rolled[:len(codes) - order + 1] * np.uint32(0x01000193) + codes[order - 1:] if order > 1 else codes.copy()
        if order in ORDERS and len(rolled):
            out.append(((rolled + np.uint32(order)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def counts(text: str) -> np.ndarray | None:
    """n-gram counts of whole ``text`` by bucket; None if it has no letter."""
    codes = letters(text)
    if len(codes) <= 1:
        return None
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(codes), BLOCK):
        total += np.bincount(buckets(codes[at:at + BLOCK + max(ORDERS) - 1]), minlength=BUCKETS)
        # n-grams that begin in the overlap belong to the next block
        over = codes[at + BLOCK:at + BLOCK + max(ORDERS) - 1]
        if len(over):
            total -= np.bincount(buckets(over), minlength=BUCKETS)
    return total


def group_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts by document and bucket, which documents have letters) for a few texts."""
    if sum(map(len, texts)) > 4 * BLOCK:
        each = [counts(t) for t in texts]
        empty = np.zeros(BUCKETS, np.int64)
        return np.stack([empty if c is None else c for c in each]), np.array([c is not None for c in each])
    codes = [letters(t) for t in texts]
    known = np.array([len(c) > 1 for c in codes])
    hashed = [buckets(c) if k else np.empty(0, np.uint32) for c, k in zip(codes, known)]
    flat = np.concatenate(hashed).astype(np.int64) + np.repeat(np.arange(len(texts)) * BUCKETS, [len(h) for h in hashed])
    return np.bincount(flat, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS), known


@dataclass
class LanguageModel:
    labels: list[str]
    weights: np.ndarray          # buckets x labels, idf already multiplied in
    idf: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, n: np.ndarray) -> np.ndarray:
        n = n.astype(np.float32)
        length = np.sqrt(((n * self.idf) ** 2).sum(axis=1, keepdims=True))
        z = (n @ self.weights / np.maximum(length, 1e-9) + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def document_frequency(rows: DataFrame) -> tuple[np.ndarray, int]:
    """(documents by bucket, documents with letters) over all ``rows`` (``t``).  Each partition
    sends at most one number a bucket."""
    def run(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches, GROUP):
            n, known = group_counts(batch.column(0).to_pylist())
            total[:BUCKETS] += (n > 0).sum(axis=0)
            total[BUCKETS] += known.sum()
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    found = rows.select("t").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(BUCKETS + 1, np.int64)
    for r in found:
        df[r["bucket"]] = r["n"]
    return df[:BUCKETS], int(df[BUCKETS])


def ftrl(x: list, y: np.ndarray, classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float, seed: int):
    """Weights (buckets + 1 x classes; the last row is the bias, not penalised) from sparse rows
    ``x`` of (bucket ids, values)."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    pen1 = np.full((BUCKETS + 1, 1), l1)
    pen1[-1] = 0

    def weights(i):
        zi, ni = z[i], n[i]
        return np.where(np.abs(zi) <= pen1[i], 0.0, -(zi - np.sign(zi) * pen1[i]) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(x)):
            i, v = x[k]
            w = weights(i)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = v[:, None] * p
            g2 = g * g
            z[i] += g - (np.sqrt(n[i] + g2) - np.sqrt(n[i])) / alpha * w
            n[i] += g2
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature with the smallest log loss, by golden-section search over its logarithm."""
    def loss(log_t):
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    a, b, g = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_label: int = 1500, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01,
          seed: int = 7) -> LanguageModel | None:
    """Fit on the rows where ``learn`` holds and language and text are not null.  Document frequencies
    cover all of them; the classifier is fitted on ``per_label`` distinct rows of each language (all, if it
    has fewer), of which every fifth sets the temperature.  None without rows; a language that has rows
    but none in the sample is an error."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("y"))
    df, total = document_frequency(rows)
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1

    def run(batches):
        for batch in slices(batches, GROUP):
            n, _ = group_counts(batch.column(0).to_pylist())
            at = range(batch.num_rows)
            ids = [np.flatnonzero(n[k]) for k in at]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                                              pa.array([n[k][i].astype(np.int32) for k, i in zip(at, ids)], pa.list_(pa.int32()))],
                                             names=["y", "ids", "n"])

    picked, sizes = smallest_hashes(rows, ["id", "t"], per_label, "y")
    got = picked.select("t", "y").mapInArrow(run, "y string, ids array<int>, n array<int>").toArrow()
    lost = sizes.keys() - set(got["y"].to_pylist())
    if lost:
        raise RuntimeError(f"languages with rows but without a training row: {sorted(lost)}")
    got = got.filter(pc.greater(pc.list_value_length(got["ids"]), 0))         # texts without a letter teach nothing
    if not got.num_rows:
        return None
    labels = sorted(set(got["y"].to_pylist()))
    y = np.array([labels.index(v) for v in got["y"].to_pylist()])
    order = np.lexsort((np.array([sum(v) for v in got["n"].to_pylist()]), y))         # one order whatever the partitions
    x = []
    for ids, n in zip(got["ids"], got["n"]):
        ids = np.array(ids.values)
        v = np.array(n.values) * idf[ids]
        x.append((np.append(ids, BUCKETS), np.append(v / np.sqrt((v * v).sum()), 1.0)))
    aside = np.zeros(len(y), bool)
    aside[order[::5]] = len(y) >= 20
    inside = [k for k in order if not aside[k]]
    w = ftrl([x[k] for k in inside], y[inside], len(labels), epochs, alpha, beta, l1, l2, seed)
    model = LanguageModel(labels, (w[:-1] * idf[:, None]).astype(np.float32), idf.astype(np.float32), w[-1].astype(np.float32))
    if aside.any() and len(labels) > 1:
        model.temperature = fit_temperature(np.stack([x[k][1] @ w[x[k][0]] for k in np.flatnonzero(aside)]), y[aside])
    return model


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row: the likeliest language and its probability.

    Texts that are null or have no letter, and all texts where there was nothing to learn from, are
    ``und`` with score 0.  Ties go to the first language in alphabetical order.  No shuffle; repeated
    rows and null ids are kept; an empty table gives no rows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, GROUP):
            label, score = np.full(batch.num_rows, UNDECIDED, object), np.zeros(batch.num_rows)
            if model is not None:
                n, known = group_counts(batch.column(1).to_pylist())
                p = model.probabilities(n)
                best = p.argmax(axis=1)
                label[known] = np.array(model.labels, object)[best[known]]
                score[known] = np.minimum(p[np.arange(len(p)), best][known], 1.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(score)],
                                             names=[id_col, "lang_pred", "score"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"{id_col} {id_type}, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language could be told (not ``und``) with a
    probability of at least ``least``; tested where they lie, no shuffle."""
    own = unused(docs, "whole_text")

    def run(batches):
        for batch in slices(batches, GROUP):
            keep = np.zeros(batch.num_rows, bool)
            if model is not None:
                n, known = group_counts(batch.column(own).to_pylist())
                keep = known & (model.probabilities(n).max(axis=1) >= least)
            yield batch.drop_columns([own]).filter(pa.array(keep))

    return docs.withColumn(own, F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(run, docs.schema)
