"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (A-Z lower-cased, surrounding punctuation removed) are hashed; hashes met in too few training
texts share one embedding row.  Filters of several widths slide over the embeddings, each filter keeps its maximum over the whole text, and a
logistic unit reads the maxima.  A filter's answer at a place is the sum of one table row per word
(embedding times filter, worked out once), so scoring is table look-ups, additions and a maximum.

The decision threshold is calibrated by language.  Language is never read from a column: it is told
from the text by counting common function words, so equal texts always have equal scores."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, slices, smallest_hashes, text_bytes, written

HASHES = 1 << 24         # word hashes; only those met in LEAST_TEXTS training texts get an embedding of their own
LEAST_TEXTS = 5
WIDTHS = (1, 2, 3)
FILTERS = 8              # of each width
DIM = 8
BINS, FAR = 128, 64      # logit histogram: bins a unit, and the largest logit told apart
BLOCK = 1 << 16          # words of one text looked up at once
STRIP = bytes(b for b in range(33, 127) if not chr(b).isalnum())

# Frequent function words of each language.
FUNCTION_WORDS = {
    "de": "der die das und in zu den von mit ist für auf nicht ein eine im dem des sie es",
    "en": "the of and to in is it for that on with as are was by be this from at or",
    "es": "el la los las de que y en un una por con para se del al es no su lo",
    "fr": "le la les de des et en un une du que est pour dans sur pas qui au avec ce",
}
LANGUAGES = [*sorted(FUNCTION_WORDS), "other"]


PAD, RARE = 0, 1         # embedding rows


def word_hash(word: bytes) -> tuple[int, int]:
    """(hash, bit mask of the languages in which the word is a function word)."""
    bare = word.strip(STRIP) or word
    return zlib.crc32(bare) % HASHES, LANGUAGE_BITS.get(bare, 0)


LANGUAGE_BITS: dict[bytes, int] = {}
for _bit, _name in enumerate(sorted(FUNCTION_WORDS)):
    for _word in FUNCTION_WORDS[_name].split():
        LANGUAGE_BITS[_word.encode()] = LANGUAGE_BITS.get(_word.encode(), 0) | 1 << _bit


class Rows:
    """Whole text -> (embedding rows, language); ``row_of`` gives a hash's row, None: the hashes themselves."""

    def __init__(self, row_of: dict | None = None):
        def make(word):
            h, bits = word_hash(word)
            return (h if row_of is None else row_of.get(h, RARE)) << 8 | bits

        self.get = Memo(make).__getitem__

    def __call__(self, text: bytes) -> tuple[np.ndarray, int]:
        words = text.lower().split()
        both = np.fromiter(map(self.get, words), np.int64, len(words))
        bits = both & 255
        votes = [int(np.count_nonzero(bits & (1 << b))) for b in range(len(FUNCTION_WORDS))]
        language = votes.index(max(votes)) if any(votes) else len(FUNCTION_WORDS)
        return both >> 8, language


def padded(rows: np.ndarray) -> np.ndarray:
    """At least as many rows as the widest filter."""
    short = max(WIDTHS) - len(rows)
    return np.concatenate((rows, np.full(short, PAD, np.int64))) if short > 0 else rows


@dataclass
class ToxicityModel:
    row_of: dict                  # word hash -> embedding row
    embedding: np.ndarray         # rows x DIM
    filters: dict                 # width -> (width, DIM, FILTERS)
    bias: np.ndarray              # one a filter
    out: np.ndarray
    out_bias: float
    threshold: np.ndarray         # logit at which a language's texts count as toxic
    slope: float = 1.0
    tables: dict | None = None

    def prepare(self):
        """Look-up tables: what each word adds to each filter at each place of its window."""
        self.tables = {w: [np.ascontiguousarray((self.embedding @ f[j]).astype(np.float32)) for j in range(w)]
                       for w, f in self.filters.items()}
        return self

    def maxima(self, rows: np.ndarray, places: bool = False):
        best, where = [], []
        for w in WIDTHS:
            table, top, at = self.tables[w], None, None
            for lo in range(0, len(rows) - w + 1, BLOCK):
                part = rows[lo:lo + BLOCK + w - 1]
                n = len(part) - w + 1
                z = table[0][part[:n]]
                for j in range(1, w):
                    z += table[j][part[j:n + j]]
                here = z.max(axis=0)
                if places:
                    spot = lo + z.argmax(axis=0)
                    at = spot if top is None else np.where(here > top, spot, at)
                top = here if top is None else np.maximum(top, here)
            best.append(top)
            where.append(at)
        return (np.concatenate(best), where) if places else np.concatenate(best)

    def logit(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.maxima(rows) + self.bias, 0) @ self.out + self.out_bias)

    def score(self, logit, language):
        z = self.slope * (np.asarray(logit) - self.threshold[language])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(hashes: list[np.ndarray], y: np.ndarray, epochs: int = 6, rate: float = 0.03, seed: int = 11) -> ToxicityModel:
    """Stochastic gradient descent on the log loss, classes weighted to equal mass.  The first embedding
    dimension starts as each word's signed root of the likelihood ratio between the classes, so that
    the maxima look at telling words from the start.  Thresholds are left at zero."""
    rng = np.random.default_rng(seed)
    inside = np.arange(len(y))
    seen: tuple[dict, dict] = ({}, {})
    for k in inside:
        for h in np.unique(hashes[k]).tolist():
            seen[y[k]][h] = seen[y[k]].get(h, 0) + 1
    often = sorted(h for h in seen[0].keys() | seen[1].keys() if seen[0].get(h, 0) + seen[1].get(h, 0) >= LEAST_TEXTS)
    row_of = {h: RARE + 1 + i for i, h in enumerate(often)}
    rows = [padded(np.array([row_of.get(h, RARE) for h in text.tolist()], np.int64)) for text in hashes]
    n = np.maximum(np.bincount(y[inside], minlength=2), 1).astype(float)
    s = np.array([[seen[c].get(h, 0) for h in often] for c in (0, 1)], float).reshape(2, -1)
    expected = s.sum(axis=0) * (n / n.sum())[:, None]
    ratio = 2 * (s * np.log(np.maximum(s, 1e-9) / np.maximum(expected, 1e-9))).sum(axis=0)
    embedding = rng.normal(0, 0.05, (RARE + 1 + len(often), DIM))
    embedding[RARE + 1:, 0] += np.sign(s[1] - expected[1]) * np.minimum(np.sqrt(np.maximum(ratio, 0)), 15) / 5
    embedding[PAD] = 0
    filters = {w: rng.normal(0, 0.2, (w, DIM, FILTERS)) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][w // 2, 0] += 1.0
    total, weight = FILTERS * len(WIDTHS), len(inside) / (2.0 * n)
    model = ToxicityModel(row_of, embedding, filters, np.zeros(total), rng.normal(0.1, 0.02, total), -1.0, np.zeros(len(LANGUAGES)))
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for k in rng.permutation(inside):
            # forward over this text's own words only
            words, place = np.unique(rows[k], return_inverse=True)
            model.tables = {w: [embedding[words] @ f[j] for j in range(w)] for w, f in filters.items()}
            top, where = model.maxima(place, places=True)
            hidden = np.maximum(top + model.bias, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.out_bias, -30, 30)))
            g = (p - y[k]) * weight[y[k]]
            back = g * model.out * (hidden > 0)
            model.out -= step * g * hidden
            model.out_bias -= step * g
            model.bias -= step * back
            for i, w in enumerate(WIDTHS):
                d = back[i * FILTERS:(i + 1) * FILTERS]
                for j in range(w):
                    hit = rows[k][where[i] + j]
                    move = filters[w][j] * d
                    filters[w][j] -= step * embedding[hit].T * d
                    np.add.at(embedding, hit, -step * move.T)
        embedding[PAD] = 0
    return model.prepare()


def _best_threshold(bins: np.ndarray, n: np.ndarray) -> float:
    """Middle of the gap below the histogram bin from which on toxic has the best F1 (of ties, the lowest).
    ``bins``: numbers in ascending order; ``n``: weight of clean and toxic rows in each."""
    bins, n = bins[::-1], n[::-1]
    hits = np.cumsum(n[:, 1])
    f1 = 2 * hits / (np.cumsum(n.sum(axis=1)) + hits[-1])
    best = int(np.flatnonzero(f1 >= f1.max() - 1e-12)[-1])
    low = bins[best] / BINS
    return float((low + (bins[best + 1] + 1) / BINS) / 2) if best + 1 < len(bins) else float(low - 1)


def _calibrate(model: ToxicityModel, found: np.ndarray, least: int = 10):
    """Thresholds by language from ``found``, a row for each language, label, length (1: may be in the
    descent), place (1: was in the descent) and logit bin with its number of rows.

    Rows of the descent have no say; the others of their label and length weigh for them, so that every
    label and length has the mass it has in all learnable rows, however large the descent's share.  A
    language with fewer than ``least`` rows of a label takes the threshold of all together.  One class alone
    keeps the threshold beyond all logits."""
    language, y, short, inside, at, n = found.T
    if len(set(y.tolist())) < 2:
        model.threshold[:] = at.max() / BINS + 5 if not y.any() else at.min() / BINS - 5
        return
    weight = np.zeros(len(n))
    for c in (0, 1):
        for length in (0, 1):
            own = (y == c) & (short == length)
            out = own & (inside == 0)
            use = out if out.any() else own              # a handful of rows, all in the descent
            if use.any():
                weight[use] = n[use] * (n[own].sum() / n[use].sum())

    def best(rows):
        bins, place = np.unique(at[rows], return_inverse=True)
        mass = np.zeros((len(bins), 2))
        np.add.at(mass, (place, y[rows]), weight[rows])
        return _best_threshold(bins, mass)

    model.threshold[:] = best(weight > 0)
    for k in range(len(LANGUAGES)):
        own = (language == k) & (weight > 0)
        if min(n[own & (y == c)].sum() for c in (0, 1)) >= least:
            model.threshold[k] = best(own)


def calibration(texts: DataFrame, known: DataFrame, descent: DataFrame, model: ToxicityModel, most_words: int) -> np.ndarray:
    """Counts of all labelled rows by language, label, length, place and logit bin.  Texts are scored where
    they lie; only their ids and bins meet the labels in a shuffle join."""
    def run(batches):
        model.prepare()
        rows = Rows(model.row_of)
        for batch in slices(batches):
            told = [rows(t) for t in batch.column(1).to_pylist()]
            at = np.clip(np.floor(np.array([model.logit(padded(r)) for r, _ in told]) * BINS), -FAR * BINS, FAR * BINS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for _, k in told], pa.int32()),
                                              pa.array([int(len(r) <= most_words) for r, _ in told], pa.int32()), pa.array(at.astype(np.int32))],
                                             names=["id", "language", "short", "bin"])

    model.tables = None
    id_type = texts.schema["id"].dataType.simpleString()
    scored = texts.select("id", "t").mapInArrow(run, f"id {id_type}, language int, short int, bin int")
    marked = known.join(F.broadcast(descent.withColumn("inside", F.lit(1))), "id", "left")
    keys = ["language", "y", "short", "inside", "bin"]
    got = (scored.join(marked, "id").withColumn("inside", F.coalesce("inside", F.lit(0)) * F.col("short"))
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).toArrow())
    return np.stack([got[c].to_numpy().astype(np.int64) for c in [*keys, "n"]], axis=1)


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = 2000, most_words: int = 4000) -> ToxicityModel | None:
    """Fit on labelled rows where ``learn`` (over the labels' id) holds and the id has a text: the descent takes
    a sample of ``per_class`` ids of each label (four fifths of them, if there are fewer), of texts of at most
    ``most_words`` words (bounds of the descent alone; scoring reads whole texts); a label whose sampled texts are
    all longer gives a block of each.  All labelled rows that are not in the descent set the thresholds.  An id
    labelled both ways counts as 1; None if no labelled row is left."""
    texts = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("t"))
    known = labels.where(learn & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    known = written(known.join(texts.select("id"), "id", "left_semi"), "toxicity-labels")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # every fifth row by hash never descends; a label too small for that gives all its rows
    small = [c for c, n in counts.items() if n < 10]
    apart = (F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(5)) == 0) & ~F.col("y").isin(small)
    picked, _ = smallest_hashes(known.where(~apart), ["id"], per_class, "y")
    picked = written(picked, "toxicity-descent")
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id", "t")))
    sample = (texts.join(F.broadcast(picked), "id").dropDuplicates(["id", "t"])        # a few thousand ids, bounded by the parameter
              .withColumn("place", place).where(F.col("place") <= 4 * per_class).select("t", "y"))

    def reader(blocks: bool):
        """Word hashes of the texts of at most ``most_words`` words; ``blocks``: of one block of every longer one."""
        def run(batches):
            rows = Rows()
            for batch in slices(batches):
                got = [(y, rows(t)[0]) for t, y in zip(*(c.to_pylist() for c in batch.columns))]
                if blocks:
                    got = [(y, np.array_split(r, -(-len(r) // most_words))[zlib.crc32(r.tobytes()) % -(-len(r) // most_words)])
                           for y, r in got if len(r) > most_words]
                else:
                    got = [g for g in got if len(g[1]) <= most_words]
                yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in got], pa.int32()),
                                                  pa.array([r.astype(np.int32) for _, r in got], pa.list_(pa.int32()))], names=["y", "hashes"])
        return run

    got = sample.mapInArrow(reader(False), "y int, hashes array<int>").toArrow()
    lost = sorted(counts.keys() - set(got["y"].to_pylist()))
    if lost:                                               # all its sampled texts are long
        long = sample.where(F.col("y").isin(lost)).mapInArrow(reader(True), "y int, hashes array<int>").toArrow()
        got = pa.concat_tables([got, long])
    lost = counts.keys() - set(got["y"].to_pylist())
    if lost:
        raise RuntimeError(f"labels with rows but none in the sample: {sorted(lost)}")
    rows = [np.array(r.values, np.int64) for r in got["hashes"]]
    order = sorted(range(len(rows)), key=lambda k: (len(rows[k]), zlib.crc32(rows[k].tobytes())))     # whatever the partitions
    model = fit([rows[k] for k in order], got["y"].to_numpy()[order].astype(np.int64))
    _calibrate(model, calibration(texts, known, picked.select("id"), model, most_words))
    return model


def predict(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, predicted`` for every row: score in 0..1, predicted 1 from 0.5 on.

    Null and empty texts are scored as texts without words.  With nothing to learn from every score is
    0.  Equal texts have equal scores; repeated rows and null ids are kept; an empty table gives no rows."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if model is not None:
            model.prepare()
            rows = Rows(model.row_of)
        for batch in slices(batches):
            if model is None:
                score = np.zeros(batch.num_rows)
            else:
                told = [rows(t) for t in batch.column(1).to_pylist()]
                score = model.score([model.logit(padded(r)) for r, _ in told], np.array([k for _, k in told], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             names=[id_col, "score", "predicted"])

    slim = docs.select(F.col(id_col), text_bytes(F.col(text_col)).alias("t"))
    if model is not None:
        model.tables = None          # worked out again in each task; the tasks carry the small arrays alone
        model.embedding = model.embedding.astype(np.float32)
    return slim.mapInArrow(run, f"{id_col} {id_type}, score double, predicted int")
