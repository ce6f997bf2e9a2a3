"""Hard negatives by exact inner-product search with length buckets and sorted coordinate lists.

Vectors of one label are ordered by length and cut into buckets; a bucket holds its vectors and, for
every coordinate, their order by that coordinate.  A query with a least score t to reach needs,
in a bucket whose longest vector has length l, a cosine of c = t / (|q| l).  Above 1 the bucket is
passed over.  Else every unit vector v with q.v >= c has its coordinate f within
q_f c -+ sqrt((1 - q_f^2)(1 - c^2)), which holds for the bucket's vectors scaled by their own lengths;
for the query's focus coordinates (its largest) these ranges are cut out of the sorted lists and
intersected, and the survivors are scored exactly in integers.

Two rounds over (query block, bucket) pairs: buckets of the query's own label give the positives,
buckets of other labels the negatives.  Every round starts from scores found inside the query
block itself (queries are rows, too), so the ranges are narrow from the first bucket on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written
from .grid import numbered, pairs

SCALE = 256
BUCKET, QUERIES = 4096, 1024       # vectors of a bucket, queries of a block
FOCUS = 4                          # focus coordinates of a query
SAFE = float(1 << 53)              # products of smaller lengths are exact in double precision
LIMIT = float(1 << 56)             # squared lengths from here on could overflow 100 times a score


def quantised(vectors: DataFrame, is_anchor: Column, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """``id, label, anchor, q, sq``: integer components floor(256 x) and the squared length, of the
    rows that take part; repeated rows once."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vec_col).alias("v"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(~broken)
    q = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE))
    sq = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.select("id", "label", "anchor", q.alias("q")).distinct().withColumn("sq", sq).where(F.col("sq") < LIMIT)


def _first(rows: DataFrame, most: int) -> DataFrame:
    """Of the rows of one label and vector those with the ``most`` smallest ids: the others come after
    them in every result.  Spark limits the groups in the map tasks, so a common vector moves few rows."""
    place = F.row_number().over(Window.partitionBy("label", "q").orderBy(F.col("id").asc_nulls_last()))
    return rows.withColumn("place", place).where(F.col("place") <= most).drop("place")


def _matrix(lists: list) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    out = np.zeros((len(lists), max(map(len, lists), default=0)), np.int64)
    for i, row in enumerate(lists):
        out[i, :len(row)] = row
    return out


def _row(names: str, types: dict, *values) -> pa.RecordBatch:
    """A batch of one row; ``types`` for the columns whose Arrow type isn't plain."""
    columns = [pa.array([v], types.get(n)) for n, v in zip(names.split(), values)]
    return pa.RecordBatch.from_arrays(columns, names=names.split())


class Bucket:
    """Vectors of one label and of similar length, with the order of every coordinate."""

    def __init__(self, row: dict):
        self.label, self.ids, self.longest, self.shortest = row["label"], row["ids"], row["longest"], row["shortest"]
        self.x = np.frombuffer(row["vectors"], np.int64).reshape(len(self.ids), -1)
        self.order = np.frombuffer(row["orders"], np.uint16).reshape(self.x.shape[1], -1)
        self.lists = np.take_along_axis(self.x.T, self.order.astype(np.int64), axis=1)
        self.real = self.x.astype(np.float64)

    def reaching(self, q: np.ndarray, length: float, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(positions, exact scores) of a set of vectors that holds every one with a score of ``least`` or more."""
        q = q[:self.x.shape[1]]
        at = self._feasible(q, length, least)
        if not len(at):
            return at, np.empty(0, np.int64)
        all_of_them = 2 * len(at) > len(self.ids)
        x = self.real if length * self.longest < SAFE else self.x
        got = (x if all_of_them else x[at])[:, :len(q)] @ q.astype(x.dtype)
        return at, (got[at] if all_of_them else got).astype(np.int64)

    def _feasible(self, q: np.ndarray, length: float, least: float) -> np.ndarray:
        everything = np.arange(len(self.ids))
        if least <= 0 or not len(q):
            return everything if least <= 0 else everything[:0]
        cosine = least / (length * self.longest) if length and self.longest else np.inf
        if cosine > 1 + 1e-9:
            return everything[:0]
        cosine, ranges = min(cosine, 1.0), []
        for f in np.argsort(-np.abs(q))[:FOCUS].tolist():
            share = q[f] / length
            wide = np.sqrt(max(0.0, (1 - share * share) * (1 - cosine * cosine)))
            low = -1.0 if share <= -cosine else share * cosine - wide
            high = 1.0 if share >= cosine else share * cosine + wide
            low = low * (self.shortest if low > 0 else self.longest) - 1e-6 * self.longest       # rounding
            high = high * (self.longest if high > 0 else self.shortest) + 1e-6 * self.longest
            i, j = np.searchsorted(self.lists[f], low, "left"), np.searchsorted(self.lists[f], high, "right")
            ranges.append((j - i, f, i, j, low, high))
        ranges.sort()
        _, f, i, j, _, _ = ranges[0]
        at = self.order[f, i:j].astype(np.int64)
        for _, f, _, _, low, high in ranges[1:]:
            value = self.x[at, f]
            at = at[(value >= low) & (value <= high)]
        return at

    def best(self, at: np.ndarray, scores: np.ndarray, most: int) -> list[tuple[int, object]]:
        """The first ``most`` (score, id) by descending score, then id (nulls last)."""
        if len(at) > most:
            near = scores >= np.partition(scores, len(scores) - most)[len(scores) - most]
            at, scores = at[near], scores[near]
        found = sorted((-s, self.ids[i] is None, self.ids[i]) for s, i in zip(scores.tolist(), at.tolist())) if most else []
        return [(-s, i) for s, _, i in found[:most]]


def buckets_of(rows: DataFrame, id_type: str, label_type: str) -> DataFrame:
    """Length buckets with their sorted coordinate lists, written to the shared folder."""
    names = "part seq label longest shortest ids vectors orders"

    def build(batches):
        part, seq, held, types = TaskContext.get().partitionId(), 0, [], {}

        def bucket():
            x = _matrix([r["q"] for r in held])
            orders = np.argsort(x, axis=0, kind="stable").T.astype(np.uint16)
            return _row(names, types, part, seq, held[0]["label"], float(np.sqrt(held[0]["sq"])), float(np.sqrt(held[-1]["sq"])),
                        [r["id"] for r in held], x.tobytes(), orders.tobytes())

        for batch in slices(batches, 1024):
            types = {"part": pa.int32(), "seq": pa.int32(), "label": batch.schema.field("label").type, "ids": pa.list_(batch.schema.field("id").type)}
            for row in batch.to_pylist():
                if held and (len(held) == BUCKET or row["label"] != held[0]["label"]):
                    yield bucket()
                    held, seq = [], seq + 1
                held.append(row)
        if held:
            yield bucket()

    order = (F.col("label"), F.desc("sq"), F.col("id"))
    dealt = rows.select("id", "label", "q", "sq").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"part int, seq int, label {label_type}, longest double, shortest double, ids array<{id_type}>, vectors binary, orders binary"
    return written(dealt.mapInArrow(build, schema), "negatives-buckets")


def _seeds(x: np.ndarray, labels: list):
    """For every query of a block: (scores with all queries of the block, mask of those with its label)."""
    of = np.array([labels.index(v) for v in labels])
    lengths = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    real = x.astype(np.float64) if not len(x) or lengths.max() ** 2 < SAFE else x
    for at in range(0, len(x), 128):
        scores = (real[at:at + 128] @ real.T).astype(np.int64)
        for i in range(len(scores)):
            yield scores[i], of == of[at + i]


def _nth(scores: np.ndarray, n: int) -> int | None:
    return int(np.partition(scores, len(scores) - n)[len(scores) - n]) if 0 < n <= len(scores) else None


def blocks_of(queries: DataFrame, label_type: str, positives: int, negatives: int) -> DataFrame:
    """A row for each block: its queries, the positive scores whose windows are searched (``wanted``; none in
    the first round), and the least score that is still of use (``least``), told by the block's own queries:
    of each query in the first round, of each window in the second."""
    names = "block places labels vectors wanted least"

    def build(key, table):
        rows, types = table.to_pylist(), {"block": pa.int32(), "places": pa.list_(pa.int64()),
                                          "labels": pa.list_(table.schema.field("label").type),
                                          "wanted": pa.list_(pa.list_(pa.int64())), "least": pa.list_(pa.list_(pa.int64()))}
        x, labels, least = _matrix([r["q"] for r in rows]), [r["label"] for r in rows], []
        for r, (scores, same) in zip(rows, _seeds(x, labels)):
            if r["wanted"] is None:
                least.append([_nth(scores[same], positives + 1)])
                continue
            others = scores[~same]
            inside = [others[(50 * p <= 100 * others) & (100 * others <= 95 * p)] for p in r["wanted"]]
            known = [_nth(s, negatives) for s in inside]
            least.append([-(-p // 2) if n is None else n for p, n in zip(r["wanted"], known)])
        return pa.Table.from_batches([_row(names, types, rows[0]["block"], [r["place"] for r in rows], labels, x.tobytes(),
                                           [r["wanted"] or [] for r in rows], least)])

    schema = f"block int, places array<long>, labels array<{label_type}>, vectors binary, wanted array<array<long>>, least array<array<long>>"
    return queries.select("block", "place", "label", "q", "wanted").groupBy("block").applyInArrow(build, schema)


def _searched(both: DataFrame, id_type: str, most: int, own: bool) -> DataFrame:
    """``place, wanted, score, id``: of every pair of block and bucket the first ``most`` rows of each query
    (``own``: of its label) or of each of its windows (other labels)."""
    def run(batches):
        for batch in batches:
            out, kind = [], batch.schema.field("ids").type.value_type
            for row in slices([batch], 1):
                row = row.to_pylist()[0]
                mine = [i for i, label in enumerate(row["labels"]) if (label == row["label"]) == own]
                if not mine:
                    continue
                bucket, x = Bucket(row), np.frombuffer(row["block_vectors"], np.int64).reshape(len(row["labels"]), -1)
                lengths = np.sqrt((x.astype(float) ** 2).sum(axis=1))
                for i in mine:
                    least = row["least"][i]
                    if own:
                        floor = least[0] if least[0] is not None else -np.inf
                        at, scores = bucket.reaching(x[i], lengths[i], floor)
                        enough = scores >= floor
                        out += [(row["places"][i], None, s, n) for s, n in bucket.best(at[enough], scores[enough], most)]
                    elif least:
                        at, scores = bucket.reaching(x[i], lengths[i], min(least))
                        for p, floor in zip(row["wanted"][i], least):
                            inside = (scores >= floor) & (50 * p <= 100 * scores) & (100 * scores <= 95 * p)
                            out += [(row["places"][i], p, s, n) for s, n in bucket.best(at[inside], scores[inside], most)]
            if out:
                place, wanted, score, ids = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(wanted, pa.int64()), pa.array(score, pa.int64()),
                                                  pa.array(ids, kind)], names=["place", "wanted", "score", "id"])

    found = both.mapInArrow(run, f"place long, wanted long, score long, id {id_type}")
    first = F.row_number().over(Window.partitionBy("place", "wanted").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return found.withColumn("rank", first).where(F.col("rank") <= most)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
         positives: int = 5, negatives: int = 3) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(256 x), scores are integer inner products, higher ones first, ties by
    smaller id (null ids last).  The positives of an anchor (rows where ``is_anchor`` is true) are
    its first ``positives`` rows of the same label and another id; for each, the first ``negatives``
    rows of other labels with 50 p <= 100 n <= 95 p are returned, p and n the two scores.

    Rows with a null label, a null vector or a null or non-finite component take no part, nor do rows
    whose squared length reaches 2^56 (100 times a score would leave 64 bits).  Rows repeated in full
    count once.  Vectors of different widths are compared as if filled up with zeros; empty ones
    score 0.  Anchors without positives or negatives give no rows; so does an empty table.  Other
    columns are not read, so their names can't clash.  Nothing is capped: of equal vectors of
    one label only the first ``positives + 1`` ids are searched because no later one can be returned."""
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    rows = written(quantised(vectors, is_anchor, id_col, label_col, vec_col), "negatives-rows")
    anchors = rows.where("anchor")
    queries = written(anchors.select("label", "q").distinct().withColumn("place", F.monotonically_increasing_id()), "negatives-queries")
    n_queries = queries.count()
    n_blocks = -(-n_queries // QUERIES)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(max(n_blocks, 1))).cast("int"))
    buckets, n_buckets = numbered(buckets_of(_first(rows, max(positives + 1, negatives)), id_type, label_type), "bucket")

    def round_of(asked: DataFrame, most: int, own: bool) -> DataFrame:
        blocks = blocks_of(asked, label_type, positives, negatives).withColumnRenamed("vectors", "block_vectors")
        return _searched(pairs(blocks, n_blocks, buckets, n_buckets), id_type, most, own)

    nothing = F.lit(None).cast("array<long>")
    near = round_of(queries.withColumn("wanted", nothing), positives + 1, True)
    near = written(near.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("near")), "negatives-near")
    windows = F.array_distinct(F.transform("near", lambda x: x["score"]))
    far = round_of(queries.join(near, "place").withColumn("wanted", windows), negatives, False)
    far = far.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("wanted", "rank", "id", "score"))).alias("far"))
    answers = queries.select("place", F.col("label").alias("of"), F.col("q").alias("like")).join(near, "place").join(far, "place")
    found = anchors.join(answers, (F.col("label") == F.col("of")) & (F.col("q") == F.col("like")))
    others = F.filter("near", lambda x: ~x["id"].eqNullSafe(F.col("anchor_id")))
    found = (found.select(F.col("id").alias("anchor_id"), "near", "far")
             .select("anchor_id", "far", F.explode(F.slice(others, 1, positives)).alias("p"))
             .select("anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"),
                     F.explode(F.filter("far", lambda x: x["wanted"] == F.col("p.score"))).alias("n")))
    return found.select("anchor_id", "positive_id", F.col("n.rank").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score",
                        F.col("n.score").alias("negative_score"))
