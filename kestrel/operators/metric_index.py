"""J2 for large inputs: an exact kNN join that passes over far-away rows, and a named approximate one.

``pivot_knn_join`` is exact.  Every row belongs to the cell of its nearest pivot and is kept with its distance
to it; a cell is cut into rings of similar distance (a block: at most ``block_rows`` rows).  In the first
round a query meets the ring of its own cell that fits its distance best; the k-th distance found bounds what
follows.  By the triangle inequality a ring with pivot distances [lo, hi] around pivot p holds nothing
nearer than max(d(q, p) - hi, lo - d(q, p)), so in the second round a query goes only to the rings for which
this is within its bound.  A ring with very many queries is met in several groups, copies of one row fill
several rings of one distance.  Rings grow with the table where the parameter would make more than ``RINGS`` a
pivot: a query travels once for each ring it has to meet, and that must not grow with the rows.

``hashed_knn_join`` is approximate, and only used by name: rows meet where the signs of random projections agree
(several tables, buckets one bit away probed too); inside a bucket the join is exact."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..session import materialize, shuffles_dropped
from .bounded import bounded
from .neighbors import knn_join, nearest, squared
from .trees import matrix

PIVOTS = 128
BLOCK_ROWS = 1024       # rows of a ring; more where that made over RINGS rings a pivot
RINGS = 2
GROUP_QUERIES = 8192    # queries that meet a ring at once, about
TILE = 256
AT_ONCE = 2_000_000      # (query, probed bucket) rows that are joined at once
SLACK = 1e-9            # relative room for rounding in the bounds


def choose_pivots(refs: DataFrame, vec: str, n: int) -> np.ndarray:
    """The ``n`` distinct vectors with the smallest hashes."""
    rows = refs.select(F.col(vec).cast("array<double>").alias("x")).where(F.col("x").isNotNull())
    picked = rows.withColumn("h", F.xxhash64("x")).groupBy("h").agg(F.min("x").alias("x")).orderBy("h").limit(n).collect()
    return np.array([r["x"] for r in picked], np.float64)


def _placed(df: DataFrame, key: str, vec: str, pivots: np.ndarray) -> DataFrame:
    """``key, x, cell, d``: the nearest pivot and the distance to it; written."""
    rows = df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("x")).where(F.col("x").isNotNull())

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                d = np.sqrt(squared(matrix(part.column(1)), pivots))
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                                 names=["key", "x", "cell", "d"])

    return materialize(rows.mapInArrow(place, f"key {rows.schema['key'].dataType.simpleString()}, x array<double>, cell int, d double"), "knn-placed")


def _rings(placed: DataFrame, block_rows: int) -> DataFrame:
    """``block, cell, lo, hi, n, keys, vectors``: a row for each ring; written."""
    kind = placed.schema["key"].dataType.simpleString()
    order = ("cell", "d", "key")

    def cut(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def ring(rows):
            t = pa.Table.from_batches(rows).combine_chunks()
            d = t.column("d").to_numpy()
            keys = t.column("key").chunk(0)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([t.column("cell")[0].as_py()], pa.int32()), pa.array([d[0]]), pa.array([d[-1]]),
                 pa.array([len(d)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(d)], pa.int32()), keys),
                 pa.array([matrix(t.column("x").chunk(0)).tobytes()], pa.binary())], names=["block", "cell", "lo", "hi", "n", "keys", "vectors"])

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            at = 0
            while at < batch.num_rows:
                same = at + int(np.searchsorted(cells[at:], cells[at], "right"))
                if held and held[0].column("cell")[0].as_py() != cells[at]:
                    yield ring(held)
                    held, size, seq = [], 0, seq + 1
                stop = min(same, at + block_rows - size)
                held.append(batch.slice(at, stop - at))
                size, at = size + stop - at, stop
                if size == block_rows:
                    yield ring(held)
                    held, size, seq = [], 0, seq + 1
        if held:
            yield ring(held)

    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.mapInArrow(cut, f"block long, cell int, lo double, hi double, n long, keys array<{kind}>, vectors binary"), "knn-rings")


def _met(asked: DataFrame, rings: DataFrame, groups: int, k: int, exclude_self: bool) -> DataFrame:
    """``qkey, rkey, dist2, compared``: what every asked (query, block) gives, the best k within the query's ``bound``
    (null: none), and a row a group with the number of pairs compared."""
    kind = rings.schema["keys"].dataType.elementType.simpleString()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["qkey", "rkey", "dist2", "compared"]
        qk, rk = left.column("key").combine_chunks(), right.column("keys").combine_chunks()
        kinds = [qk.type, rk.type.value_type, pa.float64(), pa.int64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        rk = rk.flatten()
        refs = np.frombuffer(right.column("vectors")[0].as_py(), np.float64).reshape(len(rk), -1)
        x, bound = matrix(left.column("x").combine_chunks()), left.column("bound").to_numpy()          # a null bound is NaN
        rows, cols, dist = nearest(x, qk.to_numpy(zero_copy_only=False), refs, rk.to_numpy(zero_copy_only=False), k, exclude_self, bound)
        found = pa.table([qk.take(pa.array(rows)), rk.take(pa.array(cols)), pa.array(dist), pa.nulls(len(rows), pa.int64())], names=names)
        note = pa.table([pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]), pa.nulls(1, pa.float64()), pa.array([len(x) * len(refs)])], names=names)
        return pa.concat_tables([found, note])

    salt = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
    left = asked.select("block", salt.alias("salt"), "key", "x", "bound")
    right = rings.select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("salt"), "keys", "vectors")
    met = left.groupBy("block", "salt").cogroup(right.groupBy("block", "salt"))
    return materialize(met.applyInArrow(meet, f"qkey {kind}, rkey {kind}, dist2 double, compared long"), "knn-met")


def _first(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("qkey").orderBy("dist2", "rkey"))
    return found.where(F.col("qkey").isNotNull()).select("qkey", "rkey", "dist2").withColumn("nn_rank", place.cast("int")).where(F.col("nn_rank") <= k)


def pivot_knn_join(queries: DataFrame, refs: DataFrame, key: str, vec: str, k: int, exclude_self: bool = True, pivots: int = PIVOTS,
                   block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(``qkey, rkey, dist2, nn_rank`` - the rows ``knn_join`` returns - and one row ``queries, refs, compared``:
    the two sides' sizes and the pairs whose distance was computed).  Keys are unique and not null; rows
    without a vector take no part.  Vectors have no missing components."""
    centre = choose_pivots(refs, vec, pivots)
    if not len(centre):
        empty = queries.select(F.col(key).alias("qkey"), F.col(key).alias("rkey"), F.lit(0.0).alias("dist2"), F.lit(0).alias("nn_rank")).where("false")
        return empty, queries.agg(F.count(F.lit(1)).alias("queries"), F.lit(0).cast("long").alias("refs"), F.lit(0).cast("long").alias("compared"))
    placed = _placed(refs, key, vec, centre)
    asked = placed if queries is refs else _placed(queries, key, vec, centre)
    sizes = asked.agg(F.count(F.lit(1)).alias("queries")).crossJoin(placed.agg(F.count(F.lit(1)).alias("refs"))).first()
    rings = _rings(placed, max(block_rows, -(-sizes["refs"] // (RINGS * pivots))))
    groups = max(1, -(-sizes["queries"] // GROUP_QUERIES))
    meta = bounded(rings.select("block", F.col("cell").alias("in_cell"), "lo", "hi"))
    gap = F.greatest(F.col("lo") - F.col("d"), F.col("d") - F.col("hi"), F.lit(0.0))
    home = (asked.select("key", "cell", "d").join(meta, F.col("cell") == F.col("in_cell"))
            .groupBy("key").agg(F.min_by("block", F.struct(gap, F.col("block"))).alias("block")))
    nothing = F.lit(None).cast("double").alias("bound")
    near = _met(asked.join(home, "key").select("block", "key", "x", nothing), rings, groups, k, exclude_self)
    kth = _first(near, k).where(F.col("nn_rank") == k).select(F.col("qkey").alias("key"), F.col("dist2").alias("bound"))
    limits = np.array([[r["cell"], r["hi"]] for r in rings.groupBy("cell").agg(F.max("hi").alias("hi")).collect()])      # a row a pivot
    radius = np.full(len(centre), -np.inf)
    radius[limits[:, 0].astype(int)] = limits[:, 1]

    def reach(batches):
        """Cells a query has to look into, with its distance to their pivots."""
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                d = np.sqrt(squared(matrix(part.column(1)), centre))
                limit = np.sqrt(part.column(2).to_numpy(zero_copy_only=False).astype(np.float64))
                i, cell = np.nonzero((radius >= 0) & ~(d - radius - SLACK * (d + np.abs(radius)) > limit[:, None]))
                rows = part.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell.astype(np.int32)), pa.array(d[i, cell])],
                                                 names=["key", "x", "bound", "cell", "d"])

    kind = asked.schema["key"].dataType.simpleString()
    rest = asked.select("key", "x").join(kth, "key", "left").select("key", "x", "bound")
    rest = rest.mapInArrow(reach, f"key {kind}, x array<double>, bound double, cell int, d double").join(meta, F.col("cell") == F.col("in_cell"))
    rest = rest.where(F.col("bound").isNull() | (gap - SLACK * (F.col("d") + F.col("hi")) <= F.sqrt("bound")))
    rest = rest.join(home.select(F.col("key").alias("at"), F.col("block").alias("done")), (F.col("key") == F.col("at")) & (F.col("block") == F.col("done")),
                     "left_anti")
    far = _met(rest.select("block", "key", "x", "bound"), rings, groups, k, exclude_self)
    both = near.unionByName(far)
    counts = both.agg(F.lit(sizes["queries"]).cast("long").alias("queries"), F.lit(sizes["refs"]).cast("long").alias("refs"),
                      F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))
    return _first(both, k), counts


def hashed_knn_join(queries: DataFrame, refs: DataFrame, key: str, vec: str, k: int, exclude_self: bool = True, tables: int = 8, bits: int = 5,
                    seed: int = 42) -> DataFrame:
    """Approximate ``qkey, rkey, dist2, nn_rank``: the nearest among the rows that share a bucket with the query in one of
    ``tables`` tables.  A bucket is the signs of ``bits`` random projections of the vectors less their mean; a
    query also looks into the buckets one sign away.  Distances are exact; neighbours may be missed, and a query
    that meets fewer than k rows returns fewer.  More tables or fewer bits: better recall, more work.

    A row is written once, with its buckets; vectors are copied to their buckets in the join alone, for about ``AT_ONCE``
    copies of queries at a time (a table at least), and the files of a join are gone before the next begins."""
    mean = np.array([r["m"] for r in refs.select(F.posexplode(F.col(vec).cast("array<double>")).alias("j", "v")).groupBy("j")
                     .agg(F.avg("v").alias("m")).orderBy("j").collect()])                     # a row a dimension
    planes = np.random.default_rng(seed).normal(size=(tables * bits, len(mean)))

    def signed(df: DataFrame) -> DataFrame:
        """``key, vec, codes``: a row for each row, with its bucket in every table; floats stay floats."""
        kind = df.schema[vec].dataType
        plain = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
        rows = df.select(F.col(key), (F.col(vec) if plain else F.col(vec).cast("array<double>")).alias(vec)).where(F.col(vec).isNotNull())

        def code(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, TILE):
                    part = batch.slice(at, TILE)
                    side = ((matrix(part.column(1)) - mean) @ planes.T > 0).reshape(part.num_rows, tables, bits)
                    bucket = (side * (1 << np.arange(bits))).sum(axis=2) | np.arange(tables) << bits
                    codes = pa.ListArray.from_arrays(pa.array(np.arange(0, bucket.size + 1, tables, dtype=np.int32)), pa.array(bucket.astype(np.int64).ravel()))
                    yield pa.RecordBatch.from_arrays([*part.columns, codes], names=[key, vec, "codes"])

        kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        return materialize(rows.mapInArrow(code, f"{key} {kind[key]}, {vec} {kind[vec]}, codes array<bigint>"), "knn-hashed")

    given = signed(refs)
    asked = given if queries is refs else signed(queries)
    n = max(asked.count(), 1)
    flips = [0, *(1 << i for i in range(bits))]

    def met(first: int, last: int) -> DataFrame:
        """The nearest of each query that share a bucket with it in the tables ``first`` to ``last - 1``; written."""
        some = F.slice("codes", first + 1, last - first)
        probes = F.flatten(F.transform(some, lambda c: F.array(*[c.bitwiseXOR(F.lit(x).cast("long")) for x in flips])))
        found = knn_join(asked.select(key, vec, F.explode(probes).alias("bucket")), given.select(key, vec, F.explode(some).alias("bucket")),
                         key, vec, k, by=["bucket"], exclude_self=exclude_self)
        return materialize(_first(found.groupBy("qkey", "rkey").agg(F.min("dist2").alias("dist2")), k), "knn-table")

    step = max(1, AT_ONCE // (n * len(flips)))
    with shuffles_dropped(asked.sparkSession):
        parts = [met(at, min(at + step, tables)) for at in range(0, tables, step)]
    once = reduce(DataFrame.unionByName, parts).groupBy("qkey", "rkey").agg(F.min("dist2").alias("dist2"))
    return _first(once, k)
