"""Ranked lexical search: impact vectors in length buckets, pruned by norms and coordinate bounds.

A document's impact vector holds, for each of its terms, the damped frequency
(10^9 tf) div (1000 tf + 8 m); an item's vector holds its term counts times the terms' weights.  The
score is their inner product.  Document vectors are ordered by length and cut into buckets;
a bucket holds one list of (document, impact) for each term, its largest impact, and its longest
vector.  For an item whose tenth best score so far is t,

* the bucket is passed over if |item| times the longest length is below t (Cauchy-Schwarz);
* otherwise terms are set aside, weakest first, as long as what they can add (the lesser of the sum
  of their largest contributions and their Cauchy-Schwarz bound) stays below t: a document that
  holds only such terms can't reach t.  Candidates are the documents in the other terms' lists;
* candidates are scored exactly with integers over all terms.

Vectors hold only terms that some item may ask for.  These are told by a bit table of fixed size
over the items' terms, whatever their number; a term that passes it by chance is never asked for."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import batch_of, slices, text_bytes, written
from .grid import numbered, pairs

SCALE, DAMP, FREE, SPREAD = 1_000_000_000, 8, 25, 75      # fixed values of the score: 10^9, 8, 100 - 75, 75
TABLE_BITS = 22                     # of the bit table: 512 kB
BUCKET, POSTINGS = 4096, 1 << 20    # documents and entries of a bucket
ITEMS, ITEM_TERMS = 512, 1 << 18    # items and terms of a block
SAFE_SLACK = 1 + 1e-9               # bounds are doubles: never below the true value

# a term is a run of ASCII letters, digits and of all bytes of other characters, A-Z lower-cased
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def item_vectors(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item_id, item, term, k``: a row for each distinct term of an item; ``item`` numbers the distinct rows."""
    item_type = items.schema[item_col].dataType.simpleString()
    rows = written(items.select(F.col(item_col).alias("item_id"), text_bytes(F.col(text_col)).alias("t")).distinct()
                   .withColumn("item", F.monotonically_increasing_id()), "lexical-items")

    def count(batches):
        for batch in slices(batches):
            at, terms, counts = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                seen = Counter(terms_of(text))
                at += [i] * len(seen)
                terms += seen.keys()
                counts += seen.values()
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(terms, pa.binary()),
                                              pa.array(counts, pa.int64())], names=["item_id", "item", "term", "k"])

    return written(rows.mapInArrow(count, f"item_id {item_type}, item long, term binary, k long"), "lexical-item-terms")


def bit_table(terms: DataFrame) -> np.ndarray:
    """One bit for each low part of a term's hash; at most 2^16 words reach the driver."""
    spot = terms.select(F.xxhash64("term").bitwiseAND((1 << TABLE_BITS) - 1).alias("spot"))
    words = (spot.groupBy(F.shiftright("spot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 AS int))")).alias("bits")).collect())
    out = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for r in words:
        out[r["word"]] = r["bits"]
    return np.unpackbits(out.astype("<i8").view(np.uint8), bitorder="little").astype(bool)


def document_vectors(docs: DataFrame, id_col: str, text_col: str, asked: np.ndarray) -> DataFrame:
    """``id, n, terms, tf`` of every document with at least one term; ``terms`` are those in the bit table."""
    id_type = docs.schema[id_col].dataType.simpleString()
    low = (1 << TABLE_BITS) - 1

    def count(batches):
        known: dict[bytes, bool] = {}           # short words only, bounded: 2^16 of at most 64 bytes
        for batch in slices(batches):
            at, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                mine, counts = [], []
                for term, k in Counter(words).items():
                    hit = known.get(term)
                    if hit is None:
                        hit = bool(asked[xxh64_intdigest(term, 42) & low])
                        if len(term) <= 64:
                            if len(known) >= 1 << 16:
                                known.clear()
                            known[term] = hit
                    if hit:
                        mine.append(term)
                        counts.append(k)
                at.append(i)
                sizes.append(len(words))
                terms.append(mine)
                tfs.append(counts)
            yield batch_of(pa.schema([("id", batch.schema.field(0).type), ("n", pa.int64()), ("terms", pa.list_(pa.binary())),
                                      ("tf", pa.list_(pa.int64()))]),
                           [batch.column(0).take(pa.array(at, pa.int64())), sizes, terms, tfs])

    rows = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("t"))
    return rows.mapInArrow(count, f"id {id_type}, n long, terms array<binary>, tf array<long>")


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    m = FREE + (SPREAD * n * documents) // total
    return (SCALE * tf) // (1000 * tf + DAMP * m)


def buckets_of(vectors: DataFrame, id_type: str, documents: int, total: int) -> DataFrame:
    """Length buckets, longest vectors first, written to the shared folder.  Rows are dealt by (length, id),
    so copies of one text fill no task."""
    def measure(batches):
        for batch in slices(batches, 1024):
            tf, sizes = batch.column(3).flatten().to_numpy(), pa.compute.list_value_length(batch.column(3)).to_numpy()
            found = impacts(tf, np.repeat(batch.column(1).to_numpy(), sizes), documents, total)
            square = np.bincount(np.repeat(np.arange(len(sizes)), sizes), found.astype(float) ** 2, len(sizes))
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), pa.array(found, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.sqrt(square)), batch.column(2), lists],
                                             names=["id", "length", "terms", "impacts"])

    def build(batches):
        part, seq, held, entries = TaskContext.get().partitionId(), 0, [], 0
        for batch in slices(batches, 64):
            held.append(batch)
            entries += len(batch.column(2).flatten())
            if entries >= POSTINGS or sum(b.num_rows for b in held) >= BUCKET:
                yield _bucket(part, seq, pa.Table.from_batches(held))
                held, seq, entries = [], seq + 1, 0
        if held:
            yield _bucket(part, seq, pa.Table.from_batches(held))

    # documents that hold no asked term can't score above zero
    rows = vectors.where(F.size("terms") > 0).mapInArrow(measure, f"id {id_type}, length double, terms array<binary>, impacts array<long>")
    rows = written(rows, "lexical-impacts")
    dealt = rows.repartitionByRange(F.desc("length"), F.col("id")).sortWithinPartitions(F.desc("length"), "id")
    return written(dealt.mapInArrow(build, f"part int, seq int, longest double, ids array<{id_type}>, terms array<binary>, stops binary, "
                                           "docs binary, impacts binary"), "lexical-buckets")


def _bucket(part: int, seq: int, rows: pa.Table) -> pa.RecordBatch:
    """A bucket's lists: entries ordered by term, then document."""
    rows = rows.combine_chunks()
    lists = rows.column("terms").chunk(0)
    sizes = pa.compute.list_value_length(lists).to_numpy()
    words = lists.flatten().dictionary_encode()
    code, value = words.indices.to_numpy(), rows.column("impacts").chunk(0).flatten().to_numpy()
    order = np.argsort(code, kind="stable")
    docs = np.repeat(np.arange(len(sizes)), sizes)[order].astype("<i4")
    stops = np.cumsum(np.bincount(code, minlength=len(words.dictionary))).astype("<i8")
    ids = rows.column("id").chunk(0)
    values = [pa.array([v], t) for v, t in ((part, pa.int32()), (seq, pa.int32()), (rows.column("length")[0].as_py(), pa.float64()))]
    values += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, words.dictionary)]
    values += [pa.array([x.tobytes()], pa.binary()) for x in (stops, docs, value[order].astype("<i8"))]
    return pa.RecordBatch.from_arrays(values, names=["part", "seq", "longest", "ids", "terms", "stops", "docs", "impacts"])


class Lists:
    """The lists of one bucket, by term."""

    def __init__(self, row: dict):
        self.longest, self.ids = row["longest"], row["ids"]
        stops = np.frombuffer(row["stops"], "<i8").tolist()
        self.docs, self.impacts = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["impacts"], "<i8")
        self.place = {t: (a, b) for t, a, b in zip(row["terms"], [0, *stops], stops)}
        self.tops = np.maximum.reduceat(self.impacts, [0, *stops[:-1]]).tolist() if stops else []
        self.top = dict(zip(row["terms"], self.tops))

    def best(self, terms: list[bytes], weights: list[int], most: int, least: int) -> list[tuple[int, object]]:
        """The first ``most`` (score, id) with a score of at least ``least`` (above 0), by falling score, then id."""
        here = [(w * self.top[t], w, t) for t, w in zip(terms, weights) if w and t in self.top]
        if not here or self.longest * sum(w * w for _, w, _ in here) ** 0.5 * SAFE_SLACK < least:
            return []
        here.sort()
        aside, added, square = 0, 0, 0
        while aside < len(here):
            added, square = added + here[aside][0], square + here[aside][1] ** 2
            if min(added, self.longest * square ** 0.5 * SAFE_SLACK) >= least:
                break
            aside += 1
        scores = np.zeros(len(self.ids), np.int64)
        for _, w, t in here[aside:]:
            a, b = self.place[t]
            scores[self.docs[a:b]] += w * self.impacts[a:b]
        at = np.flatnonzero(scores)
        for _, w, t in here[:aside]:
            a, b = self.place[t]
            held = scores[self.docs[a:b]] > 0           # candidates only
            scores[self.docs[a:b][held]] += w * self.impacts[a:b][held]
        at = at[scores[at] >= max(least, 1)]
        if len(at) > most:
            at = at[scores[at] >= np.partition(scores[at], len(at) - most)[len(at) - most]]
        found = sorted((-s, self.ids[i] is None, self.ids[i]) for s, i in zip(scores[at].tolist(), at.tolist()))
        return [(-s, i) for s, _, i in found[:most]]


def item_blocks(terms: DataFrame, weights: DataFrame, item_type: str) -> tuple[DataFrame, int]:
    """(blocks of whole items with their weighted vectors, how many); a block's number is drawn by the item's."""
    sizes = terms.agg(F.countDistinct("item").alias("items"), F.count(F.lit(1)).alias("terms")).first()
    n = max(-(-sizes["items"] // ITEMS), -(-sizes["terms"] // ITEM_TERMS))
    vectors = (terms.join(weights, "term").groupBy("item", "item_id")
               .agg(F.collect_list(F.struct("term", (F.col("k") * F.col("w")).alias("w"))).alias("vector")))
    one = F.struct("item", "item_id", F.col("vector.term").alias("terms"), F.col("vector.w").alias("weights"))
    return vectors.groupBy(F.pmod(F.xxhash64("item"), F.lit(max(n, 1))).cast("int").alias("block")).agg(F.collect_list(one).alias("items")), n


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of every item with a score above 0, by falling score,
    then ascending id (null ids last).

    Null and empty texts have no term: such documents are not counted and never found, such items find
    nothing.  Repeated documents are documents of their own; items repeated in full count once, and items
    that share an id but not their text are ranked apart.  Empty tables give no rows.  Other columns are not
    read, so their names can't clash.  Whole texts are read, and every document can be found."""
    item_type, id_type = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    terms = item_vectors(items, item_col, item_text_col)
    vectors = written(document_vectors(docs, id_col, text_col, bit_table(terms)), "lexical-vectors")
    sums = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(2 * sums["n"] + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = terms.select("term").distinct().join(holding, "term").select("term", F.floor(1000 * F.log(ratio)).alias("w"))
    blocks, n_blocks = item_blocks(terms, weights, item_type)
    buckets, n_buckets = numbered(buckets_of(vectors, id_type, sums["n"], max(sums["l"], 1)), "bucket")
    both = pairs(blocks, n_blocks, buckets, n_buckets)

    def run(batches):
        least: dict[int, list[int]] = {}            # of the items met by this task: its best scores
        for batch in batches:
            kinds = batch.schema.field("items").type.value_type.field("item_id").type, batch.schema.field("ids").type.value_type
            for one in slices([batch], 1):
                row, out = one.to_pylist()[0], []
                lists = Lists(row)
                for item in row["items"]:
                    best = least.setdefault(item["item"], [])
                    found = lists.best(item["terms"], item["weights"], top, best[-1] if len(best) == top else 1)
                    out += [(item["item"], item["item_id"], i, s) for s, i in found]
                    best[:] = sorted(best + [s for s, _ in found], reverse=True)[:top]
                if out:
                    number, item_id, ids, scores = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(item_id, kinds[0]), pa.array(ids, kinds[1]),
                                                      pa.array(scores, pa.int64())], names=["item", "item_id", "doc_id", "score"])

    found = both.mapInArrow(run, f"item long, item_id {item_type}, doc_id {id_type}, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select(F.col("item_id").alias(item_col), "rank",
                                                                             F.col("doc_id").alias(id_col), "score")
