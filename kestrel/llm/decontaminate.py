"""Benchmark decontamination: size-partitioned MinHash containment search.

The search is asymmetric: short test items inside long documents.  A fixed-length
MinHash signature of a document says nothing about a passage of forty words in
it, so the *item* is sketched: the bottom-k MinHash of its shingles, with k set
by the size partition the item falls in.  With containment at least t, at most
floor((1-t) q) of the item's q shingles are missing, so any floor((1-t) q) + 1
of them, the k smallest hashes, include one that the document has.  The
partitions double in size; k is taken at the upper bound of the partition, and
so no item at or above the threshold can be missed.

Items are a table like documents.  Their shingles and sketches are written; two bit tables of fixed
size over the hashes (all shingles, and sketches alone) go to the tasks that read documents, whatever
the number of items.  A document that hits the sketch table writes those of its distinct shingles that
hit the other.  Equality joins do the rest: sketch values give the candidate pairs, and the exact
shingles (the words themselves, not hashes) verify them."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.bounded import bounded

from .common import slices, text_bytes, unused, written

MULT = 0x9E3779B97F4A7C15          # odd multiplier of the rolling combination
TABLE_BITS = 24                    # of a bit table: 2 MB


class WordHashes(dict):
    """Memo of 64-bit word hashes; emptied when it grows beyond ``limit`` words.  Words longer than ``longest``
    bytes are not remembered, so that it holds at most some 30 MB."""

    limit, longest = 1 << 17, 64

    def __missing__(self, word):
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = h
        return h


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words from the words' 64-bit hashes (wraps modulo 2**64)."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n].copy()
    for i in range(1, size):
        out *= np.uint64(MULT)
        out += codes[i:n + i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)       # spreads the low bits used by the bit table
    out ^= out >> np.uint64(32)
    return out


def sketch_size(q: int, threshold: float) -> int:
    """Bottom-k length for an item of ``q`` shingles: that of the largest item of its size partition."""
    upper = 1 << (q - 1).bit_length()
    return min(q, int(np.floor((1 - threshold) * upper + 1e-9)) + 1)


SHINGLES = "item long, item_id {item}, size int, total long, hash long, shingle binary, sketch boolean"
HITS = "id {id}, row long, mark binary, size int, hash long, shingle binary"


def _row_number(at: int) -> int:
    """A number for the ``at``-th row of a task; kept in the written table it was made for."""
    return (TaskContext.get().partitionId() << 40) + at


def item_shingles(items: DataFrame, item_col: str, text_col: str, shingle: int, threshold: float) -> DataFrame:
    """A row for each distinct shingle of an item row, marked where it belongs to the sketch; written.
    An item shorter than ``shingle`` words is one shingle of all its words; blank ones have none."""
    item_type = items.schema[item_col].dataType.simpleString()
    names = [x.split()[0] for x in SHINGLES.split(", ")]

    def run(batches):
        at, memo = 0, WordHashes()
        for batch in slices(batches):
            rows = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words, number = words_of(text), _row_number(at)
                at += 1
                if not words:
                    continue
                size = min(shingle, len(words))
                hashes = shingle_hashes(np.array([memo[w] for w in words], np.uint64), size)
                first = {}
                for j, h in enumerate(hashes.tolist()):
                    first.setdefault(b" ".join(words[j:j + size]), h)
                least = sorted(set(first.values()))[:sketch_size(len(first), threshold)]
                sketch = set(least)
                rows += [(number, i, size, len(first), h, s, h in sketch) for s, h in first.items()]
            if rows:
                number, place, size, total, h, text, sketch = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int64()), batch.column(0).take(pa.array(place)), pa.array(size, pa.int32()), pa.array(total, pa.int64()),
                     pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(text, pa.binary()), pa.array(sketch, pa.bool_())], names=names)

    rows = items.select(F.col(item_col).alias("i"), text_bytes(F.col(text_col)).alias("t"))
    return written(rows.mapInArrow(run, SHINGLES.format(item=item_type)), "decontaminate-items")


def bit_tables(shingles: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By shingle length: (bits of all shingle hashes, bits of the sketches).  At most 2^18 words of each reach the driver."""
    spot = F.col("hash").bitwiseAND((1 << TABLE_BITS) - 1)
    words = (shingles.groupBy("size", "sketch", F.shiftright(spot, 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 AS int))")).alias("bits")).collect())
    plain: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in words:
        both = plain.setdefault(r["size"], tuple(np.zeros(1 << (TABLE_BITS - 6), np.int64) for _ in range(2)))
        both[0][r["word"]] |= r["bits"]
        if r["sketch"]:
            both[1][r["word"]] |= r["bits"]
    return plain


def _hit(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    spot = hashes & np.uint64(64 * len(table) - 1)
    return (table.view(np.uint64)[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def shingle_hits(docs: DataFrame, id_col: str, text_col: str, tables: dict) -> DataFrame:
    """``id, row, mark`` (SHA-1 of the text) ``, size, hash, shingle``: of every document that hits a sketch table, its
    distinct shingles that hit the tables; written."""
    id_type, names = docs.schema[id_col].dataType.simpleString(), [x.split()[0] for x in HITS.split(", ")]

    def run(batches):
        at, memo = 0, WordHashes()
        for batch in slices(batches):
            rows = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words, number = words_of(text), _row_number(at)
                at += 1
                if not words:
                    continue
                codes = np.array([memo[w] for w in words], np.uint64)
                found = {}
                for size, (every, sketches) in tables.items():
                    hashes = shingle_hashes(codes, size)
                    where = np.flatnonzero(_hit(every, hashes))
                    if len(where) and _hit(sketches, hashes[where]).any():
                        for j in where.tolist():
                            found.setdefault((size, b" ".join(words[j:j + size])), int(hashes[j]))
                if found:
                    mark = hashlib.sha1(text).digest()
                    rows += [(i, number, mark, size, h, s) for (size, s), h in found.items()]
            if rows:
                place, number, mark, size, h, text = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(place)), pa.array(number, pa.int64()), pa.array(mark, pa.binary()), pa.array(size, pa.int32()),
                     pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(text, pa.binary())], names=names)

    rows = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("t"))
    return written(rows.mapInArrow(run, HITS.format(id=id_type)), "decontaminate-hits")


def _contained(docs: DataFrame, items: DataFrame, id_col, text_col, item_col, item_text_col, shingle, threshold) -> DataFrame:
    """``row, id, mark, item, item_id, shared, total`` of every document row that contains an item row."""
    known = item_shingles(items, item_col, item_text_col, shingle, threshold)
    hits = shingle_hits(docs, id_col, text_col, bit_tables(known))
    sketches = known.where("sketch").select("item", "size", "hash")
    pairs = hits.select("row", "size", "hash").join(bounded(sketches), ["size", "hash"]).select("row", "item").distinct()
    # exact: the same words, not the same hash
    same = hits.join(bounded(known.select("item", "item_id", "total", "size", "shingle")), ["size", "shingle"])
    counts = same.groupBy("row", "id", "mark", "item", "item_id", "total").agg(F.count(F.lit(1)).alias("shared"))
    return counts.where(F.col("shared") >= threshold * F.col("total") - 1e-9).join(pairs, ["row", "item"], "left_semi")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``id, item_id, shared, item_shingles, containment`` for every document and item
    whose containment (share of the item's distinct word shingles found in the document) is at
    least ``threshold``.

    Items shorter than ``shingle`` words are one shingle of all their words.  Null or blank texts match
    nothing; whole texts are read, and long ones cost in proportion to their length.  Repeated documents or
    items are reported repeated.  Empty tables give no rows; other columns are not read, so their names
    can't clash.  Nothing of either table passes through the driver but bit tables of fixed size."""
    found = _contained(docs, items, id_col, text_col, item_col, item_text_col, shingle, threshold)
    return found.select(F.col("id").alias(id_col), "item_id", "shared", F.col("total").alias("item_shingles"),
                        (F.col("shared") / F.col("total")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.  A row is known by its id and text, so that of
    rows sharing an id only the contaminated ones go; null ids are ids like any other."""
    found = _contained(docs, items, id_col, text_col, item_col, item_text_col, shingle, threshold).select("id", "mark").distinct()
    bad, own = bounded(found), unused(docs, "text_mark")
    marked = docs.withColumn(own, F.unhex(F.sha1(text_bytes(F.col(text_col)))))
    return marked.join(bad, marked[id_col].eqNullSafe(bad["id"]) & (marked[own] == bad["mark"]), "left_anti").select(*docs.columns)
