"""SimHash near-duplicates: deletion-variant signatures, equality join, exact verification.

A 64-bit fingerprint is cut into ``segments(k)`` = k//2 + 1 segments, so two
fingerprints at most ``k`` bits apart agree up to *one* bit in at least one
segment.  Every segment is indexed once per bit with that bit blanked (64 keys
a fingerprint); two segments differ by at most one bit exactly when they share
a variant.  Candidates come from an equality join on the variant key and are
verified on the whole fingerprint inside the join, so only true links leave it.

Large groups of near copies are never paired out.  First every fingerprint is
compared with one drawn member of each of its buckets (a map-side combined
minimum), which joins most of a group into one component.  Then only
fingerprints of *different* components meet, and in each bucket the members of
its largest component are only looked up by the others."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met, slices, text_bytes, unused, written
from .components import components

BITS = 64
SEED = 42
BLOCK = 1 << 15       # shingles counted at once, bounds memory for very long texts


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned SimHash of whole ``text``: A-Z lower-cased, words split at ASCII white space,
    ``shingle``-word shingles with repeats (fewer words: the whole sequence; none: 0)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = list(zip(starts[:n].tolist(), ends[-n:].tolist()))
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[s:e], SEED) for s, e in spans[at:at + BLOCK]], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, fp`` (fp: the 64 bits as a signed long) for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("t")).mapInArrow(run, f"id {id_type}, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, max_bits: int, *carry: str) -> DataFrame:
    """``key, fp`` (and ``carry``): one row for each blanked bit, 64 a fingerprint."""
    lo = F.lit(None).cast("int")
    width = F.lit(None).cast("int")
    for first, w in segments(max_bits):
        lo = F.when((F.col("bit") >= first) & (F.col("bit") < first + w), F.lit(first)).otherwise(lo)
        width = F.when((F.col("bit") >= first) & (F.col("bit") < first + w), F.lit(w)).otherwise(width)
    rows = fps.select("fp", *carry, F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    rows = rows.select("fp", *carry, "bit", lo.alias("lo"), width.alias("w"))
    # the segment without its blanked bit, then the bit's own number in front (6 bits)
    kept = "(fp & ~shiftleft(1L, bit)) & shiftleft(shiftrightunsigned(-1L, 64 - w), lo)"
    return rows.select(F.expr(f"shiftleft(cast(bit AS long), 58) | shiftrightunsigned({kept}, lo)").alias("key"), "fp", *carry) \
        if max(w for _, w in segments(max_bits)) <= 58 else \
        rows.select(F.expr(f"xxhash64(bit, {kept})").alias("key"), "fp", *carry)


def near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def star_links(rooted: DataFrame, max_bits: int, turn: int) -> DataFrame:
    """Links ``a, b`` between roots: every fingerprint against one member of each of its buckets.

    The member is drawn by a hash of fingerprint, bucket and ``turn``, so the buckets of a large group
    offer different members and the group grows together in very few turns; a bucket of m
    fingerprints costs m comparisons."""
    keyed = variants(rooted, max_bits, "root")
    draw = F.xxhash64("fp", "key", F.lit(turn))
    tops = (keyed.groupBy("key").agg(F.min(F.struct(draw.alias("h"), "fp", "root")).alias("top"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select(F.col("key").alias("k2"), F.col("top.fp").alias("fp2"), F.col("top.root").alias("root2")))
    return (met(keyed, tops, (F.col("key") == F.col("k2")) & (F.col("root") != F.col("root2")) & near("fp", "fp2", max_bits))
            .select(F.col("root").alias("a"), F.col("root2").alias("b")).distinct())


def merged(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """``fp, root`` with the roots that ``links`` join made one."""
    tops = components(links).withColumnRenamed("root", "top")
    return written(met(rooted, tops, rooted["root"] == tops["node"], "left")
                   .select("fp", F.coalesce("top", "root").alias("root")), "simhash-rooted")


def fingerprint_components(fps: DataFrame, max_bits: int, turns: int = 2) -> DataFrame:
    """``fp, root`` for every distinct fingerprint of the table ``fps`` (column ``fp``):
    equal roots exactly when a chain of links of at most ``max_bits`` bits joins them."""
    rooted = fps.select("fp", F.col("fp").alias("root"))
    for turn in range(turns):
        rooted = merged(rooted, star_links(rooted, max_bits, turn))

    # all links that are left lie between components: the largest component of a bucket is looked up by the rest
    keyed = variants(rooted, max_bits, "root")
    mains = (keyed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
             .agg(F.max_by("root", F.struct("n", "root")).alias("root"), F.sum("n").alias("n")).where("n > 1").drop("n"))
    rest = met(keyed, mains, ["key", "root"], "left_anti").select(F.col("key").alias("k2"), F.col("fp").alias("fp2"), F.col("root").alias("root2"))
    cross = (met(keyed, rest, (F.col("key") == F.col("k2")) & (F.col("root") != F.col("root2")) & near("fp", "fp2", max_bits))
             .select(F.col("root").alias("a"), F.col("root2").alias("b")).distinct())
    return merged(rooted, cross)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int):
    """(``id, fp`` of every row, ``fp, low, root`` of every distinct fingerprint; ``low`` is its smallest id)."""
    marked = written(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    return marked, met(distinct, fingerprint_components(distinct.select("fp"), max_bits), "fp")


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                            max_bits: int = 4) -> DataFrame:
    """One row per input row: ``id, fingerprint`` (16 hex digits)``, component_id``
    (the smallest id reachable over links of at most ``max_bits`` bits, itself included).

    Null and blank texts have fingerprint zero and are linked like any other.
    Rows without an id take the component's smallest known id (null if none).
    Repeated rows are returned repeated.  An empty table gives no rows."""
    marked, roots = _grouped(docs, id_col, text_col, shingle, max_bits)
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = met(roots, lowest, "root").select("fp", "component_id")
    return met(marked, by_fp, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                         max_bits: int = 4) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest id (of several
    fingerprints with that id, the smallest).  A document is an (id, fingerprint): repeated rows of one count
    once, and rows that share an id but not their component all stay.  Components in which no row has an
    id keep all their rows (there is nothing to choose by)."""
    marked, roots = _grouped(docs, id_col, text_col, shingle, max_bits)
    chosen = (roots.groupBy("root").agg(F.min(F.struct(F.col("low").isNull().alias("nameless"), "low", "fp")).alias("first"))
              .select("root", "first.*"))
    # the id alone tells the row, but where an id has several rows: only these are hashed again
    often = marked.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("often"))
    name, print_, many = (unused(docs, n) for n in ("chosen_id", "chosen_print", "chosen_often"))
    stay = (met(chosen.where("NOT nameless"), often, F.col("low") == F.col("id"))
            .select(F.col("id").alias(name), F.col("fp").alias(print_), F.col("often").alias(many)))

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        known = [None if t is None else fingerprint(t, shingle) for t in texts]
        return pd.Series([None if v is None else v - (1 << BITS if v >> 63 else 0) for v in known], dtype="Int64")

    whole = F.when(F.col(many), text_bytes(F.col(text_col)))
    kept = docs.join(stay, docs[id_col] == stay[name]).withColumn(unused(docs, "own_print"), hashed(whole))
    own = kept.columns[-1]
    kept = kept.where(~F.col(many) | (F.col(own) == F.col(print_))).dropDuplicates([id_col, print_]).select(*docs.columns)
    if not docs.schema[id_col].nullable:
        return kept
    nameless = roots.join(chosen.where("nameless").select("root"), "root", "left_semi").select("fp")
    unnamed = docs.where(F.col(id_col).isNull())
    own = unused(docs, "own_print")
    unnamed = unnamed.withColumn(own, hashed(text_bytes(F.col(text_col))))
    return kept.unionByName(unnamed.join(nameless, unnamed[own] == nameless["fp"], "left_semi").select(*docs.columns))
