"""Exact duplicates by 128-bit content hash, proved byte by byte (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, unused


def content_hash(col: Column) -> Column:
    """128-bit content hash (MD5) as 16 bytes."""
    return F.unhex(F.md5(col.cast("binary")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                     hash_fn=content_hash) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z.  Rows are
    grouped by ``hash_fn`` (128 bits) *and* the text bytes, so two texts that
    collide fall into two groups.  Copies collapse map-side, a hot text costs
    one row per input partition in the shuffle.  The decision goes back to the
    rows over (hash, SHA-256), a narrow join that adaptive execution splits
    where one text holds many rows.

    ``keep``: ``min`` (smallest id stays) or ``max``.  Null text counts as
    empty.  Repeated rows of one id all count in ``group_size`` and are all
    reported; a null id stays only where its whole group has no id.  An empty
    table gives an empty result; other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    best = {"min": F.min, "max": F.max}[keep]
    groups = (rows.select("id", "t", hash_fn(F.col("t")).alias("h")).groupBy("h", "t")
              .agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("h", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"), "keep_id", "group_size"))
    marks = rows.select("id", hash_fn(F.col("t")).alias("h"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"))
    return marks.join(groups, ["h", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows
    of one kept id one stays.  Rows without an id stay only if no equal text
    has one."""
    marked = exact_duplicates(docs, id_col, text_col, keep).where("kept").select(
        F.col(id_col).alias("keep_id"), F.unhex("text_sha256").alias("keep_sha")).distinct()
    own = unused(docs, "text_sha")
    sha = F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256))
    staged = docs.withColumn(own, sha)
    hit = staged.join(marked, staged[id_col].eqNullSafe(marked["keep_id"]) & (staged[own] == marked["keep_sha"]), "left_semi")
    return hit.dropDuplicates([id_col, own]).select(*docs.columns)
