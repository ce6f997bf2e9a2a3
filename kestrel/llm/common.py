"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir

SLICE = 256      # rows of an Arrow batch that are turned into Python objects at once


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared checkpoint folder of the session, as a URI."""
    root = checkpoint_dir(spark).rstrip("/")
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[len("file:"):]
    if "://" not in root:
        root = "file://" + root
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and
    later jobs reread files instead of running the work again."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def met(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` by sorting both.  Spark sizes a written table by its compressed files and takes
    an explode to add nothing, so left to itself it may send a side with a row a fingerprint, or 64, through the driver."""
    return left.hint("merge").join(right, on, how)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(col: Column) -> Column:
    """Whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it was."""
    plain = F.octet_length(col) == F.char_length(col)      # pure ASCII: lower() changes A-Z alone
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32(id as text) mod ``modulus``; a null id has no remainder (null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def held_out(id_col: Column, modulus: int, rest: int) -> Column:
    """True for rows kept back from learning; a null id is never held out."""
    return F.coalesce(remainder(id_col, modulus) == rest, F.lit(False))


def hash_below(h: Column, share: float) -> Column:
    """True for the smallest ``share`` of all 64-bit hashes ``h``.  The share is not rounded, so that a
    bounded sample of any number of rows finds its rows."""
    top = int(share * 2 ** 64) - 2 ** 63
    return F.lit(True) if top >= 2 ** 63 else h <= F.lit(top)


def smallest_hashes(rows: DataFrame, keys: list[str], most: int, group: str) -> tuple[DataFrame, dict]:
    """(rows, distinct rows by group, estimated): of each value of ``group`` the ``most`` rows (all, if there
    are fewer) whose ``keys`` have the smallest hashes.  Copies of a row count once, so that they fill no
    sample; only about twice the rows asked for are moved."""
    h = F.xxhash64(*keys)
    sizes = {r[group]: r["n"] for r in rows.groupBy(group).agg(F.approx_count_distinct(h).alias("n")).collect()}
    near = F.lit(False)
    for value, n in sizes.items():
        near = F.when(F.col(group) == F.lit(value), hash_below(h, min(1.0, (2 * most + 50) / n))).otherwise(near)
    place = F.row_number().over(Window.partitionBy(group).orderBy(h, *keys))
    picked = rows.where(near).dropDuplicates([group, *keys]).withColumn("__place", place).where(F.col("__place") <= most).drop("__place")
    return picked, sizes


def slices(batches, rows: int = SLICE):
    """Arrow batches in short slices, so few Python objects live at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


class Memo(dict):
    """``memo[key]`` is ``make(key)``, computed once while the key stays in use.  Bounded: at
    ``limit`` entries the table becomes the old generation and only keys met again survive; keys longer
    than ``LONGEST`` (text without spaces) are made anew each time and never held."""

    LONGEST = 128

    def __init__(self, make, limit: int = 1 << 18):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(key) > self.LONGEST:
            return self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value
