"""Scans and sinks (S1-S3): Parquet tables, delimited files, result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


MIN_PARTITIONS = "spark.kestrel.scan.minPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``, scanned as it is stored.

    A Parquet file of one row group is one split, so a small table lies on one task however many cores
    there are.  A session may ask for more with ``spark.kestrel.scan.minPartitions`` (the bench does);
    unset, as on a cluster, no shuffle is ever added."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = int(spark.conf.get(MIN_PARTITIONS, "0"))
    return df.repartition(wanted) if wanted else df


def read_delimited(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ",") -> DataFrame:
    """Header CSV scan.  With a schema no inference pass runs over the
    file; without one Spark samples the whole file for types, as the
    reference's reader does.  Malformed fields become NULL (PERMISSIVE)."""
    reader = spark.read.option("header", "true").option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Scored-rows and result-table sink (overwrite, no driver collect)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


def read_result(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    return spark.read.format(fmt).load(path)
