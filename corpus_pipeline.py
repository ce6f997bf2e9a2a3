"""Corpus cleaning pipeline: language ID, exact and near duplicates, benchmark passages, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.  All but the
last return the rows that stay with the columns of ``documents``; the last returns a row of token ids
for each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, exact_dedup, language_id, sentencepiece_codec, simhash
from kestrel.llm.common import held_out, written
from kestrel.llm.queries import PIECES, table, vocabulary

LEAST_LANGUAGE_SCORE = 0.25      # below this no language is likelier than one drawn from four


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter go."""
    model = language_id.train(docs, ~held_out(F.col("doc_id"), 5, 0))
    return language_id.accepted(docs, model, least=LEAST_LANGUAGE_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (4-word shingles, at most 4 differing bits)."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left."""
    return sentencepiece_codec.encode_documents(docs, vocabulary(PIECES))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_copies), ("simhash", drop_near_copies),
          ("decontaminate", drop_benchmark), ("sentencepiece", encode)]

ORACLE_SQL = None                # language ID, SimHash and Viterbi have no SQL form; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
