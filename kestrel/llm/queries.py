"""Registered queries of the subpackage: thin digests over the operators, and their SQL twins."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, exact_dedup, hard_negatives, html_extract, language_id, lattice, lexical_search, secrets_scan,
               sentencepiece_codec, simhash, token_files, toxicity, warc)
from .common import held_out

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the files are installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_lattice(spark, sf_dir):
    """Lattice scores of all documents, learned from those whose crc32(doc_id) mod 7 is not 2."""
    docs = table(spark, sf_dir, "documents")
    aside = held_out(F.col("doc_id"), 7, 2)
    found = lattice.score_documents(docs, ~aside, vocabulary(PIECES))
    return found.select("doc_id", aside.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_toxicity(spark, sf_dir):
    """Toxicity of all documents, learned from labels whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    aside = held_out(F.col("doc_id"), 5, 0)
    found = toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), ~aside))
    return found.select("doc_id", aside.alias("held_out"), "score", "predicted")


def op3_html(spark, sf_dir):
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.train(pages))


def op4_exact_dedup(spark, sf_dir):
    """Exact duplicate classes of all documents; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="max")


OP4_SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS t FROM documents)"""


def op5_sentencepiece(spark, sf_dir):
    """All documents encoded by streaming Viterbi and decoded again."""
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op6_warc(spark, sf_dir):
    """All pages written as WARC archives and read back by byte ranges."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


OP6_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
     q AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q"""


def op7_simhash(spark, sf_dir):
    """SimHash components of all documents (4-word shingles, at most 4 differing bits)."""
    return simhash.simhash_near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_language_id(spark, sf_dir):
    """Language of all documents, learned from those whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    aside = held_out(F.col("doc_id"), 5, 0)
    found = language_id.predict(docs, language_id.train(docs, ~aside))
    return found.select("doc_id", aside.alias("held_out"), "lang_pred", "score")


def op9_token_files(spark, sf_dir):
    """Token files of all documents, written and read back."""
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), vocabulary(TOKENIZER))


def op10_decontaminate(spark, sf_dir):
    """Documents that contain a benchmark item (5-word shingles, containment 0.8 or more)."""
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round("containment", 6))


def _sql_words(col: str) -> str:
    return f"list_filter(string_split_regex({col}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


OP10_SQL = f"""
WITH i AS (SELECT item_id, {_sql_words(LOWER)} AS w FROM benchmark),
     i2 AS (SELECT item_id, w, least(5, len(w)) AS k FROM i WHERE len(w) > 0),
     s AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS g
           FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM i2)),
     t AS (SELECT item_id, count(*) AS total FROM s GROUP BY item_id),
     d AS (SELECT doc_id, {_sql_words(LOWER)} AS w FROM documents),
     k AS (SELECT DISTINCT k FROM s),
     g AS (SELECT DISTINCT doc_id, k, array_to_string(w[j:j + k - 1], ' ') AS g
           FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, k))
SELECT g.doc_id, s.item_id, count(*) AS shared, any_value(t.total) AS item_shingles,
       round(count(*) / any_value(t.total), 6) AS containment
FROM g JOIN s ON g.g = s.g AND g.k = s.k JOIN t ON t.item_id = s.item_id
GROUP BY g.doc_id, s.item_id HAVING count(*) >= 0.8 * any_value(t.total) - 1e-9"""

def op11_secrets(spark, sf_dir):
    """Secrets of all documents: stated patterns and the randomness battery."""
    found = secrets_scan.secret_spans(table(spark, sf_dir, "documents"))
    shown = lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])       # noqa: E731
    base = F.filter("spans", lambda x: x["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")       # noqa: E731
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets_scan.KINDS],
                        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", shown), ",").alias("spans"))


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every 50th vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0, vec_col="embedding")


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                  CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
     n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
           FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
            AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def op13_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item, among all documents."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, t AS terms FROM (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS t FROM documents)
           WHERE len(t) > 0),
     c AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n, terms, row_number() OVER () AS r FROM d),
     g AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM c),
     tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS t FROM c) GROUP BY r, doc_id, n, t),
     w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM tf, g GROUP BY t, big_n),
     q AS (SELECT item_id, i, t, count(*) AS k FROM (SELECT item_id, row_number() OVER () AS i,
                  unnest(regexp_extract_all(LOWERED, '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS t FROM benchmark)
           GROUP BY item_id, i, t),
     s AS (SELECT item_id, i, r, doc_id,
                  CAST(sum(k * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // l)))) AS BIGINT) AS score
           FROM q JOIN tf ON q.t = tf.t JOIN w ON w.t = q.t, g GROUP BY item_id, i, r, doc_id),
     k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""".replace("LOWERED", LOWER)

QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_toxicity": op2_toxicity,
    "op3_html": op3_html,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_decontaminate": op10_decontaminate,
    "op11_secrets": op11_secrets,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE = {"op4_exact_dedup": OP4_SQL, "op6_warc": OP6_SQL, "op10_decontaminate": OP10_SQL, "op12_hard_negatives": OP12_SQL,
          "op13_lexical_search": OP13_SQL}
