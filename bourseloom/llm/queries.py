"""Registered queries of this subpackage, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourseloom.llm import (
    alignment, bayes_minhash, chunks, extraction, hashing_search, jaccard_join, lengths, line_dedup, mixing, packing,
    position_search, quality, syncmers,
)
from bourseloom.llm.store import settle, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lexical_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op2_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs).select(
        "doc_id", F.col("__mix_source").alias("source"), F.col("__mix_lang").alias("lang"),
        F.col("__mix_topic").alias("topic"), F.col("__mix_tokens").alias("tokens"),
        F.round("__mix_probability", 6).alias("probability"))


def op3_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf, "documents"))


def op4_syncmer_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.edited_neighbours(table(spark, sf, "documents"))


def op5_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that stay."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = quality.resample(docs, table(spark, sf, "labels"))
    return kept.select("doc_id", F.col("__quality_weight").alias("log_weight"),
                       F.col("__quality_score").alias("score"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.repeated_spans(table(spark, sf, "documents"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    text = extraction.extract(table(spark, sf, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op8_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    histogram = lengths.length_histogram(table(spark, sf, "documents"))
    return lengths.limit_table(settle(histogram, "histogram"))


def op9_multi_index_hashing(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return hashing_search.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_best_position_search(spark: SparkSession, sf: str) -> DataFrame:
    return position_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"))


def op13_bayes_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return bayes_minhash.near_duplicates(table(spark, sf, "documents"))


def registered() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_lexical_packing, op2_source_mixing, op3_ngram_jaccard_join,
        op4_syncmer_fingerprints, op5_importance_resampling, op6_substring_dedup,
        op7_html_extraction, op8_length_histogram, op9_multi_index_hashing,
        op10_line_dedup, op11_best_position_search, op12_tokenizer_alignment, op13_bayes_minhash)}


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, pos, string_split(coalesce(text, ''), chr(10))[pos] AS line
  FROM (SELECT doc_id, text,
               unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
        FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT keyed.*, often.k IS NOT NULL AND doc_id <> often.keep AS gone
  FROM keyed LEFT JOIN often ON keyed.k = often.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id
"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all({_LOW}, {_TERM}) AS terms FROM documents
), counted AS (
  SELECT doc, doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM counted
), postings AS (
  SELECT doc, doc_id, n, term, count(*) AS tf
  FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM counted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, total GROUP BY term
), asked AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all({_LOW}, {_TERM})) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
), scored AS (
  SELECT item, item_id, doc_id, doc,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

SQL: dict[str, str] = {
    "op2_source_mixing": mixing.mix_sql(), "op10_line_dedup": OP10_SQL, "op11_best_position_search": OP11_SQL}
