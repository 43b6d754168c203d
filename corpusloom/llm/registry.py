"""The queries of this folder, with production parameters, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe_codec, hard_negatives, media, near_dedup, ngram_join, packing, pii, secrets_crf, sharding, token_counts, topk_search, toxicity
from .common import documents, split_pattern, surrogate_key, tokenizer_path


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), sharding.even_tree(8), sharding.grow(sharding.even_tree(8)))


def op2_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op4_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


def op8_impact_ordered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 1024)
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op3_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


def op5_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_crf.scan(documents(spark, sf_dir))


def op6_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(documents(spark, sf_dir), surrogate_key(spark))


def op9_chunked_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_table(documents(spark, sf_dir))


def op10_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_quantised_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_group_dictionary_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern(), tokenizer_path("piece_bpe_32k.model")
    return alignment.align(documents(spark, sf_dir), *files).documents


def op13_ngram_product_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(documents(spark, sf_dir), words=3, percent=90)


QUERIES = {q.__name__: q for q in (op1_hash_tree_sharding, op2_transducer_token_counts, op3_bounded_space_packing, op4_transducer_bpe, op5_crf_secrets, op6_bayesian_minhash, op7_surrogates, op8_impact_ordered_topk, op9_chunked_media, op10_boosted_toxicity, op11_quantised_hard_negatives, op12_group_dictionary_alignment, op13_ngram_product_join)}
ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL["op8_impact_ordered_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
ORACLE_SQL["op11_quantised_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same),
r AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND p.n <= 5
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""
