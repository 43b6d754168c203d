"""From raw documents to training windows: toxicity, near duplicates, personal data, packing.

Counts as part of corpusloom.llm. Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as
Parquet to the scratch folder below spark.checkpoint.dir and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import near_dedup, packing, pii, toxicity
from corpusloom.llm.common import documents, split_pattern, staged, surrogate_key, tokenizer_path
from corpusloom.session import share_package


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on labelled rows of docs, scores below 0.5."""
    share_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, over runs of five words at a similarity of 0.8 or more."""
    share_package(spark)
    return near_dedup.one_of_each(docs, words=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars is that of the new text."""
    return pii.replace(docs, surrogate_key(spark))


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens."""
    share_package(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


STAGES = [("toxicity", clean), ("near_duplicates", distinct), ("surrogates", private), ("packing", windows)]
#: Trees, signatures and tokenizers have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
