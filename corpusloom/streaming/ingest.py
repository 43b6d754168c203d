"""Incremental ingestion, an extension: new files of a folder are chunked and appended, each exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..operators.chunking import chunk_rows, recursive_chunks


def ingest_chunks(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, size: int = 100, overlap: int = 0) -> None:
    """Chunk what has come to `source` (Parquet with doc_id and text) since the last call, and append it to `target`.

    The file sink commits each batch once, and the checkpoint remembers what was read, so that a run that broke off goes on where it stopped.
    """
    docs = spark.readStream.schema(schema).parquet(source)
    chunks = chunk_rows(docs, lambda t: recursive_chunks(t, size, overlap)).drop("headers")
    chunks.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
