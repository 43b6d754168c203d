"""Shared by the operators of this folder: small helpers; `staged` cuts lineage by a written table."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release, staged

__all__ = ["documents", "own_columns", "release", "split_pattern", "staged", "surrogate_key", "tokenizer_path"]


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that clashing extra columns can do no harm."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@functools.cache
def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def surrogate_key(spark: SparkSession) -> str:
    """The key of surrogates: a deployment sets spark.corpusloom.surrogate.key; without it a key for tests, which protects nobody."""
    return spark.conf.get("spark.corpusloom.surrogate.key", "for tests only")


def tidied(of: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A function of Arrow batches that gives its memory back to the system when its task ends: workers live on, and those of later
    steps share an executor's memory with them."""

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        try:
            yield from of(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim()

    return run


def trim() -> None:
    """Let the C library return free memory; others than glibc do so by themselves."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
