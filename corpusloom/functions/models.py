"""Extension points for models, with deterministic defaults that need no network.

A model is anything with the method of its protocol. It is made once per Arrow batch stream by a factory, so that weights and clients are
loaded on the executors and never sent with each row.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import text as T


class Embedder(Protocol):
    def encode(self, texts: list[str]) -> list[list[float]]: ...


class PairScorer(Protocol):
    def score(self, pairs: list[tuple[str, str]]) -> list[float]: ...


class Generator(Protocol):
    def generate(self, prompt: str, max_tokens: int, temperature: float) -> str: ...


def plain_tokens(text: str) -> list[str]:
    return re.sub(r"[^\w\s]", "", (text or "").lower()).split()


class HashEmbedder:
    """Feature hashing of tokens into a vector of unit length; a text without tokens is the zero vector."""

    def __init__(self, dim: int = 384) -> None:
        self.dim = dim

    def encode(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.dim
            for token in plain_tokens(text):
                h = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little")
                v[h % self.dim] += 1.0 if h >> 63 else -1.0
            n = math.sqrt(sum(x * x for x in v))
            out.append([x / n for x in v] if n else v)
        return out


def longest_first(a: int, b: int, limit: int) -> tuple[int, int]:
    """How much of a pair's sides stays when one after the other is taken from the longer one, of equal ones from the second, until both fit."""
    over = a + b - limit
    if over <= 0:
        return a, b
    if a >= b:
        cut = min(over, a - b)
        a, over = a - cut, over - cut
    else:
        cut = min(over, b - a)
        b, over = b - cut, over - cut
    return max(0, a - over // 2), max(0, b - (over + 1) // 2)


def file_tokens(path: str) -> Callable[[str], list]:
    """Token ids by a tokenizer file, without special tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def normal_tokens(text: str) -> list[str]:
    """The words of a normalised text, as T.tokens has them."""
    return text.lower().translate({ord(c): None for c in T.PUNCTUATION}).split()


class OverlapScorer:
    """Jaccard similarity of the token sets of query and document, the pair cut together to `limit` tokens, longest side first.

    tokens: what divides a text, such as file_tokens of a model's own vocabulary.
    """

    def __init__(self, limit: int = 512, tokens: Callable[[str], list] = plain_tokens) -> None:
        self.limit, self.tokens = limit, tokens

    def score(self, pairs: list[tuple[str, str]]) -> list[float]:
        out = []
        for q, d in pairs:
            x, y = self.tokens(q), self.tokens(d)
            n, m = longest_first(len(x), len(y), self.limit)
            a, b = set(x[:n]), set(y[:m])
            out.append(len(a & b) / len(a | b) if a | b else 0.0)
        return out


class QuoteGenerator:
    """A stand-in for a chat model: asks about a text's first words, and gives its first sentence and one that isn't there as references."""

    def generate(self, prompt: str, max_tokens: int = 1500, temperature: float = 0.1) -> str:
        context = prompt.split("\n\n", 1)[-1]
        first = re.split(r"(?<=[.!?])\s", context.strip(), maxsplit=1)[0]
        question = "What is said about " + " ".join(plain_tokens(context)[:4]) + "?"
        return "```json\n" + json.dumps({"question": question, "references": [first, "zzz qqq xxx"]}) + "\n```"


class ContextAnswerer:
    """A stand-in for a model that answers from documents: how many it was shown, and the question."""

    def generate(self, prompt: str, max_tokens: int = 1500, temperature: float = 0.1) -> str:
        context, asked = prompt.rsplit("\nQuestion: ", 1)
        return f"{len(re.findall(r'^Document [0-9]+:$', context, re.MULTILINE))} documents on: {asked}"


class JoinRewriter:
    """A stand-in for a rewriting model: the last user turn of the conversation, then the utterance."""

    def generate(self, prompt: str, max_tokens: int = 100, temperature: float = 0.1) -> str:
        history, asked = prompt.rsplit("\n\n", 1)
        turns = re.findall(r"^User: (.*?)(?=\n(?:User|Assistant): |\Z)", history, re.MULTILINE | re.DOTALL)
        return f"{turns[-1]} {asked}".strip() if turns else asked.strip()


def embed(df: DataFrame, text_col: str, to: str = "embedding", factory: Callable[[], Embedder] = HashEmbedder) -> DataFrame:
    """df with vectors of a text column; the model is made once per task."""

    @pandas_udf("array<float>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in batches:
            yield pd.Series(model.encode([x or "" for x in s]))

    return df.withColumn(to, of(F.col(text_col)))


def embedded(df: DataFrame, text_col: str, to: str = "embedding", factory: Callable[[], Embedder] = HashEmbedder, rows_per_call: int = 32, retries: int = 3, dim: int | None = None) -> DataFrame:
    """df with vectors of a text column, `error` where there is none, and `seconds`, a row's share of the call that gave it.

    Texts go to the model rows_per_call at a time. A call that fails is tried again in halves, until a failing text is alone; that one is tried `retries` times, and then
    has a null vector and the error's text. So has one whose vector isn't of `dim` components, if that is given. Columns of df called as these three are refused.
    """
    names = [to, "error", "seconds"]
    if clash := set(names) & set(df.columns):
        raise ValueError(f"there are columns called {sorted(clash)}")
    at, size = df.columns.index(text_col), rows_per_call

    def of(batches):
        import pyarrow as pa

        model = factory()

        def called(texts: list[str], tries: int) -> list[tuple]:
            began = time.perf_counter()
            try:
                vectors = model.encode(texts)
                if len(vectors) != len(texts):
                    raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
            except Exception as e:  # any failure of a model is its text's failure
                if len(texts) > 1:
                    half = len(texts) // 2
                    return called(texts[:half], retries) + called(texts[half:], retries)
                return called(texts, tries - 1) if tries > 1 else [(None, f"{type(e).__name__}: {e}", time.perf_counter() - began)]
            each = (time.perf_counter() - began) / len(texts)
            fits = lambda v: dim is None or len(v) == dim
            return [([float(x) for x in v], None, each) if fits(v) else (None, f"ValueError: {len(v)} components instead of {dim}", each) for v in vectors]

        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            rows = [r for i in range(0, len(texts), size) for r in called(texts[i : i + size], retries)]
            columns = zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.list_(pa.float32()), pa.string(), pa.float64()), strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in columns)], names=[*batch.schema.names, *names])

    from pyspark.sql.types import _parse_datatype_string

    full = _parse_datatype_string(f"{to} array<float>, error string, seconds double")
    return df.mapInArrow(of, type(full)([*df.schema.fields, *full.fields]))


def pair_scores(query: Column, document: Column, factory: Callable[[], PairScorer] = OverlapScorer, characters: int = 1 << 20) -> Column:
    """Scores of (query, document) pairs; a call of the model takes pairs of at most so many characters, or one."""

    @pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for q, d in batches:
            scores, held, size = [], [], 0
            for pair in zip(q, d, strict=True):
                pair = tuple(x or "" for x in pair)
                n = len(pair[0]) + len(pair[1])
                if held and size + n > characters:
                    scores += model.score(held)
                    held, size = [], 0
                held.append(pair)
                size += n
            yield pd.Series([*scores, *(model.score(held) if held else [])], dtype="float64")

    return of(query, document)


def generate(df: DataFrame, prompt_col: str, to: str, factory: Callable[[], Generator], max_tokens: int, temperature: float, retries: int = 3) -> DataFrame:
    """df with the model's reply to a prompt, and `error` where all tries failed (the reply is then null)."""
    prompt_at, schema = df.columns.index(prompt_col), f"{to} string, error string"

    def of(batches):
        import pyarrow as pa

        model = factory()
        for batch in batches:
            replies, errors = [], []
            for prompt in batch.column(prompt_at).to_pylist():
                reply = error = None
                for _ in range(retries):
                    try:
                        reply, error = model.generate(prompt or "", max_tokens, temperature), None
                        break
                    except Exception as e:  # any failure of a model is that row's failure
                        error = f"{type(e).__name__}: {e}"
                replies.append(reply)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replies, pa.string()), pa.array(errors, pa.string())], names=[*batch.schema.names, to, "error"])

    from pyspark.sql.types import _parse_datatype_string

    full = _parse_datatype_string(schema)
    return df.mapInArrow(of, type(full)([*df.schema.fields, *full.fields]))


def lexical_score(query: Column, document: Column) -> Column:
    """The overlap scorer as columns: Jaccard similarity of distinct normalised tokens."""
    a, b = F.array_distinct(T.tokens(query)), F.array_distinct(T.tokens(document))
    both, whole = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(whole > 0, both.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))
