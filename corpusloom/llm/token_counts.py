"""Operator 2, token counts by a compiled finite-state tokenizer.

The piece model's normal pieces are compiled into a deterministic transducer (bpe.Transducer) whose transitions carry
the number of tokens that they emit; characters outside the vocabulary count one token a UTF-8 byte. Every text is read
in chunks of some CHUNK characters, all chunks of a batch at once. A chunk's state map says, for each state in which it may
be entered, in which state it is left and how many tokens it has emitted; a text's maps compose pairwise, level by level
(a parallel prefix scan), and its count is where the start leads. Chunks begin, if they can, at a space mark after another
character: no piece goes from a character into a mark that follows it, so the machine starts anew there. Long texts without
such places are cut anywhere, and these chunks are read from every state that the chunk before may leave.

Defined cases: a null text counts as empty, an empty text has 0 tokens; repeated rows each get their row; an empty
table gives an empty result; extra columns are ignored. Texts are never cut short.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .bpe import CHUNK, END, ChunkMap, Transducer, chunk_begins, no_collector, portions
from .common import own_columns

MARK = "▁"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class PieceCounter:
    def __init__(self, ranks: dict[str, float], chunk: int = CHUNK) -> None:
        self.machine, self.chunk = Transducer(ranks), chunk
        #: whether a mark after another character always starts the machine anew
        self.restarts = not any(MARK in t.lstrip(MARK) for t in ranks)

    def maps(self, texts: list[str]) -> list[list[ChunkMap]]:
        """State maps of the chunks of each text; none of an empty text."""
        import numpy as np

        # each text that isn't empty: a mark, its characters with spaces as marks, END
        held = [t for t in texts if t]
        symbols = np.frombuffer("".join([f"{MARK}{t} " for t in held]).encode("utf-32-le"), np.int32).copy()
        mark = ord(MARK)
        symbols[symbols == 32] = mark
        ends = np.cumsum([len(t) + 2 for t in held], dtype=np.int64)
        symbols[ends - 1] = END
        begins = np.append(0, ends[:-1])
        if self.restarts:
            places = np.flatnonzero((symbols[1:] == mark) & (symbols[:-1] != mark)) + 1
        else:
            places = begins
        chunks, fresh = chunk_begins(np.union1d(places, begins), len(symbols), self.chunk) if held else (begins[:0], np.zeros(0, bool))
        # texts begin chunks of their own
        every = np.union1d(chunks, begins) if held else chunks
        sure = np.ones(len(every), bool)
        sure[np.searchsorted(every, chunks)] = fresh
        maps = self.machine.read(symbols, every, sure).maps
        at = np.searchsorted(every, begins).tolist() + [len(every)]
        own = iter([maps[a:b] for a, b in zip(at, at[1:], strict=False)])
        return [next(own) if t else [] for t in texts]

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        out = []
        for some in portions(texts):
            for maps in self.maps(some):
                out.append(sum(n for _, n in self.machine.scan(maps).ways.values()) if maps else 0)
        return out

    def count(self, text: str) -> int:
        return self.counts([text])[0]


@functools.cache
def counter(path: str) -> PieceCounter:
    """The compiled model of a worker; kept from task to task."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return PieceCounter({p.piece: -p.score for p in model.pieces if p.type == p.NORMAL})


def count_tokens(docs: DataFrame, model_path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; one pass, no shuffle."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        count = counter(model_path).counts
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            with no_collector():
                n = count(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(of, SCHEMA)
