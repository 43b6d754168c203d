"""Operator 3, bounded-space online packing into token windows.

Each document is tokenised and ended by an end id. Its whole windows are sequences of their own; the rest goes, in
the order of its partition, into one of at most `open_windows` open windows, the fullest in which it fits (best fit).
When none fits and all are open, the fullest is emitted and a new one opened. What is left open at a partition's end
is merged: the left windows, by their fill alone, go to merge tasks, a fixed number of partitions to each, and are
packed whole, the largest first, best fit. Space and work of every task are bounded by the split size.

Defined cases: a null text counts as empty and gives the end id alone; repeated rows are packed each; an empty table
gives an empty result; extra columns are ignored; a document of any length is cut into whole windows, never cut short.
"""

from __future__ import annotations

import array
import base64
import functools
import re
import sys
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, staged, tidied

WINDOW, END_ID = 1024, 0
#: Characters beyond Latin letters and common marks, whose classes may differ between versions of Unicode.
UNUSUAL = "[^\x00-\xff\u0100-\u024f\u2010-\u2027]"
#: Open windows of a partition.
OPEN_WINDOWS = 256
#: Partitions whose left windows are merged in one task.
MERGE_PARTITIONS = 16
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, fill int, left_open boolean"


class FastIds:
    """Ids of a text by a tokenizer file, packed as little-endian unsigned 32-bit.

    Texts of common characters without a special string are encoded by the same vocabulary's ranks, several times faster;
    all others by the tokenizer itself.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unusual = re.compile("|".join([*map(re.escape, special), UNUSUAL])).search

    def __call__(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids if self.unusual(text) else self.fast(text)
        packed = array.array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()


@functools.cache
def fast_ids(path: str, ranks_path: str, pattern: str) -> FastIds:
    """One for a worker; kept from task to task."""
    return FastIds(path, ranks_path, pattern)


class BestFit:
    """Windows by free space: finds the least space that suffices, and the least of all, in a few steps."""

    def __init__(self, size: int) -> None:
        self.by_free: list[list] = [[] for _ in range(size + 1)]
        self.bits, self.open = 0, 0

    def add(self, free: int, window) -> None:
        self.by_free[free].append(window)
        self.bits |= 1 << free
        self.open += 1

    def take(self, need: int):
        """(free, window) of least free space of at least `need`, removed; None if there is none."""
        bits = self.bits >> need
        if not bits:
            return None
        free = need + (bits & -bits).bit_length() - 1
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return free, found


def pack_stream(lengths: Iterable[tuple[int, object]], size: int, open_windows: int) -> Iterator[tuple[list, int, bool]]:
    """(pieces, fill, left open) of each window, for (length, piece) with lengths from 1 to size."""
    fit = BestFit(size)
    for length, piece in lengths:
        if (found := fit.take(length)) is None:
            if fit.open >= open_windows:
                free, window = fit.take(0)  # the fullest
                yield window, size - free, False
            found = size, []
        free, window = found
        window.append(piece)
        if free == length:
            yield window, size, False
        else:
            fit.add(free - length, window)
    while (found := fit.take(0)) is not None:
        yield found[1], size - found[0], True


def pieces_of(batches: Iterable, ids_of: FastIds, size: int, end_id: int) -> Iterator[tuple[int, tuple]]:
    """(length, (doc_id, start, length, crc, doc_tokens)) of every piece: whole windows, then the rest."""
    end = int(end_id).to_bytes(4, "little")
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = memoryview(ids_of(text or "") + end)
            n = len(ids) // 4
            for start in range(0, n, size):
                piece = ids[4 * start : 4 * (start + size)]
                yield len(piece) // 4, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)


def pack(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, size: int = WINDOW, end_id: int = END_ID, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    ranks_file and pattern: the same vocabulary as ranks, and how it divides texts.
    """

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        rows, window_no = [], 0
        for window, fill, left_open in pack_stream(pieces_of(batches, fast_ids(tokenizer_file, ranks_file, pattern), size, end_id), size, open_windows):
            offset = 0
            for piece in window:
                rows.append((*piece, (partition << 33) + window_no, offset, fill, left_open))
                offset += piece[2]
            window_no += 1
            if len(rows) >= 20_000:
                yield _batch(pa, rows)
                rows = []
        if rows:
            yield _batch(pa, rows)

    # written once: texts are tokenised once, and the windows stay what they are
    packed = staged(own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidied(of), PIECES), "packed")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    done = packed.where(~F.col("left_open")).select(*keep, F.col("window").alias("sequence_id"), "offset")

    def merge(frame):
        import pandas as pd

        # whole, largest first; the number breaks ties, so that a repeated task gives the same
        order = frame.sort_values(["fill", "window"], ascending=[False, True])
        rows = []
        for window, _, _ in pack_stream(zip(order["fill"].tolist(), zip(order["window"].tolist(), order["fill"].tolist(), strict=True), strict=True), size, len(order)):
            at = 0
            for number, fill in window:
                rows.append((number, window[0][0], at))
                at += fill
        return pd.DataFrame(rows, columns=["window", "sequence_id", "base"])

    left = packed.where("left_open")
    group = F.shiftright("window", 33) / F.lit(MERGE_PARTITIONS)
    moved = left.groupBy("window").agg(F.first("fill").alias("fill")).groupBy(F.floor(group).alias("merge_group")).applyInPandas(merge, "window long, sequence_id long, base long")
    merged = left.join(moved, "window").select(*keep, "sequence_id", (F.col("offset") + F.col("base")).alias("offset"))
    return done.unionByName(merged)


def _batch(pa, rows: list[tuple]):
    kinds = (pa.int64(),) * 7 + (pa.int32(), pa.bool_())
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def padding(packed: DataFrame, size: int = WINDOW) -> DataFrame:
    """sequences, tokens and padding of a packing; a fill that is a power of two is not padded."""
    fills = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    padded = F.when(F.expr("(fill & (fill - 1)) = 0"), 0).otherwise(F.lit(size) - F.col("fill"))
    return fills.agg(F.count(F.lit(1)).alias("sequences"), F.sum("fill").alias("tokens"), F.sum(padded).alias("padding"))


def sequences(packed: DataFrame) -> DataFrame:
    """Ordered pieces of each sequence."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length"))).alias("pieces"))
