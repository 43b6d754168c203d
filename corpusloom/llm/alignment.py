"""Operator 12, cross-tokenizer alignment by a dictionary of groups.

A space and the text are encoded by a byte-level vocabulary (A), the text by a piece model (B), which adds the space itself. Where
a token of A and one of B end at the same byte, both are cut; what lies between two cuts is a group: some ids of A and
some of B. All its A-B occurrence pairs are links.

1. Every task divides its documents into chunks of bounded bytes, interns the distinct groups of a chunk, and writes one row for each
   document (its groups as numbers in the chunk's dictionary, with how often each occurs) and one for each dictionary entry (how
   many of the chunk's documents hold it). A document that links an id pair in several distinct groups is written down as that many too many.
2. The entries of all chunks are drawn together by group key: one row for each distinct group, with the documents that hold it. Its
   links are expanded once, to distinct id pairs with their number of occurrences. An id pair's count is the sum of its groups' documents less
   what was counted too often: the documents that hold it linked.
3. A group's totals over its links go back to the chunks by group key, and there to the documents.

So rows shuffle once for each entry of a chunk's dictionary, not for each group of a document, and nothing but the best count of each A id (no more
rows than the vocabulary) is broadcast. Keys are 128-bit digests of the ids.

Defined cases: null and empty texts, and those whose tokens of either side don't join to the space and the text (a piece model
may normalise), have no tokens: zeros and an empty digest; special tokens' strings inside texts are plain text; repeated rows each get a row
and each count as a document; an empty table gives an empty result; extra columns are ignored. Texts are never cut short.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_codec import Strings
from .common import own_columns, staged, tidied
from .packing import UNUSUAL

#: Bytes of the texts of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
ROWS = "chunk long, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, held binary, many binary, at int, key binary, a array<int>, b array<int>, docs int"
DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
SPACE = "▁"
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Encoders:
    """Ids by both vocabularies, and the bytes of their tokens."""

    def __init__(self, json_file: str, ranks_file: str, pattern: str, model_file: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.slow = Tokenizer.from_file(json_file)
        self.slow.encode_special_tokens = True
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.unusual = re.compile(UNUSUAL).search
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
        signs = {c: b for b, c in _signs().items()}
        assert set(ByteLevel.alphabet()) == set(signs)
        entries = {i: e for e, i in self.slow.get_vocab(with_added_tokens=True).items()}
        self.a = Strings({i: bytes(signs[c] for c in e) if all(c in signs for c in e) else e.encode() for i, e in entries.items()})
        self.b = Strings({i: self._piece(i) for i in range(self.pieces.get_piece_size())})
        self.marked_a = Strings({2 * i + last: b"%d" % i + b",|"[last : last + 1] for i in entries for last in (0, 1)})
        self.marked_b = Strings({2 * i + last: b"%d" % i + b",;"[last : last + 1] for i in range(self.pieces.get_piece_size()) for last in (0, 1)})

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode()

    def both(self, text: str) -> tuple[list[int], list[int]]:
        spaced = " " + text
        # the same vocabulary by ranks, several times faster; only characters of which versions of Unicode may differ go to the tokenizer
        return self.slow.encode(spaced, add_special_tokens=False).ids if self.unusual(text) else self.fast(spaced), self.pieces.encode(text, num_threads=1)


def _signs() -> dict[int, str]:
    """byte -> the character that stands for it in byte-level entries: itself where it can be seen, else the next one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in seen)}


@functools.cache
def encoders(*files: str) -> Encoders:
    """One for a worker; kept from task to task."""
    return Encoders(*files)


def _mixed(x, by: int):
    """Spread 64-bit values."""
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def _keys(ids, starts, side: int):
    """Two 64-bit digests of each run of ids."""
    import numpy as np

    n = np.diff(np.append(starts, len(ids)))
    place = np.arange(len(ids)) - np.repeat(starts, n)
    base = ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(24)) + np.uint64((side + 1) << 62)
    return [np.add.reduceat(_mixed(_mixed(base * np.uint64(m) + np.uint64(k), m), _MIX[0]), starts) for k, m in enumerate(_MIX)]


class Chunk:
    """Groups of some documents, and their dictionary."""

    def __init__(self, coders: Encoders, texts: list[str | None]) -> None:
        import numpy as np

        self.np, self.coders = np, coders
        a, b, self.has = [], [], np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            if not text:
                continue
            x, y = (np.array(ids, np.int32) for ids in coders.both(text))
            whole = b" " + text.encode()
            if coders.a.join(x) == whole and coders.b.join(y) == whole:
                a.append(x), b.append(y)
                self.has[i] = True
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
        none = [np.zeros(0, np.int32)]
        self.a, self.b = np.concatenate(a or none), np.concatenate(b or none)
        ends_a, ends_b = np.cumsum(coders.a.size.take(self.a)), np.cumsum(coders.b.size.take(self.b))
        cut_a, cut_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        self.last_a, self.last_b = cut_a, cut_b
        stop_a, stop_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        self.from_a, self.from_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
        if not len(stop_a):
            self.from_a = self.from_b = np.zeros(0, np.int64)
        self.size_a, self.size_b = stop_a - self.from_a, stop_b - self.from_b
        #: groups of each document; every document's last tokens end together
        self.doc_ends = np.searchsorted(stop_a, np.cumsum(self.n_a), side="left") + 1 if len(self.n_a) else np.zeros(0, np.int64)
        self.doc_of = np.repeat(np.arange(len(self.n_a)), np.diff(np.append(0, self.doc_ends)))
        self.intern()

    def intern(self) -> None:
        """Numbers of the distinct groups, and each document's."""
        np = self.np
        if not len(self.from_a):
            self.keys, self.number, self.one = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            x, y = (p + q for p, q in zip(_keys(self.a, self.from_a, 0), _keys(self.b, self.from_b, 1), strict=True))
            order = np.lexsort((y, x))
            new = np.append(True, (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1]))
            self.number = np.empty(len(order), np.int64)
            self.number[order] = np.cumsum(new) - 1
            self.one = order[new]  # an occurrence of each
            self.keys = np.stack([x[self.one], y[self.one]], 1)
        n = max(1, len(self.keys))
        held, self.many = np.unique(self.doc_of * n + self.number, return_counts=True)
        self.held_doc, self.held = held // n, held % n
        self.docs = np.bincount(self.held, minlength=len(self.keys))

    def too_often(self):
        """(a, b, n): id pairs, and how often documents hold them in one more distinct group of theirs."""
        np = self.np
        # an entry's distinct pairs; only entries of several tokens, or that share their pair with one, can repeat a pair
        a, b, entry = self.pairs()
        pair = a.astype(np.int64) << 32 | b
        kinds, kind = np.unique(pair, return_inverse=True)
        shared = np.bincount(kind, minlength=len(kinds)) > 1
        keep = shared[kind]
        kind, entry = kind[keep], entry[keep]
        if not len(kind):
            return kinds[:0], kinds[:0], kinds[:0]
        order = np.argsort(entry, kind="stable")
        kind, entry = kind[order], entry[order]
        begin, stop = np.searchsorted(entry, self.held, "left"), np.searchsorted(entry, self.held, "right")
        count = stop - begin
        at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        seen, times = np.unique(np.repeat(self.held_doc, count) * len(kinds) + kind[at], return_counts=True)
        extra = np.bincount(seen % len(kinds), times - 1, len(kinds)).astype(np.int64)
        some = np.flatnonzero(extra)
        return kinds[some] >> 32, kinds[some] & 0xFFFFFFFF, extra[some]

    def pairs(self):
        """(a, b, entry): the distinct id pairs of every entry of the dictionary."""
        np = self.np
        na, nb = self.size_a[self.one], self.size_b[self.one]
        a, b, entry = [], [], []
        single = np.flatnonzero((na == 1) & (nb == 1))
        a.append(self.a[self.from_a[self.one[single]]]), b.append(self.b[self.from_b[self.one[single]]]), entry.append(single)
        for e in np.flatnonzero((na > 1) | (nb > 1)).tolist():
            i = self.one[e]
            x, y = set(self.a[self.from_a[i] : self.from_a[i] + na[e]].tolist()), set(self.b[self.from_b[i] : self.from_b[i] + nb[e]].tolist())
            a.append(np.repeat(np.array([*x], np.int32), len(y))), b.append(np.tile(np.array([*y], np.int32), len(x))), entry.append(np.full(len(x) * len(y), e))
        return np.concatenate(a), np.concatenate(b), np.concatenate(entry)

    def digests(self) -> list[str]:
        """The digest of each document's groups as text."""
        np = self.np
        groups_a, groups_b = np.repeat(np.arange(len(self.size_a)), self.size_a), np.repeat(np.arange(len(self.size_b)), self.size_b)
        before_a, before_b = np.append(0, np.cumsum(self.size_a)), np.append(0, np.cumsum(self.size_b))
        place_a, place_b = np.arange(len(self.a)) + before_b[groups_a], np.arange(len(self.b)) + before_a[groups_b + 1]
        text_a, text_b = 2 * self.a.astype(np.int64) + self.last_a, 2 * self.b.astype(np.int64) + self.last_b
        offset = len(self.coders.marked_a.size)
        tokens = np.empty(len(self.a) + len(self.b), np.int64)
        tokens[place_a], tokens[place_b] = text_a, text_b + offset
        out, start = [], 0
        for end in np.cumsum(self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256(_joined(self.coders, tokens[start:end], offset)[:-1]).hexdigest())
            start = end
        return out


def _joined(coders: Encoders, tokens, offset: int) -> bytes:
    """Marked ids of both vocabularies as one text; those of B are moved by the offset."""
    import numpy as np

    if not hasattr(coders, "marked"):
        both = Strings({0: b""})
        both.size = np.concatenate([coders.marked_a.size, coders.marked_b.size])
        both.at = np.concatenate([coders.marked_a.at, coders.marked_b.at + len(coders.marked_a.octets)])
        both.octets = np.concatenate([coders.marked_a.octets, coders.marked_b.octets])
        coders.marked = both
    return coders.marked.join(tokens)


def _chunks(batches: Iterable, most: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of rows of at most so many bytes, or one row."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(text or "") + 64
            if ids and size + n > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id), texts.append(text)
            size += n
    if ids:
        yield ids, texts


@dataclass(frozen=True)
class Alignment:
    """documents: DOCUMENT of every row; links: (a, b, n_docs) of every id pair; dictionary: (key, a, b, docs) of every distinct group."""

    documents: DataFrame
    links: DataFrame
    dictionary: DataFrame


def _interned(docs: DataFrame, files: tuple[str, str, str, str], most: int) -> DataFrame:
    """ROWS of three kinds: documents (held not null), dictionary entries (key not null), and id pairs counted too often (a, b and docs alone)."""

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        names = [x.split()[0] for x in ROWS.split(", ")]
        kinds = dict(zip(names, (pa.int64(),) * 5 + (pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32()), strict=True))

        def batch_of(n: int, **columns):
            return pa.RecordBatch.from_arrays([c if isinstance(c := columns.get(x), pa.Array) else pa.nulls(n, k) if c is None else pa.array(c, k) for x, k in kinds.items()], names=names)

        def lists(ids, starts, sizes):
            ends = np.append(0, np.cumsum(sizes))
            at = np.repeat(starts - ends[:-1], sizes) + np.arange(int(ends[-1]))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[at], pa.int32()))

        partition = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_chunks(batches, most)):
            c = Chunk(encoders(*files), texts)
            chunk, n = (partition << 32) + number, len(ids)
            links = np.bincount(c.doc_of, c.size_a * c.size_b, len(c.n_a)).astype(np.int64) if len(c.n_a) else np.zeros(0, np.int64)
            full = lambda values, has=c.has, n=n: np.bincount(np.flatnonzero(has), values, n).astype(np.int64)  # noqa: E731  zeros for documents without tokens
            cut = np.searchsorted(c.held_doc, np.arange(len(c.n_a) + 1))
            own = iter(zip(cut, cut[1:], c.digests(), strict=False))
            held, many, sha = [], [], []
            for has in c.has.tolist():
                i, j, digest = next(own) if has else (0, 0, "")
                held.append(c.held[i:j].astype("<i4").tobytes()), many.append(c.many[i:j].astype("<i4").tobytes()), sha.append(digest)
            yield batch_of(n, chunk=np.full(n, chunk), doc_id=ids, n_a=full(c.n_a), n_b=full(c.n_b), n_links=full(links), groups_sha256=sha, held=held, many=many)
            if m := len(c.keys):
                keys = c.keys.tobytes()
                one = c.one
                yield batch_of(m, chunk=np.full(m, chunk), at=np.arange(m), key=[keys[i : i + 16] for i in range(0, 16 * m, 16)], a=lists(c.a, c.from_a[one], c.size_a[one]), b=lists(c.b, c.from_b[one], c.size_b[one]), docs=c.docs)
            x, y, extra = c.too_often() if m else ((), (), ())
            if k := len(x):
                yield batch_of(k, chunk=np.full(k, chunk), a=lists(x, np.arange(k), np.ones(k, int)), b=lists(y, np.arange(k), np.ones(k, int)), docs=extra)

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidied(of), ROWS)


def align(docs: DataFrame, json_file: str, ranks_file: str, pattern: str, model_file: str, chunk_bytes: int = CHUNK_BYTES) -> Alignment:
    """The alignment of every text's tokens by A (a tokenizer file, and the same vocabulary as ranks and pattern) and B (a piece model)."""
    rows = staged(_interned(docs, (json_file, ranks_file, pattern, model_file), chunk_bytes), "interned")
    entries = rows.where("key is not null")
    dictionary = staged(entries.groupBy("key").agg(F.first("a").alias("a"), F.first("b").alias("b"), F.sum("docs").alias("docs")), "dictionary")

    # an entry's distinct ids of either side with their numbers, then its pairs: each distinct group is expanded once
    often = lambda c: F.expr(f"transform(array_distinct({c}), x -> named_struct('id', x, 'n', size(filter({c}, y -> y = x))))")
    pairs = dictionary.select("key", "docs", F.explode(often("a")).alias("x"), "b").select("key", "docs", "x", F.explode(often("b")).alias("y"))
    pairs = pairs.select("key", "docs", F.col("x.id").alias("a"), F.col("y.id").alias("b"), (F.col("x.n").cast("long") * F.col("y.n")).alias("n"))
    less = rows.where("key is null and held is null").select(F.col("a")[0].alias("a"), F.col("b")[0].alias("b"), (-F.col("docs")).cast("long").alias("docs"))
    links = staged(pairs.select("a", "b", "docs").unionByName(less).groupBy("a", "b").agg(F.sum("docs").alias("n_docs")), "links")
    best = links.groupBy("a").agg(F.max("n_docs").alias("best"))
    ranked = staged(links.join(F.broadcast(best), "a").withColumn("is_best", F.col("n_docs") == F.col("best")).drop("best"), "ranked")  # a row for each A id, no more than its vocabulary has
    totals = pairs.join(ranked, ["a", "b"]).groupBy("key").agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("best"), F.sum(F.col("n") * F.col("n_docs")).alias("total"))
    back = entries.select("key", "chunk", "at").join(totals, "key").select("chunk", "at", "best", "total")
    held = rows.where("held is not null").select(F.col("chunk").alias("own"), "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "held", "many")

    def of(own, found):
        import numpy as np
        import pyarrow as pa

        at = found["at"].to_numpy().astype(np.int64)
        best, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        best[at], total[at] = found["best"].to_numpy(), found["total"].to_numpy()
        numbers, many = (own[c].to_pylist() for c in ("held", "many"))
        ends = np.append(0, np.cumsum([len(x) // 4 for x in numbers]))
        numbers, many = (np.frombuffer(b"".join(x), "<i4").astype(np.int64) for x in (numbers, many))

        def summed(values):
            upto = np.append(0, np.cumsum(values))
            return pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64())

        return pa.table([own["doc_id"], own["n_a"], own["n_b"], summed(many), own["n_links"], summed(best[numbers] * many), summed(total[numbers] * many), own["groups_sha256"]], names=[c.split()[0] for c in DOCUMENT.split(", ")])

    documents = held.groupBy("own").cogroup(back.groupBy("chunk")).applyInArrow(of, DOCUMENT)
    return Alignment(documents, links, dictionary)
