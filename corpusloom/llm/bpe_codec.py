"""Operator 4, byte-level BPE encoding and decoding by a lazily determinised transducer.

Encoding: the pattern divides a text into matches. The bytes of all matches of a batch, each match ended by END, are one
stream of the transducer of bpe.py, which emits tokens after bounded lookahead; it is read in chunks, all at once, and
matches longer than a chunk are cut anywhere, as bpe.py says. Decoding: token bytes stream through an incremental
UTF-8 state machine that holds back an unfinished character until its last byte has come.

The usual pattern of byte-level vocabularies is itself read as a machine over classes of characters (Matches); other
patterns are searched for. Nothing is remembered from text to text but the machine.

Defined cases: a null text counts as empty and has no ids; repeated rows each get their row; an empty table gives an
empty result; extra columns are ignored. Texts are never cut short.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .bpe import END, Transducer, chunk_begins, no_collector, portions
from .common import own_columns

#: Fixed value: the pattern that Matches reads by classes.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE, BLANK, LETTER, NUMBER, OTHER, EDGE = range(6)
#: Ids decoded at a time.
DECODE_IDS = 1 << 14
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Memo(dict):
    """part -> make(part), remembered within a bound."""

    def __init__(self, make, most: int = 700_000, longest: int = 40) -> None:
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, part):
        value = self.make(part)
        if len(part) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[part] = value
        return value


@functools.cache
def classes():
    """Class of every code point: OTHER, but for letters, numbers, white space (SPACE) and the space itself (BLANK)."""
    import numpy as np
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(pattern, every):
                table[low + m.start() : low + m.end()] = kind
    table[32] = BLANK
    return table


class Matches:
    """Where the matches of a pattern begin in texts."""

    def __init__(self, pattern: str) -> None:
        import regex

        self.usual, self.search = pattern == USUAL, regex.compile(pattern).finditer

    def __call__(self, points, edges):
        """Whether a match begins at each place of an array of code points; texts are divided and ended by line feeds at `edges`, where none begins."""
        import numpy as np

        if not self.usual:
            begins = np.zeros(len(points), bool)
            start = 0
            for edge in edges.tolist():
                text = points[start:edge].astype("<u4").tobytes().decode("utf-32-le")
                places = [m.span() for m in self.search(text) if m.end() > m.start()]
                if sum(b - a for a, b in places) != len(text):
                    raise ValueError("the pattern leaves characters out")
                begins[[start + a for a, _ in places]] = True
                start = edge + 1
            return begins
        kind = classes().take(points)
        kind[edges] = EDGE
        before, after = np.append(np.uint8(EDGE), kind[:-1]), np.append(kind[1:], np.uint8(EDGE))
        white, solid_next = kind <= BLANK, (after > BLANK) & (after != EDGE)
        # white space: where a run of it begins, and its last one if a character follows, which goes with that if it is a space
        # others: where the class changes, but not after a space
        begins = np.where(white, (before > BLANK) | solid_next, (kind != before) & (before != BLANK))
        begins[edges] = False
        # an apostrophe that begins a match takes certain letters along
        for at in np.flatnonzero((points == 39) & begins).tolist():
            ahead = "".join(map(chr, points[at + 1 : at + 3].tolist()))
            size = 3 if ahead in ("re", "ve", "ll") else 2 if ahead[:1] in ("s", "t", "m", "d") else 0
            if size:
                begins[at + 1] = False
                if kind[at + size] == LETTER:
                    begins[at + size] = True
        return begins


class Strings:
    """Byte strings by number, to be put together."""

    def __init__(self, strings: dict[int, bytes]) -> None:
        import numpy as np

        self.size = np.zeros(max(strings) + 1, np.int64)
        for i, x in strings.items():
            self.size[i] = len(x)
        self.at = np.cumsum(self.size) - self.size
        self.octets = np.frombuffer(b"".join(strings[i] for i in sorted(strings)), np.uint8)

    def join(self, numbers) -> bytes:
        import numpy as np

        size = self.size.take(numbers)
        ends = np.cumsum(size)
        return self.octets.take(np.repeat(self.at.take(numbers) - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)).tobytes()


class ByteBpe:
    """ranks: token bytes -> id, which is also its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.matches = ranks, Matches(pattern)
        self.machine = Transducer(ranks, ranks)
        self.tokens, self.decimals = Strings({i: t for t, i in ranks.items()}), Strings({i: b"%d " % i for i in ranks.values()})

    def _encoded(self, texts: list[str]) -> Iterator:
        """Ids of each text, as arrays; read as one stream."""
        import numpy as np

        joined = "\n".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.int32)
        edges = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
        begins = self.matches(points, edges)
        # the bytes, with END before each match but the first of a text, and in place of the edge after its last
        octets = np.frombuffer(joined.encode(), np.uint8).astype(np.int32)
        lead = np.flatnonzero((octets & 0xC0) != 0x80)  # where characters begin
        octets[lead[edges]] = END
        inner = begins.copy()
        inner[np.append(0, edges[:-1] + 1)] = False
        symbols = np.insert(octets, lead[inner], END)
        certain = np.append(0, np.flatnonzero(symbols[:-1] == END) + 1)
        labels, many = self.machine.labels_of(self.machine.read(symbols, *chunk_begins(certain, len(symbols)), record=True).taken)
        # ids until the edge of each text
        edge_at = lead[edges] + np.cumsum(inner)[edges]
        until = np.cumsum(many)[edge_at].tolist()
        start = 0
        for end in until:
            yield labels[start:end]
            start = end

    def encode_all(self, texts: list[str]) -> Iterator:
        """An array of ids for each text."""
        for some in portions(texts):
            yield from self._encoded(some)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def decode_stream(self, ids, at_a_time: int = 1) -> Iterator[str]:
        """Text as soon as whole characters have come, after so many ids each; bytes that are no UTF-8 become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in range(0, len(ids), at_a_time):
            if text := machine.decode(self.tokens.join(ids[i : i + at_a_time])):
                yield text
        if text := machine.decode(b"", True):
            yield text


@functools.cache
def codec(path: str, pattern: str) -> ByteBpe:
    """The compiled vocabulary of a worker; kept from task to task."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return ByteBpe(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every row."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = codec(path, pattern)
        for batch in batches:
            with no_collector():
                ids = list(bpe.encode_all([t or "" for t in batch.column(1).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(of, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give a null text."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if ids is None else "".join(bpe.decode_stream(ids, DECODE_IDS)) for ids in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return own_columns(encoded, "doc_id", "ids").mapInArrow(of, "doc_id long, text string")


def digests(bpe: ByteBpe, ids) -> tuple[int, str, str]:
    """Number of ids, digest of the ids in decimal, and digest of the text that they are decoded to, as a stream."""
    whole = hashlib.sha256()
    for piece in bpe.decode_stream(ids, DECODE_IDS):
        whole.update(piece.encode())
    return len(ids), hashlib.sha256(bpe.decimals.join(ids)[:-1]).hexdigest(), whole.hexdigest()


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every row, decode the ids again, and return digests of both; one pass, no shuffle."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        bpe = codec(path, pattern)
        for batch in batches:
            with no_collector():
                rows = [digests(bpe, ids) for ids in bpe.encode_all([t or "" for t in batch.column(1).to_pylist()])]
            n, coded, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(of, SCHEMA)
