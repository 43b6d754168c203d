"""Operator 9, media columns as content-defined chunks.

A document's text, as UTF-8 and padded with bytes 255 to a positive multiple of 576, is a picture of 8-bit samples, 24 wide. A
rolling gear hash cuts the payload into chunks where the hash of the last 32 bytes meets a mask, so that passages shared by documents give
equal chunks. The stored form of a document is its recipe (a header and the ordered list of digest and length of its chunks)
and, in that order, the samples of these chunks, which lie beside the recipe or, for a chunk that occurs more than once in the table,
once for all in the chunk table; `media_bytes` and `media_sha256` are those of the form as it was read back from both.

1. Digests alone, without bytes, are grouped by Spark to find those that more than one place holds.
2. A Bloom filter over these digests goes to all tasks, with BITS_EACH bits for each of them, but MOST_BITS (64 MB) at most. Chunks
   that it doesn't hold are certainly single and are stored with their recipe, where the text is; the others go to the chunk table.
   More shared chunks than the largest filter can tell apart only send more chunks there; nothing is lost.
3. One pass over the texts writes recipes and the filter's chunks; the latter are deduplicated by digest and written; only they
   are shuffled.
4. Reading back, recipes that name shared chunks are joined with the chunk table, all chunks are put in order,
   every digest is verified, and features are computed from the samples read.

Defined cases: a null text counts as empty (one padded block); equal texts have equal values; repeated rows each get a row; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, staged

UNIT, PAD, WIDTH = 576, 255, 24
LEAST, MASK_BITS, MOST = 512, 11, 8192
#: Bits of the filter: for each digest, at least (2 MB) and at most (64 MB); and how many are set for a digest.
BITS_EACH, LEAST_BITS, MOST_BITS, FILTER_HASHES = 16, 1 << 24, 1 << 29, 4
#: Words of the filter that are put together at a time.
PAGE = 1 << 12
DIGEST = 16
MAGIC = b"CLM1"
STORED = "row long, doc_id long, n_bytes long, recipe binary, own binary, shared array<int>, digest binary, samples binary"
RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


@functools.cache
def _gear():
    """A value for each byte, from a fixed seed."""
    import numpy as np

    return np.random.default_rng(9).integers(0, 2**32, 256, np.uint32)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and the padded payload."""
    data = (text or "").encode()
    return len(data), data + bytes([PAD]) * ((-len(data)) % UNIT if data else UNIT)


def cuts(payload: bytes) -> list[int]:
    """Ends of the chunks. The gear hash h = 2h + gear[byte], of 32 bits, at every place at once: 32 bytes back all else has left it."""
    import numpy as np

    h = _gear()[np.frombuffer(payload, np.uint8)]
    for w in (1, 2, 4, 8, 16):
        h[w:] = h[w:] + (h[:-w] << np.uint32(w)) if len(h) > w else h[w:]
    ends, start, n = [], 0, len(payload)
    for at in (np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist():
        while at - start > MOST:
            start += MOST
            ends.append(start)
        if at - start >= LEAST:
            ends.append(at)
            start = at
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunks(payload: bytes) -> list[tuple[bytes, bytes]]:
    """(digest, samples) in order."""
    out, start = [], 0
    for end in cuts(payload):
        part = payload[start:end]
        out.append((hashlib.blake2b(part, digest_size=DIGEST).digest(), part))
        start = end
    return out


def recipe_of(n_bytes: int, listed: list[tuple[bytes, bytes]]) -> bytes:
    """Magic, width, bytes of the text, chunks, and digest and length of each."""
    return b"".join([MAGIC, struct.pack("<IQI", WIDTH, n_bytes, len(listed)), *(d + struct.pack("<I", len(p)) for d, p in listed)])


def read_recipe(recipe: bytes) -> tuple[int, list[tuple[bytes, int]]]:
    """Bytes of the text; (digest, length) in order."""
    if recipe[:4] != MAGIC:
        raise ValueError("no recipe")
    _, n_bytes, count = struct.unpack_from("<IQI", recipe, 4)
    at = 20
    return n_bytes, [(recipe[i : i + DIGEST], struct.unpack_from("<I", recipe, i + DIGEST)[0]) for i in range(at, at + count * (DIGEST + 4), DIGEST + 4)]


class Filter:
    """A Bloom filter over digests; words: its bits, 64 by 64."""

    def __init__(self, words) -> None:
        self.words, self.bits = words, 64 * len(words)

    @staticmethod
    def places(digest: bytes, bits: int) -> tuple[int, ...]:
        return tuple(x % bits for x in struct.unpack("<4I", digest))[:FILTER_HASHES]

    def __contains__(self, digest: bytes) -> bool:
        words = self.words
        return all(words[p >> 6] >> (p & 63) & 1 for p in self.places(digest, self.bits))


def _texts(docs: DataFrame) -> DataFrame:
    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text")


def shared_filter(docs: DataFrame):
    """64-bit words of the filter over digests that more than one place holds."""
    import numpy as np

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([d for t in batch.column(1).to_pylist() for d, _ in chunks(payload_of(t)[1])], pa.binary())], names=["digest"])

    many = staged(_texts(docs).mapInArrow(of, "digest binary").groupBy("digest").count().where("count > 1").select("digest"), "shared")
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * many.count()).bit_length()))

    def bits(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(batch.num_rows, -1)[:, :FILTER_HASHES].astype(np.int64).ravel() % size
            at.sort()
            word, begin = np.unique(at >> 6, return_index=True)
            held = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)), begin)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(held.view(np.int64), pa.int64())], names=["word", "bits"])

    def page(table):
        import pyarrow as pa

        word = table["word"].to_numpy()
        words = np.zeros(PAGE, np.int64)
        words[word % PAGE] = table["bits"].to_numpy()
        return pa.table([pa.array([int(word[0]) // PAGE], pa.int64()), pa.array([words.tobytes()], pa.binary())], names=["page", "words"])

    # a task holds the bits of a batch, and a page; the driver gets the filter's own bytes, at most MOST_BITS / 8
    held = many.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    pages = held.withColumn("page", F.floor(F.col("word") / PAGE)).groupBy("page").applyInArrow(page, "page long, words binary").toArrow()
    words = np.zeros(size // 64, np.int64)
    for number, own in zip(pages.column("page").to_pylist(), pages.column("words").to_pylist(), strict=True):
        words[number * PAGE : (number + 1) * PAGE] = np.frombuffer(own, np.int64)[: len(words) - number * PAGE]
    return words


def store(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written media: (row, doc_id, n_bytes, recipe, own samples, numbers of shared chunks), and the chunk table (digest, samples)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(shared_filter(docs).tobytes())

    def media(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        filter_, row = Filter(memoryview(sent.value).cast("Q")), TaskContext.get().partitionId() << 33
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary())
        for batch in batches:
            out, found = [], {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, payload = payload_of(text)
                listed = chunks(payload)
                shared = [i for i, (d, _) in enumerate(listed) if d in filter_]
                apart = set(shared)
                own = payload if not shared else b"".join(p for i, (_, p) in enumerate(listed) if i not in apart)
                found.update(listed[i] for i in shared)
                out.append((row, doc_id, n, recipe_of(n, listed), own, shared, None, None))
                row += 1
            out += [(None,) * 6 + (d, p) for d, p in found.items()]  # a chunk row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in STORED.split(", ")])

    written = staged(_texts(docs).mapInArrow(media, STORED), "media")
    sent.unpersist()
    table = staged(written.where("digest is not null").select("digest", "samples").dropDuplicates(["digest"]), "chunks")
    return written.where("digest is null").drop("digest", "samples"), table


def rebuilt(recipe: bytes, own: bytes, shared: dict[int, bytes]) -> tuple[int, bytes, bytes]:
    """Bytes of the text, payload and stored form of a document; raises where a chunk isn't what the recipe says."""
    n_bytes, listed = read_recipe(recipe)
    parts, at = [], 0
    for i, (digest, length) in enumerate(listed):
        if i in shared:
            part = shared[i]
        else:
            part = own[at : at + length]
            at += length
        if len(part) != length or hashlib.blake2b(part, digest_size=DIGEST).digest() != digest:
            raise ValueError(f"chunk {i} is damaged")
        parts.append(part)
    payload = b"".join(parts)
    return n_bytes, payload, recipe + payload


def feature(payload: bytes) -> str:
    """Mean, deviation and contrast between neighbours of the samples, and their histogram over eighths."""
    import numpy as np

    x = np.frombuffer(payload, np.uint8)
    bins = np.bincount(x >> 5, minlength=8)
    return f"{x.mean():.3f};{x.std():.3f};{np.abs(np.diff(x.astype(np.int16))).mean():.3f};" + ",".join(f"{b / len(x):.4f}" for b in bins)


def describe(doc_id, recipe: bytes, own: bytes, shared: dict[int, bytes]) -> tuple:
    n, payload, form = rebuilt(recipe, own, shared)
    return doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(form), hashlib.sha256(form).hexdigest(), feature(payload)


_KINDS = ("int64", "int64", "int64", "string", "int64", "int64", "string", "string")


def _result(rows: list[tuple]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, getattr(pa, k)()) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def media_table(docs: DataFrame) -> DataFrame:
    """Store every document, read it back, and return sizes, digests and features of what was read."""
    stored, table = store(docs)

    def alone(batches: Iterable) -> Iterator:
        for batch in batches:
            rows = [describe(*r, {}) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield _result(rows)

    def joined(batches: Iterable) -> Iterator:
        for batch in batches:
            rows = [describe(d, r, o, {p["at"]: p["samples"] for p in parts}) for d, r, o, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield _result(rows)

    single = stored.where("size(shared) = 0").select("doc_id", "recipe", "own").mapInArrow(alone, RESULT)
    some = stored.where("size(shared) > 0")
    # digest of chunk i of a recipe: it starts at byte 20 + i * (DIGEST + 4)
    named = some.select("row", F.explode("shared").alias("at"), "recipe").select("row", "at", F.expr(f"substring(recipe, 21 + at * {DIGEST + 4}, {DIGEST})").alias("digest"))
    parts = named.join(table, "digest").groupBy("row").agg(F.collect_list(F.struct("at", "samples")).alias("parts"))
    several = some.select("row", "doc_id", "recipe", "own").join(parts, "row").select("doc_id", "recipe", "own", "parts").mapInArrow(joined, RESULT)
    return single.unionByName(several)
