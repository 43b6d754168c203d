"""Splitting texts into chunks: recursive by words, by Markdown heading, and around spans that must stay whole.

The splitters are pure functions of one text (greedy packing and nesting are sequential); `chunk_rows` runs any of them
over a table in Arrow batches, and `register_udtf` offers them to SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, MapType, StringType, StructField, StructType

from ..functions.text import TABLE, check_window
from .sentences import Boundaries, joined

Span = tuple[int, int]
#: What ends sentences and paragraphs, names of environments, and what sentence splitting must not cut
#: (displayed and inline formulas, references to figures, tables and equations with the mark after them, and their abbreviations).
SENTENCE_END = re.compile(r"(?<=[.!?])(\s+)")
PARAGRAPH_GAP = re.compile(r"\n\s*\n")
OPENING = re.compile(r"\\begin\{([^}]+)\}")
PROTECTED = re.compile(r"\\\[.*?\\\]|\$.*?\$|(?:Fig\.|Figure|Tab\.|Table|Eq\.|Equation)\s+\d+[.:]|\b(?:[Ff]igs?|[Tt]abs?|[Ee]qs?)\.", re.DOTALL)
BEGIN = "\\begin{"
HEADING = re.compile(r"(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$")
FENCE = re.compile(r"\s{0,3}(```+|~~~+)")
#: Characters of texts whose pieces are held at a time; the last of them may go beyond.
CHARACTERS_AT_A_TIME = 1_000_000


@dataclass(frozen=True)
class Section:
    """A piece of text and the headings above it, by level."""

    content: str
    headers: dict[int, str] = field(default_factory=dict)


def split_paragraphs(text: str) -> list[str]:
    return [p for p in PARAGRAPH_GAP.split(text) if p.strip()]


def split_sentences(text: str) -> list[str]:
    """Sentences with the white space after them; together they are the text, unless a blank piece was dropped."""
    out, start = [], 0
    for gap in SENTENCE_END.finditer(text):
        out.append(text[start : gap.end()])
        start = gap.end()
    return [s for s in [*out, text[start:]] if s.strip()]


def recursive_chunks(text: str, size: int = 100, overlap: int = 0) -> list[str]:
    """Chunks of at most `size` words: by paragraphs, then sentences, then words; only windows of words overlap.

    A text within the size stays as it is. Paragraphs are packed with a blank line between them, sentences as they stand; a sentence over
    the size among others is a chunk of its own, uncut. A single sentence is cut into windows of words.
    """
    check_window(size, overlap)
    if len(text.split()) <= size:
        return [text]
    if len(paragraphs := split_paragraphs(text)) > 1:
        return [c for group in _packed(paragraphs, "\n\n", size) for c in recursive_chunks(group, size, overlap)]
    if len(sentences := split_sentences(text)) > 1:
        return _packed(sentences, "", size)
    words = text.split()
    return [" ".join(words[i : i + size]) for i in range(0, len(words), size - overlap)]


def _packed(parts: list[str], glue: str, size: int) -> list[str]:
    """Neighbours joined while they stay within the size."""
    out: list[str] = []
    held = ""
    for part in parts:
        joined = held + glue + part if held else part
        if held and len(joined.split()) > size:
            out.append(held)
            held = part
        else:
            held = joined
    return [*out, held] if held else out


def header_sections(text: str) -> list[Section]:
    """Sections that start at Markdown headings of level 1 to 6, heading line kept; headings inside code fences are text."""
    out: list[Section] = []
    headers: dict[int, str] = {}
    lines: list[str] = []
    fence = ""

    def flush() -> None:
        if content := "\n".join(lines).strip():
            out.append(Section(content, dict(headers)))
        lines.clear()

    for line in text.split("\n"):
        mark = FENCE.match(line)
        if mark and (not fence or mark[1].startswith(fence)):
            fence = "" if fence else mark[1]
        found = None if fence or mark else HEADING.match(line)
        if found:
            flush()
            level = len(found[1])
            headers = {k: v for k, v in headers.items() if k < level} | {level: found[2]}
        lines.append(line)
    flush()
    return out


def matching_end(text: str, at: int) -> int:
    """Where the environment that begins at `at` ends, others of its name inside counted; -1 if it never does.

    The name is the first that can be read from `at` on, anything up to a closing brace; marks of that name count from where the
    opening one would end if it stood at `at`.
    """
    if not (first := OPENING.search(text, at)):
        return -1
    opening, closing, depth = first[0], f"\\end{{{first[1]}}}", 1
    for mark in re.compile(f"{re.escape(opening)}|{re.escape(closing)}").finditer(text, at + len(opening)):
        depth += 1 if mark[0] == opening else -1
        if not depth:
            return mark.end()
    return -1


def environment_spans(text: str) -> list[Span]:
    """Outermost LaTeX environments; one that isn't closed is passed over, and the search goes on after its `\\begin`."""
    spans, at = [], 0
    while (at := text.find(BEGIN, at)) >= 0:
        end = matching_end(text, at)
        if end < 0:
            at += len(BEGIN) - 1
        else:
            spans.append((at, end))
            at = end
    return spans


def table_spans(text: str) -> list[Span]:
    """Tables: two lines or more between bars, each ended by a newline; the first may start within a line."""
    return [m.span() for m in re.finditer(TABLE, text)]


def merge_spans(spans: Iterable[Span]) -> list[Span]:
    """Sorted, overlapping and touching ones joined."""
    out: list[Span] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def preserved_spans(text: str) -> list[Span]:
    """Environments and the tables outside of them, merged."""
    environments = environment_spans(text)
    return merge_spans(environments + [t for t in table_spans(text) if not any(s <= t[0] and t[1] <= e for s, e in environments)])


def protected_sentences(text: str, learned: Boundaries | None = None) -> list[str]:
    """Sentences, trimmed, never cut inside formulas and references; masks end in a sign of their own, so none is part of another.

    With `learned` (sentences.learn), stops of abbreviations, initials and numbers end no sentence either.
    """
    kept: list[str] = []

    def mask(m: re.Match) -> str:
        kept.append(m[0])
        return f"\x00{len(kept) - 1}\x01"

    masked = PROTECTED.sub(mask, text)
    restore = lambda s: re.sub("\x00(\\d+)\x01", lambda m: kept[int(m[1])], s)
    pieces = split_sentences(masked)
    return [restore(s.strip()) for s in (joined(pieces, learned) if learned else pieces)]


def structured_chunks(text: str, learned: Boundaries | None = None) -> list[str]:
    """Sentences of what lies between preserved spans, and each span whole, in order."""
    out, at = [], 0
    for start, end in preserved_spans(text):
        out += protected_sentences(text[at:start], learned)
        out.append(text[start:end])
        at = end
    return out + protected_sentences(text[at:], learned)


def section_chunks(text: str, size: int, learned: Boundaries | None = None) -> list[Section]:
    """An extension: sections, and those over the size cut into structured chunks packed up to it, with their headings."""
    out = []
    for s in header_sections(text):
        parts = [s.content] if len(s.content.split()) <= size else _packed(structured_chunks(s.content, learned), " ", size)
        out += [Section(p, s.headers) for p in parts]
    return out


def as_sections(chunks: Iterable[str | Section]) -> list[Section]:
    """Any chunker's output: strings have no headings."""
    return [c if isinstance(c, Section) else Section(str(getattr(c, "page_content", c)), dict(getattr(c, "metadata", {}))) for c in chunks]


def portions(batch) -> Iterator[list[tuple[int, str]]]:
    """Places and texts of a batch's second column, nulls left out, until they have CHARACTERS_AT_A_TIME: a batch counts rows, however long their texts."""
    part, held = [], 0
    for at, value in enumerate(batch.column(1)):
        if (t := value.as_py()) is None:
            continue
        part.append((at, t))
        held += len(t)
        if held >= CHARACTERS_AT_A_TIME:
            yield part
            part, held = [], 0
    yield part


def chunk_rows(docs: DataFrame, chunker: Callable[[str], Iterable[str | Section]], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, chunk_no from 0, content, headers) of every text, and the columns `keep` of its row, in the order of rows; a null text has no chunks. Each text is split once.

    A row's columns go along with its chunks, so that nothing has to be joined back and repeated ids do no harm. Kept columns may not be called as the others are.
    """
    if clash := {"doc_id", "chunk_no", "content", "headers"} & set(keep):
        raise ValueError(f"{sorted(clash)} can't be kept under that name")

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.string(), pa.map_(pa.int32(), pa.string()))
        for batch in batches:
            for part in portions(batch):
                rows = [(at, n, c.content, list(c.headers.items())) for at, t in part for n, c in enumerate(as_sections(chunker(t)))]
                if rows:
                    at, *columns = (pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *columns, *(c.take(at) for c in batch.columns[2:])], names=["doc_id", "chunk_no", "content", "headers", *keep])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *(F.col(f"`{c}`") for c in keep))
    own = [StructField("doc_id", LongType()), StructField("chunk_no", LongType()), StructField("content", StringType()), StructField("headers", MapType(IntegerType(), StringType()))]
    return rows.mapInArrow(of, StructType([*own, *rows.schema.fields[2:]]))


def span_rows(docs: DataFrame, finder: Callable[[str], list[Span]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, span_no, start, end) of every text, half-open, in code points."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in portions(batch):
                rows = [(batch.column(0)[at].as_py(), n, s, e) for at, t in part if t for n, (s, e) in enumerate(finder(t))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "span_no", "start", "end"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(of, "doc_id long, span_no long, start long, end long")


def register_udtf(spark: SparkSession, name: str = "recursive_chunks") -> None:
    """A table function for SQL: SELECT ... FROM docs, LATERAL recursive_chunks(text, size, overlap)."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="chunk_no int, content string")
    class RecursiveChunks:
        def eval(self, text: str, size: int, overlap: int):
            if text is not None:
                yield from enumerate(recursive_chunks(text, size, overlap))

    spark.udtf.register(name, RecursiveChunks)
