"""Text functions as column expressions: normalisation, tokens, counts, previews, sentences, windows, tables.

White space here is what Unicode counts as such together with U+001C to U+001F, spelt out, because Java's and RE2's
`\\s` are narrower.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space (code points above 255 by their hexadecimal numbers), and the 32 ASCII punctuation characters.
WS = r"[\t-\r\x1c-\x20\x85\xa0{u}1680{u}2000-{u}200a{u}2028{u}2029{u}202f{u}205f{u}3000]".replace("{u}", chr(92) + "u")
NOT_WS = WS.replace("[", "[^", 1)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Fixed value: a line between bars and at least one more, none empty, each ended by a newline.
TABLE = r"\|[^\n]+\|\n(?:\|[^\n]+\|\n)+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize(c: Column | str) -> Column:
    """Lower case, without ASCII punctuation, white space collapsed to single spaces, trimmed."""
    bare = F.translate(F.lower(col(c)), PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, WS + "+", " "))


def words(c: Column | str) -> Column:
    """Words between white space."""
    return F.filter(F.split(col(c), WS + "+", -1), lambda x: x != "")


def tokens(c: Column | str) -> Column:
    """Words of the normalised text; white space need not be collapsed first."""
    return words(F.translate(F.lower(col(c)), PUNCTUATION, ""))


def word_count(c: Column | str) -> Column:
    return F.size(words(c)).cast("long")


def fuzzy_share(reference: Column, document: Column) -> Column:
    """Share of the reference's tokens, repeated ones counted, that the document's tokens hold; null for no tokens."""
    return F.try_divide(F.size(F.filter(reference, lambda t: F.array_contains(document, t))).cast("double"), F.size(reference).cast("double"))


def is_fuzzy_match(reference: Column, document: Column, threshold: float) -> Column:
    return F.coalesce(fuzzy_share(reference, document) >= threshold, F.lit(False))


def is_blank(c: Column) -> Column:
    return ~c.rlike(NOT_WS)


def paragraphs(c: Column | str) -> Column:
    """Pieces between blank lines, as they are; blank ones are dropped."""
    return F.filter(F.split(col(c), rf"\n{WS}*\n", -1), lambda p: ~is_blank(p))


def sentences(c: Column | str) -> Column:
    """Pieces that end with a full stop, exclamation or question mark and the white space after it; blank ones are dropped."""
    return F.filter(F.regexp_extract_all(col(c), F.lit(rf"(?s)(?:[^.!?]|[.!?](?!{WS}))*+(?:[.!?]{WS}++|$)"), F.lit(0)), lambda s: (s != "") & ~is_blank(s))


def word_windows(c: Column | str, size: int, overlap: int = 0) -> Column:
    """Windows of `size` words, each `size - overlap` after the one before, joined by single spaces.

    With an overlap the last window may lie wholly inside the one before it.
    """
    check_window(size, overlap)

    def windows(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, size), " "))

    return F.flatten(F.transform(F.array(words(c)), windows))  # the words are bound once, not split anew for each window


def check_window(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"an overlap of {overlap} words in windows of {size} never ends; 0 <= overlap < size is asked for")


def tables(c: Column | str) -> Column:
    """Texts of the tables in a text."""
    return F.regexp_extract_all(col(c), F.lit(TABLE), F.lit(0))


def first_text(*columns: Column | str) -> Column:
    """The first that is neither null nor empty, else ''."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in columns), F.lit(""))


def basename(c: Column | str) -> Column:
    """What follows the last slash; N/A for an empty or missing path."""
    path = col(c)
    return F.when(F.coalesce(path, F.lit("")) == "", F.lit("N/A")).otherwise(F.substring_index(path, "/", -1))


def preview(c: Column | str, size: int = 500) -> Column:
    """The first `size` characters, and `...` if there are more."""
    text = col(c)
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def display(c: Column | str, size: int) -> Column:
    """The first `size` characters and `...`, always."""
    return F.concat(F.substring(col(c), 1, size), F.lit("..."))


def cleanup(c: Column | str) -> Column:
    """Without double quotes at the ends, and with a backslash and n turned into a newline."""
    return F.replace(F.btrim(col(c), F.lit('"')), F.lit("\\n"), F.lit("\n"))


def heading_lines(headers: Column) -> Column:
    """Markdown lines of a map from heading level to title."""
    return F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(F.repeat(F.lit("#"), e["key"]), F.lit(" "), e["value"]))


def to_whole(c: Column, kind: str) -> Column:
    """A number or its text, truncated toward zero; null where it is none."""
    return c.cast("string").try_cast("double").try_cast(kind)


def strip_fence(c: Column | str) -> Column:
    """A model's reply without code fences: what a fence marked json holds, else what any fence holds, else all; trimmed."""
    text, trimmed = col(c), lambda x: F.regexp_replace(x, rf"^{WS}+|{WS}+$", "")
    inside = lambda mark: F.split(F.substring(text, F.instr(text, F.lit(mark)) + len(mark), F.length(text)), "```", 2)[0]
    return trimmed(F.when(F.instr(text, "```json") > 0, inside("```json")).when(F.instr(text, "```") > 0, inside("```")).otherwise(text))


def harmonic_mean(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """part / whole; 0 where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))
