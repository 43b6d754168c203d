"""Sentence boundaries learned from a corpus without labels: abbreviations, collocations and sentence starters by log-likelihood ratios.

After Kiss and Strunk, Unsupervised Multilingual Sentence Boundary Detection (2006). A word that nearly always has a full stop, is short, and has stops inside is an
abbreviation; a pair of words around a stop that keep company more than chance has it, is a collocation; and a word that follows sentence ends more
than chance has it, is a starter. Counting is one aggregation of the words with what follows them, in Spark; what is learned is a small table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import staged

#: Fixed values of the method: least scores of the three, and the share of stops that an abbreviation is held to have.
ABBREVIATION, COLLOCATION, STARTER, STOPPED = 0.3, 7.88, 30.0, 0.99
#: What is learned has at most so many entries of each kind, the best ones.
MOST = 20_000
#: What is cut off a word but for a final stop.
EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}.]+$"


@dataclass(frozen=True)
class Boundaries:
    """What a corpus has taught, in lower case and without final stops."""

    abbreviations: frozenset[str] = frozenset()
    collocations: frozenset[tuple[str, str]] = frozenset()
    starters: frozenset[str] = field(default=frozenset())


def bare_words(text: Column | str) -> Column:
    """Words between white space, without signs at their edges but final stops; words of signs alone are left out."""
    return F.filter(F.transform(T.words(text), lambda w: F.regexp_replace(w, EDGES, "")), lambda w: w.rlike(r"[\p{L}\p{N}]"))


def kind_of(word: Column) -> Column:
    """A word in lower case without its final stops; all numbers are one."""
    return F.regexp_replace(F.regexp_replace(F.lower(word), r"[.]+$", ""), r"^[-+]?\p{N}[\p{N}.,]*$", "#")


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(kind, stopped, following, n): how often a word, with a stop or without, stands before another ("" at a text's end)."""
    words = docs.select(bare_words(F.col(f"`{text_col}`")).alias("w")).where(F.size("w") > 0)
    pairs = words.select(F.explode(F.arrays_zip(F.col("w").alias("word"), F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("after"))).alias("p")).select("p.*")
    return pairs.groupBy(kind_of(F.col("word")).alias("kind"), F.endswith("word", F.lit(".")).alias("stopped"), F.coalesce(kind_of(F.col("after")), F.lit("")).alias("following")).agg(F.count(F.lit(1)).alias("n"))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """(kind, with_stop, without_stop, score) of every word of letters that has a stop somewhere."""
    per = counts.groupBy("kind").agg(F.sum(F.when(F.col("stopped"), F.col("n")).otherwise(0)).alias("with_stop"), F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("n"))).alias("without_stop"))
    total = per.agg((F.sum("with_stop") / F.sum(F.col("with_stop") + F.col("without_stop"))).alias("p"))
    rows = per.where(r"with_stop > 0 and kind rlike '\\p{L}'").crossJoin(F.broadcast(total)).where("p < 1")  # one row
    held, bare = F.col("with_stop"), F.col("without_stop")
    ratio = lambda p: held * F.log(p) + bare * F.log(F.lit(1.0) - p)
    letters = F.length(F.regexp_replace("kind", "[.]", ""))
    stops = F.length("kind") - letters + 1
    score = F.lit(2.0) * (ratio(F.lit(STOPPED)) - ratio(F.col("p"))) * F.exp(-letters) * stops * F.pow(letters.cast("double"), -bare.cast("double"))
    return rows.select("kind", held.alias("with_stop"), bare.alias("without_stop"), score.alias("score"))


def _kept_company(a: Column, b: Column, both: Column, n: Column) -> Column:
    """Twice the log-likelihood ratio of b being likelier after a than elsewhere."""
    log = lambda p, k, m: F.when((p > 0) & (p < 1), k * F.log(p) + (m - k) * F.log(F.lit(1.0) - p)).otherwise(F.lit(0.0))
    p, after, elsewhere = b / n, both / a, F.when(n > a, (b - both) / (n - a)).otherwise(F.lit(0.0))
    return F.lit(2.0) * (log(after, both, a) + log(elsewhere, b - both, n - a) - log(p, both, a) - log(p, b - both, n - a))


def learn(docs: DataFrame, text_col: str = "text") -> Boundaries:
    """What the texts teach; an empty corpus teaches nothing. At most MOST entries of each kind come to the driver."""
    counts = staged(counted(docs, text_col), "word-pairs")
    scores = abbreviation_scores(counts).where(F.col("score") >= ABBREVIATION)
    known = staged(scores.orderBy(F.desc("score"), "kind").limit(MOST).select("kind", F.lit(True).alias("short")), "abbreviations")
    n = counts.agg(F.sum("n")).first()[0] or 0
    every = staged(counts.groupBy("kind").agg(F.sum("n").alias("all")), "kinds")
    stops = counts.where("stopped and following <> ''").join(F.broadcast(known), "kind", "left")  # at most MOST rows
    initial = F.col("short").isNotNull() | F.col("kind").rlike(r"^\p{L}$") | (F.col("kind") == "#")

    ends = stops.where(~initial).groupBy("following").agg(F.sum("n").alias("both"))
    total = ends.agg(F.coalesce(F.sum("both"), F.lit(0))).first()[0]
    whole = F.lit(float(n))
    begins = ends.join(every.select(F.col("kind").alias("following"), F.col("all").alias("b")), "following").withColumn("score", _kept_company(F.lit(float(total)), F.col("b"), F.col("both"), whole))
    starters = begins.where((F.col("score") >= STARTER) & (F.col("both") / F.lit(float(total)) > F.col("b") / whole) & F.col("following").rlike(r"^\p{L}")).orderBy(F.desc("score"), "following").limit(MOST)

    pairs = stops.where(initial).select("kind", "following", F.col("n").alias("both")).join(every.select("kind", F.col("all").alias("a")), "kind").join(every.select(F.col("kind").alias("following"), F.col("all").alias("b")), "following")
    pairs = pairs.withColumn("score", _kept_company(F.col("a"), F.col("b"), F.col("both"), whole)).where((F.col("both") > 1) & (F.col("score") >= COLLOCATION) & (F.col("both") / F.col("a") > F.col("b") / whole))
    company = pairs.orderBy(F.desc("score"), "kind", "following").limit(MOST)
    return Boundaries(frozenset(r.kind for r in known.collect()), frozenset((r.kind, r.following) for r in company.collect()), frozenset(r.following for r in starters.collect()))


_STRIP = re.compile(r"^[^\w]+|[^\w.]+$")
_NUMBER = re.compile(r"[-+]?\d[\d.,]*")


def _kind(word: str) -> str:
    bare = _STRIP.sub("", word).lower().rstrip(".")
    return "#" if _NUMBER.fullmatch(bare) else bare


def joined(pieces: list[str], learned: Boundaries) -> list[str]:
    """Pieces that end in stops, put together again where the stop ends an abbreviation, an initial or a number and no sentence.

    A known starter in capitals begins a sentence after an abbreviation, but not after an initial, nor in a collocation. A number's stop ends a sentence unless a word in small
    letters follows.
    """
    out: list[str] = []
    for piece in pieces:
        if out and _goes_on(out[-1].split()[-1], piece.split()[0], learned):
            out[-1] += piece
        else:
            out.append(piece)
    return out


def _goes_on(last: str, following: str, learned: Boundaries) -> bool:
    if not _STRIP.sub("", last).endswith("."):
        return False
    kind, after = _kind(last), _kind(following)
    small = following[:1].islower()
    if (kind, after) in learned.collocations:
        return True
    if kind == "#":
        return small
    if len(kind) == 1 and kind.isalpha():
        return True
    return kind in learned.abbreviations and (small or after not in learned.starters)
