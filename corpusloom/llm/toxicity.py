"""Operator 10, toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A model is fitted in one task from at most MAX_TRAIN labelled rows of MAX_TRAIN_BYTES together, taken in the order of a hash of
doc_id, never from held-out ones (crc32 of doc_id as text divisible by 5); folds go by another hash, so that they stay even however
many labels there are. The lexicon's words and word beginnings are chosen by log-odds of the documents
that hold them. Each half of the rows, by another hash, gets its features from the lexicon of the other half, so that no row is
described by words that it helped to choose; on four fifths of them the trees are grown, on the last fifth scores are
calibrated by pooling adjacent violators, and texts are then scored with the lexicon of all rows. Only texts are inputs of a score. Scoring is one pass over whole texts without a shuffle.

Defined cases: a null text scores as an empty one; a null doc_id counts as held out; rows without a label, or with one
other than 0 and 1, teach nothing; labels of one class, or none, give every text the share of that class (0 for none);
repeated rows score alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_codec import Memo
from .common import own_columns, tidied
from .near_dedup import shingle_set

#: Labelled rows that a model is fitted on, at most, and bytes of their texts.
MAX_TRAIN, MAX_TRAIN_BYTES = 8_000, 64 << 20
#: Lexicon: documents of class 1 that hold an entry, their least log-odds, and entries, at most.
LEAST_DOCS, LEAST_LOG_ODDS, MAX_LEXICON = 5, 3.0, 4_000
#: Lengths of word beginnings in the lexicon.
BEGINNINGS = (4, 5, 6)
#: Words within which a lexicon hit counts as near the second person.
NEAR = 5
#: Words whose codes are remembered, by task.
MAX_WORDS = 200_000
TREES, DEPTH, RATE, BINS, LEAST_LEAF, RIDGE = 40, 3, 0.2, 32, 10, 1.0
#: Second-person words of the languages served.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner deinen ihr euch euer tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros os".split())
#: Characters that stand for letters.
LOOKALIKES = str.maketrans("013457@$", "oieastas", "*")
WORD = re.compile(r"[\w@$*]+")
CAPITAL_WORD = re.compile(r"\b[A-Z]{2,}\b")
RUN_OF_MARKS = re.compile(r"[!?.]{2,}")
WORD_HIT, BEGINNING_HIT, PERSON, MASKED, MASKED_HIT = 1, 2, 4, 8, 16
FEATURES = ("lexicon_density", "lexicon_hits", "beginning_density", "beginning_hits", "second_person_density", "near_second_person", "capitals", "capital_words", "exclamations", "questions", "other_marks", "runs_of_marks", "masked_words", "masked_hits", "words")
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@dataclass
class Lexicon:
    words: frozenset = frozenset()
    beginnings: frozenset = frozenset()

    def code(self, word: str) -> int:
        plain = word if word.isalpha() else word.translate(LOOKALIKES)
        masked = plain != word and plain.isalpha() and any(c.isalpha() for c in word)
        code = WORD_HIT * (word in self.words) | PERSON * (word in SECOND_PERSON) | MASKED * masked
        if masked and (plain in self.words or any(plain[:n] in self.beginnings for n in BEGINNINGS)):
            code |= MASKED_HIT
        if any(len(word) >= n and word[:n] in self.beginnings for n in BEGINNINGS):
            code |= BEGINNING_HIT
        return code


def learn_lexicon(texts: list[str], toxic: list[int]) -> Lexicon:
    """Words and word beginnings that documents of class 1 hold far more often; copies of a document count once."""
    kept: list[list[str]] = [[], []]
    seen = set()
    for text, label in zip(texts, toxic, strict=True):
        shingles = shingle_set(text, 5)
        key = (int(shingles[0]) if len(shingles) else 0, label)  # near copies mostly share the least hash
        if key not in seen:
            seen.add(key)
            kept[label].append(text)

    def entries(text: str) -> set:
        distinct = set(WORD.findall(text.lower()))
        return distinct | {(w[:n],) for w in distinct for n in BEGINNINGS if len(w) > n}

    toxic_docs: Counter = Counter()
    for text in kept[1]:
        toxic_docs.update(entries(text))
    toxic_docs = Counter({x: n for x, n in toxic_docs.items() if n >= LEAST_DOCS})
    other_docs: Counter = Counter()
    for text in kept[0]:
        other_docs.update(toxic_docs.keys() & entries(text))
    odds = {}
    for x, n in toxic_docs.items():
        o = math.log((n + 0.5) / (len(kept[1]) + 1)) - math.log((other_docs[x] + 0.5) / (len(kept[0]) + 1))
        if o >= LEAST_LOG_ODDS:
            odds[x] = (-o * n, str(x))
    best = sorted(odds, key=odds.get)[:MAX_LEXICON]
    return Lexicon(frozenset(x for x in best if isinstance(x, str)), frozenset(x[0] for x in best if isinstance(x, tuple)))


class Features:
    def __init__(self, lexicon: Lexicon) -> None:
        self.codes = Memo(lexicon.code, most=MAX_WORDS)

    def __call__(self, text: str) -> list[float]:
        import numpy as np

        codes = np.frombuffer(bytes(map(self.codes.__getitem__, WORD.findall(text.lower()))), np.uint8)
        marks = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        words, size = max(1, len(codes)), max(1, len(text))
        of = lambda bit: int(np.count_nonzero(codes & bit))
        lexicon, beginning, masked_hits = of(WORD_HIT), of(BEGINNING_HIT), of(MASKED_HIT)
        near = 0.0
        if lexicon or beginning or masked_hits:
            persons, hits = np.flatnonzero(codes & PERSON), np.flatnonzero(codes & (WORD_HIT | BEGINNING_HIT | MASKED_HIT))
            at = np.searchsorted(persons, hits)
            padded = np.r_[-(10**9), persons, 10**9]
            near = float(np.mean(np.minimum(hits - padded[at], padded[at + 1] - hits) <= NEAR))
        ask, shout = int(marks[63]), int(marks[33])
        other = int(marks[34:48].sum() + marks[58:63].sum() + marks[64] + marks[91:97].sum() + marks[123:127].sum())
        return [lexicon / words, math.log1p(lexicon), beginning / words, math.log1p(beginning), of(PERSON) / words, near, int(marks[65:91].sum()) / size, len(CAPITAL_WORD.findall(text)) / words, shout / size, ask / size, other / size, len(RUN_OF_MARKS.findall(text)) / words, of(MASKED) / words, math.log1p(masked_hits), math.log1p(len(codes))]


@dataclass
class Trees:
    """Boosted trees of equal depth for the log-odds; node i has children 2i+1 and 2i+2."""

    base: float = 0.0
    features: list = field(default_factory=list)
    cuts: list = field(default_factory=list)
    leaves: list = field(default_factory=list)

    @classmethod
    def fit(cls, x, y) -> Trees:
        import numpy as np

        share = min(max(float(np.mean(y)), 1e-4), 1 - 1e-4)
        self = cls(math.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
        total = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
            node = np.zeros(len(y), int)
            feature, cut = [], []
            for level in range(DEPTH):
                for _ in range(2**level):
                    here = node == len(feature)
                    f, c = cls._split(bins[here], grad[here], hess[here], edges)
                    feature.append(f)
                    cut.append(c)
                node = 2 * node + 1 + (x[np.arange(len(y)), np.array(feature)[node]] > np.array(cut)[node])
            node -= 2**DEPTH - 1
            leaf = RATE * np.bincount(node, grad, 2**DEPTH) / (np.bincount(node, hess, 2**DEPTH) + RIDGE)
            self.features.append(feature)
            self.cuts.append(cut)
            self.leaves.append(leaf.tolist())
            total += leaf[node]
        return self

    @staticmethod
    def _split(bins, grad, hess, edges) -> tuple[int, float]:
        """Feature and cut of most gain; a cut at infinity sends all to the left."""
        import numpy as np

        best, chosen, g_all, h_all = 1e-6, (0, float("inf")), grad.sum(), hess.sum()
        for f, edge in enumerate(edges):
            if not len(edge):
                continue
            g, h, n = (np.cumsum(np.bincount(bins[:, f], w, len(edge) + 1))[:-1] for w in (grad, hess, None))
            gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(n < LEAST_LEAF) | (len(grad) - n < LEAST_LEAF)] = 0
            if gain.max() > best:
                best, chosen = gain.max(), (f, float(edge[int(gain.argmax())]))
        return chosen

    def __call__(self, x):
        import numpy as np

        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(np.array(self.features), np.array(self.cuts), np.array(self.leaves), strict=True):
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total


def isotonic(raw, y) -> tuple[list[float], list[float]]:
    """Points of a non-decreasing curve from raw scores to shares, by pooling adjacent violators; between points it is linear."""
    import numpy as np

    blocks: list[list[float]] = []  # sum of labels, rows, sum of raw scores
    for s, label in sorted(zip(np.asarray(raw).tolist(), np.asarray(y).tolist(), strict=True)):
        blocks.append([label, 1, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at, share = [b[2] / b[1] for b in blocks], [(b[0] + 0.01) / (b[1] + 0.02) for b in blocks]
    # beyond its ends the curve goes on to 0 and 1, so that it orders there too
    return [at[0] - 20, *at, at[-1] + 20], [share[0] / 2, *share, (1 + share[-1]) / 2]


@dataclass
class Model:
    share: float = 0.0
    lexicon: Lexicon = field(default_factory=Lexicon)
    trees: Trees | None = None
    curve: tuple = ()

    def scorer(self):
        """texts -> scores, with a memo of its own."""
        import numpy as np

        if self.trees is None:
            return lambda texts: np.full(len(texts), self.share)
        features = Features(self.lexicon)

        def score(texts):
            raw = self.trees(np.array([features(t) for t in texts])) if texts else np.zeros(0)
            return np.clip(np.interp(raw, *self.curve), 0.0, 1.0)

        return score


def fit(texts: list[str], toxic: list[int], folds: list[int]) -> Model:
    """folds: 0 to 9 of each row; even and odd ones choose each other's lexicon, 8 and 9 calibrate."""
    import numpy as np

    y = np.array(toxic)
    if len(set(toxic)) < 2:
        return Model(float(y.mean()) if len(y) else 0.0)
    fold = np.array(folds)
    grown, held = np.flatnonzero(fold < 8), np.flatnonzero(fold >= 8)
    if any(len(set(y[p])) < 2 for p in (grown, held)):  # too few rows to divide
        grown = held = np.arange(len(y))
    x = np.zeros((len(y), len(FEATURES)))
    for half in (0, 1):
        teach, told = np.flatnonzero(fold % 2 == half), np.flatnonzero(fold % 2 != half)
        features = Features(learn_lexicon([texts[i] for i in teach], y[teach].tolist()))
        for i in told:
            x[i] = features(texts[i])
    trees = Trees.fit(x[grown], y[grown].astype(float))
    return Model(float(y.mean()), learn_lexicon(texts, toxic), trees, isotonic(trees(x[held]), y[held]))


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN, most_bytes: int = MAX_TRAIN_BYTES) -> Model:
    """Fit on at most `most` labelled rows, and `most_bytes` of their texts, that aren't held out, in the order of a hash of doc_id."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    taught = own_columns(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & (F.crc32(key.cast("binary")) % 5 != 0))
    # the bounded sample of ids is taken from the small table, then joined with the texts
    chosen = taught.withColumn("order", F.md5(key.cast("binary"))).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), key), F.lit(10)).cast("int")).orderBy("order", "toxic").limit(most)
    rows = own_columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    rows = rows.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).orderBy("order", "toxic", "crc").limit(most)
    until = Window.orderBy("order", "toxic", "crc").rowsBetween(Window.unboundedPreceding, 0)  # `most` rows, one task by its bound
    taken = rows.withColumn("size", F.sum("size").over(until)).where(F.col("size") <= most_bytes).select("text", "toxic", "fold")

    def fitted(batches: Iterable) -> Iterator:
        import pyarrow as pa

        texts, toxic, folds = [], [], []
        for batch in batches:
            for column, values in zip((texts, toxic, folds), batch.columns, strict=True):
                column += values.to_pylist()
        model = fit([t or "" for t in texts], [int(t) for t in toxic], folds)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = taken.mapInArrow(tidied(fitted), "model binary").collect()  # a row; none of an empty table
    return pickle.loads(made[0].model) if made else Model()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        scorer = model.scorer()
        for batch in batches:
            s = scorer([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([is_held_out(i) for i in batch.column(0).to_pylist()], pa.bool_()), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype("int32"), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidied(of), SCHEMA)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold."""
    text_at = docs.columns.index("text")

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        scorer = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array(scorer([t or "" for t in batch.column(text_at).to_pylist()]) < threshold))

    return docs.mapInArrow(tidied(of), docs.schema)
