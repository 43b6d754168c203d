"""Operator 5, secrets by patterns and a linear-chain conditional random field.

Three patterns give the base spans. Beside them a linear-chain CRF tags a text's words as begin of a secret, inside, or
outside, from the word's shape, the words beside it and features of the whole text; the best tagging is found by
Viterbi. It is trained here, by stochastic gradient on the conditional likelihood with exact forward-backward, on texts
that a generator makes from a seed: assignments, keys, hashes and tokens among ordinary words, numbers and addresses, in prose,
notes and settings, whose file features are computed as those of any text.

Most words can't be part of a secret on any tagging: a word is settled as outside if, whatever tags the words beside it
have, the tagging gains by making it outside (and, where the next word was inside, that one a begin). The scores compared
are those of the word where it stands. The chain falls apart at settled words, and Viterbi is run, exactly, on what lies
between. No word is left out for its length or characters. Memory is bounded by one text.

Defined cases: a null text counts as empty and has no spans; repeated rows each get a row; an empty table gives an empty
result; extra columns are ignored; spans are in code points, the end exclusive; base spans always stay; of CRF spans
the words that base spans cover whole are left out, and all others stay, whether they overlap a base span or not.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from .bpe_codec import Memo
from .common import own_columns

#: The base patterns, the group that is measured and its least length. Letters of ASCII only are of either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs of 24 and more are the runs [0-9a-f]+ that don't fail
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
#: Quick signs without which a pattern can't match.
ASSIGN_SIGN = re.compile(r"[:=]")
WORD = re.compile(r"[^\s\"'`<>(){}\[\],;=:]+")
#: What a word can be to its neighbours; and by how much a proof must hold, above rounding.
BESIDE, SURE = ("edge", "cue", "plain", "mixed"), 1e-6
#: Letters and digits by kind: all that a word's shape says of them, but for cues and the entropy of long words with digits.
MASK = {c: "0" if chr(c).isdigit() else "a" if chr(c).islower() else "A" for c in range(0x250) if chr(c).isdigit() or chr(c).isalpha() and (chr(c).islower() or chr(c).isupper())}
OUT, BEGIN, INSIDE = 0, 1, 2
TAGS = 3
SEED, LINES, EPOCHS, RATE, DECAY = 7, 900, 4, 0.4, 1e-4
CUES = frozenset("password passwd pwd secret token key apikey api_key auth bearer credential credentials private access session signature client_secret access_key".split())
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and kind."""
    found = []
    for k, (name, pattern, group, least) in enumerate(KINDS):
        if name == "assign" and not ASSIGN_SIGN.search(text):
            continue
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def shape(word: str) -> tuple[str, ...]:
    """Features of a word by itself."""
    digits, upper, lower = sum(c.isdigit() for c in word), sum(c.isupper() for c in word), sum(c.islower() for c in word)
    other, n = len(word) - digits - upper - lower, len(word)
    kinds = "".join(k for k, x in (("d", digits), ("u", upper), ("l", lower), ("o", other)) if x)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:], strict=False))
    humps = sum(a.islower() and b.isupper() for a, b in zip(word, word[1:], strict=False))
    size = "1-5" if n < 6 else "6-11" if n < 12 else "12-19" if n < 20 else "20-31" if n < 32 else "32+"
    out = [f"kinds={kinds}", f"size={size}", f"kinds+size={kinds}{size}", f"turns={min(turns, 4)}", f"humps={min(humps, 4)}"]
    if word.lower().strip(".!?_-") in CUES:
        out.append("cue")
    if "@" in word or "/" in word and "." in word:
        out.append("address")
    if word.count(".") == 3 and digits + 3 == n:
        out.append("number.address")
    if n >= 12 and digits and upper + lower:
        entropy = -sum(c / n * math.log2(c / n) for c in (word.count(x) for x in set(word)))
        out.append(f"entropy={int(entropy)}")
    return tuple(out)


def beside(word: str | None) -> str:
    """What a word is to its neighbours."""
    return "edge" if word is None else "cue" if word.lower().strip(".!?_-") in CUES else "plain" if word.isalpha() else "mixed"


def file_features(text: str) -> tuple[str, ...]:
    """Features of the whole text."""
    signs = text.count("=") + text.count(":")
    return ("file:code" if signs * 40 > len(text) else "file:some" if signs else "file:prose",)


class Crf:
    """weights: feature -> score of each tag; moves: score from tag to tag."""

    def __init__(self) -> None:
        self.weights: dict[str, list[float]] = defaultdict(lambda: [0.0] * TAGS)
        self.moves = [[0.0] * TAGS for _ in range(TAGS)]
        self.moves[OUT][INSIDE] = -30.0  # a secret starts with its begin

    def scores(self, words: list[str], context: tuple[str, ...], before: str | None = None, after: str | None = None) -> list[list[float]]:
        out = []
        for i, w in enumerate(words):
            features = (*shape(w), "before=" + beside(words[i - 1] if i else before), "after=" + beside(words[i + 1] if i + 1 < len(words) else after), *context)
            out.append([sum(self.weights[f][t] if f in self.weights else 0.0 for f in features) for t in range(TAGS)])
        return out

    def fit(self, lines: Iterable[tuple[list[str], list[int], tuple[str, ...]]]) -> Crf:
        lines = list(lines)
        rng = random.Random(SEED)
        for epoch in range(EPOCHS):
            rng.shuffle(lines)
            for words, tags, context in lines:
                self._learn(words, tags, context, RATE / (1 + epoch))
        return self

    def _learn(self, words: list[str], tags: list[int], context: tuple[str, ...], rate: float) -> None:
        """One step along the gradient: features seen less features expected."""
        s, n = self.scores(words, context), len(words)
        log_sum = lambda xs: (m := max(xs)) + math.log(sum(math.exp(x - m) for x in xs))
        start = [0.0, 0.0, -30.0]
        a = [[s[0][t] + start[t] for t in range(TAGS)]]
        for i in range(1, n):
            a.append([s[i][t] + log_sum([a[-1][u] + self.moves[u][t] for u in range(TAGS)]) for t in range(TAGS)])
        b = [[0.0] * TAGS for _ in range(n)]
        for i in range(n - 2, -1, -1):
            b[i] = [log_sum([self.moves[t][u] + s[i + 1][u] + b[i + 1][u] for u in range(TAGS)]) for t in range(TAGS)]
        whole = log_sum(a[-1])
        for i, w in enumerate(words):
            features = (*shape(w), "before=" + beside(words[i - 1] if i else None), "after=" + beside(words[i + 1] if i + 1 < n else None), *context)
            for t in range(TAGS):
                step = rate * ((tags[i] == t) - math.exp(a[i][t] + b[i][t] - whole))
                for f in features:
                    self.weights[f][t] += step - rate * DECAY * self.weights[f][t]
        for i in range(n - 1):
            for u in range(TAGS):
                for t in range(TAGS):
                    if (u, t) != (OUT, INSIDE):
                        p = math.exp(a[i][u] + self.moves[u][t] + s[i + 1][t] + b[i + 1][t] - whole)
                        self.moves[u][t] += rate * ((tags[i] == u and tags[i + 1] == t) - p)

    def viterbi(self, scores: list[list[float]]) -> list[int]:
        """Best tags; the words before and after count as outside."""
        best, back = [scores[0][t] + self.moves[OUT][t] for t in range(TAGS)], []
        for s in scores[1:]:
            come = [max(range(TAGS), key=lambda u, t=t: best[u] + self.moves[u][t]) for t in range(TAGS)]
            best = [best[come[t]] + self.moves[come[t]][t] + s[t] for t in range(TAGS)]
            back.append(come)
        tag = max(range(TAGS), key=lambda t: best[t] + self.moves[t][OUT])
        tags = [tag]
        for come in reversed(back):
            tags.append(tag := come[tag])
        return tags[::-1]


def made_texts(rng: random.Random) -> Iterator[tuple[str, list[int]]]:
    """Made-up texts and the tags of their words: prose, notes, and settings, which name more secrets and put signs between them and their cues."""
    syllables = "the an er ing tion de la que en ver sch lich ment os ado or st re is".split()
    hexes, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda letters, low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    harmless = (
        lambda: [some("0123456789", 1, 4)], lambda: [f"{rng.randint(1, 12)}.{rng.randint(0, 9)}."], lambda: [f"{word()}.{some('0123456789', 2, 2)}@{word()}.example.com"], lambda: [".".join(str(rng.randint(1, 254)) for _ in range(4))],
        lambda: ["+1", some("0123456789", 3, 3), "555-" + some("0123456789", 4, 4)], lambda: [some("0123456789", 16, 16)], lambda: [word().upper() + "!!"], lambda: ["https", "//" + word() + ".example.org/" + word()], lambda: [f"{rng.randint(2000, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"],
        lambda: [rng.choice(["token", "secret", "key", "password"]), word(), word()], lambda: ["|"], lambda: [word().capitalize() + "."], lambda: [word() + "&&&"],
        lambda: [word().capitalize() + word().capitalize()], lambda: [word()[:3] + some("0123456789", 1, 2)], lambda: [some("0123456789", 1, 2) + word()[:2]], lambda: [some(alnum[:26], 2, 5)], lambda: [word().capitalize(), word()], lambda: [(word() + word() + word()).capitalize()], lambda: [word() + word() + word()],
    )
    secret = (lambda: some(hexes, 16, 48), lambda: some(alnum, 20, 44) + "7q", lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 16), lambda: some(hexes, 18, 18), lambda: "sk_" + some(alnum, 24, 32) + "4", lambda: some(alnum, 12, 16) + "9_" + some(alnum, 12, 16) + "3x", lambda: some(alnum[:52], 16, 40), lambda: some(alnum[:52], 20, 24))
    # known by the cue before them only
    weak = (lambda: "".join(word().capitalize() for _ in range(3)), lambda: some(alnum, 5, 7) + some("0123456789", 1, 1), lambda: word()[:5] + some("0123456789", 2, 4), lambda: word().capitalize() + some("0123456789", 2, 4) + "!")
    for _ in range(LINES):
        style = rng.choice(("prose", "notes", "notes", "settings"))
        secrets, sign = {"prose": 0.12, "notes": 0.2, "settings": 0.3}[style], {"prose": [" "], "notes": [" ", ": "], "settings": ["=", ": ", " = "]}[style]
        parts: list[str] = []
        tags: list[int] = []
        for _ in range(rng.randint(4, 14)):
            if rng.random() < secrets:
                cued = rng.random() < 0.75
                if cued:
                    parts += [rng.choice(["password", "token", "api_key", "secret", "auth", "key", "Bearer"]), rng.choice(sign)]
                    tags.append(OUT)
                for j in range(1 + (rng.random() < 0.15)):
                    parts += [rng.choice(weak if cued and not j and rng.random() < 0.3 else secret)(), " "]
                    tags.append(INSIDE if j else BEGIN)
            else:
                for new in rng.choice(harmless)() if rng.random() < 0.3 else [word()]:
                    parts += [new, rng.choice(sign) if style == "settings" and rng.random() < 0.5 else " "]
                    tags.append(OUT)
        yield "".join(parts), tags


def _made_lines(rng: random.Random) -> Iterator[tuple[list[str], list[int], tuple[str, ...]]]:
    """Words, tags and file features of made-up texts."""
    for text, tags in made_texts(rng):
        yield WORD.findall(text), tags, file_features(text)


@functools.cache
def trained() -> Crf:
    """The model; training takes some seconds and always gives the same."""
    return Crf().fit(_made_lines(random.Random(SEED)))


class Tagger:
    def __init__(self, crf: Crf) -> None:
        import numpy as np

        self.crf = crf
        #: how far begin and inside lead outside by the words beside and by the text
        self.before, self.after = (np.array([self._lead([name + b]) for b in BESIDE]) for name in ("before=", "after="))
        #: the same by shapes, and the word's row of these and what it is to its neighbours, as one number
        self.rows: dict[tuple[str, ...], int] = {}
        self.leads = np.zeros((0, 2))
        self.codes, self.masks = Memo(self._code), Memo(self._shape_code)
        m, tags = crf.moves, (BEGIN, INSIDE)
        left = [min(m[p][OUT] - m[p][t] for p in range(TAGS)) for t in tags]
        #: what being outside gains at least by the moves: next to outside or begin; before an inside that stays; before one that becomes begin
        self.alone = np.array([g + min(m[OUT][n] - m[t][n] for n in (OUT, BEGIN)) for g, t in zip(left, tags, strict=True)])
        self.stays = np.array([g + m[OUT][INSIDE] - m[t][INSIDE] for g, t in zip(left, tags, strict=True)])
        self.turns = np.array([g + m[OUT][BEGIN] - m[t][INSIDE] + min(m[BEGIN][n] - m[INSIDE][n] for n in range(TAGS)) for g, t in zip(left, tags, strict=True)])

    def _lead(self, features: Iterable[str]) -> list[float]:
        own = [sum(self.crf.weights[f][t] for f in features if f in self.crf.weights) for t in range(TAGS)]
        return [own[BEGIN] - own[OUT], own[INSIDE] - own[OUT]]

    def _code(self, word: str) -> int:
        masked = word.translate(MASK)
        if word.lower().strip(".!?_-") in CUES or len(word) >= 12 and any(map(str.isdigit, masked)):
            return self._shape_code(word)
        return self.masks[masked]

    def _shape_code(self, word: str) -> int:
        import numpy as np

        features = shape(word)
        if features not in self.rows:
            self.rows[features] = len(self.rows)
            self.leads = np.vstack([self.leads, [self._lead(features)]])
        return self.rows[features] * len(BESIDE) + BESIDE.index(beside(word))

    def unsettled(self, words: list[str], context: tuple[str, ...]) -> list[int]:
        """Where a best tagging might have another tag than outside."""
        import numpy as np

        if not words:
            return []
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        kinds = codes % len(BESIDE)
        lead = self.leads[codes // len(BESIDE)] + self._lead(context)
        lead[1:] += self.before[kinds[:-1]]
        lead[:-1] += self.after[kinds[1:]]
        lead[0] += self.before[0]
        lead[-1] += self.after[0]
        turned = np.append(lead[1:, 0] - lead[1:, 1], np.inf)  # no word follows the last
        least = np.minimum(self.alone, np.maximum(self.stays, self.turns + turned[:, None]))
        return np.flatnonzero((lead > least - SURE).any(1)).tolist()

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Spans (start, end) of tagged secrets."""
        words, context = WORD.findall(text), file_features(text)
        unsettled, out, at = self.unsettled(words, context), [], 0
        if not unsettled:
            return []
        found = [m.span() for m in WORD.finditer(text)]
        while at < len(unsettled):
            stop = at
            while stop + 1 < len(unsettled) and unsettled[stop + 1] == unsettled[stop] + 1:
                stop += 1
            first, last = unsettled[at], unsettled[stop]
            scores = self.crf.scores(words[first : last + 1], context, words[first - 1] if first else None, words[last + 1] if last + 1 < len(words) else None)
            for i, tag in enumerate(self.crf.viterbi(scores), first):
                if tag == BEGIN or tag == INSIDE and not out:
                    out.append(found[i])
                elif tag == INSIDE:
                    out[-1] = (out[-1][0], found[i][1])
            at = stop + 1
        return out


def scan_text(text: str, tagger: Tagger) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base spans (start, kind, end), and CRF spans (start, end) without the words that these cover whole."""
    base = base_spans(text)
    added = [part for span in tagger.spans(text) for part in uncovered(text, span, base)]
    return base, added


def uncovered(text: str, span: tuple[int, int], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The span as it is where it meets no base span; else its words that hold a character outside base spans, neighbours as one."""
    start, end = span
    near = [(b, c) for b, _, c in base if b < end and c > start]
    if not near:
        return [span]
    out, joined = [], False
    for m in WORD.finditer(text, start, end):
        at = m.start()
        for b, c in near:  # by start
            if b <= at < c:
                at = c
        if at >= m.end():
            joined = False
        elif joined:
            out[-1] = (out[-1][0], m.end())
        else:
            out.append(m.span())
            joined = True
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans by kind, their digest and all spans of every row; one pass, no shuffle."""
    crf = trained()
    model = (dict(crf.weights), crf.moves)

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        own = Crf()
        own.weights, own.moves = model
        tagger = Tagger(own)
        names = [k[0] for k in KINDS]
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                base, added = scan_text(text or "", tagger)
                coded = [f"{names[k]}:{s}:{e}" for s, k, e in base]
                every = sorted([(s, k, e) for s, k, e in base] + [(s, len(KINDS), e) for s, e in added])
                row = [*(sum(k == x for _, k, _ in base) for x in range(3)), hashlib.sha256(",".join(coded).encode()).hexdigest(), ",".join(f"{(*names, 'crf')[k]}:{s}:{e}" for s, k, e in every)]
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            kinds = (pa.int64(),) * 3 + (pa.string(),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(of, SCHEMA)
