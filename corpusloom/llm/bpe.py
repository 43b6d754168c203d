"""A byte-pair vocabulary compiled, as texts ask for it, into a deterministic finite-state transducer over number tables.

Let last(i) be the last token of the encoding of a word's first i symbols. The encoding of those symbols is the one
of the first i - |last(i)| symbols followed by last(i), and a token t that ends at i is last(i) exactly if t encodes
to itself and the pair of last(i - |t|) and t, put together, encodes to that very pair. So the machine need only know

* the suffix: the longest end of what it has read that some longer token begins with (no later token starts before it), and
* for every cut in that suffix from which a longer token may start, and for its end: the last token there, and the
  tokens up to there that are not settled yet.

Tokens that the encodings at all these cuts share are settled and are emitted; the lookahead is thereby bounded by
the longest token. Of a last token only what may still join across its end matters: the parts that end it while it is
joined, each until it is joined itself, and of these only such as some later part could join. Last tokens that agree in
this are one. There are finitely many such states, numbered as they are met. A transition is determinised when it is first
asked for. A table of states and symbols holds its number; three arrays give the next state, how many tokens it emits
and where these stand. The symbol END emits what is unsettled and leads back to the start.

A stream of symbols is read in chunks, all at once: step j reads the j-th symbol of every chunk. What a chunk does is a
map from the state in which it is entered to the state in which it is left and the number of tokens emitted. A chunk that
begins where the machine certainly starts anew is one way from the start. Any other is read from the start and from
every state in which a way through the chunk before it ends, until no new state comes up; most ways soon run into
one, so that this ends after a round or two. Maps of neighbours compose.

When more than `max_transitions`, or MAX_CELLS, are held all are dropped before the next stream and made anew as needed,
which bounds memory and changes no result.
"""

from __future__ import annotations

import contextlib
import gc
from bisect import bisect_left
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

#: Transitions held before the machine starts afresh, and cells of its table: some 150 MB each.
MAX_TRANSITIONS, MAX_CELLS = 500_000, 1 << 25
#: Pairs whose compatibility is remembered.
MAX_PAIRS = 250_000
#: Symbols of a chunk, and of a stream that is read at once.
CHUNK, STREAM = 256, 1 << 20
#: Symbols are Unicode code points or bytes. END is none of them, and UNKNOWN + n stands for those outside the vocabulary that are n bytes of UTF-8.
SYMBOLS = 0x110000
END, UNKNOWN = SYMBOLS, SYMBOLS
START = 0


@contextlib.contextmanager
def no_collector() -> Iterator[None]:
    """Without the cyclic collector, which would walk all states again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class ChunkMap(NamedTuple):
    """What a chunk does: state in which it is entered -> (state in which it is left, tokens emitted).

    A fresh one begins where the machine starts anew, after it has emitted what was unsettled before, so that one way from START says all.
    """

    fresh: bool
    ways: dict[int, tuple[int, int]]


class Read(NamedTuple):
    """A stream as it was read: a map for each chunk; and, recorded, the transition taken by each symbol."""

    maps: list[ChunkMap]
    taken: object


class Transducer:
    """ranks: token (str or bytes) -> rank, the lowest joined first, the leftmost of equals; labels: token -> number emitted for it.

    A symbol outside the vocabulary joins with nothing and emits as many labels 0 as it has UTF-8 bytes.
    """

    def __init__(self, ranks: dict, labels: dict | None = None, max_transitions: int = MAX_TRANSITIONS) -> None:
        self.ranks, self.max_transitions = ranks, max_transitions
        self.labels = labels or dict.fromkeys(ranks, 0)
        self.empty = next(iter(ranks))[:0]
        self.symbol = chr if isinstance(self.empty, str) else lambda code: bytes((code,))
        #: what a longer token begins with
        self.starts = {t[:i] for t in ranks for i in range(1, len(t))}
        #: the joinings that make each token that encodes to itself
        self.histories = {t: history for t in ranks for parts, history in (self.join(t),) if len(parts) == 1}
        #: whether each token's joinings come in the order of their ranks, which lets last tokens be taken as one
        self.ordered = all(a[0] <= b[0] for h in self.histories.values() for a, b in zip(h, h[1:], strict=False))
        #: left part -> right parts that join it, each after the rank from which both are there and are joined
        self.joins: dict = {}
        for t, rank in ranks.items():
            for i in range(1, len(t)):
                if t[:i] in ranks and (right := t[i:]) in ranks:
                    self.joins.setdefault(t[:i], []).append((rank if len(right) == 1 else max(rank, ranks[right]), right))
        self.pairs: dict = {}
        self.reset()

    def reset(self) -> None:
        """Drop all states and transitions."""
        import numpy as np

        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.same: dict = {}
        self.alike: dict = {}
        self.limits: dict = {}
        self.made = 0
        #: number of a symbol's column, and the symbols by column; transitions by state and column
        self.column, self.symbols = np.full(SYMBOLS + 8, -1, np.int64), []
        self.table = np.full((1 << 10, 64), -1, np.int32)
        self.next, self.many, self.at = (np.zeros(1 << 10, np.int64) for _ in range(3))
        self.rest_many = np.zeros(1 << 10, np.int32)
        self.emitted = array("i")
        self._state(self.empty, ((0, None, ()),))

    def join(self, symbols: Sequence) -> tuple[list, list]:
        """The encoding of a short word by its definition, and for each joining its rank and the outermost parts after it."""
        parts, history = [symbols[i : i + 1] for i in range(len(symbols))], []
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            rank, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            history.append((rank, parts[0], parts[-1]))
        return parts, history

    def _fits(self, left, token) -> bool:
        """Whether left and token, put together, are not joined across: both histories are played, the lowest rank first and
        the leftmost of equals, and the parts that meet must never be next."""
        if left is None:
            return True
        if (known := self.pairs.get((left, token))) is not None:
            return known
        before, after, i, j = self.histories[left], self.histories[token], 0, 0
        last, first, never = left[-1:], token[:1], float("inf")
        while True:
            a = before[i][0] if i < len(before) else never
            b = after[j][0] if j < len(after) else never
            across = self.ranks.get(last + first, never)
            if across < a and across <= b:
                fits = False
                break
            if a == b == never:
                fits = True
                break
            if a <= b:
                last, i = before[i][2], i + 1
            else:
                first, j = after[j][1], j + 1
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[left, token] = fits
        return fits

    def _last(self, last, since):
        """What stands for a last token after which `since` has been read: None if nothing can join it any more."""
        if last is None or not self.ordered:
            return last
        if (found := self.same.get((last, since), 0)) != 0:
            return found
        profile, part = [], last[-1:]
        for rank, _, right in [*self.histories[last], (float("inf"), None, None)]:
            if right != part:  # `part` ends the token until it is joined at this rank
                if part in self.joins and (n := bisect_left(self._limits(part, since), rank)):
                    profile.append((part, n))
                part = right
        found = self.same[last, since] = self.alike.setdefault((since, tuple(profile)), last) if profile else None
        return found

    def _limits(self, part, since) -> list:
        """Sorted ranks from which right parts that `since` can become, or that it begins with, are joined to a left part."""
        if (found := self.limits.get((part, since))) is None:
            wider = self._rights(part, since[:-1]) if since else self.joins[part]
            rights = sorted(x for x in wider if x[1].startswith(since) or since.startswith(x[1]))
            found = self.limits[part, since] = [limit for limit, _ in rights], rights
        return found[0]

    def _rights(self, part, since) -> list:
        self._limits(part, since)
        return self.limits[part, since][1]

    def _state(self, suffix, cuts: tuple) -> int:
        """Number of a state; cuts, the earliest first: (symbols read since, last token or None at the start, labels not settled)."""
        if (number := self.numbers.get((suffix, cuts))) is None:
            number = self.numbers[suffix, cuts] = len(self.states)
            self.states.append((suffix, cuts))
            self.rest_many = _room(self.rest_many, number)
            self.rest_many[number] = len(cuts[-1][2])
            self.table = _room(self.table, number, -1)
        return number

    def rest(self, state: int) -> tuple:
        """Labels that are not settled in a state, as they are if nothing follows."""
        return self.states[state][1][-1][2]

    def step(self, state: int, code: int) -> tuple[tuple, int]:
        """The labels that a state emits by a symbol, and the next state."""
        suffix, cuts = self.states[state]
        if code >= END:
            return (*cuts[-1][2], *(0,) * (code - UNKNOWN)), START
        symbol = self.symbol(code)
        read = suffix + symbol
        for size, last, waiting in cuts:
            token = read[len(read) - size - 1 :]
            if token in self.histories and self._fits(last, token):
                new = (0, self._last(token, self.empty), (*waiting, self.labels[token]))
                break
        else:
            raise ValueError(f"the vocabulary's tokens don't fit together at {read!r}")
        kept = [(size + 1, self._last(last, since), waiting) for size, last, waiting in cuts if (since := read[len(read) - size - 1 :]) in self.starts]
        kept.append(new)
        shared, least, first = 0, min(len(c[2]) for c in kept), kept[0][2]
        while shared < least and all(c[2][shared] == first[shared] for c in kept):
            shared += 1
        return first[:shared], self._state(read[len(read) - kept[0][0] :], tuple((size, last, waiting[shared:]) for size, last, waiting in kept))

    def _columns(self, symbols):
        """Columns of an array of symbols; those not met before get one."""
        import numpy as np

        columns = self.column.take(symbols)
        if len(new := np.unique(symbols[columns < 0])):
            for code in new.tolist():
                column = code
                if code < SYMBOLS and (symbol := self.symbol(code)) not in self.ranks:
                    column = UNKNOWN + (len(symbol.encode()) if isinstance(symbol, str) else 1)
                if self.column[column] < 0:
                    self.column[column] = len(self.symbols)
                    self.symbols.append(column)
                self.column[code] = self.column[column]
            columns = self.column.take(symbols)
        if len(self.symbols) > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)], 1)
            return self._columns(symbols)
        return columns

    def _transitions(self, state, column):
        """Numbers of the transitions of states by columns; those that are new are made."""
        import numpy as np

        cell = state * self.table.shape[1] + column
        number = self.table.ravel().take(cell)
        if number.min() >= 0:
            return number
        new = sorted(set(cell[number < 0].tolist()))
        self.next, self.many, self.at = (_room(x, self.made + len(new)) for x in (self.next, self.many, self.at))
        for c in new:
            s, by = divmod(c, self.table.shape[1])
            emitted, to = self.step(s, self.symbols[by])
            self.next[self.made], self.many[self.made], self.at[self.made] = to, len(emitted), len(self.emitted)
            self.table[s, by] = self.made
            self.emitted.extend(emitted)
            self.made += 1
        return self.table.ravel().take(cell)

    def _walk(self, columns, begins, ends, states, record: bool):
        """Read columns[begin:end] from each state, all in step: (states, tokens emitted, transitions taken, way after way, or None)."""
        import numpy as np

        order = np.argsort(begins - ends, kind="stable")  # the longest first, so that those still reading come first
        starts, length = begins, (ends - begins)[order]
        begins, state = begins[order], states[order].astype(np.int64)
        total = np.zeros(len(order), np.int64)
        steps = int(length[0]) if len(length) else 0
        if record:
            taken = np.empty(int(length.sum()), np.int32)
            at = (np.cumsum(ends - starts) - (ends - starts))[order]
        for j, n in enumerate(np.searchsorted(-length, -np.arange(steps), side="left").tolist()):
            number = self._transitions(state[:n], columns.take(begins[:n] + j))
            state[:n] = self.next.take(number)
            total[:n] += self.many.take(number)
            if record:
                taken[at[:n] + j] = number
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back], taken if record else None

    def read(self, symbols, begins, fresh, record: bool = False) -> Read:
        """Read a stream in chunks that begin at `begins`; fresh: where the machine certainly starts anew (always where a stream begins).

        Recorded chunks that aren't fresh are taken to go on from the chunk before; fresh ones to be entered in START.
        """
        import numpy as np

        if self.made > self.max_transitions or self.table.size > MAX_CELLS:
            self.reset()
        columns = self._columns(symbols)
        ends = np.append(begins[1:], len(symbols))
        left, total, taken = self._walk(columns, begins, ends, np.full(len(begins), START), record)
        maps = [ChunkMap(f, {START: way}) for f, way in zip(fresh.tolist(), zip(left.tolist(), total.tolist(), strict=True), strict=True)]
        cut, later = np.flatnonzero(~fresh), {}
        while True:
            open_ = [(c, x) for c in cut.tolist() for x in {x for x, _ in maps[c - 1].ways.values()} if x not in maps[c].ways]
            if not open_:
                break
            chunk, entry = (np.array(x, np.int64) for x in zip(*open_, strict=True))
            left, total, steps = self._walk(columns, begins[chunk], ends[chunk], entry, record)
            at = np.append(0, np.cumsum(ends[chunk] - begins[chunk]))
            for i, (c, e) in enumerate(open_):
                maps[c].ways[e] = int(left[i]), int(total[i])
                if record:
                    later[c, e] = steps[at[i] : at[i + 1]]
            cut = np.unique(chunk + 1)  # only what follows these can have got another state to begin with
            cut = cut[(cut < len(fresh))]
            cut = cut[~fresh[cut]]
        if record:
            for c in np.flatnonzero(~fresh).tolist():
                state = maps[c - 1].ways[START if fresh[c - 1] else state][0]
                if state != START:
                    taken[begins[c] : ends[c]] = later[c, state]
        return Read(maps, taken)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """a, then b. If b is fresh, what was unsettled after a comes first; else every state in which a ends is one that b was read from."""
        if b.fresh:
            ((x, n),) = b.ways.values()
            return ChunkMap(a.fresh, {e: (x, m + int(self.rest_many[y]) + n) for e, (y, m) in a.ways.items()})
        return ChunkMap(a.fresh, {e: (b.ways[y][0], m + b.ways[y][1]) for e, (y, m) in a.ways.items()})

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """Compose neighbours in pairs, level by level."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def labels_of(self, numbers):
        """(labels emitted along transitions, how many by each)."""
        import numpy as np

        many = self.many[numbers]
        ends = np.cumsum(many, dtype=np.int64)
        where = np.repeat(self.at[numbers] - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.frombuffer(self.emitted, np.int32)[where] if len(where) else np.zeros(0, np.int32), many


def portions(texts: list[str], most: int = STREAM) -> Iterator[list[str]]:
    """Texts in order, in lists of some `most` characters; a longer text is a list of its own."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > most:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def _room(x, number: int, value: int = 0):
    """x, or with the same values twice as long or more, so that it has this place."""
    import numpy as np

    while number >= len(x):
        x = np.concatenate([x, np.full_like(x, value)])
    return x


def chunk_begins(certain, size: int, chunk: int = CHUNK):
    """(begins, fresh) of the chunks of a stream: the first certain restart in every `chunk` symbols; a stretch of more than four times
    as many without one is cut where it must be. certain: sorted places where the machine starts anew, 0 first."""
    import numpy as np

    held = certain // chunk
    begins = certain[np.append(True, held[1:] != held[:-1])] if len(certain) else certain
    gap = np.diff(np.append(begins, size))
    if not (long := np.flatnonzero(gap > 4 * chunk)).size:
        return begins, np.ones(len(begins), bool)
    more = np.concatenate([np.arange(begins[i] + chunk, begins[i] + gap[i], chunk) for i in long])
    every = np.concatenate([begins, more])
    order = np.argsort(every, kind="stable")
    return every[order], np.append(np.ones(len(begins), bool), np.zeros(len(more), bool))[order]
