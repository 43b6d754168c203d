import base64
import hashlib
import random
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from corpusloom.llm import bpe, bpe_codec, packing, token_counts

from .conftest import key, texts_of

PIECES, RANKS, FAST = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def strings():
    rnd = random.Random(1)
    odd = ["", "a", " ", "  ", "a  b", "   the   ", "\n\n x\t  y", "▁▁a ▁b", "<s>hi</s> <unk>", "<|endoftext|> x", "<0x0A>", "é\U0001f600漢字", " " * 37 + "x", "a" * 300, "ſſ\0b", "it's we'll 'd"]
    return odd + ["".join(rnd.choice("ab  \n▁the<s>é漢'!9") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def unspaced():
    """Long texts in which no word ends, or words are longer than chunks."""
    rnd = random.Random(2)
    some = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    return [some("abcdefghingtion", 5000), some("etaoin", 3000) + " " + some("shrdlu", 4000), "x" * 5000, "the" * 2000, " " * 3000, "é漢" * 1500, "\U0001f600" * 700]


def test_counts_equal_the_library(strings, unspaced):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    whole, small = token_counts.counter(PIECES), token_counts.PieceCounter(token_counts.counter(PIECES).machine.ranks, chunk=3)
    want = [len(lib.encode(s, num_threads=1)) for s in strings + unspaced]
    assert whole.counts(strings + unspaced) == want
    assert small.counts(strings[:500]) == want[:500]


def test_chunk_maps_say_what_each_entry_leads_to(strings, unspaced):
    c = token_counts.PieceCounter(token_counts.counter(PIECES).machine.ranks, chunk=3)
    m = c.machine
    cut_anywhere = 0
    for s, maps in zip(strings[:300] + [u[:400] for u in unspaced], c.maps(strings[:300] + [u[:400] for u in unspaced]), strict=True):
        assert bool(maps) == bool(s)
        cut_anywhere += sum(not x.fresh for x in maps)
        assert all(len(x.ways) == 1 and bpe.START in x.ways for x in maps if x.fresh)
        # every state in which a chunk can be left is one from which the next was read
        assert all(x in b.ways for a, b in zip(maps, maps[1:], strict=False) if not b.fresh for x, _ in a.ways.values())
        if maps:
            left = maps[0]
            for x in maps[1:]:
                left = m.compose(left, x)
            assert left == m.scan(list(maps))
    assert cut_anywhere > 100


def test_a_machine_that_starts_afresh_gives_the_same(strings):
    c = bpe_codec.codec(RANKS, P.PATTERN)
    small = bpe_codec.ByteBpe(c.ranks, P.PATTERN)
    small.machine.max_transitions = 20
    assert [small.encode(s) for s in strings[:200]] == [c.encode(s) for s in strings[:200]]


def test_a_machine_whose_last_tokens_are_not_taken_as_one_gives_the_same(strings):
    """Joinings out of the order of ranks: a vocabulary in which a later joining has a lower rank."""
    rnd = random.Random(3)
    for _ in range(40):
        tokens = list("abc")
        while len(tokens) < 14:
            t = rnd.choice(tokens) + rnd.choice(tokens)
            tokens += [t] if t not in tokens and len(t) <= 6 else []
        inner = tokens[3:]
        rnd.shuffle(inner)
        ranks = {t: i for i, t in enumerate([*"abc", *inner])}
        machine = bpe.Transducer(ranks)
        for _ in range(30):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            want = len(machine.join(word)[0])
            state, n = bpe.START, 0
            for c in map(ord, word):
                emitted, state = machine.step(state, c)
                n += len(emitted)
            assert n + len(machine.rest(state)) == want, (ranks, word)


def test_codec_equals_the_library_and_round_trips(strings, unspaced):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    c = bpe_codec.codec(RANKS, P.PATTERN)
    assert P.PATTERN == bpe_codec.USUAL
    for s, ids in zip(strings + unspaced, c.encode_all(strings + unspaced), strict=True):
        assert ids.tolist() == lib.encode_ordinary(s) and "".join(c.decode_stream(ids)) == s


def test_matches_by_classes_are_those_of_the_pattern():
    import numpy as np
    import regex

    rnd = random.Random(4)
    usual, other = bpe_codec.Matches(P.PATTERN), bpe_codec.Matches(P.PATTERN)
    other.usual = False
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    texts = ["", "".join(rnd.sample(every, 20_000)), *("".join(rnd.choice("ab' \n\t1!　\x85\x1c½srevltmdé") for _ in range(rnd.randint(0, 12))) for _ in range(5000))]
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.int32)
    edges = np.cumsum([len(t) + 1 for t in texts]) - 1
    assert (usual(points, edges) == other(points, edges)).all()
    assert sum(usual(points, edges)) == sum(len(regex.findall(P.PATTERN, t)) for t in texts)


def test_queries(odd, docs, none):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, docs):
        texts = [(d, t or "") for d, t in texts_of(df)]
        got = token_counts.count_tokens(df, PIECES, 4096).collect()
        want = [(d, len(t.encode()), n := len(lib.encode(t, num_threads=1)), n > 4096) for d, t in texts]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
        got = bpe_codec.round_trip_digests(df, RANKS, P.PATTERN).collect()
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want = [(d, len(i), sha(" ".join(map(str, i)).encode()), sha(t.encode())) for d, t in texts for i in (tik.encode_ordinary(t),)]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(none, PIECES, 4096).collect() == [] == bpe_codec.round_trip_digests(none, RANKS, P.PATTERN).collect()
    again = bpe_codec.decode(bpe_codec.encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(map(tuple, again), key=key) == sorted(((d, t or "") for d, t in texts_of(odd)), key=key)


def test_the_round_trip_decodes_as_a_stream(strings, monkeypatch):
    c = bpe_codec.codec(RANKS, P.PATTERN)
    stream, fed = c.decode_stream, []
    monkeypatch.setattr(c, "decode_stream", lambda ids, n: stream(fed.append(len(ids)) or ids, n))
    for at_a_time in (1, 3, bpe_codec.DECODE_IDS):  # characters are cut between portions
        monkeypatch.setattr(bpe_codec, "DECODE_IDS", at_a_time)
        some = [*strings[:300], "\U0001f9ff\u6f22\u5b57\U00012345 e\u0301" * 5]
        for s, ids in zip(some, c.encode_all(some), strict=True):
            n, _, decoded = bpe_codec.digests(c, ids)
            assert fed.pop() == n and decoded == hashlib.sha256(s.encode()).hexdigest()
            assert "".join(stream(ids, at_a_time)) == s


def test_ids_equal_the_library(strings):
    lib, fast = Tokenizer.from_file(FAST), packing.fast_ids(FAST, RANKS, P.PATTERN)
    for s in strings:
        assert fast(s) == b"".join(i.to_bytes(4, "little") for i in lib.encode(s, add_special_tokens=False).ids)


def test_packing(odd, docs, none):
    lib = Tokenizer.from_file(FAST)
    for df in (odd, docs):
        want = defaultdict(list)
        for d, t in texts_of(df):
            want[d].append(lib.encode(t or "", add_special_tokens=False).ids + [0])
        packed = packing.pack(df, FAST, RANKS, P.PATTERN)
        pieces = packed.collect()
        fills = defaultdict(list)
        for p in pieces:
            fills[p.sequence_id].append((p.offset, p.length))
        for own in fills.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at and length > 0
                at += length
            assert at <= 1024
        crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        cut = [(d, s, len(i[s : s + 1024]), crc(i[s : s + 1024]), len(i)) for d, many in want.items() for i in many for s in range(0, len(i), 1024)]
        assert sorted(((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces), key=key) == sorted(cut, key=key)
    total = packing.padding(packing.pack(docs, FAST, RANKS, P.PATTERN)).first()
    assert total.padding <= 0.04 * total.tokens
    assert packing.pack(none, FAST, RANKS, P.PATTERN).collect() == []


def test_stream_keeps_few_windows_and_emits_the_fullest():
    out = list(packing.pack_stream([(6, "a"), (5, "b"), (9, "c"), (4, "d"), (8, "e")], 10, 2))
    assert out == [(["b"], 5, False)] or out[0] == (["a"], 6, False)
    closed = [w for w in out if not w[2]]
    assert len([w for w in out if w[2]]) <= 2 and sorted(p for w, _, _ in out for p in w) == list("abcde")
    assert all(sum({"a": 6, "b": 5, "c": 9, "d": 4, "e": 8}[p] for p in w) == fill for w, fill, _ in out) and closed
