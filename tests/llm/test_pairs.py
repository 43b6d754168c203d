"""Hard negatives, token alignment and the n-gram join against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import alignment, hard_negatives, ngram_join, registry
from corpusloom.llm.near_dedup import shingle_set

from .conftest import PASSAGE, key, texts_of
from .test_others import components_brute, mutated

# hard negatives ------------------------------------------------------------------------------------------------

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def mined_brute(rows, positives=5, negatives=10):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) in plain Python, with numbers of any size."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [min(max(math.floor(256 * x) if math.isfinite(256 * x) else (HIGH if x > 0 else LOW), LOW), HIGH) for x in v]))
    out = []
    for a, label, q in kept:
        if a % 100:
            continue
        scored = [(min(max(sum(x * y for x, y in zip(q, w, strict=True)), LOW), HIGH), i, own) for i, own, w in kept if i != a and len(w) == len(q)]
        ranked = sorted(scored, key=lambda x: (-x[0], x[1]))
        for score, positive, _ in [x for x in ranked if x[2] == label][:positives]:
            fit = [x for x in ranked if x[2] != label and 30 * score <= 100 * x[0] <= 90 * score][:negatives]
            out += [(a, positive, n, i, score, s) for n, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, row string, q string, windows string, codes string"


def mined(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "a", "b", None, "c") for r in rows], VECTORS).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(hard_negatives.prepared(df), F.col("vec_id") % 100 == 0, **sizes).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_hard_negatives(spark):
    """Ties, repeated rows and ids, nulls in every column, other dimensions, zero, negative and freak vectors, and a label of a third of all rows."""
    rng = np.random.default_rng(4)
    label = lambda: 3 if rng.random() < 0.33 else int(rng.integers(0, 10))
    rows = [(i, rng.normal(size=6).tolist(), label()) for i in range(0, 700, 2)]
    rows += [(i, rng.integers(-2, 3, 6).astype(float).tolist(), label()) for i in range(1, 300, 2)]
    rows += rows[:40] + [(i, rng.normal(size=5).tolist(), label()) for i in range(1000, 1230, 3)] + [(1100, [1.0], 1), (1101, [2.0], 1), (1102, [1.5], 2), (1200, [-1.0], 4), (1203, [1.0], 4)]
    rows += [(None, [1.0] * 6, 1), (800, None, 1), (800, [1.0] * 6, None), (800, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (801, [float("nan")] * 6, 1), (802, [float("inf")] * 6, 1), (803, [], 1), (900, [0.0] * 6, 2), (901, [0.0] * 6, 2)]
    rows += [(1300, [1e300, 1.0], 1), (1301, [1e15, 2.0], 1), (1302, [4e14, 1.0], 2), (1303, [1e13, -1.0], 3), (1400, [3e15, 5.0], 3)]
    want = mined_brute(rows)
    assert len(want) > 300 and mined(spark, rows) == want
    assert mined(spark, rows, block=50, anchor_block=2) == want
    assert mined(spark, []) == []


def test_lookups_bound_scores(spark):
    """Exact scores always lie within the residuals' bound, which leaves out most vectors."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(2000, 64))
    whole = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(whole)], "vec_id long, label long, q array<long>")
    books = hard_negatives.codebooks(df)
    assert list(books) == [64] and books[64].shape == (32, 256, 2)
    frame = hard_negatives.coded(df, books).toPandas()
    block = hard_negatives.Quantised(frame, books[64])
    score, slack = block.bounds(whole[:50])
    exact = whole[:50] @ np.array(frame["q"].tolist()).T
    assert (np.abs(score - exact) <= slack).all()
    best = np.sort(score - slack, 1)[:, -10]
    assert np.mean(score + slack >= best[:, None]) < 0.3


# alignment -----------------------------------------------------------------------------------------------------

FILES = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model")


def aligned_brute(rows):
    """Rows and links in plain Python, by the libraries alone."""
    a_side, b_side = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[3])
    a_side.encode_special_tokens = True
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    octet = {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in seen)}
    bytes_a = lambda i: bytes(octet[c] for c in a_side.id_to_token(i))
    bytes_b = lambda i: bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        if b"".join(map(bytes_a, a)) != (" " + text).encode() or b"".join(map(bytes_b, b)) != (" " + text).encode():
            return None
        out, i, j, x, y = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                x += len(bytes_a(a[i]))
                out[-1][0].append(a[i])
                i += 1
            else:
                y += len(bytes_b(b[j]))
                out[-1][1].append(b[j])
                j += 1
            if x == y:
                out.append(([], []))
        return out[:-1]

    found = [(d, groups(t)) for d, t in rows]
    count = Counter()
    for _, gs in found:
        count.update({(a, b) for x, y in gs or () for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for d, gs in found:
        if gs is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a, b) for x, y in gs for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((d, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(links), sum(count[z] == best[z[0]] for z in links), sum(count[z] for z in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, dict(count)


STRANGE = ["a▁b", "▁", " ", "  two  spaces ", "<s> </s> <unk> <0x41> <|endoftext|>", "é漢字\U0001f600 naïve", "\x00\x01\t\r\n", "aaaaaaaaaaaaaaaaaaaaaaaaa", "x " * 50, "ÄÖÜß ﬁ ½ ª", "ทดสอบภาษาไทย", "  ﻿", "don't we'll I'd", "١٢٣ 123456", "é ẛ̣"]


@pytest.mark.parametrize("size", [500, alignment.CHUNK_BYTES])
def test_alignment(spark, odd, docs, none, size):
    strange = spark.createDataFrame([(i, t) for i, t in enumerate(STRANGE * 2)], "doc_id long, text string")
    for df in (odd, docs.limit(60), strange):
        df = df.cache()
        got = alignment.align(df, *FILES, chunk_bytes=size)
        want, links = aligned_brute(texts_of(df))
        assert sorted((tuple(r) for r in got.documents.collect()), key=key) == sorted(want, key=key)
        assert {(r.a, r.b): r.n_docs for r in got.links.collect()} == links
    assert got.documents.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    empty = alignment.align(none, *FILES)
    assert empty.documents.collect() == [] and empty.links.collect() == [] and empty.dictionary.collect() == []


def test_dictionary_has_each_group_once(spark, docs):
    got = alignment.align(docs.limit(40), *FILES, chunk_bytes=5000)
    entries = got.dictionary.collect()
    assert len({bytes(r.key) for r in entries}) == len(entries) == len({(tuple(r.a), tuple(r.b)) for r in entries})
    held = Counter()
    for _, t in texts_of(docs.limit(40)):
        c = alignment.Chunk(alignment.encoders(*FILES), [t])
        held.update({c.keys[i].tobytes() for i in c.held.tolist()})
    assert {bytes(r.key): r.docs for r in entries} == dict(held)


# n-gram join ---------------------------------------------------------------------------------------------------


def joined_brute(rows, words=3, percent=90):
    return sorted(((d, n, c) for d, n, c, _ in components_brute(rows, words, percent)), key=key)


@pytest.fixture(scope="module")
def similar(spark):
    """Groups of near copies at similarities around the threshold, a chain, texts that share passages, copies, and few words."""
    rnd = random.Random(8)
    new = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    texts = []
    for size in (40, 120, 400):
        base = new(size)
        texts += [" ".join(base), *(mutated(rnd, base, rnd.randint(1, max(1, size // 40))) for _ in range(30)), " ".join(base).upper()]
    chain = new(150)
    for _ in range(12):
        texts.append(" ".join(chain))
        chain[rnd.randrange(150)] = f"c{rnd.randrange(10**6)}"
        chain[rnd.randrange(150)] = f"c{rnd.randrange(10**6)}"
    texts += [" ".join([*new(3), PASSAGE, PASSAGE.upper(), *new(2)]) for _ in range(40)]
    texts += [" ".join([*PASSAGE.split(), *new(n)]) for n in range(6) for _ in range(6)]
    pieces = [new(60) for _ in range(4)]
    texts += [" ".join(sum(rnd.sample(pieces, 3), [])) for _ in range(20)]  # all of it is held elsewhere, in other orders
    texts += ["a", "A", "a b", "a  B", "a b c", "a b c d", "", None]
    rnd.shuffle(texts)
    return spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)


def test_ngram_join(odd, docs, similar, none, monkeypatch):
    for df in (odd, similar, docs):
        assert sorted((tuple(r) for r in ngram_join.similarity_join(df).collect()), key=key) == joined_brute(texts_of(df))
    assert ngram_join.similarity_join(none).collect() == []
    want = joined_brute(texts_of(similar))
    assert len({c for _, _, c in want}) < len(want) - 60


@pytest.mark.parametrize("words, percent", [(3, 90), (1, 60), (2, 100)])
def test_ngram_join_by_small_blocks(similar, monkeypatch, words, percent):
    """Many chunks, ranges, blocks and units."""
    for name, value in {"BLOCK": 5, "VALUES": 900, "CHUNK_VALUES": 2000, "CHUNK_DOCS": 16, "RANGE_VALUES": 300}.items():
        monkeypatch.setattr(ngram_join, name, value)
    assert sorted((tuple(r) for r in ngram_join.similarity_join(similar, words, percent).collect()), key=key) == joined_brute(texts_of(similar), words, percent)


def test_products_drop_only_pairs_below_the_bound():
    rnd = random.Random(3)
    sets = [shingle_set(" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 60))), 2) for _ in range(80)] + [shingle_set("z y x", 2)] * 2
    for percent in (30, 60, 90):
        incidence = ngram_join.Incidence(sets)
        for i in range(len(sets)):
            at, got = incidence.overlaps(i, np.arange(len(sets)) != i, percent)
            both = [len(np.intersect1d(sets[i], s)) for s in sets]
            want = [j for j, n in enumerate(both) if j != i and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)]
            assert at.tolist() == want and got.tolist() == [both[j] for j in want]


# the registered queries --------------------------------------------------------------------------------------------


def test_registered_queries_have_the_parameters_of_production(spark, sf_dir):
    """On whole tables; the three of this file against brute force, by what the registry calls."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = texts_of(docs)
    run = lambda name: [tuple(r) for r in registry.QUERIES[name](spark, sf_dir).collect()]
    assert sorted(run("op13_ngram_product_join"), key=key) == joined_brute(rows)
    assert sorted(run("op12_group_dictionary_alignment")) == sorted(aligned_brute(rows)[0])
    vectors = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(run("op11_quantised_hard_negatives")) == mined_brute(vectors)
