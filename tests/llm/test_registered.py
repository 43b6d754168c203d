"""The registered queries, with the parameters that the registry gives them, against what the contract says; whole tables, the libraries alone."""

import base64
import hashlib
import math
import zlib
from collections import defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import registry

from .conftest import key, texts_of
from .test_others import base_brute, components_brute


@pytest.fixture(scope="module")
def texts(docs):
    return dict(texts_of(docs))


@pytest.fixture
def run(spark, sf_dir):
    return lambda name: registry.QUERIES[name](spark, sf_dir)


def digest(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_op1(run, texts):
    rows = run("op1_hash_tree_sharding").collect()
    assert len(rows) == len(texts) and {r.shard for r in rows} <= set(range(8)) and {r.law for r in rows} == {"key"}
    slots = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len((texts[r.doc_id] or "").encode()) + 1, zlib.crc32((texts[r.doc_id] or "").encode())) and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op2(run, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in texts.items()]
    assert sorted(tuple(r)[:4] for r in run("op2_transducer_token_counts").collect()) == sorted(want)


def test_op3(run, texts):
    lib, sequences, pieces = Tokenizer.from_file(P.path("byte_bpe_50k.json")), defaultdict(list), defaultdict(list)
    for r in run("op3_bounded_space_packing").collect():
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    for d, t in texts.items():
        ids, at = [*lib.encode(t or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + r.length])))
            at += r.length
        assert at == len(ids)


def test_op4(run, texts):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(d, len(ids := lib.encode_ordinary(t or "")), digest(" ".join(map(str, ids))), digest(t or "")) for d, t in texts.items()]
    assert sorted(map(tuple, run("op4_transducer_bpe").collect())) == sorted(want)


def test_op5(run, texts):
    for r in run("op5_crf_secrets").collect():
        base = base_brute(texts[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (*(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")), digest(",".join(base)))
        assert set(base) <= set(r.spans.split(","))


def test_op6(run, docs):
    assert sorted(map(tuple, run("op6_bayesian_minhash").collect()), key=key) == sorted(components_brute(texts_of(docs), 4, 80), key=key)


def test_op7(run, texts):
    rows = run("op7_surrogates").collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.collisions == r.unchanged == 0 for r in rows)
    found = [r for r in rows if r.n_email + r.n_phone + r.n_card + r.n_ip + r.n_name]
    assert found and all(r.text != texts[r.doc_id] for r in found)
    assert all(r.text == texts[r.doc_id] for r in rows if not any(r[c] for c in r.asDict() if c.startswith("n_")))


def test_op8(run, spark, sf_dir):
    v = {r.vec_id: [math.floor(1024 * x) for x in r.embedding] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    want = []
    for q in (q for q in v if q % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], w, strict=True)), i) for i, w in v.items() if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, run("op8_impact_ordered_topk").collect())) == sorted(want)


def test_op9(run, texts):
    for r in run("op9_chunked_media").collect():
        whole = (texts[r.doc_id] or "").encode()
        padded = whole + b"\xff" * (max(1, -(-len(whole) // 576)) * 576 - len(whole))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(whole), len(padded), digest(padded), zlib.crc32(padded[-32:])) and r.media_bytes > 0 and len(r.media_sha256) == 64 and r.feature is not None


def test_op10(run, spark, sf_dir, texts):
    rows = run("op10_boosted_toxicity").collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("toxic").isNotNull()).collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.8 * len(held)
