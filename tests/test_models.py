"""Structured replies, pair scores, and lexical search, against plain Python."""

import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import models
from corpusloom.functions import structured as S
from corpusloom.functions import text as T
from corpusloom.operators import dataset as D
from corpusloom.operators import evaluation as E

QA = "oath STRING, question STRING NOT NULL, references ARRAY<STRING> NOT NULL"
DEEP = "name STRING NOT NULL COMMENT 'as it is written', score DOUBLE, n INT, flags MAP<STRING, BOOLEAN>, parts ARRAY<STRUCT<at: BIGINT NOT NULL, words: ARRAY<STRING>>> NOT NULL"


def checked(spark, ddl, *replies):
    df = spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(replies)], "i int, reply string")
    rows = df.select("i", S.structured("reply", ddl).alias("r")).orderBy("i").collect()
    assert all((r.r.value is None) == (r.r.reason is not None) for r in rows)
    return [r.r.reason if r.r.value is None else r.r.value.asDict(True) for r in rows]


def test_structured_replies_of_a_plain_schema(spark):
    good = {"question": "q", "references": ["r", "s"]}
    assert checked(spark, QA, good, f"Here:\n```json\n{json.dumps(good)}\n```", {**good, "oath": "o", "more": 1}, {**good, "oath": None}, {"question": "q", "references": []}) == [
        {"oath": None, **good}, {"oath": None, **good}, {"oath": "o", **good}, {"oath": None, **good}, {"oath": None, "question": "q", "references": []},
    ]
    assert checked(spark, QA, None, "", "no json", "[1]", "3", {"question": "q"}, {"question": None, "references": []}, {"question": 5, "references": []}, {"question": "q", "references": "r"}, {"question": "q", "references": ["r", 5]}, {"question": "q", "references": [None]}, {**good, "oath": 1}) == [
        "no JSON", "no JSON", "no JSON", "reply is not an object", "reply is not an object", "reply.references is missing", "reply.question is missing", "reply.question is not text", "reply.references is not a list",
        "reply.references[1] is not text", "reply.references[0] is missing", "reply.oath is not text",
    ]


def test_structured_replies_of_a_deep_schema(spark):
    good = {"name": "a", "score": 1, "n": 3, "flags": {"x": True}, "parts": [{"at": 2, "words": ["w"]}, {"at": 3, "words": None}]}
    (value,) = checked(spark, DEEP, good)
    assert value == {**good, "score": 1.0}
    with_part = lambda p: {"name": "a", "parts": [good["parts"][0], p]}
    assert checked(spark, DEEP, with_part({"words": []}), with_part({"at": "2"}), with_part({"at": 2.5}), with_part(7), with_part({"at": 1, "words": [["w"]]}), {**good, "flags": {"x": 1}}, {**good, "n": 10**12}, {**good, "score": "high"}) == [
        "reply.parts[1].at is missing", "reply.parts[1].at is not a whole number", "reply.parts[1].at is not a whole number", "reply.parts[1] is not an object", "reply.parts[1].words[0] is not text",
        "reply.flags[0] is not true or false", "reply.n is not a number of that size", "reply.score is not a number",
    ]
    said = S.instructions(DEEP)
    assert '- "name": text: as it is written' in said and '- "score": a number (may be left out)' in said and '- "parts": a list, each item an object of "at": a whole number, "words": a list, each item text or null' in said
    with pytest.raises(ValueError, match="date"):
        S.instructions("d DATE")


def test_asking_for_a_structure(spark):
    class Model:
        def generate(self, prompt, max_tokens, temperature):
            if prompt.startswith("fail"):
                raise TimeoutError("late")
            assert '"question": text' in prompt
            return prompt.split("\n\n", 1)[0]

    df = spark.createDataFrame([(1, '{"question": "q", "references": []}', "k"), (2, "fail", "k"), (3, "words", None), (4, None, "k")], "id int, prompt string, error_free string")
    got = {r.id: (r.value and r.value.question, r.reason) for r in D.ask_structured(df, "prompt", QA, Model).collect()}
    assert got == {1: ("q", None), 2: (None, "TimeoutError: late"), 3: (None, "no JSON"), 4: (None, "no JSON")}


def test_longest_side_goes_first():
    for a in range(14):
        for b in range(14):
            for limit in range(14):
                x, y = a, b
                while x + y > limit:
                    if x > y:
                        x -= 1
                    else:
                        y -= 1
                assert models.longest_first(a, b, limit) == (x, y), (a, b, limit)


def test_pairs_are_cut_together(spark):
    import public_tokenizers as P

    doc, query = " ".join(f"d{i}" for i in range(900)), " ".join(f"q{i}" for i in range(20))
    assert models.OverlapScorer(100).score([(query, query + " " + doc), ("", ""), ("a", "")]) == [20 / 80, 0.0, 0.0]
    ids = models.file_tokens(P.path("word_bpe_49k.json"))
    same = "some words of a text " * 200
    assert models.OverlapScorer(512, ids).score([(same, same)]) == [1.0] and len(ids(same)) > 512
    calls = []

    class Counting:
        def score(self, pairs):
            calls.append(len(pairs))
            return [float(len(q)) for q, _ in pairs]

    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(40)], "i int, t string").coalesce(1)
    got = df.select("i", models.pair_scores(F.col("t"), F.lit("yy"), Counting, characters=30).alias("s")).collect()
    assert all(r.s == r.i for r in got)
    assert models.normal_tokens("Hello,  WORLD! x-y") == ["hello", "world", "xy"]


def test_lexical_search(spark, monkeypatch):
    """All by small blocks too: ties, repeated tokens, texts without tokens, nulls, repeated ids, and a token that all have."""
    for name, value in {"DOCUMENTS_PER_BLOCK": 20, "REFERENCES_PER_BLOCK": 7, "DOCUMENTS_AT_A_TIME": 6}.items():
        rnd = random.Random(5)
        text = lambda n: " ".join(["the"] * (n > 2) + [rnd.choice("abcdefghijklmnop" if rnd.random() < 0.7 else "abc") for _ in range(n)])
        refs, docs = [(i, text(rnd.randint(0, 9))) for i in range(30)] + [(40, None), (41, "...")], [(i, text(rnd.randint(0, 14))) for i in range(90)] + [(200, None), (3, "a b c the"), (None, "a b the")]
        r, d = spark.createDataFrame(refs, "reference_id long, text string"), spark.createDataFrame(docs, "chunk_id long, content string").repartition(3)
        for k, floor in ((1, 0.0), (4, 0.3), (500, 0.5)):
            want = []
            for i, x in refs:
                t = (x or "").replace(".", "").split()
                found = sorted((-sum(w in y.split() for w in t) / len(t), j) for j, y in docs if t and y and j is not None and y.split())
                want += [(i, j, -s, n) for n, (s, j) in enumerate([f for f in found if -f[0] >= floor][:k], 1)]
            assert sorted(map(tuple, E.lexical_top_k(r, d, k, floor).collect())) == sorted(want)
        monkeypatch.setattr(E, name, value)
    assert E.lexical_top_k(r.limit(0), d, 3, 0.1).collect() == [] == E.lexical_top_k(r, d.limit(0), 3, 0.1).collect()


def test_multiset_overlap_by_blocks(spark, monkeypatch):
    """By small blocks too: repeated tokens, repeated and missing ids, texts without tokens; no common token is a row of a join or a key of a shuffle."""
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("abcdefgh" if rnd.random() < 0.5 else "ab") for _ in range(n))
    refs, docs = [(i, text(rnd.randint(0, 9))) for i in range(20)] + [(3, "A b, b"), (None, "a"), (None, "a h"), (40, None)], [(i, text(rnd.randint(0, 14))) for i in range(60)] + [(5, "b b"), (None, "a a a h"), (None, "h"), (70, "...")]
    r, d = spark.createDataFrame(refs, "reference_id long, text string"), spark.createDataFrame(docs, "chunk_id long, content string").repartition(3)
    sides = []
    for rows in (refs, docs):
        sides.append({})
        for i, x in rows:
            sides[-1].setdefault(i, Counter()).update(models.normal_tokens(x or ""))
    want = {(i, j, n) for i, a in sides[0].items() for j, b in sides[1].items() if (n := (a & b).total())}
    for name, value in {"DOCUMENTS_PER_BLOCK": 9, "OVERLAPS_PER_BLOCK": 6, "TOKENS_PER_BLOCK": 30, "DOCUMENTS_AT_A_TIME": 4, "COMMON_AT_A_TIME": 11}.items():
        got = E.multiset_overlap(r, d)
        rows = [tuple(x) for x in got.collect()]
        assert set(rows) == want and len(rows) == len(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        monkeypatch.setattr(E, name, value)
    assert E.multiset_overlap(r.limit(0), d).collect() == [] == E.multiset_overlap(r, d.limit(0)).collect()


def test_slices_of_a_pair_of_blocks_are_bounded(monkeypatch):
    """However frequent tokens are: a slice meets so many pairs of tokens at most, unless one document alone has more."""
    monkeypatch.setattr(E, "COMMON_AT_A_TIME", 100)
    ids, words = list(range(60)), ["a b c d"] * 10 + ["a b"] * 50
    table = pa.table({"id": pa.array(ids, pa.int64()), "words": words, "asked": [True] * 10 + [False] * 50})
    refs, sizes, docs, slices = E.block_product(table, by_id=False, least=False)
    slices = list(slices)
    assert [start for start, _ in slices] == list(range(0, 50, 5)) and all(m.shape == (5, 10) and (m == 2).all() for _, m in slices)
    assert refs.to_pylist() == ids[:10] and docs.to_pylist() == ids[10:] and sizes.tolist() == [4] * 10


def test_blocks_are_bounded_by_tokens_on_both_sides(spark, monkeypatch):
    """Long references are dealt into more blocks too, and each row meets every block of the other side."""
    monkeypatch.setattr(E, "TOKENS_PER_BLOCK", 30)
    text = lambda n, size: spark.createDataFrame([(i, size, "w " * (size - 1) + "w") for i in range(n)], "id long, n int, words string")
    rows = E.block_pairs(text(6, 40), text(5, 12), 100, ["id", "n"]).collect()
    blocks = lambda asked, side: {r.id: {x[side] for x in rows if x.asked == asked and x.id == r.id} for r in rows if r.asked == asked}
    assert all(b == {0, 1} for b in blocks(True, "db").values()) and all(b == set(range(8)) for b in blocks(False, "rb").values())
    assert all(len(b) == 1 for b in [*blocks(True, "rb").values(), *blocks(False, "db").values()])


def test_matches_count_repeated_tokens_once_for_each(spark):
    refs = spark.createDataFrame([(1, "x", "a a a b c"), (1, "y", "..."), (1, "z", "c d"), (2, "w", "a")], "question_id long, reference_id string, text string")
    hits = spark.createDataFrame([(1, 10, 1, "A, b!"), (1, 11, 2, "c"), (1, 12, 3, None), (2, 10, 1, "b")], "question_id long, chunk_id long, rank long, content string")
    got = lambda th: sorted((r.reference_id, r.chunk_id) for r in E.matches(refs, hits, th).collect())
    assert got(0.8) == [("x", 10)] and got(0.5) == [("x", 10), ("z", 11)] and got(0.2) == [("x", 10), ("x", 11), ("z", 11)]
    assert sorted((r.reference_id, r.chunk_id) for r in E.matches(refs, E.hit_tokens(hits).drop("content"), 0.5).collect()) == got(0.5)


def test_tokens_need_no_collapsed_space(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aB1.,!- \t\n\x1c\x85\xa0 　é") for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.tokens("t").alias("k"), T.words(T.normalize("t")).alias("n")).collect()
    assert all(r.k == r.n == models.normal_tokens(r.t) for r in rows)
