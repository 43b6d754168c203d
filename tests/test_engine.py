"""Golden cases, properties and edge cases of the engine's operators."""

import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import models
from corpusloom.functions import text as T
from corpusloom.operators import chunking as C
from corpusloom.operators import dataset as D
from corpusloom.operators import evaluation as E
from corpusloom.operators import numbering, retrieval
from corpusloom.sources import io


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr("t").alias("x")).first().x


# text ----------------------------------------------------------------------------------------------------------


def test_normalisation_and_tokens(spark):
    assert one(spark, T.normalize, "Hello,  WORLD!\u00a0x-y") == "hello world xy"
    assert one(spark, T.tokens, "...") == [] and one(spark, T.tokens, "\u201cA\u201d \u2014 b") == ["\u201ca\u201d", "\u2014", "b"]
    assert one(spark, T.words, "\x1ca\x85b\u3000c ") == ["a", "b", "c"]


def test_sentences_and_paragraphs(spark):
    assert one(spark, T.sentences, "Hi!  Ok? Go") == ["Hi!  ", "Ok? ", "Go"] == C.split_sentences("Hi!  Ok? Go")
    assert one(spark, T.paragraphs, "a\n\n \nb\n \n\nc") == ["a", "b", "c"] == [p.strip() for p in C.split_paragraphs("a\n\n \nb\n \n\nc")]
    for t in ("", "   ", "a.", "a. ", "e.g. this. And", "no end", "x?!  y"):
        assert one(spark, T.sentences, t) == C.split_sentences(t)


def test_windows(spark):
    ten = " ".join(map(str, range(10)))
    want = ["0 1 2 3 4", "3 4 5 6 7", "6 7 8 9", "9"]
    assert one(spark, lambda c: T.word_windows(c, 5, 2), ten) == want == C.recursive_chunks(ten, 5, 2)
    with pytest.raises(ValueError, match="never ends"):
        T.word_windows("t", 5, 5)
    assert one(spark, lambda c: T.word_windows(c, 5), "") == []


def test_small_functions(spark):
    assert one(spark, T.cleanup, '"a\\nb"') == "a\nb"
    assert [one(spark, T.basename, x) for x in ("a/b.txt", "", None)] == ["b.txt", "N/A", "N/A"]
    assert one(spark, lambda c: T.preview(c, 3), "abcd") == "abc..." and one(spark, lambda c: T.preview(c, 3), "abc") == "abc"
    assert [one(spark, lambda c: T.to_whole(F.col(c), "int"), x) for x in ("2019.9", "n/a", None, "-3.7")] == [2019, None, None, -3]
    assert one(spark, T.strip_fence, "x ```json\n{}\n``` y") == "{}" and one(spark, T.strip_fence, " \n{} \n") == "{}" and one(spark, T.strip_fence, "```\n1```") == "1"
    fuzzy = spark.createDataFrame([("a a a b c", "a b"), ("...", "a"), ("a", "")], "r string, d string").select(T.is_fuzzy_match(T.tokens("r"), T.tokens("d"), 0.8).alias("m"))
    assert [r.m for r in fuzzy.collect()] == [True, False, False]
    row = spark.range(1).select(T.heading_lines(F.create_map(F.lit(2), F.lit("B"), F.lit(1), F.lit("A"))).alias("h")).first()
    assert row.h == ["# A", "## B"]


# chunking ------------------------------------------------------------------------------------------------------


def test_recursive_chunks():
    assert C.recursive_chunks("", 3) == [""] and C.recursive_chunks("   ", 3) == ["   "]
    assert C.recursive_chunks("A b. C d e f g h. I.", 3) == ["A b. ", "C d e f g h. ", "I."]
    assert C.recursive_chunks("a b\n\nc d\n\ne f g h i", 4) == ["a b\n\nc d", "e f g h", "i"]
    with pytest.raises(ValueError):
        C.recursive_chunks("a", 2, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c!", "\n\n", "d"]), max_size=40), st.integers(1, 6))
def test_chunks_lose_no_word(parts, size):
    text = " ".join(parts)
    assert " ".join(C.recursive_chunks(text, size)).split() == text.split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 8)), max_size=12))
def test_merged_spans_are_disjoint(pairs):
    spans = [(s, s + n) for s, n in pairs]
    out = C.merge_spans(spans)
    assert all(a[1] < b[0] for a, b in zip(out, out[1:], strict=False))
    assert {x for s, e in spans for x in range(s, e)} == {x for s, e in out for x in range(s, e)}


def test_spans():
    assert C.merge_spans([(5, 10), (0, 3), (10, 12), (20, 30), (22, 25)]) == [(0, 3), (5, 12), (20, 30)]
    nested = r"x \begin{figure}\begin{figure}a\end{figure}\end{figure} y \begin{open} z"
    (span,) = C.environment_spans(nested)
    assert nested[slice(*span)].startswith(r"\begin{figure}") and nested[span[1] :].startswith(" y") and C.matching_end(r"\begin{a}", 0) == -1
    assert C.table_spans("t |a|\n|b|\n|c|\nx") == [(2, 14)] and C.table_spans("|a|\n|b|") == [] and C.table_spans("|a|\n|b|\n|c|") == [(0, 8)]
    assert C.table_spans("||\n||\n|a|\n") == [] and C.table_spans("||\n|a|\n|b|\n") == [(3, 11)]
    braced, empty = r"\begin{a{b} x \end{a{b} y", r"\begin{} x \begin{q} y \end{q} z \end{q}"
    assert C.environment_spans(braced) == [(0, len(braced) - 2)] and C.matching_end(empty, 0) == len(empty)
    inside = "\\begin{t}\n|a|\n|b|\n\\end{t}"
    assert C.preserved_spans(inside) == [(0, len(inside))]


def test_protected_and_structured():
    assert C.protected_sentences("See Fig. 3 now. It $a. b$ is. Go") == ["See Fig. 3 now.", "It $a. b$ is.", "Go"]
    assert C.protected_sentences("See Table 1. The caption goes on. Eq. 2: ok. fig. 3 no") == ["See Table 1. The caption goes on.", "Eq. 2: ok.", "fig. 3 no"]
    many = " ".join(f"$x. {i}$ end." for i in range(12))
    assert C.protected_sentences(many) == [f"$x. {i}$ end." for i in range(12)]
    assert C.structured_chunks("One. Two.\n|a|\n|b|\nThree.") == ["One.", "Two.", "|a|\n|b|\n", "Three."]


def test_sections():
    text = "intro\n# A\nx\n```\n# no\n```\n## B\ny\n# C\nz"
    got = [(s.content, s.headers) for s in C.header_sections(text)]
    assert got == [("intro", {}), ("# A\nx\n```\n# no\n```", {1: "A"}), ("## B\ny", {1: "A", 2: "B"}), ("# C\nz", {1: "C"})]
    assert all(len(s.content.split()) <= 4 for s in C.section_chunks("# A\na b. c d. e f.", 4))


def test_pieces_are_held_for_few_texts_at_a_time(spark, monkeypatch):
    """A batch counts rows, not characters: pieces of its texts go out, and are let go, before the next texts are read."""
    monkeypatch.setattr(C, "CHARACTERS_AT_A_TIME", 10)
    texts = ["abcd", None, "abcdef", "", "x" * 25, "ab"]
    batch = pa.record_batch({"id": pa.array(range(6), pa.int64()), "text": texts})
    assert list(C.portions(batch)) == [[(0, "abcd"), (2, "abcdef")], [(3, ""), (4, "x" * 25)], [(5, "ab")]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [(r.doc_id, r.content) for r in C.chunk_rows(docs, lambda t: [t[:5], t[5:]]).where("content <> ''").collect()] == [(0, "abcd"), (2, "abcde"), (2, "f"), (4, "xxxxx"), (4, "x" * 20), (5, "ab")]
    assert [tuple(r) for r in C.span_rows(docs, lambda t: [(0, len(t))]).collect()] == [(i, 0, 0, len(t)) for i, t in enumerate(texts) if t]


def test_chunk_rows_and_udtf(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "doc_id long, text string")
    got = C.chunk_rows(docs, lambda t: C.recursive_chunks(t, 2)).collect()
    assert sorted((r.doc_id, r.chunk_no, r.content) for r in got) == [(1, 0, "a b"), (1, 1, "c"), (3, 0, "")]
    C.register_udtf(spark)
    docs.createOrReplaceTempView("chunk_docs")
    rows = spark.sql("SELECT doc_id, chunk_no, content FROM chunk_docs, LATERAL recursive_chunks(text, 2, 0)").collect()
    assert sorted(map(tuple, rows)) == [(1, 0, "a b"), (1, 1, "c"), (3, 0, "")]


# metrics -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def study(spark):
    hits = [(1, "alpha beta gamma delta epsilon", "p1"), (2, "blue yellow", "p2")]
    refs = {1: ["alpha beta gamma delta", "red green"], 2: ["alpha beta", "gamma delta"], 3: ["red green"]}
    h = spark.createDataFrame([(q, r, r, p, c, 1.0 / r) for q in refs for r, c, p in hits], "question_id long, rank long, chunk_id long, path string, content string, score double")
    r = spark.createDataFrame([(q, f"{q}/{i}", t) for q, ts in refs.items() for i, t in enumerate(ts)] + [(4, "4/0", "red")], "question_id long, reference_id string, text string")
    q = spark.createDataFrame([(i, "p1") for i in (1, 2, 3, 4)], "question_id long, gold_path string")
    return q, r, h


def test_golden_metrics(study):
    rows = {r.question_id: r for r in E.evaluate(*study, [2], 0.8).collect()}
    token = lambda r: tuple(round(x, 9) for x in (r.token_iou, r.token_precision, r.token_recall, r.token_f1))
    passage = lambda r: tuple(round(x, 9) for x in (r.passage_coverage, r.passage_accuracy, r.passage_precision, r.passage_recall, r.passage_f1))
    near = lambda *xs: tuple(round(x, 9) for x in xs)
    assert token(rows[1]) == near(4 / 9, 4 / 7, 2 / 3, 8 / 13) and passage(rows[1]) == near(0.5, 0, 0.5, 0.5, 0.5)
    assert token(rows[2]) == near(2 / 7, 2 / 7, 1, 4 / 9) and passage(rows[2]) == near(1, 1, 0.5, 1, 2 / 3)
    assert token(rows[3]) == near(0, 0, 0, 0) == near(*[0] * 4) and passage(rows[3]) == near(0, 0, 0, 0, 0)
    assert (rows[1].doc_coverage, rows[1].doc_precision, rows[1].doc_chunks_retrieved, rows[1].avg_score) == (1.0, 0.5, 1, 0.75)
    assert (rows[4].num_retrieved, rows[4].avg_score, rows[4].doc_coverage, rows[4].doc_precision) == (0, 0.0, 0.0, 0.0) and token(rows[4]) == near(0, 0, 0, 0)


def test_coverage_never_falls_with_k(study):
    by = {(r.question_id, r.k): r for r in E.evaluate(*study, [1, 2, 5], 0.8).collect()}
    assert all(by[q, 1].passage_coverage <= by[q, 2].passage_coverage <= by[q, 5].passage_coverage for q in (1, 2, 3, 4))


def test_failed_questions_leave_the_means(spark, study):
    q, r, h = study
    failed = q.withColumn("error", F.when(F.col("question_id") == 1, "timeout"))
    rows = {x.k: x for x in E.summary(E.evaluate(failed, r, h, [1, 2], 0.8), [1, 2, 7]).collect()}
    assert rows[2].num_questions == 3 and rows[7].num_questions == 0 and rows[7].avg_score_avg is None


def test_ranks(spark, study):
    q, r, h = study
    ranks = E.reciprocal_rank(q, E.matches(r, h, 0.8))
    assert {x.question_id: x.first_rank for x in ranks.collect()} == {1: 1, 2: 1, 3: None, 4: None}
    four = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0), (3, 3, 1 / 3), (4, None, 0.0)], "question_id long, first_rank long, reciprocal_rank double")
    assert round(E.mean_reciprocal_rank(four).first().mrr, 9) == round((2 + 1 / 3) / 4, 9)
    assert [(x.first_rank, x.percent) for x in E.rank_distribution(four).collect()] == [(1, 50.0), (3, 25.0), (None, 25.0)]


def test_fuzzy_join_asks_for_a_threshold(study):
    with pytest.raises(ValueError):
        E.fuzzy_pairs(study[1], study[2], 0.0)


def test_rerank(spark):
    h = spark.createDataFrame([(1, 1, 11, "same", 0.2), (1, 2, 12, "x", 0.9), (1, 3, 13, "same", 0.9)], "question_id long, rank long, chunk_id long, content string, s double")
    out = {r.chunk_id: (r.new_rank, r.position_change, r.direction) for r in D.rerank(h, F.col("s")).collect()}
    assert out == {12: (1, 1, "up"), 13: (2, 1, "up"), 11: (3, -2, "down")}
    assert sorted(r.chunk_id for r in D.last_of_content(h).collect()) == [12, 13]


# vectors -------------------------------------------------------------------------------------------------------


def test_cosine_top_k(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(9, [2.0, 0.0]), (1, [1.0, 0.0])], "query_id long, query_vector array<double>")
    top = {(r.query_id, r.rank): (r.vec_id, r.score) for r in retrieval.cosine_top_k(v, q, 2).collect()}
    assert top == {(9, 1): (1, 1.0), (9, 2): (2, 1.0), (1, 1): (2, 1.0), (1, 2): (3, 0.0)}
    assert retrieval.cosine_top_k(v, q, 5, floor=0.5).count() == 3 and retrieval.cosine_top_k(v.limit(0), q, 5).count() == 0
    pair = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>, c array<double>").select(retrieval.cosine(F.col("a"), F.col("b")).alias("x"), retrieval.cosine(F.col("a"), F.col("c")).alias("y")).first()
    assert (round(pair.x, 9), pair.y) == (1.0, 0.0)


def test_collection(spark, tmp_path):
    points = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b")], "vec_id long, embedding array<float>, file_path string")
    c = retrieval.Collection("test_points", 2)
    spark.sql("DROP TABLE IF EXISTS test_points")
    points.write.parquet(str(tmp_path / "snapshot"))
    assert c.restore(spark, str(tmp_path / "snapshot")) and not c.restore(spark, "nowhere") and spark.table("test_points").count() == 2
    new = spark.createDataFrame([(2, [1.0, 1.0], "c"), (3, [1.0, 1.0], "d"), (3, [1.0, 1.0], "e")], points.schema)
    assert sorted((r.vec_id, r.file_path) for r in c.upsert(points, new).collect()) == [(1, "a"), (2, "c"), (3, "e")]
    with pytest.raises(ValueError):
        c.check(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"))
    assert "PushedFilters: [IsNotNull(file_path), EqualTo(file_path,a)]" in c.keyword(spark.read.parquet(str(tmp_path / "snapshot")), "file_path", "a")._jdf.queryExecution().toString()
    spark.sql("DROP TABLE test_points")


def test_models(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, "a b")], "id long, t string")
    v = {r.id: r.embedding for r in models.embed(df, "t", factory=lambda: models.HashEmbedder(8)).collect()}
    assert v[1] == v[3] and v[2] == [0.0] * 8 and abs(sum(x * x for x in v[1]) - 1) < 1e-6
    s = df.select(models.pair_scores(F.col("t"), F.lit("b c")).alias("s"), models.lexical_score(F.col("t"), F.lit("b c")).alias("x")).collect()
    assert [round(r.s, 6) for r in s] == [round(r.x, 6) for r in s] == [0.333333, 0.0, 0.333333]

    class Broken:
        def generate(self, prompt, max_tokens, temperature):
            raise TimeoutError("late")

    out = models.generate(df, "t", "reply", Broken, 1, 0.0).collect()
    assert all(r.reply is None and r.error == "TimeoutError: late" for r in out)


# question sets, payloads, conversations ------------------------------------------------------------------------


def test_generation(spark):
    docs = spark.createDataFrame([(1, "p1", "Alpha beta gamma. More text here."), (2, "p2", "No chunks at all.")], "doc_id long, file_path string, content string")
    chunks = spark.createDataFrame([("p1", 5, "alpha beta gamma"), ("p1", 7, "nothing")], "file_path string, chunk_id long, content string")
    pairs = D.generate_pairs(docs, D.numbered_chunks(chunks), "Ask.")
    (row,) = pairs.collect()
    assert (row.pair_id, row.refs_generated, row.refs_valid, row.refs_removed) == (1, 2, 1, 1)
    assert [(r.text, list(r.chunk_numbers)) for r in row.references] == [("Alpha beta gamma.", [0])]
    stats = D.generation_stats(2, pairs).first()
    assert (stats.pairs, stats.skipped, stats.success_rate, stats.validity_rate) == (1, 1, 0.5, 0.5)
    assert D.generation_stats(0, pairs.limit(0)).first().success_rate == 0.0


def test_replies(spark):
    cases = ['```json\n{"question": "q", "references": ["r"]}\n```', '{"question": "q"}', "no json", '{"question": "q", "references": "r"}', None]
    got = spark.createDataFrame([(c,) for c in cases], "t string").select(D.parse_reply("t").alias("r")).collect()
    assert [r.r is not None for r in got] == [True, False, False, False, False]


def test_payload(spark):
    points = spark.createDataFrame([(1, "a", 1990, "keep"), (2, "b", 1991, "keep"), (3, "c", 1992, "keep")], "id long, file_path string, year int, other string")
    mapping = spark.createDataFrame([("b", "a"), ("z", "nowhere"), ("c2", "c")], "new_path string, old_path string")
    meta = spark.createDataFrame([("a", "2019.9"), ("c", None)], "file_path string, year string")
    old = D.payload_updates(mapping, meta)
    assert sorted(map(tuple, D.merge_payload(points, old).collect())) == [(1, "b", 2019, "keep"), (2, "b", 1991, "keep"), (3, "c2", None, "keep")]
    assert tuple(D.update_counts(points, old).first()) == (3, 2)
    new = D.payload_updates(mapping, meta, match_on="new")
    assert sorted(map(tuple, D.merge_payload(points, new).collect())) == [(1, "a", 1990, "keep"), (2, "b", 2019, "keep"), (3, "c", 1992, "keep")]
    with pytest.raises(ValueError, match="claim"):
        D.payload_updates(spark.createDataFrame([("x", "a"), ("y", "a")], mapping.schema), None)
    with pytest.raises(ValueError):
        D.payload_updates(mapping, None, match_on="both")


def test_conversations(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", "and?"), (1, 4, "assistant", "end"), (2, 0, "user", "only"), (3, 0, "assistant", "none")]
    convs = D.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, convs.collect())) == [(1, "User: hi\nAssistant: yes", "and?"), (2, "", "only")]
    assert {r.conv_id: r.rewritten for r in D.rewrite(convs).collect()} == {1: "hi and?", 2: "only"} and D.multi_turn(convs).count() == 1


def test_numbering_and_samples(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(200)], "id long, g string").repartition(7)
    got = numbering.number_rows(rows, "g", ["id"], "no").collect()
    for g in ("hot", None):
        ordered = sorted((r.id, r.no) for r in got if r.g == g)
        assert [n for _, n in ordered] == list(range(len(ordered)))
    a, b = (sorted(r.id for r in numbering.seeded_sample(df, "id", 10, 42).collect()) for df in (rows, rows.repartition(3)))
    assert a == b and len(set(a)) == 10 and numbering.seeded_sample(rows, "id", 500, 1).count() == 200


def test_numbering_keeps_every_row_of_a_wide_table(spark):
    """One group, rows of a kilobyte, adaptive execution on."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    wide = spark.range(200_000).select("id", F.lit("one").alias("g"), F.repeat(F.md5(F.col("id").cast("string")), 32).alias("text"))
    got = numbering.number_rows(wide, "g", ["id"], "no")
    row = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("no") == F.col("id")).alias("right"), F.min(F.length("text")).alias("size")).first()
    assert tuple(row) == (200_000, 200_000, 1024)
    assert sorted((r.id, r.row_no) for r in numbering.pick_rows(wide, ["id"], [5, 199_999, 10**9]).select("id", "row_no").collect()) == [(5, 5), (199_999, 199_999)]


def test_fuzzy_pairs_by_rare_tokens_are_all(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abcdefghijklmnop" if rnd.random() < 0.7 else "abc") for _ in range(n))
    refs, docs = [(i, text(rnd.randint(0, 9))) for i in range(40)], [(i, text(rnd.randint(0, 14))) for i in range(80)]
    r, d = spark.createDataFrame(refs, "reference_id long, text string"), spark.createDataFrame(docs, "chunk_id long, content string")
    for threshold in (0.2, 0.5, 0.8, 1.0):
        want = sorted((i, j, m / len(t)) for i, x in refs if (t := x.split()) for j, y in docs for m in [sum(w in y.split() for w in t)] if m / len(t) >= threshold)
        assert sorted(map(tuple, E.fuzzy_pairs(r, d, threshold).collect())) == want


def test_comparison_answers_and_failures(spark):
    hits = lambda rows: spark.createDataFrame(rows, "question_id long, chunk_id long, score double")
    got = E.compare_retrieval(hits([(1, 1, 0.5), (1, 2, 0.4)]), hits([(1, 2, 0.9), (2, 3, 0.1)])).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 1, 1, 0.5, 0.9, 0.4), (2, 0, 1, 0, 0.0, 0.1, 0.1)]
    asked = spark.createDataFrame([(1, "q?"), (2, "none?")], "question_id long, question string")
    shown = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "question_id long, rank long, content string")
    assert {r.question_id: (r.context, r.answer) for r in D.answer(asked, shown, "Answer.").collect()} == {1: ("Document 0:\na\nDocument 1:\nb\n", "2 documents on: q?"), 2: ("", "0 documents on: none?")}
    assert [tuple(r) for r in E.failed(spark.createDataFrame([(1, None), (2, "x")], "question_id long, error string")).collect()] == [(2, "x")]


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (None, [1.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = v.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    got = retrieval.cosine_top_k(v, asked, 5)
    assert sorted((r.query_id, r.vec_id, r.score) for r in got.collect()) == [(1, 2, 0.0), (2, 1, 0.0)]


# sources, sinks, command line ----------------------------------------------------------------------------------


def test_scans(spark, tmp_path):
    docs = tmp_path / "docs.jsonl"
    docs.write_text("\n".join(json.dumps(x) for x in ({"content": "a", "metadata": {"file_path": "p"}}, {"content": "", "metadata": {"file_path": "q"}}, {"content": "b", "metadata": {}})))
    assert [tuple(r) for r in io.documents(spark, str(docs)).collect()] == [("a", "p")]
    docs.write_text("{broken")
    with pytest.raises(Exception, match=r"MALFORMED|malformed|FAILFAST"):
        io.documents(spark, str(docs)).collect()
    meta = tmp_path / "meta.jsonl"
    meta.write_text('{"file_path": "p", "year": 1}\n{oops\n{"year": 5}\n{"file_path": "p", "year": 2}\n')
    assert [(r.file_path, r.year) for r in io.metadata(spark, str(meta)).collect()] == [("p", "2")] and io.malformed(spark, str(meta)).count() == 1
    m = tmp_path / "mapping.json"
    m.write_text('{"n": "old1",\n "n": "old2", "k": "old3"}')
    assert sorted(map(tuple, io.mapping(spark, str(m)).collect())) == [("k", "old3"), ("n", "old2")]
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.txt").write_text('"x\\ny"')
    catalog = spark.createDataFrame([("a.txt", 1), ("gone.txt", 2)], "file_path string, n int")
    found, missing = io.catalog_texts(spark, catalog, str(tmp_path / "files"))
    assert [(r.file_path, r.content) for r in found.collect()] == [("a.txt", "x\ny")] and [r.file_path for r in missing.collect()] == ["gone.txt"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("p", 1)], "file_path string, n int")
    at = str(tmp_path / "deep" / "out")
    assert io.save_json(df, at) and not io.save_json(df.limit(0), at) and spark.read.json(at).count() == 1 and io.save_json(df.limit(0), at, overwrite=True)
    assert io.save_chunks(df, at) and not io.save_chunks(df.limit(0), at) and not io.exists(spark, at)
    assert not io.save_skipped(df.limit(0), at) and io.save_skipped(df, at) and spark.read.text(at).first().value == "p"
    io.save_csv(df, at + "csv")
    assert spark.read.option("header", True).csv(at + "csv").first().file_path == "p"
    io.sorted_by_path(df, at + "idx")
    assert spark.read.parquet(at + "idx").count() == 1
    assert tuple(io.run_summary(df, df.limit(0), "o").first()) == ("o", 1, 1, 0)


def test_config(tmp_path, monkeypatch):
    f = tmp_path / "c.yaml"
    monkeypatch.setenv("WHERE", "/x")
    f.write_text("input: ${WHERE}\nk_values: [1, 2]\n")
    c = io.load_config(str(f), ("input",))
    assert c.input == "/x" and c.k_values == (1, 2) and c.seed == 42
    with pytest.raises(ValueError, match="missing"):
        io.load_config(str(f), ("output",))
    f.write_text("wrong: 1\n")
    with pytest.raises(ValueError, match="unknown"):
        io.load_config(str(f))


def test_generation_goes_on_where_it_stopped(spark, tmp_path):
    from corpusloom import cli

    spark.sql("DROP TABLE IF EXISTS resumed")
    lines = [json.dumps({"content": f"Text number {i} is here. More of it.", "metadata": {"file_path": f"p{i}", "header": []}}) for i in range(6)]
    (tmp_path / "chunks.jsonl").write_text("\n".join(lines))
    (tmp_path / "c.yaml").write_text(f"run:\n  input: {tmp_path}/chunks.jsonl\n  output: {tmp_path}/qa\n  collection: resumed\nsampling:\n  sample_documents: 6\n  batches: 2\n  dim: 16\nlog_file: {tmp_path}/run.log\n")
    at = str(tmp_path / "c.yaml")
    assert cli.main(["ingest", "--config", at]) == 0 and spark.table("resumed").count() == 6 and cli.main(["ingest", "--config", at]) == 1
    assert cli.main(["generate", "--config", at]) == 0
    first = sorted(r.file_path for r in spark.read.json(f"{tmp_path}/qa").collect())
    assert first == [f"p{i}" for i in range(6)] and sorted(r.file_path for r in spark.read.json(f"{tmp_path}/qa-asked").collect()) == first
    assert cli.main(["generate", "--config", at]) == 0  # nothing is asked again
    assert sorted(r.file_path for r in spark.read.json(f"{tmp_path}/qa").collect()) == first
    (tmp_path / "e.yaml").write_text(f"input: {tmp_path}/qa\noutput: {tmp_path}/eval\ncollection: resumed\ndim: 16\nk_values: [1, 3]\n")
    assert cli.main(["evaluate", "--config", str(tmp_path / "e.yaml")]) == 0
    row = spark.read.json(f"{tmp_path}/eval/summary").first()
    assert row.num_questions == 6 and row.embedding_time_avg > 0 and row.retrieval_time_avg > 0
    (tmp_path / "i.yaml").write_text(f"input: x\noutput: {tmp_path}/index\ncollection: resumed\n")
    assert cli.main(["index", "--config", str(tmp_path / "i.yaml")]) == 0 and spark.read.parquet(f"{tmp_path}/index").count() == 6
    spark.sql("DROP TABLE resumed")


def test_nested_config_credentials_and_keyed_question_sets(spark, tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("a:\n  input: x\nb:\n  input: y\n")
    with pytest.raises(ValueError, match="given twice"):
        io.load_config(str(tmp_path / "c.yaml"))
    monkeypatch.setenv("SOME_KEY", "k")
    assert io.credential(io.Config(api_key="z")) == "z" and io.credential(io.Config(api_key_env="SOME_KEY")) == "k"
    for bad in (io.Config(), io.Config(api_key="z", api_key_env="SOME_KEY"), io.Config(api_key_env="NO_SUCH_KEY")):
        with pytest.raises(ValueError):
            io.credential(bad)
    rows = [{"question": "q", "file_path": "p"}]
    for name, content in (("array", rows), ("keyed", {"3": rows, "5": rows})):
        (tmp_path / f"{name}.json").write_text(json.dumps(content))
        assert [(r.question, r.file_path) for r in io.qa_dataset(spark, str(tmp_path / f"{name}.json")).collect()] == [("q", "p")]
    with pytest.raises(FileNotFoundError):
        io.qa_dataset(spark, str(tmp_path / "none.json"))


# streaming and the registry ------------------------------------------------------------------------------------


def test_incremental_ingest(spark, tmp_path):
    from corpusloom.streaming import ingest

    src, out, at = (str(tmp_path / x) for x in ("src", "out", "checkpoint"))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "e f")], "doc_id long, text string")
    docs.write.parquet(src)
    ingest.ingest_chunks(spark, src, docs.schema, out, at, size=2)
    assert spark.read.parquet(out).count() == 3
    spark.createDataFrame([(3, "g")], docs.schema).write.mode("append").parquet(src)
    ingest.ingest_chunks(spark, src, docs.schema, out, at, size=2)
    assert sorted(r.content for r in spark.read.parquet(out).collect()) == ["a b", "c d", "e f", "g"]


def test_registry(spark, sf_dir):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "eval_summary_by_k" in queries
    assert entry.entry(spark).count() == 5


def test_some_queries_equal_their_oracle(spark, sf_dir):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("eval_summary_by_k", "fuzzy_reference_match", "word_windows", "payload_merge", "last_user_utterance"):
        got = entry.queries()[name](spark, sf_dir)
        columns = sorted(got.columns)
        plain = lambda x: None if x is None or x != x else round(float(x), 6) if isinstance(x, (int, float)) else x
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
        assert sorted((tuple(map(plain, r)) for r in got.select(columns).collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str), name


def test_signs_of_all_components_count(spark):
    rng = random.Random(4)
    vectors = {i: [rng.choice([-1.0, 0.0, 2.0]) for _ in range(384)] for i in range(12)}
    vectors |= {20: [*vectors[0][:64], *(-x for x in vectors[0][64:])], 21: vectors[1][:100], 22: [], 23: vectors[2][:64], 24: vectors[2][:65], 25: vectors[3][:128]}
    bits = spark.createDataFrame(list(vectors.items()), "vec_id long, v array<double>").select("vec_id", retrieval.sign_bits(F.col("v")).alias("bits"))
    got = {(r.query_id, r.vec_id): r.distance for r in retrieval.hamming_top_k(bits, bits, len(vectors)).collect()}
    signs = lambda v: {i for i, x in enumerate(v) if x > 0}
    assert got == {(a, b): len(signs(v) ^ signs(w)) for a, v in vectors.items() for b, w in vectors.items() if a != b}
    assert spark.createDataFrame([(None,)], "v array<double>").select(retrieval.sign_bits(F.col("v")).alias("b")).first().b is None
