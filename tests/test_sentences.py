"""Sentence boundaries learned from texts, and kept by the splitters."""

import math
import random
from collections import Counter

import pytest

from corpusloom.operators import chunking, sentences


@pytest.fixture(scope="module")
def corpus(spark):
    """Sentences of common words, with abbreviations of several kinds at places where none ends."""
    rnd = random.Random(4)
    words = "river house garden stone window paper mountain letter summer winter morning evening kitchen harbour bridge market village forest meadow copper".split()
    some = lambda n: " ".join(rnd.choice(words) for _ in range(n))

    def sentence():
        middle = rnd.choice([lambda: f"met Dr. {rnd.choice(['Smith', 'Bell', 'Moss'])} there", lambda: f"by e.g. {some(2)}", lambda: f"as {rnd.choice('JKLM')}. Doe et al. {rnd.randint(1990, 2024)} showed", lambda: f"in Fig. {rnd.randint(1, 9)} above", lambda: f"cost approx. {rnd.randint(2, 90)} coins", lambda: some(4)])()
        return f"{rnd.choice(['The', 'However', 'It', 'We'])} {some(rnd.randint(2, 6))} {middle} {some(rnd.randint(1, 4))}{rnd.choice('....!?')}"

    texts = [[sentence() for _ in range(rnd.randint(3, 12))] for _ in range(400)]
    return texts, spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def learned(corpus):
    return sentences.learn(corpus[1])


def test_what_is_learned(learned):
    assert {"dr", "e.g", "fig", "approx", "al"} <= learned.abbreviations
    assert not {"river", "house", "village", "meadow"} & learned.abbreviations
    assert {"the", "however"} <= learned.starters and "smith" not in learned.starters
    assert ("dr", "smith") in learned.collocations


def test_abbreviations_end_no_sentence(learned):
    for text, want in (
        ("We met Dr. Smith there. It rained.", ["We met Dr. Smith there.", "It rained."]),
        ("Use tools, e.g. this one. The end.", ["Use tools, e.g. this one.", "The end."]),
        ("As J. Doe et al. 2020 showed, it holds. We agree!", ["As J. Doe et al. 2020 showed, it holds.", "We agree!"]),
        ("It cost approx. 5 coins. However, he paid.", ["It cost approx. 5 coins.", "However, he paid."]),
        ("They cite Doe et al. However, nobody reads it.", ["They cite Doe et al.", "However, nobody reads it."]),
        ("There were 12. The rest left. It is no. 3. of many.", ["There were 12.", "The rest left.", "It is no.", "3. of many."]),
        ("", []), ("no stop at all", ["no stop at all"]),
    ):
        assert chunking.protected_sentences(text, learned) == want, text
    assert chunking.protected_sentences("We met Dr. Smith there.") == ["We met Dr.", "Smith there."]  # nothing learned


def test_boundaries_of_the_corpus(corpus, learned):
    """Of all the corpus's own boundaries nearly all are found, and few others."""
    right = wrong = missed = 0
    for parts in corpus[0]:
        got, want = chunking.protected_sentences(" ".join(parts), learned), parts
        ends = lambda x: {sum(len(s) + 1 for s in x[: i + 1]) for i in range(len(x))}
        a, b = ends(got), ends(want)
        right, wrong, missed = right + len(a & b), wrong + len(a - b), missed + len(b - a)
    assert wrong / (right + wrong) < 0.01 and missed / (right + missed) < 0.01


def test_masks_and_spans_stay(learned):
    text = "See $a. B$ by Dr. Bell. The rest.\n\\begin{x}a. B\\end{x} It ends."
    assert chunking.structured_chunks(text, learned) == ["See $a. B$ by Dr. Bell.", "The rest.", "\\begin{x}a. B\\end{x}", "It ends."]


def test_counts_and_scores_by_hand(spark):
    texts = ["Dr. Bell, (e.g.) 3.5 x!", "bell. Bell DR. 12. ...", "", None, "— !"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = Counter({(r.kind, r.stopped, r.following): r.n for r in sentences.counted(df).collect()})
    assert got == Counter({("dr", True, "bell"): 1, ("bell", False, "e.g"): 1, ("e.g", True, "#"): 1, ("#", False, "x"): 1, ("x", False, ""): 1, ("bell", True, "bell"): 1, ("bell", False, "dr"): 1, ("dr", True, "#"): 1, ("#", True, ""): 1})
    scores = {r.kind: r for r in sentences.abbreviation_scores(sentences.counted(df)).collect()}
    p = 5 / 9
    for kind, with_stop, without, letters, stops in (("dr", 2, 0, 2, 1), ("bell", 1, 2, 4, 1), ("e.g", 1, 0, 2, 2)):
        want = 2 * (with_stop * math.log(0.99 / p) + without * math.log(0.01 / (1 - p))) * math.exp(-letters) * stops * letters**-without
        assert (scores[kind].with_stop, scores[kind].without_stop) == (with_stop, without) and abs(scores[kind].score - want) < 1e-9
    assert set(scores) == {"dr", "bell", "e.g"}
    for none in (df.limit(0), df.where("text = ''"), spark.createDataFrame([("all. stop.",)], "text string")):
        assert sentences.learn(none) == sentences.Boundaries()


def test_a_table_is_split_by_what_it_taught(corpus, learned):
    docs = corpus[1].where("doc_id < 5")
    got = chunking.chunk_rows(docs, lambda t: chunking.structured_chunks(t, learned)).orderBy("doc_id", "chunk_no").collect()
    want = [(i, n, s) for i, parts in enumerate(corpus[0][:5]) for n, s in enumerate(chunking.protected_sentences(" ".join(parts), learned))]
    assert [tuple(r)[:3] for r in got] == want
