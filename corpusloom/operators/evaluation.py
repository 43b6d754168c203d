"""Fuzzy reference matching and retrieval metrics at many cut-offs, as joins and aggregations.

Shapes: references (question_id, reference_id, text); hits (question_id, rank from 1, chunk_id, path, content, score);
questions (question_id, gold_path). All metrics are 0, never null, where there is nothing to divide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import staged

METRICS = (
    "num_references", "num_retrieved", "avg_score", "token_iou", "token_precision", "token_recall", "token_f1", "passage_coverage", "passage_accuracy",
    "passage_precision", "passage_recall", "passage_f1", "doc_coverage", "doc_accuracy", "doc_precision", "doc_recall", "doc_chunks_retrieved",
    "embedding_time", "retrieval_time",
)
#: From this threshold on fuzzy pairs are looked for by the rare tokens of a reference.
PREFIX_FROM = 0.5
#: A unit of work on pairs of texts: documents, references, and tokens of either; documents and common tokens met at a time. Overlaps, of which every one is a row, take fewer references.
DOCUMENTS_PER_BLOCK, TOKENS_PER_BLOCK, REFERENCES_PER_BLOCK, OVERLAPS_PER_BLOCK, DOCUMENTS_AT_A_TIME, COMMON_AT_A_TIME = 2048, 500_000, 2048, 512, 256, 500_000
#: Seconds that a question may carry.
LATENCIES = ("embedding_time", "retrieval_time")


def fuzzy_pairs(references: DataFrame, documents: DataFrame, threshold: float, on: list[str] | None = None) -> DataFrame:
    """(reference_id, *on, chunk_id, share) of pairs in which at least `threshold` of the reference's tokens, repeated ones
    counted, occur in the document; the columns `on` must agree besides.

    references: (reference_id, text, *on); documents: (chunk_id, content, *on). A pair without a common token is never formed, which asks for a
    threshold above 0. A reference without tokens matches nothing. From PREFIX_FROM on only few of the pairs with a common token can match: a
    reference's tokens are ordered by how many documents hold them; the most frequent ones that together fall short of the threshold
    make no match alone, so that a document is a candidate only if it holds one of the others, and candidates are counted by
    themselves. Below it nearly all such pairs are candidates, and their common tokens are counted by the join itself.
    """
    if threshold <= 0:
        raise ValueError("a threshold above 0 is asked for: pairs without a common token aren't formed")
    on = on or []
    asked = references.select("reference_id", *on, T.tokens("text").alias("t")).where(F.size("t") > 0)
    counted = asked.select("reference_id", *on, F.size("t").alias("n"), F.explode("t").alias("token")).groupBy("reference_id", *on, "n", "token").agg(F.count(F.lit(1)).alias("tf"))
    docs = documents.select("chunk_id", *on, F.array_distinct(T.tokens("content")).alias("held"))
    if threshold < PREFIX_FROM:
        common = counted.join(docs.select("chunk_id", *on, F.explode("held").alias("token")), [*on, "token"]).groupBy("reference_id", *on, "chunk_id", "n").agg(F.sum("tf").alias("m"))
    else:
        docs = staged(docs, "held")  # divided into tokens once
        held = docs.select("chunk_id", *on, F.explode("held").alias("token"))
        frequency = held.join(counted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        up_to = Window.partitionBy("reference_id", *on).orderBy(F.desc("df"), "token")  # from the most frequent on; a reference is one text
        ranked = counted.join(frequency, "token", "left").fillna(0, ["df"]).withColumn("m", F.sum("tf").over(up_to))
        rare = ranked.where(F.col("m").cast("double") / F.col("n").cast("double") >= threshold)
        pairs = rare.select("reference_id", *on, "token").join(held, [*on, "token"]).select("reference_id", *on, "chunk_id").distinct()
        weights = counted.groupBy("reference_id", *on, "n").agg(F.map_from_entries(F.collect_list(F.struct("token", "tf"))).alias("tf"))
        m = F.aggregate(F.array_intersect(F.map_keys("tf"), "held"), F.lit(0).cast("long"), lambda s, t: s + F.col("tf")[t])
        common = pairs.join(weights, ["reference_id", *on]).join(docs, ["chunk_id", *on]).withColumn("m", m)
    shares = common.withColumn("share", F.col("m").cast("double") / F.col("n").cast("double"))
    return shares.where(F.col("share") >= threshold).select("reference_id", *on, "chunk_id", "share")


def block_pairs(references: DataFrame, documents: DataFrame, per_block: int, by: list[str]) -> DataFrame:
    """Both (id, n, words: n tokens between spaces), dealt by the columns `by` into blocks db and rb, with a row for each block of the other side."""
    sizes = [df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first() for df in (references, documents)]
    asked_blocks, blocks = (max(1, -(-size.rows // most), -(-size.tokens // TOKENS_PER_BLOCK)) for size, most in zip(sizes, (per_block, DOCUMENTS_PER_BLOCK), strict=True))
    dealt = lambda n: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = documents.withColumn("db", dealt(blocks)).withColumn("rb", every(asked_blocks)).withColumn("asked", F.lit(False))
    right = references.withColumn("rb", dealt(asked_blocks)).withColumn("db", every(blocks)).withColumn("asked", F.lit(True))
    return left.unionByName(right).withColumn("id", F.col("id").cast("long"))


def block_product(table, by_id: bool, least: bool) -> tuple:
    """(ids of references, their sizes, ids of documents, slices) of a pair of blocks: a slice has its first document's place and a matrix, documents by references.

    Its cells sum over the common tokens the reference's counts, or the lesser of both counts. With by_id rows of one id, null included, are one text. A slice ends
    after DOCUMENTS_AT_A_TIME, or where COMMON_AT_A_TIME pairs of a document's and a reference's token are met, so that what is held doesn't depend on how frequent tokens are.
    """
    import numpy as np
    import pyarrow.compute as pc

    sides = []
    for rows in (table.filter(table["asked"]), table.filter(pc.invert(table["asked"]))):
        ids, lists = rows["id"].combine_chunks(), pc.split_pattern(rows["words"].combine_chunks(), " ")
        text = np.arange(len(ids))
        if by_id:
            coded = ids.dictionary_encode("encode")
            ids, text = coded.dictionary, np.asarray(coded.indices, np.int64)
        sides.append((ids, np.repeat(text, np.asarray(pc.list_value_length(lists), np.int64)), lists.flatten()))
    (refs, ref_of, words), (docs, doc_of, tokens) = sides
    if not len(refs) or not len(docs):
        return refs, np.zeros(0, np.int64), docs, iter(())
    # the references' counts by token: their places from begin to end
    known = pc.unique(words)
    key, n = np.unique(np.asarray(pc.index_in(words, known), np.int64) * len(refs) + ref_of, return_counts=True)
    word, ref = np.divmod(key, len(refs))
    count = np.bincount(word, minlength=len(known))
    begin = np.cumsum(count) - count
    found = pc.index_in(tokens, known)
    there = np.asarray(found.is_valid())
    key, held = np.unique(doc_of[there] * len(known) + np.asarray(found.fill_null(0), np.int64)[there], return_counts=True)
    doc, word = np.divmod(key, len(known))
    met = np.concatenate([[0], np.cumsum(np.bincount(doc, count[word], len(docs)))])

    def slices():
        start = 0
        while start < len(docs):
            end = min(start + DOCUMENTS_AT_A_TIME, max(start + 1, int(np.searchsorted(met, met[start] + COMMON_AT_A_TIME, "right")) - 1), len(docs))
            a, b = np.searchsorted(doc, [start, end])
            times = count[word[a:b]]
            at = np.repeat(begin[word[a:b]] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
            common = np.minimum(n[at], np.repeat(held[a:b], times)) if least else n[at]
            m = np.bincount(np.repeat((doc[a:b] - start) * len(refs), times) + ref[at], common, (end - start) * len(refs))
            yield start, m.astype(np.int64).reshape(end - start, len(refs))
            start = end

    return refs, np.bincount(ref_of, minlength=len(refs)), docs, slices()


def lexical_top_k(references: DataFrame, documents: DataFrame, k: int, floor: float) -> DataFrame:
    """(reference_id, chunk_id, share, rank): each reference's k documents of the greatest share at or above the floor, ties by chunk_id. Exact.

    references: (reference_id, text); documents: (chunk_id, content); the share is that of fuzzy_pairs. Both are dealt into blocks; a pair of blocks is one unit of
    work, in which a sparse product of the documents' tokens and the references' weights is cut to the k best, slice by slice. So no pair becomes a row, no token, however
    frequent, is a key of a shuffle, and neither side is broadcast or gathered. Rows without an id, and texts without tokens, take no part.
    """
    joined = lambda df, t: df.select("id", F.size(t).alias("n"), F.array_join(t, " ").alias("words")).where(F.col("id").isNotNull() & (F.col("n") > 0))
    asked = joined(references.select(F.col("reference_id").alias("id"), T.tokens("text").alias("t")), F.col("t"))
    held = staged(joined(documents.select(F.col("chunk_id").alias("id"), F.array_distinct(T.tokens("content")).alias("t")), F.col("t")), "held")

    def best(table):
        import numpy as np
        import pyarrow as pa

        refs, n, docs, slices = block_product(table, by_id=False, least=False)
        refs, docs = np.asarray(refs, np.int64), np.asarray(docs, np.int64)
        ref = doc = m = np.zeros(0, np.int64)
        for start, some in slices:
            fit = some.astype(float) / n >= floor
            some = np.where(fit, some, 0)
            if len(some) > k:  # all that tie with the k-th stay, and are ranked with those of the slices before
                fit &= some >= np.partition(some, len(some) - k, 0)[len(some) - k]
            at, to = np.nonzero(fit)
            ref, doc, m = np.concatenate([ref, to]), np.concatenate([doc, docs[start + at]]), np.concatenate([m, some[at, to]])
            order = np.lexsort((doc, -m, ref))
            ref, doc, m = ref[order], doc[order], m[order]
            first = np.arange(len(ref)) - np.searchsorted(ref, ref) < k
            ref, doc, m = ref[first], doc[first], m[first]
        return pa.table({"reference_id": pa.array(refs[ref], pa.int64()), "chunk_id": pa.array(doc, pa.int64()), "share": pa.array(m.astype(float) / n[ref], pa.float64())})

    hits = block_pairs(asked, held, REFERENCES_PER_BLOCK, ["id", "n"]).groupBy("db", "rb").applyInArrow(best, "reference_id long, chunk_id long, share double")
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("reference_id").orderBy(F.desc("share"), F.asc("chunk_id"))).cast("long"))
    return ranked.where(F.col("rank") <= k)


def hit_tokens(hits: DataFrame) -> DataFrame:
    """hits with `tokens`, those of their texts, unless they have them."""
    return hits if "tokens" in hits.columns else hits.withColumn("tokens", T.tokens("content"))


def matches(references: DataFrame, hits: DataFrame, threshold: float) -> DataFrame:
    """(question_id, reference_id, chunk_id, rank) of hits that hold a reference of their question.

    A question meets its own hits only: as many pairs as its references times its hits. A hit's text is divided once, and a reference's
    distinct tokens are looked up in it by their hashes.
    """
    tokens = references.select("question_id", "reference_id", T.tokens("text").alias("t")).where(F.size("t") > 0)
    often = F.transform(F.array_distinct("t"), lambda x: F.struct(x, F.size(F.filter("t", lambda y: y == x)).alias("n")))
    asked = tokens.select("question_id", "reference_id", F.size("t").alias("size"), F.map_from_entries(often).alias("tf"))
    held = hit_tokens(hits).select("question_id", "chunk_id", "rank", F.array_distinct("tokens").alias("held"))
    m = F.aggregate(F.array_intersect(F.map_keys("tf"), "held"), F.lit(0), lambda s, t: s + F.col("tf")[t])
    return asked.join(held, "question_id").where(m.cast("double") / F.col("size").cast("double") >= threshold).select("question_id", "reference_id", "chunk_id", "rank").distinct()


def at_each_k(ranked: DataFrame, ks: list[int]) -> DataFrame:
    """Rows of rank <= k for every k, with column k: retrieval is ranked once and cut at each k."""
    return ranked.withColumn("k", F.explode(F.array(*(F.lit(int(k)) for k in ks)))).where("rank <= k")


def grid(questions: DataFrame, ks: list[int]) -> DataFrame:
    """Every question at every k, so that questions without hits keep their rows."""
    return questions.withColumn("k", F.explode(F.array(*(F.lit(int(k)) for k in ks))))


def multiset_overlap(references: DataFrame, documents: DataFrame) -> DataFrame:
    """(reference_id, chunk_id, overlap) of all pairs with a common token: size of the intersection of their multisets of tokens. Exact.

    references: (reference_id, text); documents: (chunk_id, content). Rows of one id, also those without, are one multiset and go to one block. As in lexical_top_k a pair
    of blocks is one unit of work: a document's tokens are shuffled as one text, once for each block of references, and no common token becomes a row.
    """
    joined = lambda df, key, text: df.select(F.col(key).alias("id"), T.tokens(text).alias("t")).select("id", F.size("t").alias("n"), F.array_join("t", " ").alias("words")).where("n > 0")

    def overlaps(table):
        import numpy as np
        import pyarrow as pa

        refs, _, docs, slices = block_product(table, by_id=True, least=True)
        kinds = pa.schema([("reference_id", pa.int64()), ("chunk_id", pa.int64()), ("overlap", pa.int64())])
        found = []
        for start, some in slices:
            doc, ref = np.nonzero(some)
            found.append(pa.record_batch([refs.take(pa.array(ref)), docs.take(pa.array(start + doc)), pa.array(some[doc, ref])], schema=kinds))
        return pa.Table.from_batches(found, kinds)

    held = staged(joined(documents, "chunk_id", "content"), "held")
    pairs = block_pairs(joined(references, "reference_id", "text"), held, OVERLAPS_PER_BLOCK, ["id"])
    return pairs.groupBy("db", "rb").applyInArrow(overlaps, "reference_id long, chunk_id long, overlap long")


def token_metrics(questions: DataFrame, references: DataFrame, hits: DataFrame, found: DataFrame, ks: list[int]) -> DataFrame:
    """(question_id, k) and iou, precision, recall, f1 of tokens as multisets.

    With f references found among the first k hits, the retrieved multiset is f times all tokens of these hits, and the
    reference multiset all tokens of all references; without any found, all four are 0.
    """
    f = at_each_k(found, ks).groupBy("question_id", "k").agg(F.count_distinct("reference_id").alias("f"))
    asked = references.select("question_id", F.explode(T.tokens("text")).alias("token")).groupBy("question_id", "token").agg(F.count(F.lit(1)).alias("n"))
    asked_size = asked.groupBy("question_id").agg(F.sum("n").alias("asked"))
    hits = hit_tokens(hits)
    per_hit = hits.select("question_id", "rank", F.explode("tokens").alias("token")).groupBy("question_id", "rank", "token").agg(F.count(F.lit(1)).alias("n"))
    size = at_each_k(hits.select("question_id", "rank", F.size("tokens").alias("n")), ks).groupBy("question_id", "k").agg(F.sum("n").alias("held"))
    wanted = per_hit.join(asked.select("question_id", "token", F.col("n").alias("asked_n")), ["question_id", "token"])
    common = at_each_k(wanted, ks).groupBy("question_id", "k", "token", "asked_n").agg(F.sum("n").alias("n"))
    overlap = common.join(f, ["question_id", "k"]).groupBy("question_id", "k").agg(F.sum(F.least(F.col("asked_n"), F.col("f") * F.col("n"))).alias("both"))
    rows = grid(questions.select("question_id"), ks).join(f, ["question_id", "k"], "left").join(size, ["question_id", "k"], "left").join(overlap, ["question_id", "k"], "left").join(asked_size, "question_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = rows.select("question_id", "k", zero("f").alias("f"), zero("both").alias("both"), zero("asked").alias("asked"), (zero("f") * zero("held")).alias("held"))
    counted = lambda part, whole: F.when(F.col("f") > 0, T.share(part, whole)).otherwise(F.lit(0.0))
    both, asked_n, held = F.col("both"), F.col("asked"), F.col("held")
    rows = rows.select("question_id", "k", counted(both, asked_n + held - both).alias("token_iou"), counted(both, held).alias("token_precision"), counted(both, asked_n).alias("token_recall"))
    return rows.withColumn("token_f1", T.harmonic_mean(F.col("token_precision"), F.col("token_recall")))


def passage_metrics(questions: DataFrame, references: DataFrame, hits: DataFrame, found: DataFrame, ks: list[int]) -> DataFrame:
    """(question_id, k) and coverage (= recall), accuracy, precision, f1 of references; all 0 without references or hits."""
    asked = references.groupBy("question_id").agg(F.count_distinct("reference_id").alias("asked"))
    got = at_each_k(hits.select("question_id", "rank"), ks).groupBy("question_id", "k").agg(F.count(F.lit(1)).alias("got"))
    hit = at_each_k(found, ks).groupBy("question_id", "k").agg(F.count_distinct("reference_id").alias("found"), F.count_distinct("rank").alias("useful"))
    rows = grid(questions.select("question_id"), ks).join(asked, "question_id", "left").join(got, ["question_id", "k"], "left").join(hit, ["question_id", "k"], "left").fillna(0, ["asked", "got", "found", "useful"])
    coverage = F.when(F.col("got") > 0, T.share(F.col("found"), F.col("asked"))).otherwise(F.lit(0.0))
    rows = rows.withColumn("passage_coverage", coverage).withColumn("passage_accuracy", F.when((F.col("asked") > 0) & (F.col("got") > 0) & (F.col("found") == F.col("asked")), 1.0).otherwise(0.0))
    rows = rows.withColumn("passage_precision", F.when(F.col("asked") > 0, T.share(F.col("useful"), F.col("got"))).otherwise(F.lit(0.0))).withColumn("passage_recall", F.col("passage_coverage"))
    return rows.withColumn("passage_f1", T.harmonic_mean(F.col("passage_precision"), F.col("passage_recall"))).select("question_id", "k", "passage_coverage", "passage_accuracy", "passage_precision", "passage_recall", "passage_f1")


def document_metrics(questions: DataFrame, hits: DataFrame, ks: list[int]) -> DataFrame:
    """(question_id, k) and coverage (= accuracy = recall), precision and number of hits from the gold document, and avg_score and num_retrieved."""
    cut = at_each_k(hits.select("question_id", "rank", "path", "score"), ks)
    got = cut.join(questions.select("question_id", "gold_path"), "question_id").groupBy("question_id", "k").agg(F.count(F.lit(1)).alias("num_retrieved"), F.count_if(F.col("path") == F.col("gold_path")).alias("doc_chunks_retrieved"), F.avg("score").alias("avg_score"))
    rows = grid(questions.select("question_id"), ks).join(got, ["question_id", "k"], "left").fillna(0, ["num_retrieved", "doc_chunks_retrieved"]).fillna(0.0, ["avg_score"])
    any_hit = F.when(F.col("doc_chunks_retrieved") > 0, 1.0).otherwise(0.0)
    return rows.select("question_id", "k", "num_retrieved", "avg_score", any_hit.alias("doc_coverage"), any_hit.alias("doc_accuracy"), T.share(F.col("doc_chunks_retrieved"), F.col("num_retrieved")).alias("doc_precision"), any_hit.alias("doc_recall"), "doc_chunks_retrieved")


def evaluate(questions: DataFrame, references: DataFrame, hits: DataFrame, ks: list[int], threshold: float) -> DataFrame:
    """One row per question and k with all metrics, and the latencies that questions carry; questions with a non-null `error` column are
    left out of every k (`failed` lists them). Hits, their texts divided into tokens, and matches are written once, since every metric reads them."""
    if "error" in questions.columns:
        questions = questions.where("error is null").drop("error")
    hits = staged(hit_tokens(hits.where(F.col("rank") <= max(ks))).drop("content"), "hits")
    found = staged(matches(references, hits, threshold), "found")
    asked = grid(questions.select("question_id"), ks).join(references.groupBy("question_id").agg(F.count_distinct("reference_id").alias("num_references")), "question_id", "left").fillna(0, ["num_references"])
    parts = [asked, document_metrics(questions, hits, ks), token_metrics(questions, references, hits, found, ks), passage_metrics(questions, references, hits, found, ks)]
    if times := [c for c in LATENCIES if c in questions.columns]:
        parts.append(grid(questions.select("question_id", *times), ks))
    return reduce(lambda a, b: a.join(b, ["question_id", "k"]), parts)


def failed(questions: DataFrame) -> DataFrame:
    """(question_id, error) of the questions that the metrics leave out."""
    return questions.where("error is not null").select("question_id", "error")


def compare_retrieval(original: DataFrame, rewritten: DataFrame, by: str = "question_id") -> DataFrame:
    """What a rewritten query retrieves against the original: per question the hits of each, those of both, and the best scores (0 without hits)."""
    a, b = (h.select(by, "chunk_id", F.col("score").alias(f"{name}_score")) for h, name in ((original, "original"), (rewritten, "rewritten")))
    both = a.join(b, [by, "chunk_id"], "full").groupBy(by).agg(
        F.count("original_score").alias("n_original"), F.count("rewritten_score").alias("n_rewritten"), F.count_if(F.col("original_score").isNotNull() & F.col("rewritten_score").isNotNull()).alias("n_common"),
        F.coalesce(F.max("original_score"), F.lit(0.0)).alias("best_original"), F.coalesce(F.max("rewritten_score"), F.lit(0.0)).alias("best_rewritten"),
    )
    return both.withColumn("best_gain", F.col("best_rewritten") - F.col("best_original"))


def summary(results: DataFrame, ks: list[int], metrics: list[str] | None = None) -> DataFrame:
    """Per k the number of questions and the plain mean of each metric; a k without questions keeps a row of 0 questions."""
    metrics = metrics or [m for m in METRICS if m in results.columns]
    every = results.sparkSession.createDataFrame([(int(k),) for k in ks], "k int")
    means = results.groupBy("k").agg(F.count(F.lit(1)).alias("num_questions"), *(F.avg(m).alias(f"{m}_avg") for m in metrics))
    return every.join(F.broadcast(means), "k", "left").fillna(0, ["num_questions"])  # a row per k on either side


def reciprocal_rank(questions: DataFrame, found: DataFrame) -> DataFrame:
    """question_id, first_rank (null if no hit holds a reference) and reciprocal_rank (then 0)."""
    first = found.groupBy("question_id").agg(F.min("rank").cast("long").alias("first_rank"))
    return questions.select("question_id").join(first, "question_id", "left").withColumn("reciprocal_rank", F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0)))


def mean_reciprocal_rank(ranks: DataFrame) -> DataFrame:
    """One row: mrr over all questions, those without a rank as 0."""
    return ranks.agg(F.coalesce(F.avg("reciprocal_rank"), F.lit(0.0)).alias("mrr"), F.count(F.lit(1)).alias("num_questions"))


def rank_distribution(ranks: DataFrame) -> DataFrame:
    """first_rank (null: none found), questions and their percentage of all, by rank ascending, null last."""
    total = ranks.agg(F.count(F.lit(1)).alias("total"))
    by = ranks.groupBy("first_rank").agg(F.count(F.lit(1)).alias("n_questions"))
    return by.crossJoin(F.broadcast(total)).select("first_rank", "n_questions", (F.lit(100.0) * F.col("n_questions") / F.col("total")).alias("percent")).orderBy(F.asc_nulls_last("first_rank"))  # total: one row


def unpivot(summaries: DataFrame, keys: list[str], metrics: list[str], value: str) -> DataFrame:
    """(keys, metric, value) rows of a wide table."""
    return summaries.unpivot(keys, metrics, "metric", value)


def improvement(baseline: DataFrame, changed: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, baseline, changed, delta, points): delta is changed - baseline, points 100 times that."""
    a, b = unpivot(baseline, keys, metrics, "baseline"), unpivot(changed, keys, metrics, "changed")
    delta: Column = F.col("changed") - F.col("baseline")
    return a.join(b, [*keys, "metric"]).withColumn("delta", delta).withColumn("points", F.lit(100.0) * delta)
