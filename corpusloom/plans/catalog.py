"""The engine's queries over the parquet tables, each beside its oracle SQL.

Tables stand in as follows: `embeddings` for points (label: document), `benchmark` for questions and references (the two items of
2n and 2n + 1 are the references of both), `documents` for chunks (source: path), `conversations`, `labels` for metadata.
Queries run over whole tables; vector queries are all ids divisible by 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import models
from ..functions import text as T
from ..functions.structured import structured
from ..operators import chunking, dataset, evaluation, numbering, retrieval, sentences
from ..session import staged, table
from ..sources import io

KS, LEXICAL_KS, FLOOR, THRESHOLD = [3, 5, 10, 15, 20], [3, 5, 10], 0.3, 0.8
QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) + F.lit(0.0) for c in columns})


# SQL building blocks -------------------------------------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_WS = _WS.replace("[", "[^", 1)
_PUNCT = T.PUNCTUATION.replace("'", "''")


def _norm(c: str) -> str:
    return f"trim(regexp_replace(translate(lower({c}), '{_PUNCT}', ''), '{_WS}+', ' ', 'g'))"


def _tok(c: str) -> str:
    return f"list_filter(string_split({_norm(c)}, ' '), lambda x: x <> '')"


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{_WS}+'), lambda x: x <> '')"


def _div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"


def _f1(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


_COSINE = """
pair AS (SELECT a.vec_id AS query_id, a.label AS gold, b.vec_id, b.label,
  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) + 0.0 AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)"""
_HIT = f"""{_COSINE}, hit AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair WHERE score >= {FLOOR})"""
_DOC_BY_K = f"""WITH {_HIT}, g AS (SELECT q.vec_id AS question_id, k FROM embeddings q, (SELECT unnest({KS}) AS k) WHERE q.vec_id % 100 = 0),
m AS (SELECT query_id AS question_id, g.k, count(*) AS num_retrieved, count(*) FILTER (WHERE label = gold) AS chunks, avg(score) AS avg_score
  FROM hit JOIN g ON hit.query_id = g.question_id AND hit.rank <= g.k GROUP BY 1, 2),
d AS (SELECT question_id, k, coalesce(num_retrieved, 0) AS num_retrieved, round(coalesce(avg_score, 0.0), 6) + 0.0 AS avg_score,
  CASE WHEN coalesce(chunks, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS doc_coverage,
  round({_div("coalesce(chunks, 0)", "coalesce(num_retrieved, 0)")}, 6) + 0.0 AS doc_precision, coalesce(chunks, 0) AS doc_chunks_retrieved
  FROM g LEFT JOIN m USING (question_id, k))"""
_SHARES = f"""
ref AS (SELECT item_id, unnest({_tok("text")}) AS tok FROM benchmark),
refn AS (SELECT item_id, count(*) AS n FROM ref GROUP BY 1),
reftf AS (SELECT item_id, tok, count(*) AS tf FROM ref GROUP BY 1, 2),
doctok AS (SELECT doc_id, tok, count(*) AS tf FROM (SELECT doc_id, unnest({_tok("text")}) AS tok FROM documents) GROUP BY 1, 2),
shares AS (SELECT item_id, doc_id, CAST(sum(reftf.tf) AS DOUBLE) / CAST(max(n) AS DOUBLE) AS share
  FROM reftf JOIN doctok USING (tok) JOIN refn USING (item_id) GROUP BY 1, 2)"""
_LEXICAL = f"""{_SHARES},
hits AS (SELECT * FROM (SELECT item_id AS question_id, doc_id AS chunk_id, d.source AS path, round(share, 6) + 0.0 AS score,
  row_number() OVER (PARTITION BY item_id ORDER BY round(share, 6) DESC, doc_id) AS rank
  FROM shares JOIN documents d USING (doc_id) WHERE round(share, 6) >= {FLOOR}) WHERE rank <= {max(LEXICAL_KS)}),
refs AS (SELECT a.item_id AS question_id, b.item_id AS reference_id FROM benchmark a JOIN benchmark b ON a.item_id // 2 = b.item_id // 2),
found AS (SELECT h.question_id, r.reference_id, h.chunk_id, h.rank FROM hits h JOIN refs r USING (question_id)
  JOIN shares s ON s.item_id = r.reference_id AND s.doc_id = h.chunk_id WHERE s.share >= {THRESHOLD}),
ks AS (SELECT unnest({LEXICAL_KS}) AS k),
g AS (SELECT item_id AS question_id, k FROM benchmark, ks),
nref AS (SELECT question_id, count(DISTINCT reference_id) AS asked FROM refs GROUP BY 1)"""
_TOKEN_METRICS = f"""
fk AS (SELECT question_id, k, count(DISTINCT reference_id) AS f FROM found, ks WHERE rank <= k GROUP BY 1, 2),
askedtok AS (SELECT question_id, tok, sum(tf) AS n FROM refs JOIN reftf ON item_id = reference_id GROUP BY 1, 2),
asked AS (SELECT question_id, sum(n) AS asked FROM askedtok GROUP BY 1),
heldtok AS (SELECT question_id, k, tok, sum(tf) AS n FROM hits, ks, doctok WHERE doc_id = chunk_id AND rank <= k GROUP BY 1, 2, 3),
held AS (SELECT question_id, k, sum(n) AS held FROM heldtok GROUP BY 1, 2),
common AS (SELECT question_id, k, sum(least(a.n, f * h.n)) AS shared FROM heldtok h JOIN askedtok a USING (question_id, tok) JOIN fk USING (question_id, k) GROUP BY 1, 2),
tn AS (SELECT question_id, k, coalesce(f, 0) AS f, coalesce(shared, 0) AS shared, coalesce(asked, 0) AS asked, coalesce(f, 0) * coalesce(held, 0) AS held
  FROM g LEFT JOIN fk USING (question_id, k) LEFT JOIN held USING (question_id, k) LEFT JOIN common USING (question_id, k) LEFT JOIN asked USING (question_id)),
tm0 AS (SELECT question_id, k, CASE WHEN f > 0 THEN {_div("shared", "asked + held - shared")} ELSE 0.0 END AS iou,
  CASE WHEN f > 0 THEN {_div("shared", "held")} ELSE 0.0 END AS p, CASE WHEN f > 0 THEN {_div("shared", "asked")} ELSE 0.0 END AS r FROM tn),
tm AS (SELECT question_id, k, iou AS token_iou, p AS token_precision, r AS token_recall, {_f1("p", "r")} AS token_f1 FROM tm0)"""
_PASSAGE_METRICS = f"""
got AS (SELECT question_id, k, count(*) AS got FROM hits, ks WHERE rank <= k GROUP BY 1, 2),
pf AS (SELECT question_id, k, count(DISTINCT reference_id) AS found, count(DISTINCT rank) AS useful FROM found, ks WHERE rank <= k GROUP BY 1, 2),
pn AS (SELECT question_id, k, coalesce(asked, 0) AS asked, coalesce(got, 0) AS got, coalesce(found, 0) AS found, coalesce(useful, 0) AS useful
  FROM g LEFT JOIN nref USING (question_id) LEFT JOIN got USING (question_id, k) LEFT JOIN pf USING (question_id, k)),
pm0 AS (SELECT question_id, k, CASE WHEN got > 0 THEN {_div("found", "asked")} ELSE 0.0 END AS c,
  CASE WHEN asked > 0 AND got > 0 AND found = asked THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS a, {_div("useful", "got")} AS p FROM pn),
pm AS (SELECT question_id, k, c AS passage_coverage, a AS passage_accuracy, p AS passage_precision, c AS passage_recall, {_f1("p", "c")} AS passage_f1 FROM pm0)"""
_RANKS = """ranks AS (SELECT item_id AS question_id, first_rank, coalesce(1.0 / first_rank, 0.0)::DOUBLE AS reciprocal_rank
  FROM benchmark LEFT JOIN (SELECT question_id, min(rank) AS first_rank FROM found GROUP BY 1) f ON f.question_id = item_id)"""
_RERANKED = f"""
dset AS (SELECT doc_id, list(tok) AS ts FROM doctok GROUP BY 1), rset AS (SELECT item_id, list(tok) AS ts FROM reftf GROUP BY 1),
rr0 AS (SELECT h.*, CAST(len(list_intersect(r.ts, d.ts)) AS DOUBLE) / CAST(len(list_distinct(list_concat(r.ts, d.ts))) AS DOUBLE) AS s
  FROM hits h JOIN rset r ON r.item_id = question_id JOIN dset d ON d.doc_id = chunk_id),
rr AS (SELECT *, round(s, 6) + 0.0 AS rerank_score, row_number() OVER (PARTITION BY question_id ORDER BY round(s, 6) DESC, rank) AS new_rank FROM rr0)"""


def _r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


# vectors -------------------------------------------------------------------------------------------------------


def _vector_queries(v: DataFrame) -> DataFrame:
    return v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def _top(spark: SparkSession, sf_dir: str, k: int, floor: float | None) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return retrieval.cosine_top_k(v, _vector_queries(v), k, floor)


@query(f"WITH {_COSINE}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20")
def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 20, None)


@query(f"WITH {_HIT} SELECT query_id, rank, vec_id, score FROM hit WHERE rank <= 20")
def topk_cosine_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 20, FLOOR)


@query(f"WITH {_COSINE}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair) SELECT query_id, rank, vec_id, score FROM r WHERE rank = 1")
def top1_no_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 1, None)


@query("SELECT count(*) AS points_count, CAST(max(len(embedding)) AS BIGINT) AS dim, count(*) FILTER (WHERE len(embedding) <> 64) AS off_dim FROM embeddings")
def collection_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.Collection("points", 64).info(table(spark, sf_dir, "embeddings"))


@query("SELECT vec_id, label FROM embeddings WHERE label = 3")
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.Collection("points", 64).keyword(table(spark, sf_dir, "embeddings"), "label", 3).select("vec_id", "label")


@query("""SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN -1 ELSE label END AS label FROM embeddings
UNION ALL SELECT vec_id + 1000000000, -1 FROM embeddings WHERE vec_id % 3 = 0""")
def collection_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    changed = v.where("vec_id % 3 = 0").withColumn("label", F.lit(-1))
    return retrieval.Collection("points", 64).upsert(v, changed.unionByName(changed.withColumn("vec_id", F.col("vec_id") + 1000000000)))


@query("""WITH pair AS (SELECT a.vec_id AS query_id, b.vec_id,
  CAST(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST((z[1] > 0) <> (z[2] > 0) AS BIGINT))) AS BIGINT) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pair)
SELECT query_id, vec_id, distance, rank FROM r WHERE rank <= 50""")
def binary_quantization(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = table(spark, sf_dir, "embeddings").select("vec_id", retrieval.sign_bits(F.col("embedding")).alias("bits"))
    return retrieval.hamming_top_k(bits, bits.where("vec_id % 100 = 0"), 50)


@query("""WITH pair AS (SELECT a.vec_id AS query_id, b.vec_id, a.embedding AS x, b.embedding AS y,
  CAST(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST((z[1] > 0) <> (z[2] > 0) AS BIGINT))) AS BIGINT) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS n FROM pair),
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(CAST(x AS DOUBLE[]), CAST(y AS DOUBLE[])), 6) + 0.0 AS score FROM near WHERE n <= 50),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def binary_quantization_rescored(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return retrieval.quantized_search(v, _vector_queries(v), 10, 5)


def _vector_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    hits = _top(spark, sf_dir, max(KS), FLOOR).join(v.select("vec_id", F.col("label").alias("path")), "vec_id").withColumnRenamed("query_id", "question_id")
    questions = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("question_id"), F.col("label").alias("gold_path"))
    return evaluation.document_metrics(questions, hits, KS)


@query(f"{_DOC_BY_K} SELECT * FROM d")
def eval_doc_metrics_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_vector_metrics(spark, sf_dir), "avg_score", "doc_precision").drop("doc_accuracy", "doc_recall")


@query(f"""{_DOC_BY_K} SELECT k, count(*) AS num_questions, round(avg(num_retrieved), 6) + 0.0 AS num_retrieved_avg, round(avg(avg_score), 6) + 0.0 AS avg_score_avg,
round(avg(doc_coverage), 6) + 0.0 AS doc_coverage_avg, round(avg(doc_precision), 6) + 0.0 AS doc_precision_avg, round(avg(doc_chunks_retrieved), 6) + 0.0 AS doc_chunks_retrieved_avg FROM d GROUP BY k""")
def eval_summary_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ["num_retrieved", "avg_score", "doc_coverage", "doc_precision", "doc_chunks_retrieved"]
    return rounded(evaluation.summary(eval_doc_metrics_by_k(spark, sf_dir), KS, metrics), *(f"{m}_avg" for m in metrics))


# text ----------------------------------------------------------------------------------------------------------


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query(f"SELECT doc_id, md5({_norm('text')}) AS norm_md5, CAST(len({_tok('text')}) AS BIGINT) AS n_tokens FROM documents")
def normalize_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.normalize("text").cast("binary")).alias("norm_md5"), F.size(T.tokens("text")).cast("long").alias("n_tokens"))


@query(f"SELECT doc_id, CAST(len({_words('text')}) AS BIGINT) AS n_words FROM documents")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.word_count("text").alias("n_words"))


@query(f"SELECT tok AS token, count(*) AS n FROM (SELECT unnest({_tok('text')}) AS tok FROM documents) GROUP BY 1")
def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select(F.explode(T.tokens("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH s AS (SELECT doc_id, list_filter(regexp_extract_all(text, '(?s).*?[.!?]{_WS}+|.+$'), lambda x: regexp_matches(x, '{_NOT_WS}')) AS ss FROM documents)
SELECT doc_id, CAST(i AS BIGINT) AS sentence_no, ss[i + 1] AS sentence FROM (SELECT doc_id, ss, unnest(range(len(ss))) AS i FROM s)""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(T.sentences("text")).alias("sentence_no", "sentence")).withColumn("sentence_no", F.col("sentence_no").cast("long"))


@query(f"""WITH w AS (SELECT doc_id, {_words('text')} AS ws FROM documents)
SELECT doc_id, CAST(i // 80 AS BIGINT) AS window_no, array_to_string(ws[i + 1 : i + 100], ' ') AS content FROM (SELECT doc_id, ws, unnest(range(0, len(ws), 80)) AS i FROM w)""")
def word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(T.word_windows("text", 100, 20)).alias("window_no", "content")).withColumn("window_no", F.col("window_no").cast("long"))


_TABLED = "concat('| ', replace(text, chr(10), ' |' || chr(10) || '| '), ' |', chr(10), text)"


@query(rf"""WITH t AS (SELECT doc_id, regexp_extract_all({_TABLED}, '(\|[^\n]+\|\n)((?:\|[^\n]+\|\n)+)', 0) AS ts FROM documents)
SELECT doc_id, CAST(i AS BIGINT) AS table_no, md5(ts[i + 1]) AS table_md5 FROM (SELECT doc_id, ts, unnest(range(len(ts))) AS i FROM t)""")
def table_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.concat(F.lit("| "), F.replace("text", F.lit("\n"), F.lit(" |\n| ")), F.lit(" |\n"), F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(T.tables(shown)).alias("table_no", "t")).select("doc_id", F.col("table_no").cast("long"), F.md5(F.col("t").cast("binary")).alias("table_md5"))


@query(rf"""WITH p AS (SELECT doc_id, list_filter(regexp_split_to_array(replace(text, '. ', '.' || chr(10) || ' ' || chr(10)), '\n{_WS}*\n'), lambda x: regexp_matches(x, '{_NOT_WS}')) AS ps FROM documents)
SELECT doc_id, CAST(len(ps) AS BIGINT) AS n_paragraphs, md5(array_to_string(ps, '#')) AS paragraphs_md5 FROM p""")
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.paragraphs(F.replace("text", F.lit(". "), F.lit(".\n \n")))
    return _docs(spark, sf_dir).select("doc_id", F.size(p).cast("long").alias("n_paragraphs"), F.md5(F.array_join(p, "#").cast("binary")).alias("paragraphs_md5"))


@query("""SELECT doc_id, CASE WHEN length(text) > 500 THEN concat(substr(text, 1, 500), '...') ELSE text END AS preview, concat(substr(text, 1, 100), '...') AS shown FROM documents""")
def preview_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.preview("text").alias("preview"), T.display("text", 100).alias("shown"))


@query(r"""SELECT doc_id, md5(replace(trim(concat('""', replace(text, chr(10), '\n'), '"'), '"'), '\n', chr(10))) AS clean_md5 FROM documents""")
def cleanup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit('""'), F.replace("text", F.lit("\n"), F.lit("\\n")), F.lit('"'))
    return _docs(spark, sf_dir).select("doc_id", F.md5(T.cleanup(raw).cast("binary")).alias("clean_md5"))


@query("""SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN 'N/A' ELSE split_part(url, '/', -1) END AS base FROM pages""")
def path_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.basename("url").alias("base"))


@query("""SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), nullif(source, ''), '') AS content FROM documents""")
def content_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.first_text(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")), "source").alias("content"))


@query("""SELECT doc_id, array_to_string(['# ' || source, '### ' || lang], chr(10)) AS headings FROM documents""")
def heading_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.array_join(T.heading_lines(F.create_map(F.lit(3), F.col("lang"), F.lit(1), F.col("source"))), "\n").alias("headings"))


@query("SELECT doc_id, source AS file_path FROM documents WHERE text <> '' AND source <> ''")
def document_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("content"), F.col("source").alias("file_path"))
    return dataset.usable_documents(rows).select("doc_id", "file_path")


def _recursive_sql(text: str, size: int, step: int) -> str:
    """The recursive splitter: paragraphs packed in order (one row of a recursion each), groups over the size cut into sentences packed the same way, single sentences into windows of words."""
    packed = lambda name, source: f"""{name} AS (SELECT doc_id, g, i, 1 AS c, w AS held FROM {source} WHERE i = 1
  UNION ALL SELECT p.doc_id, p.g, p.i, CASE WHEN held + p.w > {size} THEN c + 1 ELSE c END, CASE WHEN held + p.w > {size} THEN p.w ELSE held + p.w END
  FROM {name} q JOIN {source} p ON p.doc_id = q.doc_id AND p.g = q.g AND p.i = q.i + 1)"""  # noqa: E731
    return f"""WITH RECURSIVE t AS (SELECT doc_id, {text} AS text, len({_words(text)}) AS w FROM documents WHERE text IS NOT NULL),
par AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\n{_WS}*\\n'), lambda x: regexp_matches(x, '{_NOT_WS}')) AS ps FROM t WHERE w > {size}),
p AS (SELECT doc_id, 0 AS g, i, ps[i] AS text, len({_words("ps[i]")}) AS w FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM par WHERE len(ps) > 1)),
{packed("pg", "p")},
grp AS (SELECT doc_id, pg.c AS g, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text, CAST(sum(w) AS BIGINT) AS w FROM pg JOIN p USING (doc_id, i) GROUP BY 1, 2
  UNION ALL SELECT doc_id, 1, text, w FROM t WHERE doc_id NOT IN (SELECT doc_id FROM p)),
ss AS (SELECT doc_id, g, text, list_filter(regexp_extract_all(text, '(?s).*?[.!?]{_WS}+|.+$'), lambda x: regexp_matches(x, '{_NOT_WS}')) AS ss FROM grp WHERE w > {size}),
s AS (SELECT doc_id, g, i, ss[i] AS text, len({_words("ss[i]")}) AS w FROM (SELECT doc_id, g, ss, unnest(range(1, len(ss) + 1)) AS i FROM ss WHERE len(ss) > 1)),
{packed("sg", "s")},
one AS (SELECT doc_id, g, {_words("text")} AS ws FROM ss WHERE len(ss) <= 1),
chunk AS (SELECT doc_id, g, 0 AS c, text AS content FROM grp WHERE w <= {size}
  UNION ALL SELECT doc_id, g, c, string_agg(text, '' ORDER BY i) FROM sg JOIN s USING (doc_id, g, i) GROUP BY 1, 2, 3
  UNION ALL SELECT doc_id, g, i, array_to_string(ws[i + 1 : i + {size}], ' ') FROM (SELECT doc_id, g, ws, unnest(range(0, len(ws), {step})) AS i FROM one))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g, c) - 1 AS chunk_no, content FROM chunk"""


@query(_recursive_sql("text", 100, 80))
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_rows(_docs(spark, sf_dir), lambda t: chunking.recursive_chunks(t, 100, 20)).drop("headers")


#: Texts whose lines are paragraphs, some of one long sentence.
_PARAGRAPHS = "regexp_replace(replace(replace(text, chr(10), chr(10) || ' ' || chr(10) || chr(10)), '! ', '!' || chr(10) || chr(10)), '[.] ([aeiou])', ' \\1', 'g')"


@query(_recursive_sql(_PARAGRAPHS, 40, 30))
def recursive_paragraph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several paragraphs of several sentences each, packed and cut at all three levels."""
    parted = F.replace(F.replace("text", F.lit("\n"), F.lit("\n \n\n")), F.lit("! "), F.lit("!\n\n"))
    docs = _docs(spark, sf_dir).withColumn("text", F.regexp_replace(parted, "[.] ([aeiou])", " $1"))
    return chunking.chunk_rows(docs, lambda t: chunking.recursive_chunks(t, 40, 10)).drop("headers")


class Sql(str):
    """An expression that Spark and DuckDB read alike; plain strings beside it are literals."""


def _glued_sql(parts: list[str]) -> str:
    return "concat(" + ", ".join(p if isinstance(p, Sql) else "'" + p.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for p in parts) + ")"


def _glued(parts: list[str]) -> Column:
    return F.concat(*(F.expr(p) if isinstance(p, Sql) else F.lit(p) for p in parts))


#: Texts as one sentence each, which the recursive splitter cuts by words alone.
_ONE_SENTENCE = Sql("translate(replace(text, chr(10), ' '), '.!?', '')")


@query(f"""WITH w AS (SELECT doc_id, {_ONE_SENTENCE} AS t, {_words(_ONE_SENTENCE)} AS ws FROM documents),
c AS (SELECT doc_id, 0 AS i, t AS content FROM w WHERE len(ws) <= 100
UNION ALL SELECT doc_id, i, array_to_string(ws[i + 1 : i + 100], ' ') FROM (SELECT doc_id, ws, unnest(range(0, len(ws), 80)) AS i FROM w WHERE len(ws) > 100))
SELECT doc_id, CAST(i // 80 AS BIGINT) AS chunk_no, content FROM c""")
def recursive_word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).withColumn("text", F.expr(_ONE_SENTENCE))
    return chunking.chunk_rows(docs, lambda t: chunking.recursive_chunks(t, 100, 20)).drop("headers")


#: Texts without signs of headings and fences, below two headings of their own.
_HEADED = ["# ", Sql("source"), " ##\n## ", Sql("lang"), "\n", Sql("translate(text, '#`~', '')")]


@query(f"""SELECT doc_id, CAST(0 AS BIGINT) AS chunk_no, '# ' || source || ' ##' AS content, '{{"1":"' || source || '"}}' AS headers FROM documents
UNION ALL SELECT doc_id, 1, regexp_replace({_glued_sql(["## ", *_HEADED[3:]])}, '{_WS}+$', ''), '{{"1":"' || source || '","2":"' || lang || '"}}' FROM documents""")
def header_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    headed = _docs(spark, sf_dir).withColumn("text", _glued(_HEADED))
    return chunking.chunk_rows(headed, chunking.header_sections).withColumn("headers", F.to_json("headers"))


#: Headings of several levels, upwards and downwards, with text before the first, and a fence that holds what looks like one.
_NESTED = ["intro\n# ", Sql("source"), "\nbody ", Sql("lang"), "\n### deep\n```\n# no heading\n~~~\n```\n## ", Sql("lang"), " #\n", Sql("translate(text, '#`~', '')")]


@query(f"""SELECT doc_id, CAST(0 AS BIGINT) AS chunk_no, 'intro' AS content, '{{}}' AS headers FROM documents
UNION ALL SELECT doc_id, 1, {_glued_sql(["# ", *_NESTED[1:4]])}, '{{"1":"' || source || '"}}' FROM documents
UNION ALL SELECT doc_id, 2, {_glued_sql(["### deep\n```\n# no heading\n~~~\n```"])}, '{{"1":"' || source || '","3":"deep"}}' FROM documents
UNION ALL SELECT doc_id, 3, regexp_replace({_glued_sql(["## ", *_NESTED[5:]])}, '{_WS}+$', ''), '{{"1":"' || source || '","2":"' || lang || '"}}' FROM documents""")
def header_sections_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    headed = _docs(spark, sf_dir).withColumn("text", _glued(_NESTED))
    return chunking.chunk_rows(headed, chunking.header_sections).withColumn("headers", F.to_json("headers"))


#: A nested environment with another's marks inside, one that is never closed, and two tables: after a line between bars that is empty, and without a last newline.
_ENVIRONMENT = ["\\begin{", Sql("lang"), "}", Sql("doc_id"), "\\begin{", Sql("lang"), "} a \\begin{b} \\end{", Sql("lang"), "}\\end{", Sql("lang"), "}"]
_TABLE_1 = ["| a", Sql("doc_id"), " |\n| b |\n"]
_SPANNED = ["see ", *_ENVIRONMENT, " ", Sql("translate(text, '|', '')"), " \\begin{c\n", *_TABLE_1, "x\n||\n", "| c |\n| d |\n", "| e |"]


@query(f"""WITH s AS (SELECT doc_id, length({_glued_sql(["see "])}) AS a, length({_glued_sql(_ENVIRONMENT)}) AS e, length({_glued_sql(_SPANNED[:-3])}) AS t1,
  length({_glued_sql(_TABLE_1)}) AS n1, length({_glued_sql(_SPANNED[:-2])}) AS t2, length({_glued_sql(_SPANNED[-2:-1])}) AS n2 FROM documents)
SELECT doc_id, CAST(0 AS BIGINT) AS span_no, a AS start, a + e AS "end" FROM s UNION ALL SELECT doc_id, 1, t1 - n1, t1 FROM s UNION ALL SELECT doc_id, 2, t2, t2 + n2 FROM s""")
def preserved_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.span_rows(_docs(spark, sf_dir).withColumn("text", _glued(_SPANNED)), chunking.preserved_spans)


#: Texts as one sentence, with references and formulas whose marks end none, before sentences more.
_PLAIN = Sql("translate(replace(text, chr(10), ' '), '.!?$|', '')")
_GUARDED = [_PLAIN, " in Table 1. The caption goes on. See Fig. ", Sql("doc_id"), ": ok $a. b$ there! Eq. 3 ends"]


@query(f"""WITH p AS (SELECT doc_id, [{_glued_sql([_PLAIN, " in Table 1. The caption goes on."])}, {_glued_sql(["See Fig. ", Sql("doc_id"), ": ok $a. b$ there!"])}, 'Eq. 3 ends'] AS ps FROM documents)
SELECT doc_id, CAST(i AS BIGINT) AS chunk_no, regexp_replace(ps[i + 1], '^{_WS}+', '') AS content FROM (SELECT doc_id, ps, unnest(range(3)) AS i FROM p)""")
def protected_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_rows(_docs(spark, sf_dir).withColumn("text", _glued(_GUARDED)), chunking.structured_chunks).drop("headers")


# references and metrics ----------------------------------------------------------------------------------------


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("reference_id"), "text")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), F.col("source").alias("path"), F.col("text").alias("content"))


@query(f"WITH {_SHARES} SELECT item_id AS reference_id, doc_id AS chunk_id, round(share, 6) + 0.0 AS share FROM shares WHERE share >= {THRESHOLD}")
def fuzzy_reference_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.fuzzy_pairs(_references(spark, sf_dir), _chunks(spark, sf_dir), THRESHOLD), "share")


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS chunk_number FROM documents")
def chunk_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.number_rows(_docs(spark, sf_dir).select("doc_id", "source"), "source", ["doc_id"], "chunk_number")


@query("SELECT doc_id, source, md5(text) AS text_md5, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS chunk_number FROM documents")
def chunk_numbering_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbering.number_rows(_docs(spark, sf_dir), "source", ["doc_id"], "chunk_number")
    return rows.select("doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"), "chunk_number")


@query("SELECT doc_id, row_no FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM documents) WHERE row_no IN (0, 7, 42, 1000000000)")
def pick_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.pick_rows(_docs(spark, sf_dir).select("doc_id"), ["doc_id"], [0, 7, 42, 1_000_000_000])


@query(f"""WITH {_SHARES}, n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS no FROM documents)
SELECT item_id AS reference_id, source, array_to_string(list(no ORDER BY no), ',') AS chunk_numbers FROM shares JOIN n USING (doc_id) WHERE share >= {THRESHOLD} GROUP BY 1, 2""")
def reference_chunk_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = chunk_numbering(spark, sf_dir).withColumnRenamed("doc_id", "chunk_id")
    found = evaluation.fuzzy_pairs(_references(spark, sf_dir), _chunks(spark, sf_dir), THRESHOLD).join(numbers, "chunk_id")
    return found.groupBy("reference_id", "source").agg(F.array_join(F.transform(F.array_sort(F.collect_list("chunk_number")), lambda n: n.cast("string")), ",").alias("chunk_numbers"))


_PAIRS = f"""WITH {_SHARES}, valid AS (SELECT DISTINCT item_id FROM shares WHERE share >= {THRESHOLD}),
pairs AS (SELECT b.item_id // 4 AS pair_id, count(*) AS refs_generated, count(v.item_id) AS refs_valid, count(*) - count(v.item_id) AS refs_removed FROM benchmark b LEFT JOIN valid v USING (item_id) GROUP BY 1)"""


@query(f"{_PAIRS} SELECT * FROM pairs WHERE refs_valid >= 1")
def reference_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir).select(F.col("chunk_id").alias("chunk_number"), "content", F.lit("all").alias("file_path"))
    refs = table(spark, sf_dir, "benchmark").withColumn("pair_id", F.floor(F.col("item_id") / 4))
    pairs = refs.groupBy("pair_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_id", "text"))), lambda x: x["text"]).alias("references")).withColumn("file_path", F.lit("all"))
    return dataset.validate_references(pairs, chunks, THRESHOLD).select("pair_id", "refs_generated", "refs_valid", "refs_removed")


@query(f"""{_PAIRS}, kept AS (SELECT * FROM pairs WHERE refs_valid >= 1), n AS (SELECT count(DISTINCT item_id // 4) AS documents FROM benchmark)
SELECT max(documents) AS documents, count(pair_id) AS pairs, max(documents) - count(pair_id) AS skipped, CAST(coalesce(sum(refs_generated), 0) AS BIGINT) AS refs_generated, CAST(coalesce(sum(refs_valid), 0) AS BIGINT) AS refs_valid,
CAST(coalesce(sum(refs_removed), 0) AS BIGINT) AS refs_removed, round({_div("count(pair_id)", "max(documents)")}, 6) + 0.0 AS success_rate, round({_div("coalesce(sum(refs_valid), 0)", "coalesce(sum(refs_generated), 0)")}, 6) + 0.0 AS validity_rate FROM n LEFT JOIN kept ON true""")
def generation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "benchmark").select(F.floor(F.col("item_id") / 4)).distinct().count()
    return rounded(dataset.generation_stats(n, reference_validity(spark, sf_dir)), "success_rate", "validity_rate")


def _lexical(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """questions, references and hits of lexical retrieval: the share of a question's tokens that a document holds."""
    items, chunks = table(spark, sf_dir, "benchmark"), _chunks(spark, sf_dir)
    # shares are compared when rounded
    best = rounded(evaluation.lexical_top_k(_references(spark, sf_dir), chunks, max(LEXICAL_KS), FLOOR - 1e-6), "share").where(F.col("share") >= FLOOR)
    hits = staged(best.join(chunks, "chunk_id").select(F.col("reference_id").alias("question_id"), "rank", "chunk_id", "path", "content", F.col("share").alias("score")), "lexical-hits")
    group = F.floor(F.col("item_id") / 2)
    questions = items.select(F.col("item_id").alias("question_id"), group.alias("g"), F.lit("src0").alias("gold_path"))
    references = questions.join(items.select(group.alias("g"), F.col("item_id").alias("reference_id"), "text"), "g").select("question_id", "reference_id", "text")
    return questions.drop("g"), references, hits


@query(f"WITH {_LEXICAL} SELECT question_id, rank, chunk_id, path, score FROM hits")
def lexical_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexical(spark, sf_dir)[2].select("question_id", "rank", "chunk_id", "path", "score")


@query(f"WITH {_LEXICAL}, {_TOKEN_METRICS} SELECT question_id, k, {_r6('token_iou', 'token_precision', 'token_recall', 'token_f1')} FROM tm")
def token_metrics_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, references, hits = _lexical(spark, sf_dir)
    found = evaluation.matches(references, hits, THRESHOLD)
    return rounded(evaluation.token_metrics(questions, references, hits, found, LEXICAL_KS), "token_iou", "token_precision", "token_recall", "token_f1")


_PASSAGES = ("passage_coverage", "passage_accuracy", "passage_precision", "passage_recall", "passage_f1")


@query(f"WITH {_LEXICAL}, {_PASSAGE_METRICS} SELECT question_id, k, {_r6(*_PASSAGES)} FROM pm")
def passage_metrics_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, references, hits = _lexical(spark, sf_dir)
    return rounded(evaluation.passage_metrics(questions, references, hits, evaluation.matches(references, hits, THRESHOLD), LEXICAL_KS), *_PASSAGES)


_AVERAGED = ("token_iou", "token_precision", "token_recall", "token_f1", *_PASSAGES, "doc_coverage", "doc_precision", "num_references")


@query(f"""WITH {_LEXICAL}, {_TOKEN_METRICS}, {_PASSAGE_METRICS},
dm AS (SELECT question_id, k, count(rank) AS got, count(*) FILTER (WHERE path = 'src0') AS own FROM g LEFT JOIN hits USING (question_id) WHERE rank <= k OR rank IS NULL GROUP BY 1, 2),
dd AS (SELECT question_id, k, CASE WHEN coalesce(own, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS doc_coverage, {_div("coalesce(own, 0)", "coalesce(got, 0)")} AS doc_precision FROM g LEFT JOIN dm USING (question_id, k))
SELECT k, count(*) AS num_questions, {", ".join(f"round(avg({m}), 6) + 0.0 AS {m}_avg" for m in _AVERAGED[:-1])}, round(avg(asked), 6) + 0.0 AS num_references_avg
FROM tm JOIN pm USING (question_id, k) JOIN dd USING (question_id, k) JOIN nref USING (question_id) GROUP BY k""")
def eval_lexical_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = evaluation.evaluate(*_lexical(spark, sf_dir), LEXICAL_KS, THRESHOLD)
    return rounded(evaluation.summary(results, LEXICAL_KS, list(_AVERAGED)), *(f"{m}_avg" for m in _AVERAGED))


def _ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, references, hits = _lexical(spark, sf_dir)
    return evaluation.reciprocal_rank(questions, evaluation.matches(references, hits, THRESHOLD))


@query(f"WITH {_LEXICAL}, {_RANKS} SELECT question_id, first_rank, round(reciprocal_rank, 6) + 0.0 AS reciprocal_rank FROM ranks")
def first_relevant_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_ranks(spark, sf_dir), "reciprocal_rank")


@query(f"WITH {_LEXICAL}, {_RANKS} SELECT round(coalesce(avg(reciprocal_rank), 0.0), 6) + 0.0 AS mrr, count(*) AS num_questions FROM ranks")
def mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.mean_reciprocal_rank(_ranks(spark, sf_dir)), "mrr")


@query(f"WITH {_LEXICAL}, {_RANKS} SELECT first_rank, count(*) AS n_questions, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM ranks), 6) + 0.0 AS percent FROM ranks GROUP BY 1")
def rank_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.rank_distribution(_ranks(spark, sf_dir)), "percent")


@query(f"""WITH {_SHARES} SELECT item_id AS reference_id, doc_id AS chunk_id, CAST(sum(least(reftf.tf, doctok.tf)) AS BIGINT) AS overlap FROM reftf JOIN doctok USING (tok) GROUP BY 1, 2""")
def multiset_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.multiset_overlap(_references(spark, sf_dir), _chunks(spark, sf_dir))


# re-ranking ----------------------------------------------------------------------------------------------------


def _reranked(spark: SparkSession, sf_dir: str, k: int | None) -> DataFrame:
    _, _, hits = _lexical(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    return dataset.rerank(hits.join(asked, "question_id"), F.round(models.lexical_score(F.col("question"), F.col("content")), 6) + F.lit(0.0), k)


@query(f"WITH {_LEXICAL}, {_RERANKED} SELECT question_id, chunk_id, rank, new_rank, rerank_score FROM rr WHERE new_rank <= 5")
def rerank_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reranked(spark, sf_dir, 5).select("question_id", "chunk_id", "rank", "new_rank", "rerank_score")


@query(f"WITH {_LEXICAL}, {_RERANKED} SELECT question_id, chunk_id, rank - new_rank AS position_change, CASE WHEN rank > new_rank THEN 'up' WHEN rank < new_rank THEN 'down' ELSE 'same' END AS direction FROM rr")
def rank_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reranked(spark, sf_dir, None).select("question_id", "chunk_id", "position_change", "direction")


@query(f"""WITH {_LEXICAL}, {_RERANKED},
r2 AS (SELECT f.question_id, min(f.rank) AS old, min(rr.new_rank) AS new FROM found f JOIN rr USING (question_id, chunk_id) GROUP BY 1),
m AS (SELECT coalesce(avg(coalesce(1.0 / old, 0.0)), 0.0)::DOUBLE AS a, coalesce(avg(coalesce(1.0 / new, 0.0)), 0.0)::DOUBLE AS b,
  avg(CASE WHEN old <= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS c, avg(CASE WHEN new <= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS d FROM benchmark LEFT JOIN r2 ON question_id = item_id)
SELECT 'all' AS scope, 'mrr' AS metric, round(a, 6) + 0.0 AS baseline, round(b, 6) + 0.0 AS changed, round(b - a, 6) + 0.0 AS delta, round(100.0 * (b - a), 6) + 0.0 AS points FROM m
UNION ALL SELECT 'all', 'hit_at_3', round(c, 6) + 0.0, round(d, 6) + 0.0, round(d - c, 6) + 0.0, round(100.0 * (d - c), 6) + 0.0 FROM m""")
def rerank_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, references, hits = _lexical(spark, sf_dir)

    def of(h: DataFrame) -> DataFrame:
        ranks = evaluation.reciprocal_rank(questions, evaluation.matches(references, h, THRESHOLD))
        hit = F.avg(F.when(F.col("first_rank") <= 3, 1.0).otherwise(0.0))
        return ranks.agg(F.avg("reciprocal_rank").alias("mrr"), hit.alias("hit_at_3")).withColumn("scope", F.lit("all"))

    return rounded(evaluation.improvement(of(hits), of(dataset.as_hits(_reranked(spark, sf_dir, None))), ["scope"], ["mrr", "hit_at_3"]), "baseline", "changed", "delta", "points")


@query(f"""WITH {_LEXICAL} SELECT question_id, md5(string_agg('Document ' || (rank - 1) || ':' || chr(10) || text || chr(10), '' ORDER BY rank)) AS context_md5
FROM hits JOIN documents ON doc_id = chunk_id WHERE rank <= 5 GROUP BY 1""")
def context_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _lexical(spark, sf_dir)[2].where("rank <= 5")
    return dataset.context_of(hits, "question_id", "rank", "content").select("question_id", F.md5(F.col("context").cast("binary")).alias("context_md5"))


@query(f"""WITH {_LEXICAL}, c AS (SELECT question_id, count(*) AS n FROM hits WHERE rank <= 5 GROUP BY 1)
SELECT item_id AS question_id, md5(coalesce(n, 0) || ' documents on: ' || text) AS answer_md5 FROM benchmark LEFT JOIN c ON question_id = item_id""")
def grounded_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    answers = dataset.answer(asked, _lexical(spark, sf_dir)[2].where("rank <= 5"), "Answer from the documents only.")
    return answers.select("question_id", F.md5(F.col("answer").cast("binary")).alias("answer_md5"))


# ingestion and payloads ----------------------------------------------------------------------------------------


@query("SELECT doc_id, source AS file_path FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def catalog_missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.resume(_docs(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.col("source").alias("file_path"))


@query(f"""WITH c AS (SELECT d.doc_id, unnest(range(0, len({_words('text')}), 100)) AS i FROM documents d JOIN labels USING (doc_id))
SELECT 'chunks' AS output_file, count(DISTINCT doc_id) AS docs_processed, count(*) AS records_written, (SELECT count(*) FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)) AS n_skipped FROM c""")
def ingest_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    there = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    chunks = there.select(F.col("doc_id").alias("file_path"), F.explode(T.word_windows("text", 100)).alias("content"))
    return io.run_summary(chunks, io.resume(docs, table(spark, sf_dir, "labels"), "doc_id"), "chunks")


@query("SELECT CAST(doc_id AS VARCHAR) AS file_path, 'missing' AS reason FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def ingest_skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = io.resume(_docs(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")
    return io.skipped_list(missing.select(F.col("doc_id").cast("string").alias("file_path")))


@query("SELECT doc_id, n_chars, md5(concat(source, '/', lang)) AS header_md5, md5(text) AS content_md5 FROM documents")
def chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(F.col("text").alias("content"), F.struct("n_chars", F.array("source", "lang").alias("header")).alias("metadata"))
    rows = _docs(spark, sf_dir).select("doc_id", record.alias("r"))
    return rows.select("doc_id", "r.metadata.n_chars", F.md5(F.array_join("r.metadata.header", "/").cast("binary")).alias("header_md5"), F.md5(F.col("r.content").cast("binary")).alias("content_md5"))


def _payload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    points = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("src/"), "doc_id").alias("file_path"), F.col("n_chars").cast("int").alias("year"), F.col("lang").alias("title"), "source")
    labels = table(spark, sf_dir, "labels")
    mapping = labels.select(F.concat(F.lit("moved/"), "doc_id").alias("new_path"), F.concat(F.lit("src/"), "doc_id").alias("old_path"))
    year = F.when(F.col("toxic") == 1, "n/a").otherwise("2019.9")
    metadata = labels.where("quality = 1").select(F.concat(F.lit("src/"), "doc_id").alias("file_path"), year.alias("year"), F.col("doc_id").cast("string").alias("n_citations"), F.lit(None).cast("string").alias("title"))
    return points, dataset.payload_updates(mapping, metadata)


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN concat('src/', d.doc_id) ELSE concat('moved/', d.doc_id) END AS file_path,
CASE WHEN l.quality = 1 THEN CASE WHEN l.toxic = 1 THEN NULL ELSE 2019 END ELSE CAST(d.n_chars AS INTEGER) END AS year, CASE WHEN l.quality = 1 THEN NULL ELSE d.lang END AS title, d.source,
CASE WHEN l.quality = 1 THEN CAST(d.doc_id AS BIGINT) END AS n_citations FROM documents d LEFT JOIN labels l USING (doc_id)""")
def payload_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.merge_payload(*_payload(spark, sf_dir))


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN concat('src/', d.doc_id) ELSE concat('moved/', d.doc_id) END AS file_path,
CASE WHEN l.doc_id % 3 = 0 THEN CASE WHEN l.toxic = 1 THEN 2019 END ELSE CAST(d.n_chars AS INTEGER) END AS year,
CASE WHEN l.doc_id % 2 = 0 THEN CASE WHEN l.quality = 1 THEN concat('T "', d.doc_id, '"') END ELSE d.lang END AS title, d.source,
CASE WHEN l.doc_id % 5 = 0 THEN concat('"10.1/x', d.doc_id, '"') END AS doi, CASE WHEN l.doc_id % 4 = 1 THEN concat('[', d.doc_id, ',null]') WHEN l.doc_id % 4 = 2 THEN 'null' END AS refs,
CASE WHEN d.doc_id % 2 = 0 THEN '"old"' END AS kept
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def payload_merge_partial_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata whose rows have different keys, of which a point has some as columns: absent ones stay, null overwrites, others arrive with their type."""
    points, _ = _payload(spark, sf_dir)
    points = points.withColumn("payload", F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("kept"), F.lit('"old"'))))
    labels, i = table(spark, sf_dir, "labels"), F.col("doc_id")
    key = lambda when, name, value: F.when(when, F.concat(F.lit(f', "{name}": '), value)).otherwise(F.lit(""))
    line = F.concat(
        F.lit('{"file_path": "src/'), i, F.lit('"'), key(i % 3 == 0, "year", F.when(F.col("toxic") == 1, F.lit('"2019.9"')).otherwise(F.lit("null"))),
        key(i % 2 == 0, "title", F.when(F.col("quality") == 1, F.concat(F.lit('"T \\"'), i, F.lit('\\""'))).otherwise(F.lit("null"))), key(i % 5 == 0, "doi", F.concat(F.lit('"10.1/x'), i, F.lit('"'))),
        key(i % 4 == 1, "refs", F.concat(F.lit("["), i, F.lit(", null]"))), key(i % 4 == 2, "refs", F.lit("null")), F.lit("}"),
    )
    metadata = labels.select(F.concat(F.lit("src/"), i).alias("file_path"), dataset.open_entry(line).alias("entry"))
    mapping = labels.select(F.concat(F.lit("moved/"), i).alias("new_path"), F.concat(F.lit("src/"), i).alias("old_path"))
    merged = dataset.merge_payload(points, dataset.payload_updates(mapping, metadata))
    return merged.select("doc_id", "file_path", "year", "title", "source", *(F.col("payload")[k].alias(k) for k in ("doi", "refs", "kept")))


@query("SELECT (SELECT count(*) FROM labels) AS mappings_processed, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) AS points_updated")
def payload_dry_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.update_counts(*_payload(spark, sf_dir))


@query("""SELECT page_id, CAST(trunc(TRY_CAST(v AS DOUBLE)) AS INTEGER) AS year, v AS title
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat(page_id, '.9') WHEN 1 THEN 'n/a' WHEN 2 THEN NULL ELSE concat('-', page_id, '.5') END AS v FROM pages)""")
def payload_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, kind = F.col("page_id").cast("string"), F.col("page_id") % 4
    v = F.when(kind == 0, F.concat(i, F.lit(".9"))).when(kind == 1, "n/a").when(kind == 3, F.concat(F.lit("-"), i, F.lit(".5")))
    return dataset.coerced(table(spark, sf_dir, "pages").select("page_id", v.alias("year"), v.alias("title")))


# conversations -------------------------------------------------------------------------------------------------

_CONV = """
s AS (SELECT * FROM conversations WHERE role IN ('user', 'assistant')),
l AS (SELECT conv_id, max(turn) AS t FROM s WHERE role = 'user' GROUP BY 1),
h AS (SELECT s.conv_id, string_agg(upper(role[1]) || role[2:] || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS conversation FROM s JOIN l ON s.conv_id = l.conv_id AND turn < t GROUP BY 1),
c AS (SELECT l.conv_id, coalesce(conversation, '') AS conversation, text AS last_utterance FROM l JOIN s ON s.conv_id = l.conv_id AND turn = t LEFT JOIN h ON h.conv_id = l.conv_id)"""


@query(f"WITH {_CONV} SELECT * FROM c")
def last_user_utterance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.conversations(table(spark, sf_dir, "conversations"))


@query(f"WITH {_CONV} SELECT conv_id, last_utterance FROM c WHERE conversation <> ''")
def multi_turn_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.multi_turn(last_user_utterance(spark, sf_dir)).select("conv_id", "last_utterance")


@query(f"""WITH {_CONV}, p AS (SELECT l.conv_id, max(turn) AS t FROM s JOIN l ON s.conv_id = l.conv_id AND turn < l.t WHERE role = 'user' GROUP BY 1),
w AS (SELECT c.conv_id, c.last_utterance, trim(CASE WHEN s.text IS NULL THEN c.last_utterance ELSE s.text || ' ' || c.last_utterance END) AS rewritten FROM c LEFT JOIN p ON p.conv_id = c.conv_id LEFT JOIN s ON s.conv_id = p.conv_id AND s.turn = p.t)
SELECT conv_id, rewritten, CAST(len({_tok("last_utterance")}) AS BIGINT) AS original_tokens, CAST(len({_tok("rewritten")}) AS BIGINT) AS rewritten_tokens FROM w""")
def rewrite_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dataset.rewrite(last_user_utterance(spark, sf_dir))
    return rows.select("conv_id", "rewritten", F.size(T.tokens("last_utterance")).cast("long").alias("original_tokens"), F.size(T.tokens("rewritten")).cast("long").alias("rewritten_tokens"))


def _asked_hits(items: DataFrame, asked: DataFrame, text: str) -> DataFrame:
    """The five items that hold the largest shares, 0.2 at least, of each utterance's tokens."""
    shares = rounded(evaluation.fuzzy_pairs(asked.select(F.col("conv_id").alias("reference_id"), F.col(text).alias("text")), items, 0.2 - 1e-6), "share").where("share >= 0.2")
    return retrieval.ranked(shares, "reference_id", [F.desc("share"), F.asc("chunk_id")], 5).select(F.col("reference_id").alias("question_id"), "chunk_id", "rank", F.col("share").alias("score"))


def _asked_sql(name: str, text: str) -> str:
    return f"""{name}_t AS (SELECT conv_id, unnest({_tok(text)}) AS tok FROM w), {name}_n AS (SELECT conv_id, count(*) AS n FROM {name}_t GROUP BY 1),
{name}_s AS (SELECT conv_id AS question_id, item_id AS chunk_id, round(CAST(count(*) AS DOUBLE) / CAST(max(n) AS DOUBLE), 6) + 0.0 AS score
  FROM {name}_t JOIN (SELECT DISTINCT item_id, tok FROM ref) USING (tok) JOIN {name}_n USING (conv_id) GROUP BY 1, 2),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM {name}_s WHERE score >= 0.2) WHERE rank <= 5)"""


@query(f"""WITH {_CONV}, p AS (SELECT l.conv_id, max(turn) AS t FROM s JOIN l ON s.conv_id = l.conv_id AND turn < l.t WHERE role = 'user' GROUP BY 1),
w AS (SELECT c.conv_id, c.last_utterance, trim(CASE WHEN s.text IS NULL THEN c.last_utterance ELSE s.text || ' ' || c.last_utterance END) AS rewritten FROM c LEFT JOIN p ON p.conv_id = c.conv_id LEFT JOIN s ON s.conv_id = p.conv_id AND s.turn = p.t),
ref AS (SELECT item_id, unnest({_tok("text")}) AS tok FROM benchmark), {_asked_sql("a", "last_utterance")}, {_asked_sql("b", "rewritten")}
SELECT question_id, count(a.score) AS n_original, count(b.score) AS n_rewritten, count(*) FILTER (WHERE a.score IS NOT NULL AND b.score IS NOT NULL) AS n_common,
coalesce(max(a.score), 0.0) AS best_original, coalesce(max(b.score), 0.0) AS best_rewritten, round(coalesce(max(b.score), 0.0) - coalesce(max(a.score), 0.0), 6) + 0.0 AS best_gain
FROM a FULL JOIN b USING (question_id, chunk_id) GROUP BY 1""")
def rewrite_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = staged(dataset.rewrite(last_user_utterance(spark, sf_dir)).select("conv_id", "last_utterance", "rewritten"), "rewritten")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("chunk_id"), F.col("text").alias("content"))
    both = evaluation.compare_retrieval(_asked_hits(items, convs, "last_utterance"), _asked_hits(items, convs, "rewritten"))
    return rounded(both, "best_gain")


# model replies and samples -------------------------------------------------------------------------------------


@query("SELECT doc_id, lang FROM documents ORDER BY md5('42/' || doc_id), doc_id LIMIT 10")
def sample_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.seeded_sample(_docs(spark, sf_dir), "doc_id", 10, 42).select("doc_id", "lang")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN 'Q ' || doc_id END AS question, CAST(CASE WHEN doc_id % 4 < 3 THEN 2 END AS BIGINT) AS n_references FROM documents""")
def llm_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kind = _docs(spark, sf_dir), F.col("doc_id") % 4
    body = F.to_json(F.struct(F.concat(F.lit("Q "), F.col("doc_id").cast("string")).alias("question"), F.array("lang", "source").alias("references")))
    reply = F.when(kind == 0, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nDone"))).when(kind == 1, F.concat(F.lit("```\n"), body, F.lit("\n```"))).when(kind == 2, body).otherwise(F.lit('{"question": "half'))
    parsed = docs.select("doc_id", dataset.parse_reply(reply).alias("r"))
    return parsed.select("doc_id", "r.question", F.when(F.col("r").isNotNull(), F.size("r.references")).cast("long").alias("n_references"))


@query("""WITH r AS (SELECT doc_id, doc_id % 8 AS kind, lang, source, n_chars FROM documents)
SELECT doc_id, CASE WHEN kind IN (0, 1, 7) THEN lang END AS lang, CAST(CASE WHEN kind IN (0, 1, 7) THEN n_chars END AS BIGINT) AS n_chars, CAST(CASE kind WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 7 THEN 1 END AS BIGINT) AS n_parts,
CASE kind WHEN 2 THEN 'no JSON' WHEN 3 THEN 'reply.n_chars is missing' WHEN 4 THEN 'reply.lang is not text' WHEN 5 THEN 'reply.parts[1].size is not a number' WHEN 6 THEN 'reply.parts is not a list' END AS reason FROM r""")
def structured_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with and without fences, checked against a schema of nested types: whole, empty, broken, lacking a key, of wrong types at several depths, with null for what may be null."""
    ddl = "lang STRING NOT NULL, n_chars BIGINT NOT NULL, note STRING, parts ARRAY<STRUCT<name: STRING NOT NULL, size: DOUBLE NOT NULL>> NOT NULL"
    docs, kind = _docs(spark, sf_dir), F.col("doc_id") % 8
    n, good = F.col("n_chars").cast("string"), '{"name": "a", "size": 1.5}'
    reply = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    head = ('{"lang": "', F.col("lang"), '", "n_chars": ', n)
    text = (
        F.when(kind == 0, reply("```json\n", *head, f', "parts": [{good}, {good}], "more": [1]}}', "\n```\nDone.")).when(kind == 1, reply(*head, ', "parts": []}')).when(kind == 2, reply(*head, ', "parts": ['))
        .when(kind == 3, reply('{"lang": "', F.col("lang"), '", "n_chars": null, "parts": []}')).when(kind == 4, reply('{"lang": ', n, ', "n_chars": ', n, ', "parts": []}'))
        .when(kind == 5, reply(*head, f', "parts": [{good}, {{"name": "b", "size": "large"}}]}}')).when(kind == 6, reply(*head, f', "parts": {good}}}')).otherwise(reply(*head, ', "note": null, "parts": [{"name": "c", "size": 2}]}'))
    )
    rows = docs.select("doc_id", structured(text, ddl).alias("r"))
    return rows.select("doc_id", "r.value.lang", "r.value.n_chars", F.when(F.col("r.value").isNotNull(), F.size("r.value.parts")).cast("long").alias("n_parts"), "r.reason")


_PAIR_LIMIT = 64


@query(f"""WITH {_LEXICAL}, t AS (SELECT h.question_id, h.chunk_id, h.rank, {_tok("b.text")} AS q, {_tok("d.text")} AS d FROM hits h JOIN benchmark b ON b.item_id = h.question_id JOIN documents d ON d.doc_id = h.chunk_id),
n AS (SELECT *, len(q) AS a, len(d) AS b FROM t),
c AS (SELECT *, CASE WHEN a + b <= {_PAIR_LIMIT} THEN a WHEN b <= {_PAIR_LIMIT} // 2 THEN {_PAIR_LIMIT} - b WHEN a <= {_PAIR_LIMIT} // 2 THEN a ELSE {_PAIR_LIMIT} // 2 END AS x FROM n),
s AS (SELECT question_id, chunk_id, rank, list_distinct(q[1:x]) AS q, list_distinct(d[1:least(b, {_PAIR_LIMIT} - x)]) AS d FROM c),
p AS (SELECT question_id, chunk_id, rank, round(CAST(len(list_intersect(q, d)) AS DOUBLE) / CAST(len(list_distinct(list_concat(q, d))) AS DOUBLE), 6) + 0.0 AS rerank_score FROM s)
SELECT question_id, chunk_id, rank, row_number() OVER (PARTITION BY question_id ORDER BY rerank_score DESC, rank) AS new_rank, rerank_score FROM p""")
def rerank_truncated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-ranking by a pair scorer on the executors that takes query and document together up to a number of tokens, the longer side cut first."""
    _, _, hits = _lexical(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    score = models.pair_scores(F.col("question"), F.col("content"), lambda: models.OverlapScorer(_PAIR_LIMIT, models.normal_tokens))
    pairs = hits.join(asked, "question_id").withColumn("pair_score", F.round(score, 6) + F.lit(0.0))
    return dataset.rerank(pairs, F.col("pair_score")).select("question_id", "chunk_id", "rank", "new_rank", "rerank_score")


_SIX = ("token_f1", "passage_coverage", "passage_f1", "doc_coverage", "doc_precision", "retrieval_time")


@query(f"""WITH {_LEXICAL}, {_TOKEN_METRICS}, {_PASSAGE_METRICS},
dm AS (SELECT question_id, k, count(rank) AS got, count(*) FILTER (WHERE path = 'src0') AS own FROM g LEFT JOIN hits USING (question_id) WHERE rank <= k OR rank IS NULL GROUP BY 1, 2),
dd AS (SELECT question_id, k, CASE WHEN coalesce(own, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS doc_coverage, {_div("coalesce(own, 0)", "coalesce(got, 0)")} AS doc_precision, CAST(question_id % 7 AS DOUBLE) / 8 AS retrieval_time FROM g LEFT JOIN dm USING (question_id, k))
SELECT k, count(*) AS num_questions, {", ".join(f"round(avg({m}), 6) + 0.0 AS {m}_avg" for m in _SIX)} FROM tm JOIN pm USING (question_id, k) JOIN dd USING (question_id, k) GROUP BY k""")
def six_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison table of six metrics for each k; the times that questions carry are made of their ids."""
    questions, references, hits = _lexical(spark, sf_dir)
    timed = questions.withColumn("retrieval_time", (F.col("question_id") % 7).cast("double") / 8)
    results = evaluation.evaluate(timed, references, hits, LEXICAL_KS, THRESHOLD)
    return rounded(evaluation.summary(results, LEXICAL_KS, list(_SIX)), *(f"{m}_avg" for m in _SIX))


@query(f"""WITH w AS (SELECT unnest(list_filter(list_transform({_words("text")}, lambda w: regexp_replace(w, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}.]+$', '', 'g')), lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]'))) AS word FROM documents),
k AS (SELECT regexp_replace(regexp_replace(lower(word), '[.]+$', ''), '^[-+]?\\p{{N}}[\\p{{N}}.,]*$', '#') AS kind, word LIKE '%.' AS stopped FROM w),
c AS (SELECT kind, count(*) FILTER (WHERE stopped) AS with_stop, count(*) FILTER (WHERE NOT stopped) AS without_stop FROM k GROUP BY 1),
t AS (SELECT CAST(sum(with_stop) AS DOUBLE) / CAST(sum(with_stop + without_stop) AS DOUBLE) AS p FROM c),
s AS (SELECT kind, with_stop, without_stop, p, length(replace(kind, '.', '')) AS letters, length(kind) - length(replace(kind, '.', '')) + 1 AS stops FROM c, t WHERE with_stop > 0 AND regexp_matches(kind, '\\p{{L}}'))
SELECT kind, with_stop, without_stop, round(2.0 * (with_stop * ln({sentences.STOPPED}::DOUBLE) + without_stop * ln(1.0 - {sentences.STOPPED}::DOUBLE) - with_stop * ln(p) - without_stop * ln(1.0 - p)) * exp(-letters) * stops * pow(CAST(letters AS DOUBLE), -without_stop), 4) + 0.0 AS score FROM s""")
def abbreviation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every word that has a full stop somewhere: how often with and without, and how likely it is an abbreviation."""
    scores = sentences.abbreviation_scores(staged(sentences.counted(_docs(spark, sf_dir)), "word-pairs"))
    return scores.withColumn("score", F.round("score", 4) + F.lit(0.0))
