"""Building question sets, maintaining payloads, rewriting queries and re-ranking hits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import models
from ..functions import text as T
from ..functions.structured import instructions, structured
from .evaluation import fuzzy_pairs
from .numbering import number_rows

QA_REPLY = "oath STRING, question STRING NOT NULL, references ARRAY<STRING> NOT NULL"
WHOLE, TEXTS = {"year": "int", "n_citations": "bigint"}, ("title", "journal", "content")
#: The column of an open entry, that of payload keys without a column of their own, and columns that no payload key reaches.
ENTRY, PAYLOAD, KEPT = "entry", "payload", ("vec_id", "embedding")


# question sets -------------------------------------------------------------------------------------------------


def usable_documents(docs: DataFrame, content: str = "content", path: str = "file_path") -> DataFrame:
    """Rows whose content and path are neither null nor empty."""
    return docs.where((F.col(content) != "") & (F.col(path) != ""))


def numbered_chunks(chunks: DataFrame, path: str = "file_path", order: list[str] | None = None) -> DataFrame:
    """chunk_number from 0 within each path, in the order of ids."""
    return number_rows(chunks, path, order or ["chunk_id"], "chunk_number")


def prompt(context: Column, instructions: str) -> Column:
    """Instructions, a blank line and the context."""
    return F.concat(F.lit(instructions + "\n\n"), F.coalesce(context, F.lit("")))


def context_of(hits: DataFrame, by: str, order: str, content: str) -> DataFrame:
    """(by, context): the hits' texts in rank order under `Document i:` lines, i from 0."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(content).alias("c")))), lambda x: x["c"])
    return hits.groupBy(by).agg(F.array_join(F.transform(texts, lambda c, i: F.concat(F.lit("Document "), i.cast("string"), F.lit(":\n"), F.coalesce(c, F.lit("")), F.lit("\n"))), "").alias("context"))


def parse_reply(reply: Column | str) -> Column:
    """The reply's question and references, fences stripped; null where it is no JSON object with both."""
    return structured(reply, QA_REPLY)["value"]


def ask_structured(df: DataFrame, prompt_col: str, ddl: str, factory: Callable, max_tokens: int = 1500, temperature: float = 0.1) -> DataFrame:
    """df with `value`, the model's reply to a prompt and the schema's instructions as a struct, and `reason` where there is none: of the reply, or the model's error."""
    asked = df.withColumn("full_prompt", F.concat(F.coalesce(F.col(prompt_col), F.lit("")), F.lit("\n\n" + instructions(ddl))))
    replies = models.generate(asked, "full_prompt", "reply", factory, max_tokens, temperature).withColumn("parsed", structured("reply", ddl))
    return replies.select(*df.columns, "reply", "parsed.value", F.coalesce("error", "parsed.reason").alias("reason"))


def validate_references(pairs: DataFrame, chunks: DataFrame, threshold: float) -> DataFrame:
    """pairs (pair_id, file_path, question, references) whose references some chunk of their path holds.

    Kept are pairs with one such reference at least; references become (text, chunk_numbers ascending), and counts of generated, valid and removed ones are added.
    """
    refs = pairs.select("pair_id", "file_path", F.posexplode("references").alias("no", "text")).withColumn("reference_id", F.concat_ws("/", "pair_id", "no"))
    found = fuzzy_pairs(refs.select("reference_id", "text", "file_path"), chunks.select(F.col("chunk_number").alias("chunk_id"), "content", "file_path"), threshold, ["file_path"])
    numbers = found.groupBy("reference_id").agg(F.array_sort(F.collect_list("chunk_id")).alias("chunk_numbers"))
    valid = refs.join(numbers, "reference_id").groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("no", "text", "chunk_numbers"))).alias("r"))
    kept = pairs.withColumn("refs_generated", F.size("references").cast("long")).drop("references").join(valid, "pair_id")
    return kept.withColumn("references", F.transform("r", lambda x: F.struct(x["text"].alias("text"), x["chunk_numbers"].alias("chunk_numbers")))).withColumn("refs_valid", F.size("r").cast("long")).drop("r").withColumn("refs_removed", F.col("refs_generated") - F.col("refs_valid"))


def generate_pairs(docs: DataFrame, chunks: DataFrame, instructions: str, threshold: float = 0.8, factory: Callable = models.QuoteGenerator, max_tokens: int = 1500, temperature: float = 0.1) -> DataFrame:
    """Question-reference pairs of documents (doc_id, file_path, content) that have chunks; documents without are skipped before the model is asked."""
    asked = docs.join(chunks.select("file_path").distinct(), "file_path", "left_semi").withColumn("prompt", prompt(F.col("content"), instructions))
    replies = models.generate(asked, "prompt", "reply", factory, max_tokens, temperature).withColumn("parsed", parse_reply("reply")).where("parsed is not null")
    pairs = replies.select(F.col("doc_id").alias("pair_id"), "file_path", "parsed.question", "parsed.references", T.preview("content").alias("source_document"))
    return validate_references(pairs, chunks, threshold)


def answer(questions: DataFrame, hits: DataFrame, instructions: str, factory: Callable = models.ContextAnswerer, max_tokens: int = 1500, temperature: float = 0.1) -> DataFrame:
    """questions (question_id, question) with `context`, their hits' texts in rank order, and the model's `answer` that is grounded on them.

    Without hits the context is empty; where all tries failed the answer is null and `error` says why.
    """
    context = context_of(hits, "question_id", "rank", "content")
    asked = questions.select("question_id", "question").join(context, "question_id", "left").withColumn("context", F.coalesce("context", F.lit("")))
    shown = F.concat(F.lit(instructions + "\n\n"), F.col("context"), F.lit("\nQuestion: "), F.coalesce("question", F.lit("")))
    return models.generate(asked.withColumn("prompt", shown), "prompt", "answer", factory, max_tokens, temperature).drop("prompt")


def generation_stats(documents: int | Column, pairs: DataFrame) -> DataFrame:
    """One row: documents, pairs, skipped, references generated, valid and removed, and the two rates (0 without a denominator)."""
    n = documents if isinstance(documents, Column) else F.lit(int(documents))
    total = pairs.agg(F.count(F.lit(1)).alias("pairs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("refs_generated", "refs_valid", "refs_removed"))).withColumn("documents", n.cast("long"))
    return total.select("documents", "pairs", (F.col("documents") - F.col("pairs")).alias("skipped"), "refs_generated", "refs_valid", "refs_removed", T.share(F.col("pairs"), F.col("documents")).alias("success_rate"), T.share(F.col("refs_valid"), F.col("refs_generated")).alias("validity_rate"))


# payloads ------------------------------------------------------------------------------------------------------


def coerced(metadata: DataFrame) -> DataFrame:
    """year and n_citations as whole numbers or null, title, journal and content as text or null, others as they are."""
    fix = lambda c: T.to_whole(F.col(c), WHOLE[c]) if c in WHOLE else F.col(c).cast("string") if c in TEXTS else F.col(f"`{c}`")
    return metadata.select(*(fix(c).alias(c) for c in metadata.columns))


def open_entry(line: Column) -> Column:
    """A JSON object as a map from each key that is there to its value, of any type (VARIANT): a key with null is there, a missing one isn't; of
    repeated keys the last stays; null for what is no JSON object."""
    entries = F.map_entries(F.from_json(line, "map<string,variant>"))
    later = lambda e, i: F.exists(F.slice(entries, i + F.lit(2), F.size(entries)), lambda x: x["key"] == e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~later(e, i)))


def payload_value(entry: Column, key: str, kind: str) -> Column:
    """What an open entry holds for a key, as a payload column takes it: whole numbers truncated toward zero, texts as text (of other values their
    JSON), null where a value is null or no such thing."""
    value = F.element_at(entry, key)
    if key in WHOLE:
        return F.try_variant_get(value, "$", "double").try_cast(kind)
    if kind == "string":
        text = F.try_variant_get(value, "$", "string")
        return F.coalesce(text, F.nullif(F.to_json(value), F.lit("null")))
    return F.try_variant_get(value, "$", kind)


def payload_updates(mapping: DataFrame, metadata: DataFrame | None, match_on: str = "old") -> DataFrame:
    """(match_path, file_path, ...) of a mapping (new_path, old_path) and its metadata, which is found by the old path.

    metadata: (file_path, entry), an open entry of the keys that are there; or plain columns, all of which every row then updates (with
    has_metadata, whether there is a row). match_on="old" looks points up by the old path, "new" by the new one. One pass: no update
    sees another's result. Two new paths for one matched path are refused.
    """
    if match_on not in ("old", "new"):
        raise ValueError("match_on is old or new")
    key = F.col(f"{match_on}_path")
    if not mapping.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"several mappings claim one {match_on} path")
    rows = mapping.select("old_path", key.alias("match_path"), F.col("new_path").alias("file_path"))
    if metadata is None:
        return rows.withColumn("has_metadata", F.lit(False)).drop("old_path")
    if ENTRY in metadata.columns:
        return rows.join(metadata.select(F.col("file_path").alias("old_path"), ENTRY), "old_path", "left").drop("old_path")
    found = coerced(metadata).withColumnRenamed("file_path", "old_path").withColumn("has_metadata", F.lit(True))
    return rows.join(found, "old_path", "left").withColumn("has_metadata", F.coalesce("has_metadata", F.lit(False))).drop("old_path")


def merge_payload(points: DataFrame, updates: DataFrame, kept: tuple[str, ...] = KEPT) -> DataFrame:
    """points with the listed keys overwritten where file_path matches, by null too; all else stays.

    With open entries (`entry`) each row's own keys are listed: a key of a column goes there, but for those `kept` (id and vector), every other key into
    the map `payload`, from key to JSON, whose other keys stay too. With plain columns, new ones are added.
    """
    if ENTRY in updates.columns:
        return _merge_entries(points, updates, kept)
    u = updates.select(*(F.col(c).alias(f"__{c}") for c in updates.columns), F.lit(True).alias("__hit"))
    rows = points.join(u, points["file_path"] == u["__match_path"], "left")
    keys = [c for c in updates.columns if c not in ("match_path", "file_path", "has_metadata")]
    new = {"file_path": F.coalesce("__file_path", "file_path")}
    for c in keys:
        old = F.col(c) if c in points.columns else F.lit(None)
        new[c] = F.when(F.col("__hit") & F.col("__has_metadata"), F.col(f"__{c}")).otherwise(old)
    return rows.select(*(new.pop(c, F.col(c)).alias(c) for c in points.columns), *(v.alias(c) for c, v in new.items()))


def _merge_entries(points: DataFrame, updates: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    # the points' columns in a struct, so that no name of theirs can clash with those of the updates
    u = updates.select(F.col("match_path"), F.col("file_path").alias("new_path"), F.map_filter(ENTRY, lambda k, _: k != "file_path").alias(ENTRY))
    rows = points.select(F.struct(*(F.col(f"`{c}`") for c in points.columns)).alias("p")).join(u, F.col("p.file_path") == F.col("match_path"), "left")
    own = {f.name: f.dataType.simpleString() for f in points.schema.fields if f.name not in (*kept, "file_path", PAYLOAD)}
    there = lambda c: F.coalesce(F.map_contains_key(ENTRY, c), F.lit(False))
    old = lambda c: F.col("p").getField(c)
    new = {c: F.when(there(c), payload_value(F.col(ENTRY), c, kind)).otherwise(old(c)) for c, kind in own.items()}
    new["file_path"] = F.coalesce("new_path", old("file_path"))
    rest = F.transform_values(F.map_filter(ENTRY, lambda k, _: ~k.isin(*own) if own else F.lit(True)), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    before = old(PAYLOAD) if PAYLOAD in points.columns else F.lit(None).cast("map<string,string>")
    none = F.create_map().cast("map<string,string>")
    merged = F.map_concat(F.map_filter(F.coalesce(before, none), lambda k, _: ~F.map_contains_key(rest, k)), rest)
    new[PAYLOAD] = F.when(F.coalesce(F.size(rest) > 0, F.lit(False)), merged).otherwise(before)
    columns = [*points.columns, *([] if PAYLOAD in points.columns else [PAYLOAD])]
    return rows.select(F.struct(*((new[c] if c in new else old(c)).alias(c) for c in columns)).alias("r")).select("r.*")


def update_counts(points: DataFrame, updates: DataFrame) -> DataFrame:
    """Dry run: mappings processed, those without points included, and points that would change."""
    per = updates.join(points.groupBy(F.col("file_path").alias("match_path")).agg(F.count(F.lit(1)).alias("n")), "match_path", "left")
    return per.agg(F.count(F.lit(1)).alias("mappings_processed"), F.coalesce(F.sum("n"), F.lit(0)).alias("points_updated"))


# conversations -------------------------------------------------------------------------------------------------


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, conversation, last_utterance): the last user turn, and the turns before it as `User: ...` and `Assistant: ...` lines ("" for none).

    Rows of other roles are no part; conversations without a user turn have no row.
    """
    spoken = turns.where(F.col("role").isin("user", "assistant"))
    last = spoken.where("role = 'user'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("l"))
    line = F.concat(F.initcap("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    before = spoken.join(last, "conv_id").where(F.col("turn") < F.col("l.turn")).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n").alias("conversation"))
    return last.join(before, "conv_id", "left").select("conv_id", F.coalesce("conversation", F.lit("")).alias("conversation"), F.col("l.text").alias("last_utterance"))


def rewrite(convs: DataFrame, factory: Callable = models.JoinRewriter, max_tokens: int = 100, temperature: float = 0.1) -> DataFrame:
    """convs with `rewritten`, the model's self-contained form of the last utterance, trimmed; an empty history is shown as [empty]."""
    shown = F.coalesce(F.nullif("conversation", F.lit("")), F.lit("[empty]"))
    asked = convs.withColumn("prompt", F.concat(shown, F.lit("\n\n"), F.coalesce("last_utterance", F.lit(""))))
    return models.generate(asked, "prompt", "rewritten", factory, max_tokens, temperature).withColumn("rewritten", F.trim("rewritten")).drop("prompt")


def multi_turn(convs: DataFrame) -> DataFrame:
    return convs.where("conversation <> ''")


# re-ranking ----------------------------------------------------------------------------------------------------


def rerank(hits: DataFrame, score: Column, k: int | None = None) -> DataFrame:
    """hits (question_id, rank, chunk_id, ...) with rerank_score, new_rank, position_change (old rank - new rank) and direction.

    Equal scores keep their order; chunks of equal text stay apart by their ids. The score is computed once, on the candidates given.
    """
    scored = hits.withColumn("rerank_score", score)
    new = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("rerank_score"), F.asc("rank"))).cast("long")
    out = scored.withColumn("new_rank", new).withColumn("position_change", F.col("rank") - F.col("new_rank"))
    out = out.withColumn("direction", F.when(F.col("position_change") > 0, "up").when(F.col("position_change") < 0, "down").otherwise("same"))
    return out if k is None else out.where(F.col("new_rank") <= k)


def as_hits(reranked: DataFrame) -> DataFrame:
    """Re-ranked rows in the shape of hits: the new rank and score in place of the old."""
    return reranked.withColumn("rank", F.col("new_rank")).withColumn("score", F.col("rerank_score")).drop("new_rank", "rerank_score", "position_change", "direction")


def last_of_content(hits: DataFrame) -> DataFrame:
    """Of a question's hits with equal text only the last by rank, as a lookup by content would leave."""
    last = Window.partitionBy("question_id", "content").orderBy(F.desc("rank"))
    return hits.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
