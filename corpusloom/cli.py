"""Command line: python -m corpusloom.cli evaluate|generate|update|chunk|ingest|index --config FILE [--dry-run]."""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import models
from .functions import text as T
from .operators import chunking, dataset, evaluation, numbering
from .operators.retrieval import Collection
from .session import quoted, share_package, staged
from .sources import io

log = logging.getLogger("corpusloom")
#: Models by the name that a configuration gives; a deployment adds its own.
EMBEDDERS = {"hash": models.HashEmbedder}
INSTRUCTIONS = "Ask one question that the text answers, and quote the passages that answer it word for word, as JSON with the keys question and references."


def evaluate(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """Metrics of a question set over a collection, per question and per k.

    A question that can't be embedded, or whose vector is none of the collection's, is left out of every k, logged, and listed in `failed` beside the results.
    Each question carries the time of its own embedding (`questions_per_call` of them share a call) and an equal share of the search, which is one for all.
    """
    # numbered once and written, as all that follows goes by these numbers
    qa = staged(io.qa_dataset(spark, c.input).withColumn("question_id", F.monotonically_increasing_id()), "questions")
    points = spark.table(quoted(c.collection))
    asked = staged(models.embedded(qa.select("question_id", "question", "file_path"), "question", "query_vector", lambda: EMBEDDERS[c.embedder](c.dim), c.questions_per_call, dim=c.dim), "queries")
    queries = asked.where("error is null").select(F.col("question_id").alias("query_id"), "query_vector")
    n, started = max(1, queries.count()), time.monotonic()
    found = staged(Collection(c.collection, c.dim).search(points, queries, max(c.k_values), c.score_floor), "found")
    retrieval_time = (time.monotonic() - started) / n
    hits = found.join(points, "vec_id").select(F.col("query_id").alias("question_id"), "rank", F.col("vec_id").alias("chunk_id"), F.coalesce("file_path", F.lit("")).alias("path"), F.col("content"), "score")
    questions = asked.select("question_id", F.col("file_path").alias("gold_path"), "error", F.col("seconds").alias("embedding_time"), F.lit(retrieval_time).alias("retrieval_time"))
    references = qa.select("question_id", F.posexplode("references").alias("no", "r")).select("question_id", F.concat_ws("/", "question_id", "no").alias("reference_id"), F.col("r.text").alias("text"))
    results = evaluation.evaluate(questions, references, hits, list(c.k_values), c.fuzzy_threshold)
    summary = evaluation.summary(results, list(c.k_values))
    report(summary)
    failed = evaluation.failed(questions).join(qa.select("question_id", "question"), "question_id")
    if n_failed := failed.count():
        log.warning("%d questions failed and are left out", n_failed)
    if dry_run:
        return True
    written = io.save_json(results, c.output + "/results", c.overwrite) and io.save_json(summary, c.output + "/summary", c.overwrite)
    return written and (not n_failed or io.save_json(failed, c.output + "/failed", c.overwrite))


def generate(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """A question set from sampled documents, references validated against their chunks; no pairs is a failure.

    Documents are asked batch by batch. A batch's pairs are written to a folder of its own, named after the documents that it asks, and then, beside
    the output (in `-asked`), those documents: a run that broke off goes on where it stopped, and a batch that it broke off in is asked
    again and replaced, never doubled. With `overwrite` it starts anew.
    """
    docs = numbering.seeded_sample(io.documents(spark, c.input), "file_path", c.sample_documents, c.seed).withColumn("doc_id", F.xxhash64("file_path"))
    asked_at, n = c.output.rstrip("/") + "-asked", docs.count()
    if c.overwrite and not dry_run:
        io.remove(spark, c.output)
        io.remove(spark, asked_at)
    if io.exists(spark, asked_at):
        docs = io.resume(docs, spark.read.schema("file_path string").json(asked_at), "file_path")
    docs = staged(docs.withColumn("batch", F.pmod("doc_id", F.lit(c.batches))), "sample")
    of_batch = {r.batch: r.name for r in docs.groupBy("batch").agg(F.hex(F.bit_xor(F.xxhash64("file_path", F.lit("batch")))).alias("name")).collect()}  # a row for each batch
    chunks = staged(dataset.numbered_chunks(spark.table(quoted(c.collection)).select("file_path", "content", F.col("vec_id").alias("chunk_id"))), "chunks")
    found = None
    for batch, name in sorted(of_batch.items()):
        some = docs.where(F.col("batch") == batch).drop("batch")
        pairs = staged(dataset.generate_pairs(some, chunks, INSTRUCTIONS, c.fuzzy_threshold), "pairs")
        if not dry_run:
            pairs.write.mode("overwrite").json(f"{c.output}/batch={batch}-{name}")
            some.select("file_path").write.mode("overwrite").json(f"{asked_at}/batch={batch}-{name}")
        found = pairs if found is None else found.unionByName(pairs)
    if not dry_run and io.exists(spark, c.output):
        found = io.qa_dataset(spark, c.output)
    if found is None:
        return False
    log.info("%s", dataset.generation_stats(n, found).first().asDict())
    return not found.isEmpty()


def update(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """Rename paths and merge metadata, with any keys, into a collection's payload: in place, or into another collection that `output` names."""
    points = spark.table(quoted(c.collection))
    metadata = io.open_metadata(spark, c.input + "/metadata.jsonl") if io.exists(spark, c.input + "/metadata.jsonl") else None
    updates = dataset.payload_updates(io.mapping(spark, c.input + "/mapping.json"), metadata, c.match_on)
    log.info("%s", dataset.update_counts(points, updates).first().asDict())
    if not dry_run:
        Collection(c.output, c.dim).write(dataset.merge_payload(points, updates))
    return True


def chunk(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """Chunk records of a JSONL document file, or of the files below `input` that a catalog names.

    Records hold the chunk, its row's columns, the headings above it as Markdown lines, and chunk_no. With a catalog, the paths of files that weren't
    found are written beside the output (in `-skipped`), if there are any, and a run summary is logged. Records stand in the order of rows.
    """
    size, overlap = c.chunk_size, c.overlap
    splitters = {"words": lambda t: chunking.recursive_chunks(t, size, overlap), "sections": lambda t: chunking.section_chunks(t, size)}
    skipped = None
    if c.catalog:
        rows = io.catalog(spark, c.catalog)
        named = rows.columns
        listed = rows.withColumn("at", F.monotonically_increasing_id()) if "at" not in named else rows
        spread = listed.repartitionByRange(spark.sparkContext.defaultParallelism, "at").sortWithinPartitions("at") if "at" not in named else listed
        found, skipped = io.catalog_texts(spark, spread.select(named), c.input)
        docs = found.select("content", F.struct(*(F.col(f"`{n}`") for n in named)).alias("row"))
    else:
        docs = io.documents(spark, c.input).select("content", F.struct("file_path").alias("row"))
    rows = chunking.chunk_rows(docs.withColumn("none", F.lit(None).cast("long")), splitters[c.splitter], "none", "content", keep=("row",))
    row = [F.col("row").getField(f.name).alias(f.name) for f in docs.schema["row"].dataType.fields if f.name not in ("header", "chunk_no")]
    records = rows.select("content", F.struct(*row, T.heading_lines(F.col("headers")).alias("header"), "chunk_no").alias("metadata"))
    if skipped is not None:
        records = staged(records, "records")
        log.info("%s", io.run_summary(records.select("metadata.file_path"), skipped, c.output).first().asDict())
    if dry_run:
        return True
    if skipped is not None:
        io.remove(spark, c.output.rstrip("/") + "-skipped")
        io.save_skipped(skipped, c.output.rstrip("/") + "-skipped")
    return io.save_chunks(records, c.output)


def ingest(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """Embed the chunk records of a JSONL file and write them as a collection, numbered as they are listed: by file and place in it.

    An existing collection is left alone; with `overwrite` it is replaced, with `append` the points are added to it, with ids from its greatest on. Either way the old
    version stands until the new one is whole.
    """
    collection = Collection(c.collection, c.dim)
    there = collection.exists(spark)
    if there and not (c.overwrite or c.append):
        return False
    rows = staged(io.chunk_records(spark, c.input).where("content is not null").withColumn("all", F.lit(0)), "listed")
    base = (spark.table(quoted(c.collection)).agg(F.max("vec_id")).first()[0] if there and c.append else None)
    numbered = numbering.number_rows(rows, "all", ["at"], "vec_id").withColumn("vec_id", F.col("vec_id") + F.lit(0 if base is None else base + 1)).drop("all", "at")
    points = models.embed(numbered, "content", "embedding", lambda: EMBEDDERS[c.embedder](c.dim))
    if not dry_run:
        points = staged(points, "points")
        collection.add(points) if there and c.append else collection.write(points)
    log.info("%s", collection.info(points if dry_run else spark.table(quoted(c.collection))).first().asDict())
    return True


def index(spark: SparkSession, c: io.Config, dry_run: bool) -> bool:
    """A keyword index of a collection by path: of its own, if `output` names the collection, which lookups then use; or a sorted copy with Bloom filters."""
    if not dry_run and c.output == c.collection:
        Collection(c.collection, c.dim).index(spark)
    elif not dry_run:
        io.sorted_by_path(spark.table(quoted(c.collection)), c.output)
    return True


def report(summary) -> None:
    """The summary as a table, a line per k, on the standard output and in the log."""
    rows = [r.asDict() for r in summary.orderBy("k").collect()]  # one row per k
    for row in rows:
        line = "  ".join(f"{name}={value:.4f}" if isinstance(value, float) else f"{name}={value}" for name, value in row.items())
        log.info("%s", line)
        print(line)


COMMANDS = {"evaluate": evaluate, "generate": generate, "update": update, "chunk": chunk, "ingest": ingest, "index": index}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config", required=True)
    parser.add_argument("--dry-run", action="store_true")
    args = parser.parse_args(argv)
    config = io.load_config(args.config, ("input", "output"))
    handlers = [logging.StreamHandler(), *([logging.FileHandler(config.log_file)] if config.log_file else [])]
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers)
    spark = share_package(SparkSession.builder.appName("corpusloom").getOrCreate())
    done = COMMANDS[args.command](spark, config, args.dry_run)
    return 0 if done else 1


if __name__ == "__main__":
    sys.exit(main())
