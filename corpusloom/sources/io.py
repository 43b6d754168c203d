"""Readers and writers: JSONL, JSON, text and CSV with explicit schemas and guarded sinks.

Whether a sink's path exists is asked of Hadoop's file system, so that any store that Spark reads will do.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.dataset import open_entry, usable_documents
from ..session import staged

DOCUMENTS = "content STRING, metadata STRUCT<file_path: STRING>"
CHUNKS = "content STRING, metadata STRUCT<file_path: STRING, header: ARRAY<STRING>>"
CONVERSATIONS = "conversation STRING, last_utterance STRING"
QA = "question STRING, file_path STRING, references ARRAY<STRUCT<text: STRING, chunk_numbers: ARRAY<INT>>>, source_document STRING, refs_generated INT, refs_valid INT, refs_removed INT"
#: Characters of texts that are passed on at a time.
FETCH_BYTES = 32 << 20
METADATA = "file_path STRING, year STRING, n_citations STRING, title STRING, journal STRING, content STRING"


# scans ---------------------------------------------------------------------------------------------------------


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(content, file_path) of a JSONL file; a malformed line aborts, rows without content or path are left out."""
    rows = spark.read.schema(DOCUMENTS).option("mode", "FAILFAST").json(path)
    return usable_documents(rows.select("content", F.col("metadata.file_path").alias("file_path")))


def chunk_records(spark: SparkSession, path: str) -> DataFrame:
    """(content, file_path, header, at) of chunk records as JSON lines; `at` tells their order, by file and place in it."""
    rows = _lines(spark, path).where("trim(value) <> ''").select("at", F.from_json("value", CHUNKS, {"mode": "FAILFAST"}).alias("r"))
    return rows.select("r.content", F.col("r.metadata.file_path").alias("file_path"), F.col("r.metadata.header").alias("header"), "at")


def conversations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONVERSATIONS).json(path)


def qa_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Question-reference pairs: a JSON array, JSON lines (a folder of them too), or an object whose values are arrays of pairs, by k; a missing path raises.

    Of an object's arrays only the first key's is read, since all hold the same questions.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if is_folder(spark, path):
        return spark.read.schema(QA).json(path)
    keyed = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,array<struct<{_struct(QA)}>>>").alias("m")).where(F.col("m").isNotNull() & (F.size("m") > 0))
    if not keyed.isEmpty():
        return keyed.select(F.inline(F.map_values("m")[0]))
    return spark.read.option("multiLine", True).schema(QA).json(path)


def _struct(ddl: str) -> str:
    """Fields of a DDL schema as those of a struct type."""
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file or folder, with `at`, which tells their order: by file, then place in it."""
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select("value", order.alias("at"))


def metadata(spark: SparkSession, path: str, schema: str = METADATA) -> DataFrame:
    """JSONL metadata in columns of a schema, tolerantly: malformed lines and lines without file_path are left out, of several for a path the last stays."""
    rows = _lines(spark, path).select("at", F.from_json("value", f"{schema}, _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).where("r._bad is null and r.file_path is not null")
    return rows.groupBy("r.file_path").agg(F.max_by("r", "at").alias("r")).select("r.*").drop("_bad")


def open_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, entry) of JSONL metadata with any keys, as tolerantly: the keys of a path's last line that are there, with their values."""
    rows = _lines(spark, path).select("at", "value", open_entry(F.col("value")).alias("entry"))
    rows = rows.select("at", "value", F.try_variant_get(F.element_at("entry", "file_path"), "$", "string").alias("file_path")).where("file_path is not null")
    # lines are compared, not entries: values of any type have no order
    last = rows.groupBy("file_path").agg(F.max_by("value", "at").alias("value"))
    return last.select("file_path", open_entry(F.col("value")).alias("entry"))


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """The lines that `metadata` leaves out as malformed, for a warning."""
    lines = spark.read.text(path)
    return lines.where(F.from_json("value", f"{METADATA}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull())


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """(new_path, old_path) of a JSON object; of repeated keys the last wins."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    entries = whole.select(F.posexplode("m").alias("at", "new_path", "old_path"))  # repeated keys are entries each
    return entries.groupBy("new_path").agg(F.max_by("old_path", "at").alias("old_path"))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """A table of files to read (file_path, ...): Parquet, CSV with a header, or JSON lines, by the path's ending; any other is Parquet."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.json(path) if kind in ("json", "jsonl") else spark.read.parquet(path)


def fetched(catalog: DataFrame, root: str, encoding: str = "utf-8") -> DataFrame:
    """catalog (file_path, ...) with `content`, the text of each file below a root, and `missing`, whether there is none.

    Executors open just the listed files, through the file system that the root names (a local path, or a URI of a store that pyarrow
    reads); nothing is listed. A path that isn't found, or names a folder, or is null or empty, is missing; any other error is raised. Names are taken as they
    are, whatever their characters. Batches of texts are passed on as soon as they have FETCH_BYTES.
    """
    at, names = catalog.columns.index("file_path"), catalog.columns

    def of(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(root))

        def read(name: str | None) -> str | None:
            if not name or store.get_file_info(path := base.rstrip("/") + "/" + name.lstrip("/")).type != fs.FileType.File:
                return None
            with store.open_input_stream(path) as f:
                return f.read().decode(encoding)

        for batch in batches:
            texts, size, start = [], 0, 0
            for i, name in enumerate(batch.column(at).to_pylist(), 1):
                texts.append(read(name))
                size += len(texts[-1] or "")
                if size >= FETCH_BYTES or i == batch.num_rows:
                    part = batch.slice(start, i - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array([t is None for t in texts], pa.bool_())], names=[*names, "content", "missing"])
                    texts, size, start = [], 0, i

    from pyspark.sql.types import BooleanType, StringType, StructField, StructType

    return catalog.mapInArrow(of, StructType([*catalog.schema.fields, StructField("content", StringType()), StructField("missing", BooleanType())]))


def catalog_texts(spark: SparkSession, catalog: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Texts of the files that a catalog (file_path, ...) names below a root, cleaned; and the catalog rows whose file is missing.

    The files are read once, and what was read is written. Columns of the catalog's own called content or missing are refused.
    """
    if clash := {"content", "missing"} & set(catalog.columns):
        raise ValueError(f"the catalog has columns of its own called {sorted(clash)}")
    rows = staged(fetched(catalog, root), "fetched")
    return rows.where("not missing").drop("missing").withColumn("content", T.cleanup("content")), rows.where("missing").drop("missing", "content")


# sinks ---------------------------------------------------------------------------------------------------------


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_json(df: DataFrame, path: str, overwrite: bool = False) -> bool:
    """Write JSON lines, parents made; an existing path is left alone unless overwrite. Whether it was written."""
    if exists(df.sparkSession, path) and not overwrite:
        return False
    df.write.mode("overwrite").json(path)
    return True


def save_chunks(chunks: DataFrame, path: str) -> bool:
    """Write chunk records as JSON lines in place of what was there; no records leave no path."""
    if chunks.isEmpty():
        remove(chunks.sparkSession, path)
        return False
    return save_json(chunks, path, overwrite=True)


def save_skipped(paths: DataFrame, path: str) -> bool:
    """Write skipped paths as text, if there are any."""
    if paths.isEmpty():
        return False
    paths.select(F.col("file_path").alias("value")).write.mode("overwrite").text(path)
    return True


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sorted_by_path(df: DataFrame, path: str, field: str = "file_path") -> None:
    """A keyword index in Spark's terms: written in ranges of the field, sorted, with a Bloom filter, so that equality prunes files and row groups."""
    df.repartitionByRange(field).sortWithinPartitions(field).write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{field}", "true").parquet(path)


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a run that broke off has not written yet."""
    return todo.join(done.select(key), key, "left_anti")


def skipped_list(skipped: DataFrame, reason: str = "missing") -> DataFrame:
    """(file_path, reason) of the files that a run left out: the list beside the run summary's count, a row each."""
    return skipped.select("file_path", F.lit(reason).alias("reason"))


def run_summary(chunks: DataFrame, skipped: DataFrame, output: str) -> DataFrame:
    """One row: output_file, docs_processed, records_written, n_skipped."""
    made = chunks.agg(F.count_distinct("file_path").alias("docs_processed"), F.count(F.lit(1)).alias("records_written"))
    left = skipped.agg(F.count(F.lit(1)).alias("n_skipped"))
    return made.crossJoin(F.broadcast(left)).select(F.lit(output).alias("output_file"), "docs_processed", "records_written", "n_skipped")  # one row each


# configuration -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Parameters of a run; `required` names must be given."""

    collection: str = ""
    input: str = ""
    output: str = ""
    k_values: tuple = (3, 5, 10, 15, 20)
    score_floor: float = 0.3
    fuzzy_threshold: float = 0.8
    sample_documents: int = 10
    seed: int = 42
    chunk_size: int = 100
    overlap: int = 0
    match_on: str = "old"
    overwrite: bool = False
    append: bool = False
    catalog: str = ""
    splitter: str = "words"
    embedder: str = "hash"
    questions_per_call: int = 1
    dim: int = 384
    batches: int = 8
    log_file: str = ""
    api_key: str = ""
    api_key_env: str = ""


def flattened(raw: dict) -> dict:
    """Settings of a mapping whose sections may be nested; one that is given in two places raises."""
    out: dict = {}
    for key, value in raw.items():
        for k, v in (flattened(value) if isinstance(value, dict) else {key: value}).items():
            if k in out:
                raise ValueError(f"{k} is given twice")
            out[k] = v
    return out


def credential(c: Config) -> str:
    """The model service's key: given, or in the environment variable that is named; one of the two must be there, not both."""
    if bool(c.api_key) == bool(c.api_key_env):
        raise ValueError("give either api_key or api_key_env")
    if not (found := c.api_key or os.environ.get(c.api_key_env, "")):
        raise ValueError(f"the environment has no {c.api_key_env}")
    return found


def load_config(path: str, required: tuple[str, ...] = ()) -> Config:
    """A YAML file, flat or in sections; unknown or missing keys raise. `${NAME}` values come from the environment."""
    import yaml

    raw = flattened(yaml.safe_load(Path(path).read_text()) or {})
    if unknown := set(raw) - {f.name for f in fields(Config)}:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    if missing := [k for k in required if not raw.get(k)]:
        raise ValueError(f"missing settings: {missing}")
    given = {k: os.environ[v[2:-1]] if isinstance(v, str) and v.startswith("${") and v.endswith("}") else v for k, v in raw.items()}
    return Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
