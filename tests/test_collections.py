"""Collections that are written to, open payloads, and the commands that go from stored files to points."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.functions import models
from corpusloom.operators import chunking
from corpusloom.operators import dataset as D
from corpusloom.operators.retrieval import Collection
from corpusloom.sources import io

POINT = "vec_id long, embedding array<float>, file_path string, content string, year int, title string, payload map<string,string>"


@pytest.fixture
def collection(spark, tmp_path):
    """A collection of its own for each test, three points of two paths."""
    name = f"points_{random.randrange(10**9)}"
    c = Collection(name, 2)
    rows = [(1, [1.0, 0.0], "o1", "text one", 1990, "old", {"kept": '"k"'}), (2, [0.0, 1.0], "o1", "text two", 1991, "old", None), (3, [1.0, 1.0], "o2", "text three", 1992, None, None)]
    c.create(spark.createDataFrame(rows, POINT))
    yield c
    c.drop(spark)


def rows_of(spark, c):
    return {r.vec_id: r for r in spark.table(c.name).collect()}


def configured(tmp_path, **settings):
    at = tmp_path / f"{random.randrange(10**9)}.yaml"
    at.write_text("".join(f"{k}: {v}\n" for k, v in settings.items()))
    return str(at)


def given(tmp_path, mapping, *lines):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in/mapping.json").write_text(json.dumps(mapping))
    (tmp_path / "in/metadata.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return f"{tmp_path}/in"


def test_update_changes_only_the_keys_that_are_there(spark, tmp_path, collection):
    """In place; unknown keys arrive with their type; vectors and ids are out of reach."""
    at = given(tmp_path, {"new1": "o1", "gone2": "gone"}, {"file_path": "o1", "title": "Lost"}, "{oops", {"file_path": "o1", "title": "T", "doi": "10.1/x", "n": 3, "tags": ["a", {"b": None}], "vec_id": 7, "embedding": "no"})
    assert cli.main(["update", "--config", configured(tmp_path, input=at, output=collection.name, collection=collection.name, dim=2)]) == 0
    got = rows_of(spark, collection)
    one = got[1]
    assert (one.file_path, one.content, one.year, one.title, list(one.embedding)) == ("new1", "text one", 1990, "T", [1.0, 0.0])
    assert {k: json.loads(v) for k, v in one.payload.items()} == {"kept": "k", "doi": "10.1/x", "n": 3, "tags": ["a", {"b": None}], "vec_id": 7, "embedding": "no"}
    assert (got[2].content, got[2].year, got[2].title) == ("text two", 1991, "T") and json.loads(got[2].payload["doi"]) == "10.1/x"
    assert tuple(got[3])[2:] == ("o2", "text three", 1992, None, None)
    # an explicit null overwrites, here and in the map; what has no such value is null; a key given again takes the old one's place
    at = given(tmp_path, {"new1": "new1"}, {"file_path": "new1", "title": None, "year": "2019.9", "doi": None, "n": "text"})
    assert cli.main(["update", "--config", configured(tmp_path, input=at, output=collection.name, collection=collection.name, dim=2)]) == 0
    one = rows_of(spark, collection)[1]
    assert (one.title, one.year, one.content) == (None, 2019, "text one")
    assert {k: json.loads(v) for k, v in one.payload.items()} == {"kept": "k", "doi": None, "n": "text", "tags": ["a", {"b": None}], "vec_id": 7, "embedding": "no"}


def test_update_dry_run_and_other_output(spark, tmp_path, collection):
    at = given(tmp_path, {"n": "o2"}, {"file_path": "o2", "year": 2001})
    other = collection.name + "_other"
    assert cli.main(["update", "--dry-run", "--config", configured(tmp_path, input=at, output=collection.name, collection=collection.name, dim=2)]) == 0
    assert rows_of(spark, collection)[3].file_path == "o2"
    assert cli.main(["update", "--config", configured(tmp_path, input=at, output=other, collection=collection.name, dim=2)]) == 0
    assert rows_of(spark, collection)[3].file_path == "o2" and {r.vec_id: r.year for r in spark.table(other).collect()}[3] == 2001
    assert Collection(other, 2).described(spark)["Num Buckets"] == "8"
    Collection(other, 2).drop(spark)


@pytest.mark.parametrize("value, year, title", [(2019.9, 2019, "2019.9"), ("-3.7", -3, "-3.7"), ("n/a", None, "n/a"), (None, None, None), (True, 1, "true"), ([1], None, "[1]"), ("", None, ""), (10**12, None, str(10**12))])
def test_values_of_any_type(spark, value, year, title):
    points = spark.createDataFrame([("p", 5, "t")], "file_path string, year int, title string")
    mapping = spark.createDataFrame([("p", "p")], "new_path string, old_path string")
    entry = spark.createDataFrame([("p", json.dumps({"year": value, "title": value}))], "file_path string, line string").select("file_path", D.open_entry(F.col("line")).alias("entry"))
    got = D.merge_payload(points, D.payload_updates(mapping, entry)).first()
    assert (got.year, got.title, got.payload) == (year, title, None)


def test_merge_on_odd_rows(spark):
    """No entry, null paths, clashing column names, repeated points, empty tables."""
    points = spark.createDataFrame([("p", 1, 2, 3), (None, 1, 2, 3), ("p", 1, 2, 3), ("q", 1, 2, 3)], "file_path string, match_path int, entry int, new_path int")
    mapping = spark.createDataFrame([("p2", "p"), ("q", "q")], "new_path string, old_path string")
    entry = spark.createDataFrame([("p", '{"entry": 9, "file_path": "p", "other": 1, "other": 2}')], "file_path string, line string").select("file_path", D.open_entry(F.col("line")).alias("entry"))
    got = D.merge_payload(points, D.payload_updates(mapping, entry))
    assert [tuple(r) for r in got.orderBy("file_path").collect()] == [(None, 1, 2, 3, None), *[("p2", 1, 9, 3, {"other": "2"})] * 2, ("q", 1, 2, 3, None)]
    assert D.merge_payload(points.limit(0), D.payload_updates(mapping, entry)).count() == 0 and D.merge_payload(points, D.payload_updates(mapping, entry).limit(0)).count() == 4
    lines = ["[1]", "{", "", "3", None, '{"a": {"a": 1}}']
    assert [r.e for r in spark.createDataFrame([(x,) for x in lines], "t string").select(F.map_keys(D.open_entry(F.col("t"))).alias("e")).collect()] == [None] * 5 + [["a"]]


def test_a_run_that_breaks_off_leaves_the_old_version(spark, tmp_path, collection, monkeypatch):
    new = spark.createDataFrame([(3, [5.0, 5.0], "o3", "new", 1, "x", None), (4, [0.0, 2.0], "o4", "four", 1, "x", None)], POINT)
    before = rows_of(spark, collection)
    with monkeypatch.context() as m:
        m.setattr(Collection, "_swap", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))  # between write and swap
        with pytest.raises(KeyboardInterrupt):
            collection.add(new)
    assert rows_of(spark, collection) == before
    broken = new.withColumn("title", F.raise_error(F.lit("bad row")).cast("string"))
    tried = []
    monkeypatch.setattr(Collection, "check", lambda self, points: tried.append(1))
    with pytest.raises(Exception, match="bad row"):  # in the middle of the write, each time it is tried
        collection.add(broken, tries=2)
    assert rows_of(spark, collection) == before
    collection.add(new)
    after = rows_of(spark, collection)
    assert sorted(after) == [1, 2, 3, 4] and after[3].content == "new" and after[1] == before[1]


def test_versions_before_the_last_are_deleted(spark, collection):
    from corpusloom.session import children

    seen = set()
    for i in range(4):
        collection.add(spark.createDataFrame([(10 + i, [1.0, 0.0], "p", "c", 1, "t", None)], POINT))
        seen.add(collection.location(spark))
    assert len(seen) == 4 and len(children(spark, collection.root(spark))) == 2 and spark.table(collection.name).count() == 7
    # a column more keeps the table; a column less, or another type, makes it anew
    collection.add(spark.createDataFrame([(20, [1.0, 0.0], "extra")], "vec_id long, embedding array<float>, journal string"))
    got = rows_of(spark, collection)
    assert got[20].journal == "extra" and got[20].content is None and got[1].journal is None and got[1].content == "text one"
    collection.write(spark.createDataFrame([(1, [1.0, 0.0], 5)], "vec_id long, embedding array<float>, content long"), buckets=4)
    assert [tuple(r) for r in spark.table(collection.name).collect()] == [(1, [1.0, 0.0], 5)] and collection.described(spark)["Num Buckets"] == "4"
    with pytest.raises(ValueError):
        collection.write(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>"))
    with pytest.raises(ValueError, match="exists"):
        collection.create(spark.table(collection.name))


def test_an_index_opens_only_the_files_that_it_needs(spark, tmp_path, monkeypatch):
    name = f"points_{random.randrange(10**9)}"
    c = Collection(name, 2)
    rows = [(i, [1.0, 0.0], None if i % 50 == 7 else f"dir {i % 40}/%{i % 40}.txt", f"text {i}") for i in range(2000)]
    c.create(spark.createDataFrame(rows, "vec_id long, embedding array<float>, file_path string, content string"))
    want = lambda paths: sorted(r[0] for r in rows if r[2] in paths)
    paths = ["dir 3/%3.txt", "dir 31/%31.txt", "nowhere"]
    scanned = c.lookup(spark, "file_path", paths)
    assert not c.indexed(spark, "file_path") and sorted(r.vec_id for r in scanned.collect()) == want(paths)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "10")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert cli.main(["index", "--config", configured(tmp_path, input="x", output=name, collection=name, dim=2)]) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert c.indexed(spark, "file_path") and spark.table(name).count() == 2000  # the index is no part of the table
    for some in (paths, paths[:1], ["nowhere", "zzz"], [], [paths[0]] * 2):
        got = c.lookup(spark, "file_path", some)
        assert sorted(r.vec_id for r in got.collect()) == want(some) and len(got.inputFiles()) <= 2 * len(set(some))
    everything = len(spark.read.parquet(f"{c.location(spark)}/_by_file_path/rows").inputFiles())
    assert everything >= 8
    c.add(spark.createDataFrame([(5000, [1.0, 0.0], paths[0], "new")], "vec_id long, embedding array<float>, file_path string, content string"))
    assert not c.indexed(spark, "file_path")  # another version: the old index is no longer asked
    assert sorted(r.vec_id for r in c.lookup(spark, "file_path", paths).collect()) == [*want(paths), 5000]
    c.drop(spark)


NAMES = ["plain.txt", "a b.txt", "100%.txt", "50%25.txt", "größe 漢字.txt", "deep/er/x#y?.txt", "plus+and&.txt"]


def test_catalog_reads_just_the_listed_files(spark, tmp_path):
    root = tmp_path / "store"
    for i, name in enumerate(NAMES):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f'"text {i}\\nmore"', encoding="utf-8")
    (root / "unlisted.bin").write_bytes(b"\xff\xfe no text")  # would fail if it were read
    (root / "folder").mkdir()
    listed = [(n, i) for i, n in enumerate([*NAMES, "gone.txt", "folder", "", None, NAMES[0]])]
    for at in (str(root), f"file://{root}", str(root) + "/"):
        found, missing = io.catalog_texts(spark, spark.createDataFrame(listed, "file_path string, n int").repartition(3), at)
        assert sorted((r.file_path, r.n, r.content) for r in found.collect()) == sorted([(n, i, f"text {i}\nmore") for i, n in enumerate(NAMES)] + [(NAMES[0], len(listed) - 1, "text 0\nmore")])
        assert sorted(r.n for r in missing.collect()) == [7, 8, 9, 10]
    (root / "plain.txt").write_bytes(b"\xff\xfe")
    with pytest.raises(Exception, match="decode"):  # other errors are raised
        io.catalog_texts(spark, spark.createDataFrame(listed, "file_path string, n int"), str(root))
    none, missing = io.catalog_texts(spark, spark.createDataFrame([], "file_path string, n int"), str(root))
    assert none.count() == missing.count() == 0
    with pytest.raises(ValueError, match="content"):
        io.catalog_texts(spark, spark.createDataFrame([("a", "b")], "file_path string, content string"), str(root))


def test_large_files_are_passed_on_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "FETCH_BYTES", 10)
    for i in range(7):
        (tmp_path / f"{i}").write_text("x" * i)
    got = io.fetched(spark.createDataFrame([(str(i),) for i in range(9)], "file_path string").coalesce(1), str(tmp_path)).collect()
    assert [(r.file_path, r.content, r.missing) for r in got] == [(str(i), "x" * i if i < 7 else None, i >= 7) for i in range(9)]


def records_of(spark, at):
    return [(r.metadata.file_path, r.metadata.chunk_no, r.content) for r in io._lines(spark, at).orderBy("at").select(F.from_json("value", "content string, metadata struct<file_path: string, chunk_no: long>").alias("r")).select("r.*").collect()]


def test_chunk_keeps_order_and_repeated_paths(spark, tmp_path):
    docs = [("p", "one two three four five"), ("q", "a b c"), ("p", "six seven eight")]
    (tmp_path / "docs.jsonl").write_text("\n".join(json.dumps({"content": t, "metadata": {"file_path": p}}) for p, t in docs))
    at = configured(tmp_path, input=f"{tmp_path}/docs.jsonl", output=f"{tmp_path}/chunks", chunk_size=2)
    assert cli.main(["chunk", "--config", at, "--dry-run"]) == 0 and not (tmp_path / "chunks").exists()
    assert cli.main(["chunk", "--config", at]) == 0
    want = [(p, n, " ".join(t.split()[i : i + 2])) for p, t in docs for n, i in enumerate(range(0, len(t.split()), 2))]
    assert records_of(spark, f"{tmp_path}/chunks") == want


def test_from_a_catalog_to_points(spark, tmp_path):
    """Catalogue columns and headings in the records, the missing ones listed, points numbered as listed, and more added to them."""
    root = tmp_path / "store"
    root.mkdir()
    texts = {"b 1.md": "# Title\nfirst part\n## Under\nsecond part here", "a%.md": "no heading at all", "c.md": "x"}
    for n, t in texts.items():
        (root / n).write_text(t)
    spark.createDataFrame([("b 1.md", "u1", 3), ("none.md", "u2", 4), ("a%.md", None, 5)], "file_path string, url string, n int").coalesce(1).write.parquet(f"{tmp_path}/list.parquet")
    at = configured(tmp_path, input=root, catalog=f"{tmp_path}/list.parquet", output=f"{tmp_path}/chunks", splitter="sections", chunk_size=50)
    assert cli.main(["chunk", "--config", at]) == 0
    got = [r.asDict(True) for r in spark.read.json(f"{tmp_path}/chunks").collect()]
    assert sorted((g["content"], g["metadata"]["file_path"], g["metadata"].get("url"), g["metadata"]["n"], g["metadata"]["header"]) for g in got) == [
        ("# Title\nfirst part", "b 1.md", "u1", 3, ["# Title"]), ("## Under\nsecond part here", "b 1.md", "u1", 3, ["# Title", "## Under"]), ("no heading at all", "a%.md", None, 5, []),
    ]
    assert [r.value for r in spark.read.text(f"{tmp_path}/chunks-skipped").collect()] == ["none.md"]
    name = f"made_{random.randrange(10**9)}"
    first = configured(tmp_path, input=f"{tmp_path}/chunks", output="x", collection=name, dim=8)
    assert cli.main(["ingest", "--config", first]) == 0 and cli.main(["ingest", "--config", first]) == 1
    points = spark.table(name).orderBy("vec_id").collect()
    assert [(r.vec_id, r.file_path, r.content) for r in points] == [(0, "b 1.md", "# Title\nfirst part"), (1, "b 1.md", "## Under\nsecond part here"), (2, "a%.md", "no heading at all")]
    (tmp_path / "more.jsonl").write_text(json.dumps({"content": "added", "metadata": {"file_path": "z"}}))
    assert cli.main(["ingest", "--config", configured(tmp_path, input=f"{tmp_path}/more.jsonl", output="x", collection=name, dim=8, append="true")]) == 0
    assert [(r.vec_id, r.content) for r in spark.table(name).orderBy("vec_id").collect()][2:] == [(2, "no heading at all"), (3, "added")]
    (tmp_path / "bad.jsonl").write_text("{oops")
    with pytest.raises(Exception, match=r"MALFORMED|malformed|FAILFAST"):
        cli.main(["ingest", "--config", configured(tmp_path, input=f"{tmp_path}/bad.jsonl", output="x", collection=name, dim=8, overwrite="true")])
    assert spark.table(name).count() == 4  # what fails leaves the collection
    assert cli.main(["ingest", "--config", configured(tmp_path, input=f"{tmp_path}/more.jsonl", output="x", collection=name, dim=8, overwrite="true")]) == 0
    assert [(r.vec_id, r.content) for r in spark.table(name).collect()] == [(0, "added")]
    Collection(name, 8).drop(spark)


def test_ingest_numbers_lines_as_they_stand(spark, tmp_path):
    lines = [f"w{i} x{i}" for i in random.Random(2).sample(range(500), 500)]
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps({"content": x, "metadata": {"file_path": "p"}}) for x in lines))
    name = f"made_{random.randrange(10**9)}"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # several splits of one file
        assert cli.main(["ingest", "--config", configured(tmp_path, input=f"{tmp_path}/c.jsonl", output="x", collection=name, dim=4)]) == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.content for r in spark.table(name).orderBy("vec_id").collect()] == lines
    Collection(name, 4).drop(spark)


def test_kept_columns_may_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", {"k": 1}), (1, None, None), (None, "", None)], "doc_id long, text string, extra map<string,int>")
    got = chunking.chunk_rows(docs, lambda t: chunking.recursive_chunks(t, 2), keep=("extra",)).collect()
    assert [tuple(r) for r in got] == [(1, 0, "a b", {}, {"k": 1}), (1, 1, "c", {}, {"k": 1}), (None, 0, "", {}, None)]
    with pytest.raises(ValueError, match="content"):
        chunking.chunk_rows(docs.withColumn("content", F.lit(1)), lambda t: [t], keep=("content",))


# failures --------------------------------------------------------------------------------------------------------


class Failing:
    """Fails for texts with `bad` in them, whole calls of them too; gives short vectors for `short`."""

    def __init__(self, dim=4):
        self.dim = dim

    def encode(self, texts):
        import time

        if any("bad" in t for t in texts):
            raise TimeoutError("late")
        time.sleep(sum("slow" in t for t in texts) * 0.05)
        return [[1.0] * (1 if "short" in t else self.dim) for t in texts]


def test_one_failing_text_costs_no_other(spark):
    texts = [f"t{i}" for i in range(40)]
    texts[7], texts[8], texts[31], texts[12], texts[20] = "bad one", "bad two", "short", "slow", None
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").coalesce(1)
    for size in (1, 7, 64):
        got = {r.id: r for r in models.embedded(df, "t", "v", Failing, rows_per_call=size, dim=4).collect()}
        assert {i: r.error for i, r in got.items() if r.error} == {7: "TimeoutError: late", 8: "TimeoutError: late", 31: "ValueError: 1 components instead of 4"}
        assert all((r.v is None) == bool(r.error) and r.seconds >= 0 for r in got.values()) and len(got) == 40
        if size == 1:
            assert got[12].seconds >= 0.05 > got[11].seconds
    assert models.embedded(df.limit(0), "t", "v", Failing).collect() == []
    with pytest.raises(ValueError, match="error"):
        models.embedded(df.withColumn("error", F.lit(1)), "t", "v", Failing)


def test_failing_questions_are_left_out_of_every_k(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(cli.EMBEDDERS, "failing", Failing)
    name = f"made_{random.randrange(10**9)}"
    Collection(name, 4).create(spark.createDataFrame([(i, [1.0] * 4, "p", "alpha beta") for i in range(6)], "vec_id long, embedding array<float>, file_path string, content string"))
    qa = [{"question": q, "file_path": "p", "references": [{"text": "alpha beta", "chunk_numbers": [0]}]} for q in ("good", "bad", "slow one", "short")]
    (tmp_path / "qa.json").write_text(json.dumps(qa))
    assert cli.main(["evaluate", "--config", configured(tmp_path, input=f"{tmp_path}/qa.json", output=f"{tmp_path}/out", collection=name, dim=4, k_values="[1, 3]", embedder="failing")]) == 0
    results = spark.read.json(f"{tmp_path}/out/results").collect()
    assert sorted(r.k for r in results) == [1, 1, 3, 3] and len({r.question_id for r in results}) == 2
    times = {r.question_id: r.embedding_time for r in results}
    assert max(times.values()) >= 0.05 > min(times.values())
    assert sorted((r.question, r.error) for r in spark.read.json(f"{tmp_path}/out/failed").collect()) == [("bad", "TimeoutError: late"), ("short", "ValueError: 1 components instead of 4")]
    assert [(r.k, r.num_questions, r.passage_recall_avg) for r in spark.read.json(f"{tmp_path}/out/summary").orderBy("k").collect()] == [(1, 2, 1.0), (3, 2, 1.0)]
    Collection(name, 4).drop(spark)


def test_a_batch_that_broke_off_is_asked_again_and_not_doubled(spark, tmp_path, monkeypatch):
    name = f"made_{random.randrange(10**9)}"
    lines = [json.dumps({"content": f"Text number {i} is here. More of it.", "metadata": {"file_path": f"p{i}"}}) for i in range(6)]
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    settings = {"input": f"{tmp_path}/c.jsonl", "output": f"{tmp_path}/qa", "collection": name, "dim": 4, "batches": 2}
    assert cli.main(["ingest", "--config", configured(tmp_path, **settings)]) == 0
    writer, n = spark.range(1).write.__class__, []

    def broken(self, path, *a, **b):
        n.append(path)
        if len(n) == 4:  # between the second batch's pairs and its documents
            raise OSError("disk")
        return plain(self, path, *a, **b)

    plain = writer.json
    with monkeypatch.context() as m:
        m.setattr(writer, "json", broken)
        with pytest.raises(OSError):
            cli.main(["generate", "--config", configured(tmp_path, **settings, sample_documents=6)])
    assert len(n) == 4
    for size in (6, 6):
        assert cli.main(["generate", "--config", configured(tmp_path, **settings, sample_documents=size)]) == 0
        assert sorted(r.file_path for r in io.qa_dataset(spark, f"{tmp_path}/qa").collect()) == [f"p{i}" for i in range(6)]
    Collection(name, 4).drop(spark)
