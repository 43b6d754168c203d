import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corpusloom.llm.sharding import Shard, descend, even_tree, grow, shard_documents

from .conftest import key, texts_of


def brute(doc_id, tree):
    """Level by level, in plain Python."""
    path, shards = "", [(f"{x.region}/{x.rack}/{x.shard}".split("/"), x) for x in tree if x.weight > 0]
    for level in range(3):
        names = sorted({"/".join(p[: level + 1]) for p, _ in shards})

        def draw(name, level=level):
            text = f"{'null' if doc_id is None else doc_id}/{name}"
            weight = sum(x.weight for p, x in shards if "/".join(p[: level + 1]) == name)
            return -math.log((int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weight

        path = min(names, key=lambda n: (draw(n), n))
        shards = [(p, x) for p, x in shards if "/".join(p[: level + 1]) == path]
    return shards[0][1].shard


def test_against_brute_force(odd, docs):
    for df in (odd, docs):
        got = shard_documents(df, even_tree(8), grow(even_tree(8))).collect()
        want = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), brute(d, even_tree(8)), brute(d, grow(even_tree(8)))) for d, t in texts_of(df)]
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got), key=key) == sorted(want, key=key)
        slots = defaultdict(list)
        for r in got:
            assert r.law == "key" and r.grown_shard in (r.shard, 8)
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(none):
    assert shard_documents(none, even_tree(8), grow(even_tree(8))).collect() == []


def test_weights_draw_in_proportion_and_confine_movement(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    old = [Shard("a", "r", 0, 1.0), Shard("a", "s", 1, 2.0), Shard("b", "t", 2, 1.0), Shard("b", "t", 3, 0.0)]
    new = [*old[:2], Shard("b", "t", 2, 0.5), Shard("b", "t", 3, 0.0)]
    both = descend(descend(ids, "doc_id", old, "old"), "doc_id", new, "new").collect()
    n = Counter(r.old for r in both)
    assert 3 not in n and abs(n[1] / 20_000 - 0.5) < 0.02
    assert all(r.old == 2 for r in both if r.old != r.new) and any(r.old != r.new for r in both)
    # a weight that changes in one rack moves nothing between the others
    tree = even_tree(16)
    heavier = [Shard(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    moved = {(r.old, r.new) for r in descend(descend(ids, "doc_id", tree, "old"), "doc_id", heavier, "new").collect() if r.old != r.new}
    assert moved and all(new in (4, 5, 6, 7) for _, new in moved)  # into the region that holds it
    assert {new for old, new in moved if old in (4, 5, 6, 7)} <= {4, 5} and {new for old, new in moved if old in (4, 5)} <= {5}


def test_every_shard_that_is_added_takes_rows_only_into_itself(spark):
    ids, tree = spark.range(5_000).withColumnRenamed("id", "doc_id"), even_tree(3)
    for n in range(3, 12):
        more = grow(tree)
        rows = descend(descend(ids, "doc_id", tree, "old"), "doc_id", more, "new").collect()
        assert all(r.new in (r.old, n) for r in rows) and abs(sum(r.new == n for r in rows) / 5_000 - 1 / (n + 1)) < 0.03
        tree = more


def test_slots_over_many_partitions(spark):
    rows = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")).repartition(37)
    slots = defaultdict(list)
    for r in shard_documents(rows, even_tree(8)).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 3_000 and all(sorted(x) == list(range(len(x))) for x in slots.values())
