"""Operator 1, sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards; each shard has a weight, and a subtree the sum of its shards'. A key descends level by
level: every child of the subtree reached draws the arrival time of an exponential race, -ln(u) / weight with u hashed from key and
child, and the least draw goes on, so that each is chosen in proportion to its weight. Only children of chosen subtrees draw. A draw
depends on one child, its weight and the key: where a weight changes, keys move only into or out of the subtrees that hold it,
and all others keep theirs. A shard that is added comes in a region of its own (`grow`), so that no other
subtree's weight changes and keys move only into that shard.

Defined cases: a null key hashes as the text 'null'; a null text has no bytes and the CRC of an empty text; repeated
rows share a shard and get slots of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, staged

#: Hex digits of the hash that make a draw: 52 bits, so that u is exact in a double.
DRAW_DIGITS = 13


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> list[Shard]:
    """Shards of weight 1 in order, filling racks and regions."""
    return [Shard(f"region{i // (per_rack * racks_per_region)}", f"rack{i // per_rack}", i) for i in range(shards)]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree and one more shard, in a region of its own, which takes keys only into itself."""
    n = 1 + max((x.shard for x in tree), default=-1)
    return [*tree, Shard(f"grown{n}", f"grown{n}", n, weight)]


def draw(key: Column, path: Column, weight: Column) -> Column:
    """Arrival time of a subtree for a key."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit("/"), path)
    n = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("double")
    return -F.ln((n + F.lit(0.5)) / F.lit(2.0 ** (4 * DRAW_DIGITS))) / weight


def _children(tree: list[Shard]) -> list[dict[str, dict[str, float]]]:
    """By level: path of a subtree -> path of each of its children -> weight."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for x in tree:
        paths = ["", x.region, f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}"]
        for level, (above, path) in zip(levels, zip(paths, paths[1:], strict=False), strict=True):
            of = level.setdefault(above, {})
            of[path] = of.get(path, 0.0) + float(x.weight)
    return levels


def descend(df: DataFrame, key: str, tree: list[Shard], to: str) -> DataFrame:
    """Add the shard that the key reaches, level by level; the path breaks ties. Shards of weight 0 or less draw nothing."""
    leaves = [x for x in tree if x.weight > 0]
    if not leaves:
        raise ValueError("the tree has no shard of positive weight")
    rows = df.withColumn("__path", F.lit(""))
    for level in _children(leaves):
        entries = [x for above, of in level.items() for x in (F.lit(above), F.array(*(F.struct(F.lit(path).alias("path"), F.lit(weight).alias("weight")) for path, weight in of.items())))]
        drawn = F.transform(F.create_map(*entries)[F.col("__path")], lambda c: F.struct(draw(F.col(key), c["path"], c["weight"]).alias("draw"), c["path"].alias("path")))
        rows = rows.withColumn("__path", F.array_min(drawn)["path"])
    return rows.withColumn(to, F.substring_index("__path", "/", -1).cast("int")).drop("__path")


def with_slots(df: DataFrame, shard: str) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, no shard in one task.

    Rows are numbered within (shard, input split), a group no larger than a split; the counts of these groups, one
    row each, give the offsets. The rows are written first, so that their numbers are the same in both uses.
    """
    rows = staged(df.withColumn("__row", F.monotonically_increasing_id()), "shard-rows").withColumn("__split", F.shiftright("__row", 33))
    before = Window.partitionBy(shard).orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(shard, "__split").agg(F.count(F.lit(1)).alias("__n")).select(shard, "__split", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy(shard, "__split").orderBy("__row"))
    return rows.withColumn("__within", within).join(offsets, [shard, "__split"]).withColumn("slot", (F.col("__offset") + F.col("__within") - 1).cast("long")).drop("__row", "__split", "__within", "__offset")


def shard_documents(docs: DataFrame, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (by the tree `grown`) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = own_columns(docs, "doc_id", "text").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = descend(rows, "doc_id", tree, "shard")
    rows = descend(rows, "doc_id", grown, "grown_shard") if grown else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return with_slots(rows, "shard").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.col("grown_shard").cast("int").alias("grown_shard"))
