"""Row numbers within groups of any size, picks by number, and seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def number_rows(df: DataFrame, group: str, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Number each group's rows by `order` (which must tell rows apart), without one task per group.

    Rows are dealt by ranges of (group, order), so a large group spans many tasks, and written once with the number of their range:
    dealt anew, they might fall into other ranges. They are numbered within a range, and the counts of each (group, range),
    a few numbers, give the offsets.
    """
    dealt = staged(df.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("__group"), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))
    rows = dealt.withColumn("__within", within)
    joined = rows.join(offsets, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn(name, (F.col("__offset") + F.col("__within") - 1 + start).cast("long")).drop("__part", "__n", "__group", "__p", "__offset", "__within")


def pick_rows(df: DataFrame, order: list[str], at: list[int]) -> DataFrame:
    """Rows by their number from 0 in an order that tells rows apart, with the number as `row_no`; numbers beyond the table pick nothing."""
    numbered = number_rows(df.withColumn("__all", F.lit(0)), "__all", order, "row_no")
    return numbered.where(F.col("row_no").isin([int(i) for i in at])).drop("__all")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """min(n, rows) rows without replacement, the same for the same seed and keys: the first by a hash of seed and key."""
    return df.withColumn("__order", F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")))).orderBy("__order", key).limit(n).drop("__order")
