"""Collections of vectors and exact cosine retrieval.

Search is exact: queries and vectors are dealt into blocks, each pair of blocks is one matrix product in numpy, keeps
its k best, and these are ranked per query. Neither side is broadcast or gathered; work per task is bounded by the blocks.
"""

from __future__ import annotations

import urllib.parse
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import children, delete, quoted

#: Vectors and queries of a block: a vector is shuffled once for each block of queries; and queries whose scores are held at a time.
VECTORS_PER_BLOCK, QUERIES_PER_BLOCK, AT_A_TIME = 8192, 4096, 128
#: Scores are ranked and reported at this many decimals, ties by id.
DECIMALS = 6


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; 0 where one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, floor: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding", skip_own: bool = True) -> DataFrame:
    """query_id, rank (from 1), the vector's id and score: each query's k best, at or above the floor.

    queries: (query_id, query_vector). With skip_own a vector of the query's id is no hit. Rows without an id, and vectors that are null or
    hold null or non-finite components, take no part on either side; a vector without length scores 0; a query meets vectors of its own dimension only.
    """
    v = taking_part(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")))
    q = taking_part(queries.select(F.col("query_id").cast("long").alias("id"), F.col("query_vector").cast("array<double>").alias("v")))
    v_blocks, q_blocks = max(1, -(-v.count() // VECTORS_PER_BLOCK)), max(1, -(-q.count() // QUERIES_PER_BLOCK))
    dealt = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = v.withColumn("vb", dealt(v_blocks)).withColumn("qb", every(q_blocks)).withColumn("asked", F.lit(False))
    right = q.withColumn("qb", dealt(q_blocks)).withColumn("vb", every(v_blocks)).withColumn("asked", F.lit(True))

    def best(frame):
        import numpy as np
        import pandas as pd

        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        unit = lambda m: m / np.where((n := np.sqrt((m * m).sum(1, keepdims=True))) > 0, n, 1.0)
        for _, same in frame.groupby(frame["v"].map(len)):
            asked, stored = same[same["asked"]], same[~same["asked"]]
            if not len(asked) or not len(stored):
                continue
            b, ids, queries = unit(np.array(stored["v"].tolist())).T, stored["id"].to_numpy(np.int64), asked["id"].to_numpy(np.int64)
            for i in range(0, len(asked), AT_A_TIME):
                own = queries[i : i + AT_A_TIME]
                scores = np.round(unit(np.array(asked["v"].tolist()[i : i + AT_A_TIME])) @ b, DECIMALS) + 0.0
                fit = np.ones(scores.shape, bool) if floor is None else scores >= floor
                if skip_own:
                    fit &= ids != own[:, None]
                if len(ids) > k:  # all that tie with the k-th stay, and are ranked below
                    held = np.where(fit, scores, -np.inf)
                    fit &= held >= np.partition(held, len(ids) - k, 1)[:, len(ids) - k, None]
                q, at = np.nonzero(fit)
                order = np.lexsort((ids[at], -scores[q, at], q))
                q, at = q[order], at[order]
                first = np.arange(len(q)) - np.searchsorted(q, q) < k
                found.append((own[q[first]], ids[at[first]], scores[q[first], at[first]]))
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    hits = left.unionByName(right).groupBy("vb", "qb").applyInPandas(best, "query_id long, id long, score double")
    return ranked(hits, "query_id", [F.desc("score"), F.asc("id")], k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def taking_part(rows: DataFrame) -> DataFrame:
    """Rows (id, v) with an id and finite components only."""
    return rows.where(F.col("id").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))


def ranked(hits: DataFrame, by: str, order: list, k: int, name: str = "rank") -> DataFrame:
    """The k first of each group by an order that tells rows apart, with their rank from 1."""
    return hits.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")).where(F.col(name) <= k)


def sign_bits(c: Column) -> Column:
    """Signs of all components as the bits of longs, 64 to each: bit i of long w is set where component 64 w + i is positive."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", one, i)).otherwise(none)
    words = F.sequence(F.lit(0), F.greatest(F.floor((F.array_size(c) - 1) / 64).cast("int"), F.lit(0)) + F.array_size(c) * 0)  # null for null
    return F.transform(words, lambda w: F.aggregate(F.transform(F.slice(c, w * 64 + 1, 64), bit), none, lambda s, b: s.bitwiseOR(b)))


def hamming(a: Column, b: Column) -> Column:
    """Signs that differ; where one has fewer components, the missing ones count as not positive."""
    none = F.lit(0).cast("long")
    apart = F.zip_with(a, b, lambda x, y: F.bit_count(F.coalesce(x, none).bitwiseXOR(F.coalesce(y, none))).cast("long"))
    return F.aggregate(apart, none, lambda s, n: s + n)


def hamming_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and distance: each query's k nearest by signs, ties by id; a prefilter for exact rescoring.

    Both (vec_id, bits). As in cosine_top_k both are dealt into blocks, and each pair of blocks keeps its k nearest, so that no pair becomes a row.
    """
    v, q = vectors.where("vec_id is not null and bits is not null"), queries.where("vec_id is not null and bits is not null")
    v_blocks, q_blocks = max(1, -(-v.count() // VECTORS_PER_BLOCK)), max(1, -(-q.count() // QUERIES_PER_BLOCK))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "bits"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = v.select("vec_id", "bits").withColumn("vb", dealt(v_blocks)).withColumn("qb", every(q_blocks)).withColumn("asked", F.lit(False))
    right = q.select("vec_id", "bits").withColumn("qb", dealt(q_blocks)).withColumn("vb", every(v_blocks)).withColumn("asked", F.lit(True))

    def nearest(frame):
        import numpy as np
        import pandas as pd

        asked, stored = frame[frame["asked"]], frame[~frame["asked"]]
        found = [(np.zeros(0, np.int64),) * 3]
        width = max([len(b) for b in frame["bits"]], default=0)
        packed = lambda rows: np.array([[*b, *(0,) * (width - len(b))] for b in rows["bits"]], np.int64).reshape(len(rows), width)
        bits, ids = packed(stored), stored["vec_id"].to_numpy(np.int64)
        for query, own in zip(asked["vec_id"].tolist(), packed(asked), strict=True):
            distance = np.bitwise_count((bits ^ own).view(np.uint64)).sum(1, dtype=np.int64)
            at = np.flatnonzero(ids != query)
            if len(at) > k:  # all that tie with the k-th stay, and are ranked below
                at = at[distance[at] <= np.partition(distance[at], k - 1)[k - 1]]
            at = at[np.lexsort((ids[at], distance[at]))][:k]
            found.append((np.full(len(at), query), ids[at], distance[at]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "distance"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    pairs = left.unionByName(right).groupBy("vb", "qb").applyInPandas(nearest, "query_id long, vec_id long, distance long")
    return ranked(pairs, "query_id", [F.asc("distance"), F.asc("vec_id")], k)


def quantized_search(points: DataFrame, queries: DataFrame, k: int, oversampling: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k * oversampling nearest by signs, rescored by the exact cosine. queries: (query_id, query_vector)."""
    signs = lambda df, i, v: df.select(F.col(i).alias("vec_id"), sign_bits(F.col(v)).alias("bits"))
    near = hamming_top_k(signs(points, id_col, vector_col), signs(queries, "query_id", "query_vector"), k * oversampling).select("query_id", "vec_id")
    stored = points.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = queries.select("query_id", F.col("query_vector").cast("array<double>").alias("q"))
    scored = near.join(stored, "vec_id").join(asked, "query_id").select("query_id", "vec_id", (F.round(cosine(F.col("v"), F.col("q")), DECIMALS) + F.lit(0.0)).alias("score"))
    return ranked(scored, "query_id", [F.desc("score"), F.asc("vec_id")], k).select("query_id", "rank", "vec_id", "score")


@dataclass(frozen=True)
class Collection:
    """A table of points (id, vector, payload columns) with a fixed dimension and the cosine distance.

    Whatever is written goes to files of its own, a version, below `versions` (the warehouse's folder of that name without it); only when they are whole
    does the table's location move there. So points may be computed from the collection that they replace, and a run that fails or is killed on the
    way leaves the version before. That one is kept for readers under way, older ones are deleted.
    """

    name: str
    dim: int
    id_col: str = "vec_id"
    vector_col: str = "embedding"
    versions: str = ""

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def create(self, points: DataFrame, buckets: int = 8) -> None:
        """Write as a table bucketed and sorted by id, with dimension and distance among its properties; vectors of another dimension, and an existing table, are refused."""
        if self.exists(points.sparkSession):
            raise ValueError(f"{self.name} exists")
        self.write(points, buckets)

    def write(self, points: DataFrame, buckets: int = 8, tries: int = 3) -> None:
        """Make points the collection's content. A version that fails to be written is tried anew, beside what Spark does for its tasks; the last failure is raised."""
        self.check(points)
        spark = points.sparkSession
        for left in reversed(range(tries)):
            at, draft = f"{self.root(spark)}/v-{uuid.uuid4().hex}", quoted(self.name, f"__{uuid.uuid4().hex}")
            try:
                points.write.bucketBy(buckets, self.id_col).sortBy(self.id_col).option("path", at).option("dim", self.dim).option("distance", "cosine").saveAsTable(draft)
                break
            except Exception:  # whatever it was, the version is no good
                delete(spark, at)
                if not left:
                    raise
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {draft}")  # its files stay
        self._swap(spark, points.schema, at, buckets)

    def _swap(self, spark: SparkSession, schema: StructType, at: str, buckets: int) -> None:
        """Point the table to a version. Columns that it lacks are added first, which old files can do without; where types, bucketing or lost columns forbid that, the table is made anew."""
        name = quoted(self.name)
        before = None
        if self.exists(spark):
            before = self.location(spark)
            old = {f.name: f.dataType for f in spark.table(name).schema.fields}
            more = [f for f in schema.fields if f.name not in old]
            if all(any(f.name == c and f.dataType == kind for f in schema.fields) for c, kind in old.items()) and self.described(spark).get("Num Buckets") == str(buckets):
                if more:
                    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{at}'")
            else:
                spark.sql(f"DROP TABLE {name}")
        if not self.exists(spark):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (dim '{self.dim}', distance 'cosine') CLUSTERED BY (`{self.id_col}`) SORTED BY (`{self.id_col}`) INTO {buckets} BUCKETS LOCATION '{at}'")
        spark.catalog.refreshTable(name)
        for path in children(spark, self.root(spark)):
            if path.rsplit("/", 1)[-1] not in {x.rstrip("/").rsplit("/", 1)[-1] for x in (at, before or "")}:
                delete(spark, path)

    def root(self, spark: SparkSession) -> str:
        return f"{self.versions or spark.conf.get('spark.sql.warehouse.dir') + '/versions'}/{self.name}"

    def described(self, spark: SparkSession) -> dict[str, str]:
        return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {quoted(self.name)}").collect()}

    def location(self, spark: SparkSession) -> str:
        """The folder of the version that the table shows."""
        return self.described(spark)["Location"]

    def check(self, points: DataFrame) -> None:
        if not points.where((F.size(self.vector_col) != self.dim) | F.col(self.vector_col).isNull()).isEmpty():
            raise ValueError(f"{self.name} takes vectors of {self.dim} components only")

    def restore(self, spark: SparkSession, snapshot: str) -> bool:
        """Load a Parquet snapshot if the table is missing; whether it was loaded."""
        if self.exists(spark):
            return False
        self.create(spark.read.parquet(snapshot))
        return True

    def upsert(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """old with new points added, those of an id in new replaced; of repeated new ids the last by all columns stays."""
        last = new.groupBy(self.id_col).agg(F.max_by(F.struct(*new.columns), F.to_json(F.struct(*new.columns))).alias("p")).select("p.*")
        return old.join(last, self.id_col, "left_anti").unionByName(last)

    def add(self, new: DataFrame, tries: int = 3) -> None:
        """Upsert points into the table, as its next version; columns that either lacks are null there."""
        spark = new.sparkSession
        if not self.exists(spark):
            last = new.groupBy(self.id_col).agg(F.max_by(F.struct(*new.columns), F.to_json(F.struct(*new.columns))).alias("p")).select("p.*")
            return self.write(last, tries=tries)
        old = spark.table(quoted(self.name))
        wide = lambda df, other: df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})
        columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
        return self.write(self.upsert(wide(old, new).select(columns), wide(new, old).select(columns)), tries=tries)

    def drop(self, spark: SparkSession) -> None:
        """The table and all its versions."""
        spark.sql(f"DROP TABLE IF EXISTS {quoted(self.name)}")
        delete(spark, self.root(spark))

    def info(self, points: DataFrame) -> DataFrame:
        """points_count, dim and how many are off the dimension."""
        return points.agg(F.count(F.lit(1)).alias("points_count"), F.max(F.size(self.vector_col)).cast("long").alias("dim"), F.count_if(F.size(self.vector_col) != self.dim).alias("off_dim"))

    def search(self, points: DataFrame, queries: DataFrame, k: int = 10, floor: float | None = 0.3, skip_own: bool = False) -> DataFrame:
        return cosine_top_k(points, queries, k, floor, self.id_col, self.vector_col, skip_own)

    def index(self, spark: SparkSession, field: str = "file_path") -> None:
        """A keyword index of the version that the table shows, beside its files: a copy in ranges of the field, sorted, and a table of the least and the greatest value of each
        of its files. It goes when its version goes. What is null has no entry."""
        at = self._index_at(spark, field)
        rows = spark.table(quoted(self.name)).where(F.col(field).isNotNull())
        rows.repartitionByRange(field, self.id_col).sortWithinPartitions(field).write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{field}", "true").parquet(f"{at}/rows")
        ends = spark.read.parquet(f"{at}/rows").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(field).alias("least"), F.max(field).alias("most"))
        ends.write.mode("overwrite").parquet(f"{at}/files")  # written last: an index without it is none

    def _index_at(self, spark: SparkSession, field: str) -> str:
        return f"{self.location(spark).rstrip('/')}/_by_{field}"

    def indexed(self, spark: SparkSession, field: str) -> bool:
        """Whether the version that the table shows has an index of the field."""
        return any(c.rstrip("/").endswith("/files") for c in children(spark, self._index_at(spark, field)))

    def lookup(self, spark: SparkSession, field: str, values: list) -> DataFrame:
        """Points whose field is one of some values. With an index only the files that may hold one are opened; without, the table is scanned."""
        points = spark.table(quoted(self.name))
        found = F.col(field).isin(list(values))
        if not self.indexed(spark, field):
            return points.where(found)
        at = self._index_at(spark, field)
        may = F.lit(False)
        for value in values:
            may = may | (F.col("least") <= F.lit(value)) & (F.col("most") >= F.lit(value))
        # as many files as values, and one more for each value that spans several
        files = sorted(urllib.parse.unquote(r.file) for r in spark.read.parquet(f"{at}/files").where(may).select("file").collect())
        return spark.read.schema(points.schema).parquet(*files).where(found) if files else points.limit(0)

    def keyword(self, points: DataFrame, field: str, value: object) -> DataFrame:
        """Points whose payload field equals a value; the comparison is pushed to the scan."""
        return points.where(F.col(field) == F.lit(value))
