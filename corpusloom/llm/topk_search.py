"""Operator 8, exact top-k inner products by an impact-ordered index, read a score at a time.

Vectors are put into blocks. In a block each dimension's components are quantised linearly into at most LEVELS impacts, and the
postings of a dimension, sorted by impact, fall into segments: the ids of the vectors of one dimension and impact. For a query a
segment's impact is the most that its vectors gain there over the worst that the dimension holds: the query's component times the segment's
greatest value (least, where the component is negative), less that of the worst. Segments of all dimensions are processed by
descending impact, in PORTIONS of equally many postings; every posting adds its segment's impact to its vector's accumulator.
After each portion a vector's score is at most its accumulator and the greatest impacts that are left in each dimension, and at least its
accumulator less what quantising may have added. The k-th best of the least scores is the floor; processing stops only
when it proves that all but a few vectors stay below it, or all is read. Possible members, all whose greatest score
reaches the floor, are rescored exactly from their integer components.

Every vector is indexed once for each block of QUERY_BLOCK queries; a pair of blocks is one unit of work and keeps its k best, and
these are merged per query. Nothing is broadcast, and neither side is gathered in one task.

Defined cases: vectors that are null or hold null or non-finite components, or rows without an id, take no part; empty
vectors take no part either; a query is compared with vectors of its own length only; ties go to the smaller id; repeated ids are
candidates each, but never of a query of the same id; components so large that sums may leave the whole numbers that
doubles hold are all rescored, with numbers of any size, and scores beyond 64 bits stay at their ends; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns

#: Impacts of a dimension in a block.
LEVELS = 128
#: Vectors and queries in a block; a pair of blocks is one unit of work.
BLOCK, QUERY_BLOCK = 4096, 4096
#: Portions of the postings after which the bounds are checked.
PORTIONS = 8
#: Possible members that are rescored rather than narrowed further: this many times k, or this share of the block.
FEW, FEW_SHARE = 4, 0.02
#: Sums up to here are exact in doubles.
EXACT = 1 << 53


class ImpactIndex:
    """A block's postings by dimension and impact; all numbers are whole and stay exact in doubles."""

    def __init__(self, ids, vectors, levels: int = LEVELS) -> None:
        import numpy as np

        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.size = int(np.abs(vectors.astype(float)).max(initial=0)) * dims
        if self.size > EXACT:
            return
        low = vectors.min(0)
        level = (vectors - low) // ((vectors.max(0) - low) // levels + 1)
        order = np.argsort(level, axis=0, kind="stable")
        #: postings of all segments, a dimension after the other, and where each segment begins
        self.postings = order.T.ravel().astype(np.int32)
        held = (level + np.arange(dims) * levels).ravel()
        count = np.bincount(held, minlength=dims * levels)
        least, most = np.full(dims * levels, np.iinfo(np.int64).max), np.full(dims * levels, np.iinfo(np.int64).min)
        np.minimum.at(least, held, vectors.ravel())
        np.maximum.at(most, held, vectors.ravel())
        there = np.flatnonzero(count)
        self.begins, self.count = (np.cumsum(count) - count)[there], count[there]
        self.dim, self.least, self.most = there // levels, least[there].astype(float), most[there].astype(float)

    def possible(self, query, k: int, allowed) -> tuple:
        """(vectors that may be among the k best, portions read)."""
        import numpy as np

        weight = query.astype(float)[self.dim]
        up = weight >= 0
        best, poorest = np.where(up, self.most, self.least) * weight, np.where(up, self.least, self.most) * weight
        dims = len(query)
        worst = np.full(dims, np.inf)
        np.minimum.at(worst, self.dim, poorest)
        impact = best - worst[self.dim]
        #: what quantising adds to a score at most
        slack = np.zeros(dims)
        np.maximum.at(slack, self.dim, best - poorest)
        ranked = np.argsort(-impact, kind="stable")
        cut = np.searchsorted(np.cumsum(self.count[ranked]), len(self.postings) * np.arange(1, PORTIONS) / PORTIONS, side="left") + 1
        total = np.zeros(len(self.ids))
        for portion, some in enumerate(np.split(ranked, np.minimum(cut, len(ranked))), 1):
            count = self.count[some]
            ends = np.cumsum(count)
            at = np.repeat(self.begins[some] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
            total += np.bincount(self.postings[at], np.repeat(impact[some], count), len(self.ids))
            impact[some] = -1.0  # read
            left = np.zeros(dims)
            np.maximum.at(left, self.dim, np.maximum(impact, 0.0))
            floor = np.partition(total[allowed], -k)[-k] - slack.sum()
            found = np.flatnonzero((total + left.sum() >= floor) & allowed)
            if len(found) <= max(FEW * k, FEW_SHARE * len(self.ids)):
                break
        return found, portion

    def search(self, queries, k: int, owns) -> list[tuple]:
        """Ids and scores of the k best for each integer query; its own id is left out. All, if fewer."""
        import numpy as np

        out = []
        for query, own in zip(queries, owns, strict=True):
            allowed = self.ids != own
            most = min(k, int(allowed.sum()))
            if not most:
                out.append((self.ids[:0], self.ids[:0]))
                continue
            span = int(np.abs(query.astype(float)).max()) * self.size
            found = self.possible(query, most, allowed)[0] if span <= EXACT and self.size <= EXACT else np.flatnonzero(allowed)
            if span <= EXACT:
                scores = self.vectors[found] @ query
            else:
                whole = [sum(a * b for a, b in zip(v, query.tolist(), strict=True)) for v in self.vectors[found].tolist()]
                scores = np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in whole], np.int64)
            best = np.lexsort((self.ids[found], ~scores))[:most]
            out.append((self.ids[found][best], scores[best]))
        return out


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, q): integer components floor(scale * x) of the vectors that take part."""
    v = F.col("v")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = own_columns(vectors, id_col, vector_col).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).select("vec_id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("q"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Both (vec_id, q array<long>): each query's k highest integer inner products over all vectors but those of its own id.

    Blocks are dealt by hash of the row's id and number, their count following the tables' sizes, so that no id or value makes one large.
    """
    n_vectors, n_queries = vectors.count(), queries.count()
    v_blocks, q_blocks = max(1, -(-n_vectors // block)), max(1, -(-n_queries // query_block))
    spread = lambda n: F.pmod(F.xxhash64("vec_id", F.col("q")), F.lit(n)).cast("int")
    # every vector goes once to each block of queries; every query once to each block of vectors
    left = vectors.withColumn("vb", spread(v_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumn("is_query", F.lit(False))
    right = queries.withColumn("qb", spread(q_blocks)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)))).withColumn("is_query", F.lit(True))

    def unit(frame):
        import numpy as np
        import pandas as pd

        found = []
        size = frame["q"].map(len)
        for _, same in frame.groupby(size):
            stored, asked = same[~same["is_query"]], same[same["is_query"]]
            if len(stored) and len(asked):
                index = ImpactIndex(stored["vec_id"].to_numpy(np.int64), np.array(stored["q"].tolist(), np.int64))
                hits = index.search(np.array(asked["q"].tolist(), np.int64), k, asked["vec_id"].tolist())
                found += [pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}) for own, (ids, scores) in zip(asked["vec_id"], hits, strict=True)]
        return pd.concat(found) if found else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})

    partial = left.unionByName(right).groupBy("vb", "qb").applyInPandas(unit, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
