"""Operator 11, hard negatives by product quantisation with stored residual norms.

A codebook per pair of dimensions (SUBSPACE) is fitted on a bounded sample. Every vector is stored with its codes and, for
each subspace, the norm of what its centroid leaves. For an anchor, a table of inner products with all centroids
gives a vector's score by lookups, and the sum over the subspaces of the anchor's norm times the residual's bounds what that score may be off by.

1. Positives: among the vectors of the anchor's label, those whose greatest possible score reaches the k-th of the least possible ones
   are rescored from their whole numbers, and the first ones stay.
2. Negatives: each positive opens a window of scores. A vector of another label is a candidate of a window if its possible scores
   meet the window and reach the k-th least score of those that lie surely inside; the exact whole-number rerank of the candidates completes each
   window. Nothing is left out by the filter: it only proves.

Vectors and anchors are dealt into blocks, a pair of which is one unit of work that keeps each window's first ones; these are merged. Neither
side is broadcast or gathered, but for the codebook, whose size depends on dimension alone. Where the codebook knows no vectors
of a dimension (none of it in the sample), all codes stand for zero and the norms are the vectors' own: the bounds still hold.

Defined cases: rows without an id or label, and vectors that are null, empty or hold null or non-finite components take no part; a row of the
anchor's own id is no other row; repeated rows are candidates each, and anchors each; vectors meet those of their own dimension only; ties
go to the smaller id; an anchor without positives, and a positive whose window holds nothing (always so where its score is negative),
have no rows; components so large that sums may leave the whole numbers that doubles hold are rescored with
numbers of any size, and scores beyond 64 bits stay at their ends; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, staged

#: Dimensions of a subspace, centroids of each, rows that the codebook is fitted on at most, and rounds of fitting.
SUBSPACE, CENTROIDS, FIT_ROWS, FIT_ROUNDS = 2, 256, 8192, 6
#: Vectors and anchors in a block, and anchors scored at a time.
BLOCK, ANCHOR_BLOCK, AT_A_TIME = 8192, 1024, 64
#: Sums up to here are exact in doubles.
EXACT = 1 << 53
HITS = "anchor long, positive_no int, positive_id long, positive_score long, vec_id long, score long"


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, shifted: int | None = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, q): whole components floor(scale * x) of the rows that take part; where `shifted` divides the id, the label is first moved on by one, modulo `labels`."""
    v = F.col("v")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = own_columns(vectors, id_col, vector_col, label_col).toDF("vec_id", "v", "label").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    moved = F.col("label") if shifted is None else F.when(F.col("vec_id") % shifted == 0, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label"))
    return rows.select("vec_id", moved.alias("label"), F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("q"))


def _split(vectors):
    """Vectors (n, d) by subspaces (n, s, SUBSPACE), the last filled up with zeros."""
    import numpy as np

    n, d = vectors.shape
    s = -(-d // SUBSPACE)
    out = np.zeros((n, s * SUBSPACE))
    out[:, :d] = vectors
    return out.reshape(n, s, SUBSPACE)


def _nearest(points, centroids):
    """The nearest centroid of each point, by parts of the points."""
    import numpy as np

    half = (centroids * centroids).sum(1) / 2
    return np.concatenate([np.argmax(points[i : i + 4096] @ centroids.T - half, 1) for i in range(0, len(points), 4096)]).astype(np.uint8)


def fitted(sample):
    """Whole centroids (s, CENTROIDS, SUBSPACE) of a sample (n, d), at first spread over it, then moved to their points' means some rounds."""
    import numpy as np

    parts, books = _split(sample), []
    for s in range(parts.shape[1]):
        points = parts[:, s]
        order = np.lexsort(points.T)
        book = points[order[np.linspace(0, len(points) - 1, CENTROIDS).astype(int)]]
        for _ in range(FIT_ROUNDS):
            at = _nearest(points, book)
            count = np.bincount(at, minlength=CENTROIDS)
            sums = np.stack([np.bincount(at, points[:, c], CENTROIDS) for c in range(SUBSPACE)], 1)
            book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
        books.append(np.rint(book))
    return np.stack(books)


def codebooks(vectors: DataFrame) -> dict[int, object]:
    """dimension -> centroids, fitted in one task on the FIT_ROWS rows whose hashes come first; a book is some hundred KB."""

    def of(frame):
        import numpy as np
        import pandas as pd

        return pd.DataFrame([(int(d), fitted(np.array(same["q"].tolist(), float)).tobytes()) for d, same in frame.groupby(frame["q"].map(len))], columns=["d", "book"])

    sample = vectors.select("vec_id", "q").orderBy(F.xxhash64("vec_id", "q"), "vec_id").limit(FIT_ROWS)
    rows = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(of, "d int, book binary").collect()

    def array(r):
        import numpy as np

        return np.frombuffer(r.book).reshape(-(-r.d // SUBSPACE), CENTROIDS, SUBSPACE)

    return {r.d: array(r) for r in rows}


def coded(vectors: DataFrame, books: dict[int, object]) -> DataFrame:
    """vectors with codes, a byte for each subspace, and the norms of the residuals there; and `row`, a number of its own for each row."""

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            codes, norms = [None] * batch.num_rows, [None] * batch.num_rows
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            whole = batch.column(2).flatten().to_numpy().astype(float)
            begins = np.cumsum(sizes) - sizes
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                rest = _split(whole[begins[at][:, None] + np.arange(d)])
                code = np.zeros(rest.shape[:2], np.uint8)
                if (book := books.get(d)) is not None:
                    code = np.stack([_nearest(rest[:, s], book[s]) for s in range(len(book))], 1)
                    rest = rest - book[np.arange(len(book)), code]
                norm = np.nextafter(np.sqrt((rest * rest).sum(2)).astype(np.float32), np.float32(np.inf))
                for i, c, n in zip(at.tolist(), code, norm, strict=True):
                    codes[i], norms[i] = c.tobytes(), n.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), pa.array(norms, pa.binary())], names=["vec_id", "label", "q", "codes", "norms"])

    return vectors.select("vec_id", "label", "q").mapInArrow(of, "vec_id long, label long, q array<long>, codes binary, norms binary").withColumn("row", F.monotonically_increasing_id())


class Quantised:
    """A block's vectors of one dimension, and the bounds of their scores."""

    def __init__(self, frame, book) -> None:
        import numpy as np

        self.ids, self.labels = frame["vec_id"].to_numpy(np.int64), frame["label"].to_numpy(np.int64)
        self.vectors = np.array(frame["q"].tolist(), np.int64)
        n, self.book = len(frame), book
        self.codes = np.frombuffer(b"".join(frame["codes"]), np.uint8).reshape(n, -1).T.astype(np.intp)
        self.norms = np.frombuffer(b"".join(frame["norms"]), np.float32).reshape(n, -1).astype(float)
        self.most = np.abs(self.vectors.astype(float)).max(1) * self.vectors.shape[1]

    def bounds(self, anchors):
        """(score by lookups, what it may be off by) of anchors (a, d) with all vectors."""
        import numpy as np

        parts = _split(anchors.astype(float))
        score = np.zeros((len(anchors), len(self.ids)))
        if self.book is not None:
            table = np.einsum("asd,scd->sac", parts, self.book)
            for own, codes in zip(table, self.codes, strict=True):
                score += own.take(codes, axis=1)
        return score, (np.sqrt((parts * parts).sum(2)) @ self.norms.T) * (1 + 1e-9) + 1e-3

    def exact(self, at, anchor):
        """Whole scores of the vectors `at`."""
        import numpy as np

        big = self.most[at] * float(np.abs(anchor.astype(float)).max()) > EXACT
        scores = np.zeros(len(at), np.int64)
        scores[~big] = self.vectors[at[~big]] @ anchor
        whole = anchor.tolist()
        scores[big] = [min(max(sum(a * b for a, b in zip(v, whole, strict=True)), -(1 << 63)), (1 << 63) - 1) for v in self.vectors[at[big]].tolist()]
        return scores

    def first(self, anchor, score, slack, allowed, k: int, windows: list[tuple[int, int]]) -> list:
        """(vectors, scores) of the first k of each window [low, high] among the allowed ones."""
        import numpy as np

        span = float(np.abs(anchor.astype(float)).max())
        freak = self.most * span > EXACT  # lookups prove nothing there
        low, high = score - slack, score + slack
        found = []
        for least, most in windows:
            sure = allowed & (low >= least) & (high <= most) & ~freak
            floor = least
            if np.count_nonzero(sure) >= k:
                floor = max(floor, np.partition(low[sure], -k)[-k])
            found.append(np.flatnonzero(allowed & ((high >= floor) & (low <= most) | freak)))
        every = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        scores, out = self.exact(every, anchor), []
        for (least, most), some in zip(windows, found, strict=True):
            own = scores[np.searchsorted(every, some)]
            inside = np.array([least <= s <= most for s in own.tolist()], bool)
            some, own = some[inside], own[inside]
            best = np.lexsort((self.ids[some], ~own))[:k]
            out.append((some[best], own[best]))
        return out


def _units(rows: DataFrame, anchors: DataFrame, blocks, anchor_blocks) -> DataFrame:
    """Vectors once for each block of anchors, anchors once for each block of vectors; both counts are columns of either side."""
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    stored = rows.withColumn("vb", dealt(blocks)).withColumn("ab", every(anchor_blocks)).withColumn("asked", F.lit(False)).withColumn("windows", F.lit(None).cast("array<struct<no:int,id:long,score:long>>"))
    asked = anchors.withColumn("ab", dealt(anchor_blocks)).withColumn("vb", every(blocks)).withColumn("asked", F.lit(True))
    names = ["row", "vec_id", "label", "q", "codes", "norms", "windows", "asked", "vb", "ab"]
    return stored.select(names).unionByName(asked.select(names))


def _searched(units: DataFrame, keys: list[str], k: int, books: dict[int, object], negatives: tuple[int, int] | None) -> DataFrame:
    """HITS of every unit: the first k of the anchor's label, or with `negatives` (percentages) of each window among other labels."""

    def of(frame):
        import numpy as np
        import pandas as pd

        out = []
        for d, same in frame.groupby(frame["q"].map(len)):
            stored, asked = same[~same["asked"]], same[same["asked"]]
            if not len(stored) or not len(asked):
                continue
            block, whole = Quantised(stored, books.get(d)), np.array(asked["q"].tolist(), np.int64)
            rows, ids, labels, windows = (asked[c].tolist() for c in ("row", "vec_id", "label", "windows"))
            for i in range(0, len(asked), AT_A_TIME):
                scores, slacks = block.bounds(whole[i : i + AT_A_TIME])
                for j, (score, slack) in enumerate(zip(scores, slacks, strict=True), i):
                    if negatives is None:
                        opened = [(0, 0, 0)]
                        limits, allowed = [(-(1 << 63), (1 << 63) - 1)], (block.labels == labels[j]) & (block.ids != ids[j])
                    else:
                        opened = [(int(w["no"]), int(w["id"]), int(w["score"])) for w in windows[j]]
                        limits, allowed = [(-(-negatives[0] * s // 100), negatives[1] * s // 100) for _, _, s in opened], block.labels != labels[j]
                    for (no, positive, s), (at, got) in zip(opened, block.first(whole[j], score, slack, allowed, k, limits), strict=True):
                        out += [(rows[j], no, positive, s, i, x) for i, x in zip(block.ids[at].tolist(), got.tolist(), strict=True)]
        names = [c.split()[0] for c in HITS.split(", ")]
        return pd.DataFrame(dict(zip(names, np.array(out, np.int64).reshape(-1, len(names)).T, strict=True))).astype({"positive_no": "int32"})

    return units.groupBy(*keys, "vb", "ab").applyInPandas(of, HITS)


def _ranked(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("vec_id"))).cast("int")
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of rows (vec_id, label, q) of `prepared`.

    is_anchor: a condition on them. Of other labels count those whose score lies between `least` and `most` percent of the positive's.
    """
    books = codebooks(vectors)
    rows = staged(coded(vectors, books), "coded")
    n = lambda size: F.ceil(F.count(F.lit(1)) / size).cast("int")
    anchors = rows.where(is_anchor)
    # a label's rows and anchors are dealt into as many blocks as they need, so that no label makes one large
    per = staged(rows.groupBy("label").agg(n(block).alias("vn"), F.ceil(F.count_if(is_anchor) / anchor_block).cast("int").alias("an")).where("an > 0"), "labels")
    own = _units(rows.join(per, "label"), anchors.join(per, "label").withColumn("windows", F.lit(None).cast("array<struct<no:int,id:long,score:long>>")), F.col("vn"), F.col("an"))
    found = _ranked(_searched(own, ["label"], positives, books, None), ["anchor"], positives)
    windows = found.where("score >= 0").groupBy("anchor").agg(F.collect_list(F.struct(F.col("rank").alias("no"), F.col("vec_id").alias("id"), "score")).alias("windows"))
    asked = staged(anchors.join(windows.withColumnRenamed("anchor", "row"), "row"), "asked")
    whole = (F.lit(max(1, -(-df.count() // size))) for df, size in ((rows, block), (asked, anchor_block)))
    hits = _ranked(_searched(_units(rows, asked, *whole), [], negatives, books, (least, most)), ["anchor", "positive_no"], negatives)
    ids = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hits.join(ids, "anchor").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
