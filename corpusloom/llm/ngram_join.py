"""Operator 13, n-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

A text's words (A-Z lower-cased, split at ASCII white space) make its set of distinct runs of `words` words, as 64-bit hashes; with fewer
words the whole sequence is its one run. Two sets link at a Jaccard similarity of `percent` or more. Sets that link hold at least that share of
their own size in common, which bounds every step; all bounds are exact, and no pair that may link is left out.

1. Columns are dealt into blocks by ranges of their hashes. A block's task counts, for each document, how many of its n-grams other
   documents hold too. A document less than `percent` of whose n-grams are held elsewhere links with nothing, and is done. Rows
   of equal sets are then one row of the incidence, and the step is repeated on the rest while it thins them out.
2. Two sets that link meet among each one's rarest n-grams, as many as its size leaves (a prefix of an order by frequency). Every row
   first goes to the block of the column of its prefix that most rows have, a bounded number at a time, each time with
   the column's least row; the product of a block with itself accumulates overlaps, column block by column block, rarest first, and drops pairs
   whose overlap and columns to come stay below what their sizes ask for. Of the links only a forest that spans them is written.
3. Rows of columns that hold several components after that are multiplied across components: the largest component's blocks with
   those of all others, and these with one another; rows that hang together by many columns meet once for all of them, others column by
   column, whichever is less. Again only forests become rows; links are joined into components.

Nothing is broadcast but the ids whose sets are asked for, up to MAX_BROADCAST_IDS (near_dedup); no column's or group's rows meet in one task beyond a block.
Rows are told apart by their place in their scan's partition, which is the same each time that a file is read.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; equal sets are one component; a null doc_id
takes part and is passed over where the smallest is taken; repeated rows each get a row; an empty table gives an empty result; extra
columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, staged, tidied
from .near_dedup import _blocks, _full_sets, _groups, _rare_values, components, shingle_set

WORDS, PERCENT = 3, 90
#: Values of a chunk of documents (a document of more is one of its own), its documents, and values of a range of columns, of which there are no more than MAX_RANGES.
CHUNK_VALUES, CHUNK_DOCS, RANGE_VALUES, MAX_RANGES = 1 << 21, 1 << 16, 1 << 20, 1 << 15
#: Rows of a block, and values of their sets; blocks of columns of a product.
BLOCK, VALUES, COLUMN_BLOCKS = 512, 2_000_000, 6
#: While at least this share falls away, rows are thinned out again.
WORTHWHILE = 0.1
PIECE = "range int, chunk long, held binary, ids array<long>, sizes array<int>, nodes array<binary>"
SHARED = "chunk long, ids array<long>, sizes array<int>, nodes array<binary>, doc binary, n binary"
SKETCH = "doc_id long, n_shingles long, node binary, shared long"


def _pieces(rows: DataFrame, set_of: Callable, ranges: int) -> DataFrame:
    """Incidence of rows (doc_id, text or packed set) by chunks of rows and ranges of columns: 64 bits for each entry, 48 of the column and 16 of the row; and each chunk's ids, sizes and digests."""

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()))
        names = [x.split()[0] for x in PIECE.split(", ")]
        partition, number = TaskContext.get().partitionId() << 32, 0

        def chunk_of(ids, sets):
            chunk = partition + number
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            row = np.repeat(np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
            held = np.sort((np.concatenate(sets) & np.uint64(2**64 - CHUNK_DOCS)) | row)
            cut = np.searchsorted(held, np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64))
            parts = [(r, p.tobytes()) for r, p in enumerate(np.split(held, cut)) if len(p)]
            columns = [[r for r, _ in parts] + [-1 - chunk % ranges], [chunk] * (len(parts) + 1), [p for _, p in parts] + [None], *([None] * len(parts) + [x] for x in (ids, [len(s) for s in sets], nodes))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        ids, sets, n = [], [], 0
        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = set_of(content)
                if sets and (n + len(s) > CHUNK_VALUES or len(sets) == CHUNK_DOCS):
                    yield chunk_of(ids, sets)
                    ids, sets, n, number = [], [], 0, number + 1
                ids.append(doc_id), sets.append(s)
                n += len(s)
        if sets:
            yield chunk_of(ids, sets)

    return rows.mapInArrow(tidied(of), PIECE)


def shared_counts(rows: DataFrame, set_of: Callable, ranges: int) -> DataFrame:
    """SKETCH of rows (doc_id, content): the digest of each one's set, and how many of its values rows besides it hold too (at least: of columns whose first 48 bits agree none is told from another)."""

    def in_range(table):
        import numpy as np
        import pyarrow as pa

        names, kinds = [x.split()[0] for x in SHARED.split(", ")], (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.binary(), pa.binary())
        if table["held"].null_count == len(table):  # ids of chunks go on as they are
            return pa.table([table["chunk"], table["ids"], table["sizes"], table["nodes"], pa.nulls(len(table), pa.binary()), pa.nulls(len(table), pa.binary())], names=names)
        held = [np.frombuffer(x, np.uint64) for x in table["held"].to_pylist()]
        chunk = np.repeat(np.arange(len(held)), [len(x) for x in held])
        held = np.concatenate(held)
        order = np.argsort(held >> np.uint64(16), kind="stable")
        column = held[order] >> np.uint64(16)
        same = column[1:] == column[:-1]
        at = order[np.append(same, False) | np.append(False, same)]
        row, n = np.unique((chunk[at] << 16) + (held[at] & np.uint64(CHUNK_DOCS - 1)).astype(np.int64), return_counts=True)
        cut = np.searchsorted(row, np.arange(len(table) + 1) << 16)
        doc, n, chunks = (row & (CHUNK_DOCS - 1)).astype("<i4"), n.astype("<i4"), table["chunk"].to_pylist()
        some = [(chunks[i], None, None, None, doc[a:b].tobytes(), n[a:b].tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if a < b]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*some, strict=True) if some else ((),) * 6, kinds, strict=True)], names=names)

    def of_chunk(table):
        import numpy as np
        import pyarrow as pa

        own = next(i for i, x in enumerate(table["ids"].is_valid().to_pylist()) if x)
        ids, sizes, nodes = (table[c][own].values for c in ("ids", "sizes", "nodes"))
        doc, n = (np.frombuffer(b"".join(x for x in table[c].to_pylist() if x), "<i4") for c in ("doc", "n"))
        shared = np.bincount(doc, n, len(sizes)).astype(np.int64)
        return pa.table([ids, sizes.cast(pa.int64()), nodes, pa.array(shared, pa.int64())], names=[x.split()[0] for x in SKETCH.split(", ")])

    return _pieces(rows, set_of, ranges).groupBy("range").applyInArrow(in_range, SHARED).groupBy("chunk").applyInArrow(of_chunk, SKETCH)


def ranges_for(values: int) -> int:
    return min(MAX_RANGES, max(1, -(-values // RANGE_VALUES)))


def unpacked(content: bytes):
    import numpy as np

    return np.frombuffer(content, np.uint64)


class Incidence:
    """Rows of n-grams, and what they may still gain after each block of columns, rarest columns first."""

    def __init__(self, sets: list) -> None:
        import numpy as np

        self.size = np.array([len(s) for s in sets], np.int64)
        row = np.repeat(np.arange(len(sets)), self.size)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count))
        column = rank[column]
        alone = np.sort(count, kind="stable") == 1
        #: columns of one row add nothing; the others are cut into blocks of about equally many entries
        entries = np.cumsum(np.sort(count, kind="stable"))
        first, whole = int(alone.sum()), int(entries[-1])
        goal = np.linspace(int(alone.sum()), whole, COLUMN_BLOCKS + 1)[1:-1]
        self.edges = np.unique([first, *np.searchsorted(entries, goal), len(count)])
        block = np.searchsorted(self.edges, column, side="right") - 1  # -1: alone
        #: entries by row, and in it by column; by column
        order = np.lexsort((column, row))
        self.columns, self.starts = column[order], np.append(0, np.cumsum(self.size))
        by_column = np.argsort(column, kind="stable")
        self.rows, self.column_ends = row[by_column], np.cumsum(np.bincount(column, minlength=len(count)))
        held = np.bincount(row * (len(self.edges) + 1) + block + 1, minlength=len(sets) * (len(self.edges) + 1)).reshape(len(sets), -1)
        #: values of each row in the blocks after block b
        self.left = self.size[:, None] - np.cumsum(held, 1)[:, 1:]

    def overlaps(self, i: int, allowed, percent: int):
        """(rows, overlaps) of the allowed rows whose overlap with row i is what their sizes ask for."""
        import numpy as np

        total = self.size[i] + self.size
        need = -(-percent * total // (100 + percent))
        at = np.flatnonzero(allowed & (np.minimum(self.size[i], self.size) >= need))
        own, got = self.columns[self.starts[i] : self.starts[i + 1]], np.zeros(len(self.size), np.int64)
        for b, (low, high) in enumerate(zip(self.edges, self.edges[1:], strict=False)):
            if not len(at):
                break
            some = own[np.searchsorted(own, low) : np.searchsorted(own, high)]
            begin = np.where(some > 0, self.column_ends[some - 1], 0)
            count = self.column_ends[some] - begin
            where = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            got += np.bincount(self.rows[where], minlength=len(got))
            at = at[got[at] + np.minimum(self.left[i, b], self.left[at, b]) >= need[at]]
        return at, got[at]


def _product(units: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): of each unit's links across roots, those that join what the unit's earlier ones have not. units: keys, node, root, own, lo, hi, shingles."""

    def of(frame):
        import numpy as np
        import pandas as pd

        frame = frame.drop_duplicates("node").reset_index(drop=True)
        nodes, own = frame["node"].tolist(), frame["own"].to_numpy()
        root = pd.factorize(frame["root"])[0]
        across = frame["lo"].iat[0] != frame["hi"].iat[0]  # pairs within a block are another unit's, or of one root
        incidence = Incidence([np.frombuffer(x, np.uint64) for x in frame["shingles"]])
        joined = np.arange(int(root.max()) + 1)
        before, out = np.arange(len(nodes)), []
        for i in range(1, len(nodes)):
            mine = joined[root]
            allowed = (before < i) & (mine != mine[i])
            if across:
                allowed &= own != own[i]
            at, got = incidence.overlaps(i, allowed, percent)
            for j in at[np.argsort(-got, kind="stable")].tolist():
                x, y = joined[root[i]], joined[root[j]]
                if x != y:
                    joined[joined == x] = y
                    out.append((nodes[i], nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return units.groupBy(*keys).applyInPandas(of, "a binary, b binary")


def _first_units(bands: DataFrame) -> DataFrame:
    """Every row in the column of its prefix that most rows have: blocks of a bounded number, each with the column's least row. (band, own, lo, hi, node, root, size)"""
    many = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    own = bands.join(many, "band").groupBy("node").agg(F.max(F.struct("n", "band")).alias("c"), F.first("size").alias("size")).select(F.col("c.band").alias("band"), "node", "size")
    columns = own.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("values"), F.min(F.struct("node", "size")).alias("hub")).where("n > 1")
    columns = columns.select("band", "hub", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("values") / VALUES)).cast("int").alias("blocks"))
    columns = staged(columns, "columns")
    dealt = own.join(columns.select("band", "blocks"), "band").select("band", "node", "size", F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("own"))
    hubs = columns.select("band", F.col("hub.node").alias("node"), F.col("hub.size").alias("size"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("own"))
    return dealt.unionByName(hubs).select("*", F.col("own").alias("lo"), F.col("own").alias("hi"), F.col("node").alias("root"))


def _later_groups(rest: DataFrame) -> DataFrame:
    """(group, node, root, size): rows of rest (band, node, root, size) so grouped that any two of one column and different roots share a group.

    Rows that hang together by columns are a family. Near copies share many columns, and meet once, as a family, where all its blocks with one another
    are fewer rows than those of all its columns; families that hang together loosely meet by column.
    """
    open_bands = staged(rest.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("values"), F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").drop("a", "b"), "bands")
    mine = staged(rest.join(open_bands.select("band", "hub"), "band"), "mixed")
    family = staged(components(mine.select(F.col("node").alias("a"), F.col("hub").alias("b"))), "families").withColumnRenamed("root", "family")
    cost = lambda n, values: n * F.ceil(F.greatest(n / BLOCK, values / VALUES))  # noqa: E731  rows of all pairs of blocks
    by_band = open_bands.join(family, open_bands["hub"] == family["node"]).groupBy("family").agg(F.sum(cost(F.col("n"), F.col("values"))).alias("by_band"))
    rows = mine.groupBy("node").agg(F.first("root").alias("root"), F.first("size").alias("size")).join(family, "node")
    whole = rows.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("values")).select("family", cost(F.col("n"), F.col("values")).alias("whole"))
    way = staged(by_band.join(whole, "family").select("family", (F.col("whole") <= F.col("by_band")).alias("together")), "ways")
    together = rows.join(way.where("together"), "family").select(F.concat(F.lit("family "), F.hex("family")).alias("group"), "node", "root", "size")
    apart = mine.join(family, "node").join(way.where("not together"), "family").select(F.concat(F.lit("column "), F.col("band")).alias("group"), "node", "root", "size")
    return together.unionByName(apart)


def links_of(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a forest that spans the links between sets (node, size, shingles)."""
    bands = staged(_rare_values(sets, percent).join(sets.select("node", "size"), "node"), "prefixes")
    full = sets.select("node", "shingles")
    links = staged(_product(_first_units(bands).join(full, "node"), ["band", "lo", "hi"], percent), "links")
    roots = staged(components(links), "roots")
    rest = staged(bands.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    later = staged(_later_groups(rest), "later")
    units = _blocks(later, staged(_groups(later, "group", VALUES), "groups"), "group")
    return links.union(staged(_product(units.join(full, "node"), ["group", "lo", "hi"], percent), "links"))


def similarity_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text")
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # a value for each word, of some 7 bytes
    sketch = staged(shared_counts(rows, lambda text: shingle_set(text, words), ranges_for(held // 7)), "sketch")
    company = f"node is not null and 100 * shared >= {percent} * n_shingles"
    nodes = staged(sketch.where(company).groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("size")), "nodes")
    sets = staged(_full_sets(docs, nodes, nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), words).join(nodes.select("node", "size"), "node").select("node", "size", "shingles"), "sets")
    n, values = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    while n:
        counts = shared_counts(sets.select(F.lit(None).cast("long").alias("doc_id"), "shingles"), unpacked, ranges_for(values))
        kept = staged(sets.join(counts.where(company).select("node"), "node", "left_semi"), "sets")
        before, (n, values) = values, kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        sets = kept
        if values > (1 - WORTHWHILE) * before:
            break
    roots = components(links_of(sets, percent)) if n else nodes.select("node", F.col("node").alias("root"))
    ids = staged(nodes.select("node", "doc").join(roots, "node", "left").select("node", "doc", F.coalesce("root", "node").alias("root")), "rooted")
    least = ids.join(ids.groupBy("root").agg(F.min("doc").alias("component_id")), "root").select("node", "component_id")
    linked = sketch.join(least, "node", "left")
    return linked.select("doc_id", "n_shingles", F.when(F.expr(company), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
