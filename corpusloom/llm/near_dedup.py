"""Operator 6, MinHash near-duplicates with sequential Bayesian verification.

A text's words (A-Z lower-cased, split at ASCII white space) make its set of distinct runs of `words` words, as 64-bit
hashes; with fewer words the whole sequence is its one run. Texts of equal sets are one node from the start. Nodes whose
MinHash signatures agree in a band of ROWS values meet in that band's bucket. Candidates are formed without pairing a
bucket's members with one another:

1. Every member is a candidate with the bucket's least node: as many candidates as members.
2. In buckets that then hold more than one component, members are compared by their signatures, in memory, across
   components: the largest component's blocks with those of all other members, and these with one another. Where the
   others alone are more than BLOCK (a passage that many different texts share), the bucket gives way to rare values:
   sets of the threshold must share one of their rarest values (a prefix filter, which loses nothing), and only nodes
   that do so meet. Of the pairs that the bound leaves, a forest that spans them is written, and joins the nodes into
   clusters. Within each cluster, blocks of members with their full sets are compared across components, and again
   only a forest of the confirmed links is written. No pair is left out; none but forests become rows.

A candidate's signatures are compared batch by batch; it is pruned as soon as the posterior probability, under a
uniform prior, that its similarity reaches the threshold falls below `miss`. Survivors are confirmed on their full sets.
Confirmed links are joined into components by alternating large and small stars, in the cluster. What stays out: pairs whose
bands all differ, with probability (1 - s^5)^25 at similarity s, 5e-5 at 0.8, and those that the posterior bound prunes.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; equal texts are one
component; a null doc_id takes part and is passed over where the smallest is taken; repeated rows each get a row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns, release, staged, tidied

WORDS, PERCENT = 5, 80
BANDS, ROWS, HASHES = 25, 5, 128
#: Signature values compared at a time, and the miss probability of the posterior bound.
BATCH, MISS = 32, 1e-7
#: Ids up to this number are sent to all executors to fetch texts (some 50 MB); more are joined by shuffle.
MAX_BROADCAST_IDS = 1_000_000
#: Members of a block, and values of their sets where these are compared too; two blocks are compared in memory at a time.
BLOCK, VALUES = 512, 2_000_000
#: Links of a split that are drawn together at a time.
CONTRACT = 250_000
#: Set values by hash at a time, which bounds memory on long texts.
CHUNK = 4096
SKETCH = "doc_id long, n_shingles long, node binary, sig binary, bands array<long>"


@functools.cache
def _coefficients():
    """Odd multipliers and offsets of the hash functions, from a fixed seed."""
    import numpy as np

    rng = np.random.default_rng(20)
    a, b = (rng.integers(0, 2**64, HASHES, np.uint64) for _ in range(2))
    return a | np.uint64(1), b


def _mixed(x):
    """Spread 64-bit values."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int):
    """Sorted distinct 64-bit hashes of a text's runs of words."""
    import numpy as np
    import xxhash

    parts = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII white space characters
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(h) - words + 1)
    run = np.full(n, min(words, len(h)), np.uint64)
    for i in range(min(words, len(h))):
        run = run * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(_mixed(run))


def signature(shingles):
    """HASHES least values, 32 bits each."""
    import numpy as np

    a, b = _coefficients()
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), CHUNK):
        np.minimum(least, (shingles[i : i + CHUNK, None] * a + b).min(0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(sig):
    """A key for each band of a signature."""
    import numpy as np

    rows = sig[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key.astype(np.int64)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node (digest of the set), sig and bands; the last three null for empty sets."""

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            n, node, sig, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, words)
                n.append(len(s))
                if len(s):
                    values = signature(s)
                    node.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sig.append(values.tobytes())
                    bands.append(band_keys(values))
                else:
                    node.append(None), sig.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "node", "sig", "bands"])

    return own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidied(of), SKETCH)


@functools.cache
def least_matches(percent: int, miss: float = MISS) -> dict[int, int]:
    """After n values: the least matches at which the similarity may still reach the threshold."""
    t = percent / 100
    found = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        posterior, m = 0.0, -1
        while posterior < miss:  # P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m)
            m += 1
            posterior += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found[n] = m
    return found


def _pruned(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) that the posterior bound leaves, by batches of their signatures."""
    table = least_matches(percent)

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in (2, 3))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, int)
            for n, least in table.items():
                matches[alive] += (x[alive, n - BATCH : n] == y[alive, n - BATCH : n]).sum(1)
                alive = alive[matches[alive] >= least]
            yield batch.select([0, 1]).take(pa.array(alive))

    sigs = nodes.select("node", "sig")
    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(tidied(of), "a binary, b binary")


def _full_sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """node and its set, packed, of the nodes in pairs; their texts are found by a document of each."""
    wanted = pairs.selectExpr("a as node").union(pairs.selectExpr("b as node")).distinct().join(nodes.select("node", F.col("doc").alias("doc_id")), "node")
    wanted = staged(wanted, "wanted")
    small = wanted.count() <= MAX_BROADCAST_IDS
    rows = own_columns(docs, "doc_id", "text").selectExpr("cast(doc_id as long) doc_id", "text").where(F.col("text").isNotNull())
    texts = rows.join(F.broadcast(wanted) if small else wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"])).select("node", "text")

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            out = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packed = shingle_set(text, words).tobytes()
                if xxhash.xxh3_128_digest(packed) == node:  # doc_id may be repeated with other texts
                    out.append((node, packed))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["node", "shingles"])

    return texts.mapInArrow(tidied(of), "node binary, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = int(np.isin(p, q, assume_unique=True).sum()) if len(p) and len(q) else 0
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(tidied(of), "a binary, b binary")


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) as stars: of each CONTRACT edges of a split, every node but the least of those that they join, with that least one."""

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        def stars(parts):
            u, v = (np.array([x for p in parts for x in p.column(c).to_pylist()], object) for c in (0, 1))
            at, names = pd.factorize(np.concatenate((u, v)), sort=True)  # numbered in the order of nodes
            root = list(range(len(names)))

            def find(i: int) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for x, y in zip(at[: len(u)].tolist(), at[len(u) :].tolist(), strict=True):
                x, y = find(x), find(y)
                root[max(x, y)] = min(x, y)
            own = [(names[i], names[r]) for i in range(len(names)) if (r := find(i)) != i]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*own, strict=True) if own else ((), ()))], names=["u", "v"])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CONTRACT:
                yield stars(held)
                held, n = [], 0
        if held:
            yield stars(held)

    return edges.mapInArrow(tidied(of), "u binary, v binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): the least node of its component, by alternating large and small stars.

    Before each round the edges of a split are drawn together by themselves, and the rounds end as soon as the edges are stars. The least neighbours
    of the large star are written before they are joined: a hub's rows are then one side of a join of two shuffles,
    which adaptive execution splits; an aggregation in the join's own stage would keep them in one task. The small star joins by the
    greater end, whose lesser neighbours the large star has already drawn together.
    """
    first = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    edges = staged(contracted(first), "edges")
    while True:
        ends = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.lit(None).cast("binary")))  # a node's own edges, and a null for each that leads to it
        at = ends.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.max(F.col("v").isNull()).alias("met"))
        if not at.where("least is not null and (least <> most or met)").count():
            break  # all edges of a node lead to the same root
        both = edges.union(edges.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u").select(F.explode(F.expr("array(struct(u, m as v), struct(v as u, m as v))")).alias("e"))
        small = small.select("e.u", "e.v").where("u <> v").distinct()
        edges = staged(contracted(staged(small, "edges")), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _groups(rows: DataFrame, key: str, values: float = math.inf) -> DataFrame:
    """Of the groups of rows (key, node, root, size) with several roots: `main`, the root with the most members, and into how many blocks
    its members (`mains`; 0 where one block holds the whole group) and all others (`others`) are dealt, by number and by set values."""

    def blocks(n, size):
        return F.ceil(F.greatest(n / BLOCK, size / F.lit(values))).cast("int")

    of_root = rows.groupBy(key, "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    whole = of_root.groupBy(key).agg(F.max(F.struct("n", "size", "root")).alias("top"), F.sum("n").alias("n"), F.sum("size").alias("size")).where("top.n < n")
    n, size, top_n, top_size = (F.col(c) for c in ("n", "size", "top.n", "top.size"))
    mains = F.when(blocks(n, size) <= 1, 0).otherwise(blocks(top_n, top_size))
    return whole.select(key, F.col("top.root").alias("main"), mains.alias("mains"), blocks(n - top_n, size - top_size).alias("others"))


def _blocks(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows of groups dealt into units (key, lo, hi) of two blocks, or one: any two rows of different roots meet in a unit. Blocks of the main
    root's members meet only those of others, so that a large component with few strays costs a row for each member."""
    dealt = rows.join(groups, key).withColumn("own", F.when((F.col("root") == F.col("main")) & (F.col("mains") > 0), F.expr("pmod(xxhash64(node), mains)")).otherwise(F.expr("mains + pmod(xxhash64(node), others)")).cast("int"))
    dealt = dealt.withColumn("__other", F.explode(F.expr("sequence(if(own < mains, mains, 0), mains + others - 1)")))
    return dealt.withColumn("lo", F.least("own", "__other")).withColumn("hi", F.greatest("own", "__other")).drop("main", "mains", "others", "__other")


def _rare_values(sets: DataFrame, percent: int) -> DataFrame:
    """(node, band): the rarest values of each set that other sets hold too, as many as it takes that two sets of the threshold share one.

    Two such sets have at least percent * size / 100 values in common, by the size of either; so, in one order of all values, they meet among
    the first size - that + 1 of each. The order is by the number of sets, and values of one set alone, which come first, meet nothing.
    """

    def of(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            packed = batch.column(1).to_pylist()
            ends = np.cumsum([0] + [len(x) // 8 for x in packed])
            values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["node", "held"])

    each = sets.select("node", "shingles").mapInArrow(tidied(of), "node binary, held array<long>").select("node", F.size("held").alias("size"), F.explode("held").alias("value"))
    counts = staged(each.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts")
    common = each.join(counts, "value").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("common"))
    first = F.expr(f"slice(common, 1, greatest(size(common) - ({percent} * size + 99) div 100 + 1, 0))")
    return common.select("node", F.explode(first.getField("value")).alias("band"))


def _spanning(units: DataFrame, key: str, percent: int, exact: bool) -> DataFrame:
    """(a, b): of each unit's pairs across roots that the posterior bound leaves, and with `exact` that their full sets
    confirm, those that join what the unit's earlier ones have not."""
    table = least_matches(percent)

    def of(frame):
        import numpy as np
        import pandas as pd

        nodes, n = frame["node"].tolist(), len(frame)
        sig = np.frombuffer(b"".join(frame["sig"]), "<u4").reshape(-1, HASHES)
        size = frame["size"].to_numpy()
        root = pd.factorize(frame["root"])[0]
        own = frame["own"].to_numpy()
        across = n > 0 and frame["lo"].iat[0] != frame["hi"].iat[0]  # pairs within a block are another unit's, or of one root
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]] if exact else []
        joined = list(range(int(root.max()) + 1))

        def find(i: int) -> int:
            while joined[i] != i:
                joined[i] = joined[joined[i]]
                i = joined[i]
            return i

        out = []
        for i in range(1, n):
            apart = (root[:i] != root[i]) & (own[:i] != own[i]) if across else root[:i] != root[i]
            at = np.flatnonzero(apart & (100 * np.minimum(size[:i], size[i]) >= percent * np.maximum(size[:i], size[i])))
            matches = np.zeros(len(at), int)
            for m, least in table.items():
                matches += (sig[at, m - BATCH : m] == sig[i, m - BATCH : m]).sum(1)
                keep = matches >= least
                at, matches = at[keep], matches[keep]
            for j in at[np.argsort(-matches, kind="stable")].tolist():
                x, y = find(root[i]), find(root[j])
                if x == y:
                    continue
                if exact:
                    common = len(sets[i]) + len(sets[j]) - len(np.unique(np.concatenate((sets[i], sets[j]))))
                    if 100 * common < percent * (len(sets[i]) + len(sets[j]) - common):
                        continue
                joined[x] = y
                out.append((nodes[i], nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return units.groupBy(key, "lo", "hi").applyInPandas(of, "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    release(docs.sparkSession)
    sketched = staged(sketch(docs, words), "sketch")
    nodes = staged(sketched.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nodes")
    members = nodes.select("node", "size", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min(F.struct("node", "size")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(shared.select("band", "hub"), "shared")  # written first, so that a hot band's join can be split
    members = staged(members.join(shared, "band"), "members")  # of buckets with company only

    stars = members.where("node <> hub.node").where(f"100 * least(size, hub.size) >= {percent} * greatest(size, hub.size)")
    pairs = staged(stars.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct(), "pairs")
    left = staged(_pruned(pairs, nodes, percent), "survivors")
    links = staged(_confirmed(left, staged(_full_sets(docs, nodes, left, words), "sets"), percent), "links")
    roots = staged(components(links), "roots")
    release(docs.sparkSession)

    def rooted(rows):
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    rest = staged(rooted(members.select("band", "node", "size")), "rooted")
    groups = staged(_groups(rest, "band"), "groups")
    wide = staged(rest.join(groups.where("others > 1"), "band").select(F.col("node").alias("a"), F.col("node").alias("b")).distinct(), "wide")
    sigs = nodes.select("node", "sig")
    likely = staged(_spanning(_blocks(rest, groups.where("others <= 1"), "band").join(sigs, "node"), "band", percent, exact=False), "likely")
    if not wide.isEmpty():
        sets = staged(_full_sets(docs, nodes, wide, words), "sets")
        rare = staged(rooted(_rare_values(sets, percent).join(nodes.select("node", "size"), "node")), "rare")
        units = _blocks(rare, _groups(rare, "band"), "band").join(sigs, "node")
        likely = likely.union(staged(_spanning(units, "band", percent, exact=False), "likely"))
    clusters = staged(components(links.union(likely)), "clusters").withColumnRenamed("root", "cluster")
    release(docs.sparkSession)
    open_nodes = rooted(clusters).join(nodes.select("node", "size", "sig"), "node")
    groups = staged(_groups(open_nodes, "cluster", VALUES), "groups")
    open_nodes = staged(open_nodes.join(groups.select("cluster"), "cluster", "left_semi"), "open")
    sets = staged(_full_sets(docs, nodes, open_nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), words), "sets")
    units = _blocks(open_nodes, groups, "cluster").join(sets, "node")
    links = links.union(staged(_spanning(units, "cluster", percent, exact=True), "links"))
    roots = staged(components(links), "roots")

    ids = nodes.select("node", "doc").join(roots, "node")
    least = ids.groupBy("root").agg(F.min("doc").alias("least"))
    linked = ids.join(least, "root").select("node", "least")
    of_node = nodes.select("node", "doc").join(linked, "node", "left").select("node", F.coalesce("least", "doc").alias("component_id"))
    rows = sketched.select("doc_id", "n_shingles", "node").join(of_node, "node", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, that represent their group: its smallest doc_id, once.

    Only the ids that go, or that several rows have, are joined with the texts; up to MAX_BROADCAST_IDS of them are sent
    to the texts, more are joined by shuffle. Rows of one id and text stay once. Rows without a doc_id are told apart by their texts, and come after all
    ids: of near copies without one a single row stays, and none where a group has an id. The columns may have any names.
    """
    id_ = F.col("`doc_id`").cast("long")
    # beyond all usual ids
    own = F.coalesce(id_, F.xxhash64("`text`").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), own.alias("own"), F.col("`text`").alias("text"))
    ids = near_duplicates(rows.select(F.col("own").alias("doc_id"), "text"), words, percent).groupBy(F.col("doc_id").alias("own")).agg(F.max("kept").alias("keep"), (F.count(F.lit(1)) > 1).alias("many"))
    special = staged(ids.where("not keep or many"), "special-ids")
    small = special.count() <= MAX_BROADCAST_IDS
    joined = rows.join(F.broadcast(special) if small else special, "own", "left")
    once, many = joined.where("many is null").select("row"), joined.where("keep and many").dropDuplicates(["own", "text"]).select("row")
    return once.unionByName(many).select("row.*")
