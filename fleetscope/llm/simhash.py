"""Operator 5 - SimHash near-duplicates through vantage-point trees.

Fingerprints: 64-bit SimHash of word shingles, in Python workers with numpy.  Equal fingerprints
are one node.  A vantage-point tree is grown over a bounded sample of the distinct fingerprints;
every fingerprint is routed down to its home shard, and as a visitor to each further shard that
the triangle inequality cannot rule out: at a node with vantage point v and radius m, a home
fingerprint beyond m but within m + r also visits the inner side, and a visitor goes to every
side whose points can lie within r of it.  So any two fingerprints at most r bits apart meet in
some shard.  A shard grows the same tree over its own points down to small leaves, where exact
distances decide.  Links within a leaf are reported as its connected parts (a star for each), so
a dense group never becomes all its pairs; the parts are then joined across shards by rounds of
large-star / small-star on DataFrames.

The sample bounds the number of shards (``SAMPLE_ROWS`` / ``SAMPLE_PER_SHARD``); beyond that
shards grow and the tree inside a shard takes over, 8 bytes a fingerprint.  No fingerprint or
candidate is dropped.

Cases: null, empty or blank text = fingerprint zero, linked like any other; fewer words than the
shingle = the whole sequence as one shingle; repeated rows keep a row each; a null id takes part
in links but never names a component while another id does; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import byte_slices, cut, ship, stored
from fleetscope.llm.merkle import leaf_hash

SEED = 42
SAMPLE_ROWS = 16_384
SAMPLE_PER_SHARD = 8
SHARD_ROWS = 16_384
LEAF_ROWS = 1_024
#: A split must leave at most this share of the rows on both sides together, else the rows stay whole.
MOST_COPIES = 1.7


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash; only A-Z is lower-cased, words end at space and U+0009..U+000D."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint's 64 bits as a signed long."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, text_col):
                fp = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def distances(points: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(v)).astype(np.int16)


def choose_split(points: np.ndarray, radius: int, tries: int = 8):
    """The vantage point and radius that send the fewest points to both sides; None if every
    choice would copy too many."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, tries).astype(int)]:
        d = distances(points, v)
        m = int(np.median(d))
        for mu in (m - 1, m):
            inside = np.count_nonzero(d <= mu + radius)
            outside = np.count_nonzero(d > mu - radius)
            copies, larger = (inside + outside) / len(points), max(inside, outside) / len(points)
            if larger < 0.95 and copies <= MOST_COPIES and (best is None or (copies, larger) < best[0]):
                best = ((copies, larger), int(v), mu)
    return best and best[1:]


def grow(sample: np.ndarray, rows: int, shard_rows: int, radius: int):
    """A vantage-point tree over ``sample``, which stands for ``rows`` points: nested
    ``(v, mu, inner, outer)`` with shard numbers as leaves.  Returns (tree, number of shards)."""
    count = 0

    def node(points, n):
        nonlocal count
        split = choose_split(points, radius) if n > shard_rows and len(points) >= 2 * SAMPLE_PER_SHARD else None
        if split is None:
            count += 1
            return count - 1
        v, mu = split
        near = distances(points, v) <= mu
        share = near.mean()
        return v, mu, node(points[near], n * share), node(points[~near], n * (1 - share))

    return node(sample, rows), count


def sides(points: np.ndarray, home: np.ndarray, v: int, mu: int, radius: int):
    """((indexes, home flags) of the inner, of the outer side)."""
    d = distances(points, v)
    near = d <= mu
    inner = near | (d <= mu + radius)  # homes of the outer side and visitors look inside as well
    outer = ~near | (~home & (d > mu - radius))
    i, o = np.flatnonzero(inner), np.flatnonzero(outer)
    return (i, home[i] & near[i]), (o, home[o])


def route(points: np.ndarray, tree, radius: int):
    """(index, shard, home) of every copy of every point."""
    out = []
    stack = [(tree, np.arange(len(points)), np.ones(len(points), dtype=bool))]
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            out.append((at, np.full(len(at), node, dtype=np.int32), home))
            continue
        v, mu, inner, outer = node
        (i, ih), (o, oh) = sides(points[at], home, v, mu, radius)
        stack += [(inner, at[i], ih), (outer, at[o], oh)]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, int), np.empty(0, np.int32), np.empty(0, bool))


def leaf_links(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Stars (least point, other point) of the connected parts of ``points``.  Every point is
    compared once with the points that no part has taken yet."""
    links = []
    rest = np.unique(points)
    if len(rest) <= 4 * LEAF_ROWS:  # most points have no neighbour: set those aside in one go
        near = np.zeros(len(rest), dtype=bool)
        for at in range(0, len(rest), 256):
            block = rest[at:at + 256]
            near[at:at + 256] = (np.bitwise_count(block[:, None] ^ rest[None, :]) <= radius).sum(axis=1) > 1
        rest = rest[near]
    while len(rest):
        part, edge, rest = [rest[:1]], rest[:1], rest[1:]
        while len(edge) and len(rest):
            reached = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(edge), 64):
                reached |= (np.bitwise_count(edge[at:at + 64, None] ^ rest[None, :]) <= radius).any(axis=0)
            edge, rest = rest[reached], rest[~reached]
            part.append(edge)
        part = np.concatenate(part)
        if len(part) > 1:
            least = int(part.min())
            links += [(least, int(p)) for p in part if p != least]
    return links


def shard_links(points: np.ndarray, home: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of one shard: the tree goes on inside it down to small leaves."""
    links, stack = [], [(points, home)]
    while stack:
        points, home = stack.pop()
        if not home.any() or len(points) < 2:
            continue  # visitors alone meet at one of their homes
        split = choose_split(points, radius) if len(points) > LEAF_ROWS else None
        if split is None:
            links += leaf_links(points, radius)
            continue
        (i, ih), (o, oh) = sides(points, home, *split, radius)
        stack += [(points[i], ih), (points[o], oh)]
    return links


def near_links(nodes: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) such that two fingerprints are
    connected by links exactly if they are by steps of at most ``radius`` bits."""
    spark = nodes.sparkSession
    ship(spark)
    rows = nodes.count()
    sample = np.array([r[0] for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE_ROWS).collect()],
                      dtype=np.int64).view(np.uint64)
    tree, _ = grow(sample, rows, shard_rows, radius) if len(sample) else (0, 1)

    def send(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, shard, home = route(fp, tree, radius)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp[at].view(np.int64)), pa.array(home)],
                                             names=["shard", "fp", "home"])

    def search(table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        links = np.array(shard_links(points, home, radius), dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    sent = nodes.select("fp").mapInArrow(send, "shard int, fp long, home boolean")
    return sent.groupBy("shard").applyInArrow(search, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node of its part.

    Alternating large-star and small-star rounds until nothing moves; a round groups and joins on nodes (the least
    neighbour is a partial aggregate, hot centres are split by AQE) and is checkpointed."""
    def both(e):
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def least(e):  # (a, m): least neighbour of a, itself included
        return e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))

    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        if edges.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        pairs = both(edges)
        large = pairs.join(least(pairs), pairs.a == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.join(least(large), large.a == F.col("n")).select("a", "b", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                               F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = cut(small.where("a <> b").distinct())
        # done when every node has one parent and no parent is a child
        state = edges.groupBy("a").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if state is None or state == 1 and edges.join(edges.select(F.col("b").alias("p")).distinct(), F.col("a") == F.col("p"),
                                                      "left_semi").isEmpty():
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``."""
    marked = cut(fingerprints(docs, shingle, id_col, text_col))
    nodes = cut(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    parts = connected(near_links(nodes, max_bits))
    rooted = nodes.join(parts, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("f"), "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("f", "root").join(names, "root").select("f", "component_id")
    return marked.join(labels, F.col("fp") == F.col("f")).select(id_col, "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of near-duplicates: the least by id (null ids last),
    then by the digest of all its columns, so the choice does not depend on partitions.

    Rows are told apart by what they hold, not by id: of several texts under one id each stays
    unless it is a near-duplicate itself.  Rows alike in every column count as copies; only their
    groups are deduplicated by value, all others pass one semi-join on the digest."""
    digest = leaf_hash([F.col(f"`{c}`") for c in docs.columns])
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("anonymous"), F.col(f"`{id_col}`").alias("id"), digest.alias("digest"))
    linked = near_duplicates(docs.select(key.alias("_key"), F.col(f"`{text_col}`").alias("_text")), shingle, max_bits, "_key", "_text")
    least = linked.where("_key = component_id").groupBy(F.col("_key.digest").alias("_kept")).agg(F.count(F.lit(1)).alias("_copies"))
    kept = docs.withColumn("_digest", digest).join(stored(least, "representatives"), F.col("_digest") == F.col("_kept"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    copies = kept.where("_copies > 1").dropDuplicates(["_digest"])
    return kept.where("_copies = 1").select(*own).unionByName(copies.select(*own))
