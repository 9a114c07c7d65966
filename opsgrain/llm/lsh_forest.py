"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

Distinct sets get a signature of 128 minhashes. A tree sorts the signatures in an order of hashes of its own; sets with a
long common prefix there are neighbours. A region of a tree is a prefix, and its depth adapts: it starts at five hashes and
grows only where a prefix is shared by more sets than one task should compare. Neighbours whose signatures agree often
enough are candidates. Where a region had to be split, sets that its parts have not brought together yet are compared across
the parts as well, in blocks, so no depth costs a link. Candidates form clusters, and within a cluster links are decided
by exact intersections of full sets. Both times a block's links leave a task as stars, one per component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm import components
from opsgrain.llm.common import col, text_or_empty
from opsgrain.session import stage_table

WIDTH = 3  # words of a shingle
PERCENT = 85
HASHES = 128
TREES = 25  # a pair at the threshold shares no prefix of five hashes in any of them once in two million times
DEPTHS = (5, 8, 12, 18, 27, 40, 60, 90, HASHES)
AGREE = 90  # equal minhashes of a candidate; a pair at the threshold has fewer once in 300,000 times
REGION = 1024  # signatures compared in one task
BLOCK = 512  # sets compared in one task

_ODD = np.random.default_rng(13).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = np.random.default_rng(14).integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingles(data: bytes, width: int = WIDTH) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles of a UTF-8 text, ascending; of the whole sequence if it has fewer words."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh3_64_digest
    return np.unique(np.frombuffer(b"".join([digest(plain[a:b]) for a, b in zip(starts[:n].tolist(), stops.tolist())]), "<u8"))


def signature(found: np.ndarray) -> bytes:
    """The low 16 bits of 128 minhashes, big-endian, so that equal hashes are equal bytes."""
    x = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        y = (x[at:at + 1024, None] ^ _FLIP) * _ODD
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        y ^= y >> np.uint32(12)
        np.minimum(least, y.min(0), out=least)
    return (least * np.uint32(0x297A2D39) >> np.uint32(16)).astype(">u2").tobytes()


def _by_rows(batches: Iterable[pa.RecordBatch], make: Callable[[list], list[pa.Array]], names: list[str], step: int = 256) -> Iterator[pa.RecordBatch]:
    """All columns but the last, and what ``make`` gives for the texts in the last, some hundred rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            piece = batch.slice(at, step)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *make(piece.columns[-1].to_pylist())], names=names)


def prints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n, digest, sig) of every document; digest and sig are null without words."""

    def sign(texts: list) -> list[pa.Array]:
        found = [shingles(t) for t in texts]
        return [pa.array([len(s) for s in found], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary()),
                pa.array([signature(s) if len(s) else None for s in found], pa.binary())]

    source = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(doc_id), text_or_empty(text)).alias("row"), text_or_empty(text).cast("binary").alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(lambda batches: _by_rows(batches, sign, ["doc_id", "row", "n", "digest", "sig"]),
                             f"doc_id {kind}, row long, n long, digest binary, sig binary")


class Forest:
    """Union-find over a few nodes; every tree is told by its smallest node, so that forests of many blocks share their edges."""

    def __init__(self, node: np.ndarray):
        self.node, self.root = node, np.arange(len(node))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            p, q = self.root[i], self.root[j]
            if p != q:
                low, high = (p, q) if self.node[p] <= self.node[q] else (q, p)
                self.root[self.root == high] = low

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        low = self.node[self.root]
        hung = low != self.node
        return low[hung], self.node[hung]


def agreeing(a: np.ndarray, b: np.ndarray, least: int = AGREE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of signatures of two blocks with at least ``least`` equal minhashes. Half of them rule out most pairs."""
    if len(a) * len(b) <= 64:  # most regions hold a few sets
        return np.nonzero((a[:, None] == b).sum(2) >= least)
    half = HASHES // 2
    same = np.zeros((len(a), len(b)), np.uint8)
    for k in range(half):
        same += a[:, k, None] == b[None, :, k]
    i, j = np.nonzero(same + half >= least)
    hit = [same[x, y] + (a[x, half:] == b[y, half:]).sum(1) >= least for x, y in _slices(i, j)]
    hit = np.concatenate(hit) if hit else np.zeros(0, bool)
    return i[hit], j[hit]


def _slices(i: np.ndarray, j: np.ndarray, step: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(i), step):
        yield i[at:at + step], j[at:at + step]


def overlapping(a: list[np.ndarray], b: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of two blocks with 100 * intersection >= percent * union, by exact intersections.

    Hashes that the other block lacks cannot be shared; the rest is counted by products of 0/1 matrices.
    """
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    common = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)))
    where = [(np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate(s)) for s in (a, b)]
    places = []
    for row, value in where:
        at = np.searchsorted(common, value)
        held = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == value) if len(common) else np.zeros(len(value), bool)
        by = np.argsort(at[held], kind="stable")
        places.append((row[held][by], at[held][by]))
    both = np.zeros((len(a), len(b)), np.float32)  # counts below 2**24 are exact
    step = 4096
    for begin in range(0, len(common), step):
        bits = []
        for (row, at), n in zip(places, (len(a), len(b))):
            lo, hi = np.searchsorted(at, (begin, begin + step))
            m = np.zeros((n, step), np.float32)
            m[row[lo:hi], at[lo:hi] - begin] = 1
            bits.append(m)
        both += bits[0] @ bits[1].T
    return np.nonzero(100 * both.astype(np.int64) >= percent * (na[:, None] + nb - both.astype(np.int64)))


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, HASHES).astype(np.uint16)


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u8") for s in column.to_pylist()]


def _links(payload: Callable, linked: Callable, tile: int) -> Callable[[pa.Table], pa.Table]:
    """Star edges of one block, or between the two sides of one: rows are (node, side, payload)."""

    def find(block: pa.Table) -> pa.Table:
        node = block["node"].to_numpy()
        side = block["side"].to_numpy()
        values = payload(block["payload"])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # side 2 is on both
        forest = Forest(node)
        inside = (side == 2).all()
        for x in range(0, len(left), tile):
            for y in range(x if inside else 0, len(right), tile):
                p, q = left[x:x + tile], right[y:y + tile]
                i, j = linked(*([values[k] for k in s] if isinstance(values, list) else values[s] for s in (p, q)))
                apart = node[p[i]] != node[q[j]]
                forest.join(p[i[apart]], q[j[apart]])
        a, b = forest.edges()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return find


def connect(members: DataFrame, sizes: DataFrame, payload: DataFrame, block: int, find: Callable[[pa.Table], pa.Table], chunk: str) -> DataFrame:
    """Edges (a, b) that join all linked nodes of each group, found in blocks of about ``block`` nodes.

    ``members`` has (group, node) and what ``chunk`` needs, ``sizes`` (group, size) with size > 1, ``payload`` (node, payload). Groups of one block
    are compared whole. Larger ones are dealt to blocks by ``chunk``; nodes that are then not in the group's largest
    component are compared with all of the group, block by block, so that no pair is left out but those joined already.
    """
    whole = members.join(sizes, "group").withColumn("parts", F.ceil(F.col("size") / block).cast("int")).withColumn("chunk", F.expr(chunk))
    whole = stage_table(whole.select("group", "node", "parts", "chunk"))
    schema = "a long, b long"
    first = (whole.join(payload, "node").select("group", "chunk", "node", F.lit(2).alias("side"), "payload")
             .groupBy("group", "chunk").applyInArrow(find, schema))
    edges = stage_table(first.distinct())
    large = whole.where("parts > 1")
    if large.isEmpty():
        return edges
    rooted = large.join(components.roots(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = rooted.groupBy("group", "root").agg(F.count("*").alias("n"))
    main = counted.groupBy("group").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    # every group in pieces by a hash of the node, the nodes outside its largest component once more as the other side
    placed = stage_table(rooted.join(main, "group").withColumn("piece", F.pmod(F.xxhash64("node"), "parts")).select("group", "node", "parts", "piece", (F.col("root") != F.col("main")).alias("out")))
    outs = placed.where("out").groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("rows"))
    against = placed.join(outs, "group")
    columns = against.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).select("group", "row", "piece", "node", F.lit(1).alias("side"))
    rows_ = (against.where("out").withColumn("row", F.pmod(F.xxhash64("node", F.lit(1)), "rows"))
             .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("group", "row", "piece", "node", F.lit(0).alias("side")))
    second = columns.unionByName(rows_).join(payload, "node").groupBy("group", "row", "piece").applyInArrow(find, schema)
    return edges.unionByName(stage_table(second.distinct()))


def regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (group, node, leaf, depth) of all shared regions of five hashes, and their sizes.

    ``leaf`` is the deeper region that a member falls into: of the depths tried the first that at most REGION nodes share.
    """
    ring = F.concat("sig", "sig")

    def prefix(tree, depth):
        return F.xxhash64(tree, F.substring(ring, F.lit(2 * DEPTHS[0]) * tree + 1, F.lit(2 * depth)))

    trees = nodes.withColumn("tree", F.explode(F.lit(list(range(TREES)))))
    placed = trees.select("node", prefix(F.col("tree"), DEPTHS[0]).alias("group"), "tree")
    sizes = stage_table(placed.groupBy("group").agg(F.count("*").alias("size")).where("size > 1"))
    members = stage_table(placed.join(sizes.select("group"), "group").select("group", "node", "tree"))
    leaves = stage_table(members.join(sizes.where(F.col("size") <= REGION).select("group"), "group", "left_anti").select("group", "node", "tree"))
    settled = []
    for depth in DEPTHS[1:]:
        if leaves.isEmpty():
            break
        deeper = leaves.join(nodes.select("node", "sig"), "node").select("group", "node", "tree", prefix(F.col("tree"), depth).alias("leaf"))
        deeper = stage_table(deeper)
        few = deeper.groupBy("group", "leaf").agg(F.count("*").alias("n")).where(F.col("n") <= REGION).select("group", "leaf")
        if depth == DEPTHS[-1]:
            settled.append(deeper.select("group", "node", "leaf"))
            break
        settled.append(deeper.join(few, ["group", "leaf"], "left_semi").select("group", "node", "leaf"))
        leaves = stage_table(deeper.join(few, ["group", "leaf"], "left_anti").select("group", "node", "tree"))
    if not settled:
        return members.select("group", "node", F.lit(0).cast("long").alias("leaf")), sizes
    leaf = settled[0]
    for more in settled[1:]:
        leaf = leaf.unionByName(more)
    return members.join(leaf, ["group", "node"], "left").select("group", "node", F.coalesce("leaf", F.lit(0)).alias("leaf")), sizes


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    component_id is the smallest id reachable over links of sets. Null and blank texts have an empty set and are linked with nothing.
    Null ids never name a component unless it has no other; kept is true where id and component agree, nulls included. Ids may have any
    ordered type; repeated rows and equal sets are one node. Columns beyond those named are not read; an empty table gives no rows.
    """
    made = stage_table(prints(docs, doc_id=doc_id, text=text))
    nodes = made.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("row").alias("row"), F.any_value("sig").alias("sig"))
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()))
    members, sizes = regions(nodes)
    near = connect(members, sizes, nodes.select("node", F.col("sig").alias("payload")), REGION, _links(_signatures, agreeing, 256), "leaf")
    clusters = stage_table(components.roots(near).select("node", F.col("root").alias("group")))
    sizes = clusters.groupBy("group").agg(F.count("*").alias("size"))
    links = connect(clusters, sizes, stage_table(_full_sets(docs, nodes.join(clusters, "node", "left_semi"), doc_id, text)), BLOCK,
                    _links(_sets, overlapping, BLOCK), "cast(pmod(xxhash64(node), parts) as bigint)")
    roots = components.roots(stage_table(links))
    named = nodes.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").select("digest", "component_id")
    out = made.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _full_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, payload) with the whole shingle set of each node, read again from one document that has it."""

    def collect(texts: list) -> list[pa.Array]:
        found = [shingles(t) for t in texts]
        return [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())]

    keyed = docs.select(F.xxhash64(col(doc_id), text_or_empty(text)).alias("row"), text_or_empty(text).cast("binary").alias("t"))
    wanted = keyed.join(nodes.select("row"), "row", "left_semi").select("t")
    sets = wanted.mapInArrow(lambda batches: _by_rows(batches, collect, ["digest", "payload"]), "digest binary, payload binary")
    return sets.join(nodes.select("digest", "node"), "digest").select("node", "payload").dropDuplicates(["node"])
