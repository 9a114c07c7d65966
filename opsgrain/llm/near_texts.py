"""Near-duplicate texts by similarity of their shingle sets, found through wide SimHash fingerprints.

Two texts are linked if 100 * |A & B| >= 80 * |A | B| for their sets of distinct five-word shingles. Their fingerprints of
256 bits then differ in about 39; as many bits of 64 as such a pair differs in would leave a grid nothing to select by, so
the grid has two kinds of coordinates: an anchor (the least hash of a set; a linked pair shares one of four but once in 600
times) and, where many sets share an anchor, the numbers of set bits of some two-bit segments. How many segments follows
from the number of sets under the anchor, how many such grids from the number of segments. Within a cell the Manhattan
distance of the bit counts, a lower bound, rules out pairs before the Hamming distance does. What passes forms clusters,
in which links are decided by exact intersections of full sets. Blocks leave their tasks as stars, never as pairs.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm import components
from opsgrain.llm.common import col, fresh, row_key, small_batches, text_or_empty
from opsgrain.llm.lsh_forest import BLOCK, _by_rows, _links, _sets, connect, overlapping, shingles
from opsgrain.session import stage_table

WIDTH = 5  # words of a shingle
PERCENT = 80
BITS = 256
DISTANCE = 64  # bits of a candidate; a pair at the threshold differs in 39, with a deviation of 6
ANCHORS = 4
CELL = 64  # sets that a cell should hold; cells may hold more, their blocks are then parted
TILE = 256  # fingerprints compared at a time
REGION = 1024  # fingerprints compared in one task

SEGMENTS = BITS // 2
MEET = 0.734  # two segments of a pair at the threshold have equal bit counts with this probability,
CHANCE = 0.375  # those of unlike texts with this one
MISSED = 0.02  # of the pairs at the threshold that share a crowded anchor, how many may meet in none of its grids

_LOW = np.uint64(0x5555555555555555)
_rng = np.random.default_rng(6)
_ODD = _rng.integers(0, 1 << 63, BITS // 64 + ANCHORS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.integers(0, 1 << 63, BITS // 64 + ANCHORS, dtype=np.uint64)


def _mixed(found: np.ndarray, k: int) -> np.ndarray:
    x = (found ^ _FLIP[k]) * _ODD[k]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fingerprint(found: np.ndarray) -> bytes:
    """SimHash of a set of 64-bit hashes in 256 bits: one is set if more than half of the elements have it."""
    total = np.zeros(BITS, np.int64)
    step = 255  # sums of bits that fit a byte
    for at in range(0, len(found), 64 * step):
        piece = found[at:at + 64 * step]
        words = np.stack([_mixed(piece, k) for k in range(BITS // 64)], 1)
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        for low in range(0, len(bits), step):
            total += bits[low:low + step].sum(0, dtype=np.uint8)
    return np.packbits(2 * total > len(found)).tobytes()


def anchors(found: np.ndarray) -> list[int]:
    """The least hash of a set under each of a few hash functions."""
    return [int(_mixed(found, BITS // 64 + k).min().view(np.int64)) for k in range(ANCHORS)]


def prints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, digest, fp, anchors): the digest tells sets apart; texts without words have an empty set, no fp and no anchors."""

    def sign(texts: list) -> list[pa.Array]:
        found = [shingles(t, WIDTH) for t in texts]
        return [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                pa.array([fingerprint(s) if len(s) else None for s in found], pa.binary()),
                pa.array([anchors(s) if len(s) else None for s in found], pa.list_(pa.int64()))]

    source = small_batches(docs).select(col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(lambda batches: _by_rows(batches, sign, ["doc_id", "key", "digest", "fp", "anchors"]),
                             f"doc_id {kind}, key binary, digest binary, fp binary, anchors array<long>")


def bit_counts(fp: np.ndarray) -> np.ndarray:
    """Set bits of every two-bit segment (0, 1 or 2), in the two bits of the segment."""
    high = (fp >> np.uint64(1)) & _LOW
    low = fp & _LOW
    return (low ^ high) | ((low & high) << np.uint64(1))


def manhattan(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed bit counts: they differ by one where the low bits differ, else by two or nothing."""
    x = p ^ q
    odd = x & _LOW
    return np.bitwise_count(odd) + 2 * np.bitwise_count((x >> np.uint64(1)) & _LOW & ~odd)


def close(a: np.ndarray, b: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of fingerprints of two blocks within ``distance`` bits, those beyond the Manhattan bound left out first."""
    bound = np.zeros((len(a), len(b)), np.uint16)
    p, q = bit_counts(a), bit_counts(b)
    for k in range(a.shape[1]):
        bound += manhattan(p[:, k, None], q[None, :, k])
    i, j = np.nonzero(bound <= distance)
    near = np.bitwise_count(a[i] ^ b[j]).sum(1, dtype=np.int64) <= distance
    return i[near], j[near]


def _fingerprints(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def plan(n: Column, cell: int = CELL) -> tuple[Column, Column]:
    """Segments per grid and number of grids for ``n`` sets under one anchor."""
    depth = F.greatest(F.lit(0), F.ceil(F.log(n / cell) / -math.log(CHANCE))).cast("int")
    grids = F.ceil(F.lit(math.log(MISSED)) / F.log(1 - F.pow(F.lit(MEET), depth)))
    return depth, F.when(depth > 0, grids).otherwise(1).cast("int")


def cells(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """Members (group, node, leaf) of all cells. Every set is in every grid of each of its anchors; none is left out."""
    placed = nodes.select("node", "fp", F.posexplode("anchors").alias("slot", "least")).select("node", "fp", F.xxhash64("slot", "least").alias("anchor"))
    sizes = stage_table(placed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    depth, grids = plan(F.col("n"), cell)
    shared = placed.join(sizes.select("anchor", depth.alias("depth"), grids.alias("grids")), "anchor")
    few = shared.where("depth = 0").select(F.col("anchor").alias("group"), "node")
    many = shared.where("depth > 0").withColumn("grid", F.explode(F.sequence(F.lit(1), "grids")))
    # the bit count of segment s: two hexadecimal digits hold four segments, each of two bits
    two = "shiftright(cast(conv(hex(substring(fp, cast(s div 4 as int) + 1, 1)), 16, 10) as int), cast(2 * (s % 4) as int)) & 3"
    count = f"transform(sequence(1, depth), j -> transform(array(pmod(xxhash64(grid, j), {SEGMENTS})), s -> bit_count({two}))[0])"
    deep = many.select(F.xxhash64("anchor", "grid", F.expr(count)).alias("group"), "node")
    return few.unionByName(deep).withColumn("leaf", F.lit(0).cast("long"))


def _full_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, payload) with the whole set of each node, read again from one document that has it."""

    def collect(texts: list) -> list[pa.Array]:
        found = [shingles(t, WIDTH) for t in texts]
        return [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())]

    keyed = small_batches(docs).select(row_key(doc_id, text).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    wanted = keyed.join(nodes.select("key"), "key", "left_semi").select("t")
    sets = wanted.mapInArrow(lambda batches: _by_rows(batches, collect, ["digest", "payload"]), "digest binary, payload binary")
    return sets.join(nodes.select("digest", "node"), "digest").select("node", "payload").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, digest) of all documents and sets (digest, best, root): sets of one root are linked, directly or over others.

    ``best`` is (has no id, id, key) of the set's document with the smallest id. Texts without words, null ones included, are
    copies of each other and of nothing else. Ids may have any ordered type; equal sets are one node, so copies are joined with nothing.
    """
    made = stage_table(prints(docs, doc_id=doc_id, text=text))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    nodes = made.groupBy("digest").agg(F.min(order).alias("best"), F.any_value("fp").alias("fp"), F.any_value("anchors").alias("anchors"))
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("key", F.col("best.key")))
    members = stage_table(cells(nodes).distinct())
    sizes = stage_table(members.groupBy("group").agg(F.count("*").alias("size")).where("size > 1"))
    near = connect(members, sizes, nodes.select("node", F.col("fp").alias("payload")), REGION, _links(_fingerprints, close, TILE),
                   "cast(pmod(xxhash64(node), parts) as bigint)")
    clusters = stage_table(components.roots(stage_table(near.distinct())).select("node", F.col("root").alias("group")))
    sizes = clusters.groupBy("group").agg(F.count("*").alias("size"))
    sets = stage_table(_full_sets(docs, nodes.join(clusters, "node", "left_semi"), doc_id, text))
    links = connect(clusters, sizes, sets, BLOCK, _links(_sets, functools.partial(overlapping, percent=percent), BLOCK), "cast(pmod(xxhash64(node), parts) as bigint)")
    roots = components.roots(stage_table(links.distinct()))
    return made.select("doc_id", "key", "digest"), nodes.join(roots, "node", "left").select("digest", "best", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group of linked texts, that with the smallest id, with all its columns.

    A document without an id stays only where no other of its group has one. Of rows that share the id one stays, whichever
    the key of id and text puts first; rows equal in both are one. An empty table gives no rows; extra columns come back unchanged.
    """
    made, sets = near_duplicates(docs, doc_id=doc_id, text=text, percent=percent)
    best = sets.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.key").alias("key"))
    kept = stage_table(made.join(best, "key", "left_semi").groupBy("key").agg(F.count("*").alias("copies")))
    key = fresh(docs.columns, "_key")
    keyed = docs.withColumn(key, row_key(doc_id, text))
    once = keyed.join(kept.where("copies = 1").select(F.col("key").alias(key)), key, "left_semi")
    repeated = kept.where("copies > 1").select(F.col("key").alias(key))
    if not repeated.isEmpty():
        once = once.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key]))
    return once.select(*[col(c) for c in docs.columns])
