"""SimHash near-duplicates: a grid join over bit counts, then the exact Hamming distance.

A 64-bit fingerprint is mapped to 32 segments of two bits each, of which only the number of set bits is kept
(0, 1 or 2; two bits hold one count, so the whole vector is one long). The Manhattan distance of two vectors
is a lower bound of the Hamming distance. The segments are dealt to bands; fingerprints that differ in at most
d bits agree on at least bands - d of them, so a grid over every choice of that many bands has the pair in one
cell. Pairs of a cell pass the Manhattan bound, then the Hamming distance, and are emitted by the first grid
on which they agree, once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm import components
from opsgrain.llm.common import batches_of, col, fresh, row_key, rows, small_batches, text_or_empty
from opsgrain.session import stage_table

WIDTH = 4  # words of a shingle
SEED = 42
DISTANCE = 4
BANDS = 7  # more bands: more, finer grids; right for any number above the distance
_LOW = 0x5555555555555555


def fingerprint(data: bytes, width: int = WIDTH) -> int:
    """SimHash of a UTF-8 text: a bit is set if more than half of the shingles' hashes have it."""
    words = data.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(plain[a:b], SEED) for a, b in zip(starts[:n].tolist(), stops.tolist())])
    total = np.zeros(64, np.int64)
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for at in range(0, n, 65536):
        total += np.unpackbits(bits[at:at + 65536], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, fp): the fingerprint as a signed long; null texts are empty and have zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("fp", pa.int64())])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(((i, k, fingerprint(t)) for i, k, t in rows(batches)), schema)

    source = small_batches(docs).select(col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    return source.mapInArrow(hashed, "doc_id long, key binary, fp long")


def counts(fp: Column) -> Column:
    """The vector of bit counts, two bits per segment."""
    high = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseXOR(high).bitwiseAND(_LOW).bitwiseOR(F.shiftleft(fp.bitwiseAND(high).bitwiseAND(_LOW), 1))


def manhattan(p: Column, q: Column) -> Column:
    """Manhattan distance of two vectors: counts 0, 1, 2 differ by one where the low bits differ, else by two or nothing."""
    x = p.bitwiseXOR(q)
    odd = x.bitwiseAND(_LOW)
    even = F.shiftrightunsigned(x, 1).bitwiseAND(_LOW).bitwiseAND(F.bitwise_not(odd))
    return F.bit_count(odd) + 2 * F.bit_count(even)


def band_masks(bands: int) -> list[int]:
    """Bit masks of the bands: whole segments, as even as they go."""
    cuts = [32 * i // bands for i in range(bands + 1)]
    masks = [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, *, fp: str = "fp", distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``nodes`` within ``distance`` bits, each once.

    Spark takes the exploded cells for no more bytes than their nodes, so the join is told not to broadcast them.
    """
    masks = band_masks(bands)
    grids = list(combinations(range(bands), bands - distance))
    whole = [0] * len(grids)
    for g, chosen in enumerate(grids):
        for b in chosen:
            whole[g] |= masks[b] & ((1 << 64) - 1)
    whole = [m - (1 << 64) if m >> 63 else m for m in whole]
    # lowest bands that agree, as the number of their grid
    cells = F.explode(F.array(*[F.struct(F.lit(g).alias("grid"), F.col("v").bitwiseAND(F.lit(m)).alias("cell")) for g, m in enumerate(whole)])).alias("c")
    placed = nodes.select(F.col(fp).alias("f")).withColumn("v", counts(F.col("f"))).select("f", "v", cells).select("f", "v", "c.grid", "c.cell")
    a, b = placed.alias("a"), placed.alias("b")
    x = F.col("a.v").bitwiseXOR(F.col("b.v"))
    first = F.lit(None).cast("int")
    for g, m in reversed(list(enumerate(whole))):
        first = F.when(x.bitwiseAND(F.lit(m)) == 0, g).otherwise(first)
    near = ((F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("a.f") < F.col("b.f"))
            & (manhattan(F.col("a.v"), F.col("b.v")) <= distance)
            & (F.bit_count(F.col("a.f").bitwiseXOR(F.col("b.f"))) <= distance) & (first == F.col("a.grid")))
    return a.join(b.hint("merge"), near).select(F.col("a.f").alias("a"), F.col("b.f").alias("b"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """(doc_id, key, fp, component_id): component_id is the smallest doc_id reachable over links.

    Copies are one node: fingerprints are made distinct before anything is joined. Null ids never name a
    component; null and empty texts have fingerprint zero and are linked like any other; an empty input gives no rows.
    """
    prints = stage_table(fingerprints(docs, doc_id=doc_id, text=text))
    nodes = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = stage_table(links(nodes, distance=distance, bands=bands))
    roots = components.roots(edges)  # (node, root) of the linked nodes only
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "key", "fp", "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One document of each group, that with the smallest id, with all its columns.

    Of rows that share that id one stays, whichever the key of id and text puts first; rows equal in both are one.
    """
    groups = near_duplicates(docs, doc_id=doc_id, text=text, distance=distance)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    # a component is named by its smallest id; one without any id by its smallest fingerprint
    best = groups.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("f")).agg(F.min(order).alias("best"))
    kept = stage_table(groups.join(best.select(F.col("best.key").alias("key")), "key", "left_semi").groupBy("key").agg(F.count("*").alias("copies")))
    key = fresh(docs.columns, "_key")
    keyed = docs.withColumn(key, row_key(doc_id, text))
    once = keyed.join(kept.where("copies = 1").select(F.col("key").alias(key)), key, "left_semi")
    repeated = kept.where("copies > 1").select(F.col("key").alias(key))
    if not repeated.isEmpty():
        once = once.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key]))
    return once.select(*[col(c) for c in docs.columns])
