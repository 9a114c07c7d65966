"""Benchmark decontamination: size-partitioned MinHash containment search, native operators only.

A document holds an item when it contains at least ``percent`` of the item's distinct word shingles. An item
with n shingles may miss m = n - ceil(n * percent / 100) of them, so its sketch, the m + 1 shingles with the
smallest hashes (a bottom-k MinHash whose k follows from the item's size), meets every document that holds it.
Documents are looked up shingle by shingle, up to the largest hash that any sketch has; document length
doesn't matter, as it would for a similarity of whole sets. Candidates are verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import col, fresh, row_key, text_or_empty
from opsgrain.session import stage_table

WIDTH = 5  # words of a shingle; a shorter item is one shingle of its own length
PERCENT = 80


def words(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+"), "")


def _grams(words: str, width: int) -> Column:
    """All word sequences of one width, as arrays."""
    at = F.sequence(F.lit(1), F.size(words) - (width - 1))
    return F.when(F.size(words) >= width, F.transform(at, lambda i: F.slice(words, i, width)))


def _hashes(words: str, width: int) -> Column:
    at = F.sequence(F.lit(1), F.size(words) - (width - 1))
    return F.when(F.size(words) >= width, F.transform(at, lambda i: F.xxhash64(F.slice(words, i, width))))


def _probes(words: str, width: int, top: int) -> Column:
    """Structs (width, h) of the shingles whose hash is small enough for any sketch of that width."""
    small = F.filter(_hashes(words, width), lambda h: h <= top)
    return F.coalesce(F.transform(small, lambda h: F.struct(F.lit(width).alias("width"), h.alias("h"))),
                      F.array().cast("array<struct<width: int, h: bigint>>"))


def item_shingles(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Distinct shingles of every item: item_id, item, width, h, shingle, n (of them), place (by hash) and sketch (how many)."""
    items = benchmark.select(col(item_id).alias("item_id"), row_key(item_id, text).alias("item"), words(text).alias("w")).where("size(w) > 0")
    shorter = F.coalesce(*[F.when(F.size("w") == k, _grams("w", k)) for k in range(1, WIDTH)], _grams("w", WIDTH))
    parts = (items.select("item_id", "item", F.explode(F.array_distinct(shorter)).alias("shingle")).distinct()
             .withColumns({"width": F.size("shingle"), "h": F.xxhash64("shingle")}))
    # an item is a short text, so ranking within one is bounded
    ranked = parts.groupBy("item_id", "item").agg(F.sort_array(F.collect_list(F.struct("h", "shingle", "width"))).alias("all"))
    n = F.size("all")
    return ranked.select("item_id", "item", n.alias("n"), (n - F.ceil(n * percent / 100) + 1).alias("sketch"), F.posexplode("all").alias("place", "s")) \
        .select("item_id", "item", "n", "sketch", "place", "s.*")


def held_items(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, key, item_id, n_shingles, n_shared, containment) of all documents that hold an item.

    Equal rows, in either table, count once; null ids are kept; null and empty texts hold and are nothing.
    The sketch and shingle tables are staged, so Spark knows their sizes: it broadcasts them while they are
    small and shuffles by hash beyond that.
    """
    shingles = stage_table(item_shingles(benchmark, item_id=item_id, text=item_text, percent=percent))
    bounds = shingles.where("place < sketch").groupBy("width").agg(F.max("h")).collect()  # a row per width, at most WIDTH
    if not bounds:
        bounds = [(WIDTH, -(1 << 63))]
    sketch = shingles.where("place < sketch").select("width", "h", "item")
    source = docs.select(col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), col(text).alias("text"))
    seen = F.concat(*[_probes("w", width, top) for width, top in bounds])
    met = source.select("key", words("text").alias("w")).select("key", F.inline(seen))
    candidates = stage_table(met.join(sketch, ["width", "h"]).select("key", "item").distinct())
    few = source.join(candidates.select("key").distinct(), "key", "left_semi")  # whole texts first: only suspects are cut into words again
    suspects = few.select("doc_id", "key", words("text").alias("w"))
    grams = F.concat(*[F.coalesce(_grams("w", k), F.array().cast("array<array<string>>")) for k, _ in bounds])
    # outer: from a plain explode a filter on the words is derived, and pushed below the semi join to all texts
    theirs = suspects.select("doc_id", "key", F.explode_outer(F.array_distinct(grams)).alias("shingle")).withColumn("h", F.xxhash64("shingle"))
    shared = theirs.join(shingles.select("item_id", "item", "n", "h", "shingle"), ["h", "shingle"]).join(candidates, ["key", "item"])
    counted = shared.groupBy("doc_id", "key", "item_id", "item", "n").agg(F.count_distinct("shingle").alias("n_shared"))
    return (counted.where(F.col("n_shared") * 100 >= F.col("n") * percent)
            .select("doc_id", "key", "item_id", F.col("n").cast("long").alias("n_shingles"), "n_shared",
                    (F.col("n_shared") / F.col("n")).alias("containment")).distinct())


def drop_holders(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    holders = stage_table(held_items(docs, benchmark, doc_id=doc_id, text=text, percent=percent).select("key").distinct())
    key = fresh(docs.columns, "_key")
    kept = docs.withColumn(key, row_key(doc_id, text)).join(holders.withColumnRenamed("key", key), key, "left_anti")
    return kept.select(*[col(c) for c in docs.columns])
