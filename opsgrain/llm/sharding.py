"""Histogram sort: balanced shards from counted bytes, one exchange.

Rows are ordered by (hash of the text, id, row number). The splitters of the shards are found without
sorting: each round counts the exact bytes between evenly spaced probe keys, 4,096 per open bracket, and
keeps the bracket that holds a splitter's target, until the splitter is within the tolerance. A bracket that
has shrunk to one hash (a group of copies) goes on by id, then by row number, so hot groups are split.
The rows then move once, to (shard, cell) groups whose sizes are known from the last count.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.llm.common import col, fresh, text_or_empty
from opsgrain.session import stage_table

BITS = 12  # probes per round and bracket: 2 ** BITS
HASH_BITS = 60  # of the md5 of the text: the first 15 hexadecimal digits
CELL_ROWS = 200_000  # rows that one task numbers at most, about
CELL_LEAST = 256  # smaller cells are never parted
LEVELS = ("h", "id", "n")


@dataclass(frozen=True)
class Bracket:
    """Keys whose levels before ``level`` equal ``fixed`` and whose level, shifted by ``shift``, equals ``prefix``."""

    level: int
    fixed: tuple[int, ...]
    shift: int
    prefix: int
    below: int  # exact bytes before the bracket

    def rows(self) -> Column:
        equal = [F.col(LEVELS[i]) == v for i, v in enumerate(self.fixed)]
        return reduce(lambda a, b: a & b, equal, F.shiftright(F.col(LEVELS[self.level]), self.shift) == self.prefix)

    def first(self) -> tuple[int, ...]:
        return (*self.fixed, self.prefix << self.shift)

    def behind(self) -> tuple[int, ...]:
        return (*self.fixed, (self.prefix + 1) << self.shift)


def text_hash(text: str) -> Column:
    return F.conv(F.substring(F.md5(text_or_empty(text)), 1, 15), 16, 10).cast("long")


def splitters(keys: DataFrame, shards: int, tolerance: int = 0) -> list[tuple[int, ...]]:
    """First keys of shards 1, 2, ...: tuples of one to three levels, in order.

    A splitter stands at the first probe whose preceding bytes come within ``tolerance`` of the target; with
    no such probe, behind the row in which the bytes pass the target. ``keys`` has h, id, n and size.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    found: dict[int, tuple[int, ...]] = {}
    brackets = {i: Bracket(0, (), HASH_BITS, 0, 0) for i in range(1, shards)}
    while brackets:
        parts = _counted(keys, list(dict.fromkeys(brackets.values())))
        for i, bracket in list(brackets.items()):
            target, below, now = -(-total * i // shards), bracket.below, None
            for part, size in parts[bracket]:
                if abs(below - target) <= tolerance:
                    found[i] = part.first()
                elif below + size > target:
                    now = replace(part, below=below)
                    if part.level == len(LEVELS) - 1 and part.shift == 0:  # one row
                        found[i] = part.behind()
                if now or i in found:
                    break
                below += size
            else:
                found[i] = part.behind()
            if i in found:
                del brackets[i]
            else:
                brackets[i] = now
    return [found[i] for i in sorted(found)]


def _counted(keys: DataFrame, brackets: list[Bracket]) -> dict[Bracket, list[tuple[Bracket, int]]]:
    """Exact bytes of the parts of each bracket, in key order: one pass, at most 2 ** BITS rows per bracket."""
    single = [b for b in brackets if b.shift == 0]  # one value left on this level: part the next one
    ends = {}
    if single:
        found = keys.agg(*[f(F.when(b.rows(), F.col(LEVELS[b.level + 1]))) for b in single for f in (F.min, F.max)]).first()
        ends = {b: found[2 * k:2 * k + 2] for k, b in enumerate(single)}
    which, part = F.lit(None).cast("int"), F.lit(None).cast("long")
    inner = []
    for k, b in enumerate(brackets):
        level, fixed, shift = b.level, b.fixed, max(0, b.shift - BITS)
        if b in ends:
            low, high = ends[b]
            level, fixed, shift = b.level + 1, (*b.fixed, b.prefix), 0
            while (high >> shift) - (low >> shift) >= 1 << BITS:
                shift += 1
        inner.append((level, fixed, shift))
        which = F.when(b.rows(), k).otherwise(which)
        part = F.when(b.rows(), F.shiftright(F.col(LEVELS[level]), shift)).otherwise(part)
    counted = (keys.select(which.alias("k"), part.alias("p"), "size").where("k is not null")
               .groupBy("k", "p").agg(F.sum("size").alias("size")).collect())
    out: dict[Bracket, list[tuple[Bracket, int]]] = {b: [] for b in brackets}
    for k, p, size in sorted(tuple(r) for r in counted):
        level, fixed, shift = inner[k]
        out[brackets[k]].append((Bracket(level, fixed, shift, p, 0), size))
    return out


def shard_of(cuts: list[tuple[int, ...]], levels: tuple[str, ...] = LEVELS) -> Column:
    """How many splitters stand at or before a row's key."""
    def reached(cut: tuple[int, ...]) -> Column:
        out = F.lit(True)
        for name, value in reversed(list(zip(levels, cut))):
            out = (F.col(name) > value) | ((F.col(name) == value) & out)
        return out
    return sum((reached(cut).cast("int") for cut in cuts), F.lit(0))


def shard(docs: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
          tolerance: int = 0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) plus ``size``, ``shard`` and ``slot``; law ``bytes``. A column of the
    input with one of these names stays, the new one then has an underscore in front; ids are numbers or texts of numbers.

    Sizes per shard differ by one row at most when the tolerance is 0. Slots are gapless from 0 in each shard.
    A null text has no bytes; every row weighs a byte more than its text. Null ids, repeated rows and empty
    inputs are fine. Copies of a text are neighbours and share a shard unless a splitter falls among them.
    What is kept is staged once with its keys; the rounds then read four numbers per row.
    """
    keep = docs.columns if keep is None else keep
    out_names = [fresh(keep, name) for name in ("size", "shard", "slot")]
    staged = stage_table(docs.select(
        *[col(c).alias(f"kept{i}") for i, c in enumerate(keep)], (F.octet_length(text_or_empty(text)) + 1).cast("long").alias("size"),
        text_hash(text).alias("h"), F.coalesce(col(doc_id).cast("long"), F.lit(-(1 << 62))).alias("id"), F.monotonically_increasing_id().alias("n")))
    keys = staged.select(*LEVELS, "size")
    prefix, part = "prefix", "part"
    placed = staged.withColumns({"shard": shard_of(splitters(keys, shards, tolerance)), prefix: F.shiftright("h", HASH_BITS - BITS)})
    # cells with far more rows than the others, or more than one task should number, are parted;
    # there are 2 ** BITS cells plus one per splitter, so the broadcast is bounded
    rows = placed.groupBy(F.col("shard").alias("s"), F.col(prefix).alias("p")).agg(F.count("*").alias("rows"))
    usual = F.greatest(F.lit(CELL_LEAST), F.ceil(2 * F.avg("rows").over(Window.partitionBy())))
    parts = rows.select("s", "p", F.ceil(F.col("rows") / F.least(F.lit(cell_rows), usual)).alias("parts"))
    placed = (placed.join(F.broadcast(parts), (F.col("shard") == F.col("s")) & (F.col(prefix) == F.col("p")))
              .withColumn(part, F.pmod(F.xxhash64("id", "n"), F.col("parts"))).drop("s", "p", "parts"))
    counts = placed.groupBy("shard", prefix, part).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy(prefix, part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", prefix, part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    cell = Window.partitionBy("shard", prefix, part).orderBy(*LEVELS)
    numbered = placed.withColumn("slot", F.row_number().over(cell).cast("long") - 1)  # the one exchange of the rows
    out = numbered.join(starts, ["shard", prefix, part]).withColumn("slot", F.col("slot") + F.col("start"))
    return out.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(keep)], *[F.col(c).alias(n) for c, n in zip(("size", "shard", "slot"), out_names)])
