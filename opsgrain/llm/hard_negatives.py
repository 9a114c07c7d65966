"""Hard negatives by threshold joins over an inverted index, with thresholds that fall until every window is full.

Anchors are searched against all rows in a grid of bounded cells. In a cell the rows form an inverted index: the
dimensions have one order for all rows, largest energy first, and a row's last dimensions stay out of the index as
long as their norm, times that of the longest anchor, cannot reach the threshold. Partial scores are accumulated dimension
by dimension; pairs whose partial score plus the product of the remaining norms stays below the anchor's threshold are pruned,
the others are completed from the dimensions left out, so every score is exact. A first series of joins finds the
positives of each anchor, a second one the negatives of each window below them. A threshold is a share of the anchor's
norm; anchors whose windows are full, or have been seen down to their lower ends, leave before it is lowered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from opsgrain.llm.common import col
from opsgrain.session import stage_table

# fixed values of the query
SCALE = 256
EVERY = 50
NOISY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score

LEVELS = (0.6, 0.45, 0.35, 0.27, 0.2, 0.12, 0.06, 0.0)  # thresholds as shares of the 99th percentile of the norms
CELL = 1 << 15  # rows, and anchors, of a cell at most (about)
SPREAD = 48  # cells that small inputs are dealt to
TILE = 256, 4096  # anchors and rows whose scores are held at once
STEP = 8  # dimensions between two prunings


class Index:
    """Inverted index of one cell's rows for scores of at least ``level`` times an anchor's norm."""

    def __init__(self, vectors: np.ndarray, level: float):
        square = (vectors.astype(np.float64) ** 2)[:, ::-1].cumsum(1)[:, ::-1]
        self.rest = np.sqrt(np.hstack([square, np.zeros((len(vectors), 1))]))  # norm from a dimension on
        depth = (self.rest >= level).sum(1) if level > 0 else np.full(len(vectors), vectors.shape[1])
        # rows with the most indexed dimensions first: every dimension's posting list is a leading part of the rows
        self.order = np.argsort(-depth, kind="stable")
        self.depth, self.rest, self.full = depth[self.order], self.rest[self.order], vectors[self.order]
        self.indexed = np.where(np.arange(vectors.shape[1]) < self.depth[:, None], self.full, 0)

    def join(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) arrays of all pairs that reach the anchor's ``least`` score."""
        dims = anchors.shape[1]
        square = (anchors.astype(np.float64) ** 2)[:, ::-1].cumsum(1)[:, ::-1]
        norm = np.sqrt(np.hstack([square, np.zeros((len(anchors), 1))]))
        slack = 1e-9 * (1 + norm[:, 0].max(initial=0) * self.rest[:, 0].max(initial=0))
        for q in range(0, len(anchors), TILE[0]):
            for x in range(0, len(self.full), TILE[1]):
                yield from self._tile(anchors, norm, least - slack, least, slice(q, q + TILE[0]), slice(x, x + TILE[1]), dims)

    def _tile(self, anchors, norm, floor, least, q, x, dims):
        a, n, low = anchors[q], norm[q], floor[q]
        rows, rest, depth = self.indexed[x], self.rest[x], self.depth[x]
        score = np.zeros((len(a), len(rows)), a.dtype)
        pairs = None
        for d in range(0, dims, STEP):
            listed = int(np.searchsorted(-depth, -d))  # rows with more than d indexed dimensions
            if not listed:
                break
            score[:, :listed] += a[:, d:d + STEP] @ rows[:listed, d:d + STEP].T
            if d + STEP < dims and d >= dims // 2:
                at = min(d + STEP, dims)
                # what is not accumulated yet starts at the row's depth or here, whichever comes first
                begin = np.minimum(depth, at)
                alive = score + n[:, begin] * rest[np.arange(len(rows)), begin] >= low[:, None]
                if alive.sum() * 16 < alive.size:
                    pairs = np.nonzero(alive)
                    break
        if pairs is None:
            alive = score + n[:, depth] * rest[np.arange(len(rows)), depth] >= low[:, None]
            pairs = np.nonzero(alive)
        full = self.full[x]
        for at in range(0, len(pairs[0]), 1 << 16):
            i, j = pairs[0][at:at + (1 << 16)], pairs[1][at:at + (1 << 16)]
            exact = np.einsum("ij,ij->i", a[i], full[j])
            hit = exact >= least[q][i]
            yield i[hit] + q.start, self.order[j[hit] + x.start], exact[hit].astype(np.int64)


def _matrix(lists: pa.ChunkedArray, order: Sequence[int], kind: type) -> np.ndarray:
    """Vectors as rows with their dimensions in the common order; short ones are padded with zeros."""
    lists = lists.combine_chunks()
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), len(order)), kind)
    out[np.arange(len(order)) < lengths[:, None]] = flat
    return out[:, list(order)]


def _best(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k of each group, higher scores first, then by ``tie``."""
    by = np.lexsort((tie, -score, group))
    g = group[by]
    start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return by[rank < k]


class _Found:
    """Best candidates of every window so far."""

    def __init__(self, k: int):
        self.k, self.held, self.size, self.parts = k, None, 0, []

    def add(self, window, score, tie, row):
        if len(window):
            part = np.stack([window, score, tie, row])
            self.parts.append(part[:, _best(*part[:3], self.k)])
            self.size += self.parts[-1].shape[1]
            if self.size > 1 << 20:
                self.close()

    def close(self) -> np.ndarray:
        parts = [p for p in (self.held, *self.parts) if p is not None]
        self.held, self.parts, self.size = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), np.int64), [], 0
        self.held = self.held[:, _best(*self.held[:3], self.k)]
        return self.held


def _search(order: Sequence[int], level: float, same: bool, k: int, kind: type, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Join of one cell. Anchors bring windows (no, low, high); a window's hits are rows of the same (or of another) label within it."""
    schema = pa.schema([("anchor", pa.int64()), ("no", pa.int32()), ("id", id_type), ("row", pa.int64()), ("score", pa.int64())])

    def join(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return schema.empty_table()
        found = _Found(k)
        a, x = _matrix(anchors["v"], order, kind), _matrix(rows["v"], order, kind)
        windows = anchors["w"].to_pylist()
        most = max(map(len, windows), default=0)
        low, high = np.full((len(windows), most), 1, np.int64), np.zeros((len(windows), most), np.int64)
        for i, w in enumerate(windows):
            low[i, :len(w)], high[i, :len(w)] = [p["low"] for p in w], [p["high"] for p in w]
        least = anchors["least"].to_numpy()
        al, xl = anchors["label"].to_numpy(), rows["label"].to_numpy()
        ak, xk = anchors["row"].to_numpy(), rows["row"].to_numpy()
        by_id = np.empty(rows.num_rows, np.int64)
        by_id[pc.sort_indices(rows, [("id", "ascending"), ("row", "ascending")], null_placement="at_end").to_numpy()] = np.arange(rows.num_rows)
        labels = np.intersect1d(al, xl) if same else [None]
        for label in labels:
            ai, xi = (np.flatnonzero(al == label), np.flatnonzero(xl == label)) if same else (np.arange(len(al)), np.arange(len(xl)))
            for i, j, score in Index(x[xi], level).join(a[ai], least[ai]):
                i, j = ai[i], xi[j]
                fit = (ak[i] != xk[j]) if same else (al[i] != xl[j])
                i, j, score = i[fit], j[fit], score[fit]
                for w in range(most):
                    inside = (score >= low[i, w]) & (score <= high[i, w])
                    found.add(i[inside] * most + w, score[inside], by_id[j[inside]], j[inside])
        window, score, _, row = found.close()
        number = [windows[w // most][w % most]["no"] for w in window.tolist()]
        return pa.table([anchors["row"].take(window // max(1, most)), pa.array(number, pa.int32()), rows["id"].take(row), rows["row"].take(row),
                         pa.array(score, pa.int64())], schema=schema)

    return join


def _level(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int], join, id_type: str) -> DataFrame:
    """Hits of all cells: anchor groups by row groups, every row in one cell per anchor group and the other way round."""
    across, down = grid
    left = (anchors.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(across)))
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).withColumn("cell", F.col("g") * down + F.col("cell")).drop("g"))
    right = (rows.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(down)))
             .withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).withColumn("cell", F.col("cell") * down + F.col("g")).drop("g"))
    left, right = (side.toDF(*side.columns) for side in (left, right))  # both come from one table: columns get names of their own
    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(join, f"anchor long, no int, id {id_type}, row long, score long")


def _falling(rows: DataFrame, anchors: DataFrame, windows: DataFrame, top: float, search, same: bool, k: int) -> DataFrame:
    """(anchor, no, id, row, score, rank) of the first k rows of every window (anchor, no, low, high).

    A window is done once it holds k rows at or above the threshold, or the threshold is at its lower end.
    """
    done, open_ = [], windows
    for share in LEVELS:
        asked = open_.groupBy("anchor").agg(F.collect_list(F.struct("no", "low", "high")).alias("w"), F.min("low").alias("bottom"))
        least = F.greatest(F.ceil(F.lit(share * top) * F.col("norm")), F.col("bottom")).alias("least")
        some = anchors.join(asked, F.col("row") == F.col("anchor")).select("id", "row", "label", "v", least, "w")
        hits = search(some, share * top, same, k)
        order = Window.partitionBy("anchor", "no").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
        best = stage_table(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        if share == LEVELS[-1]:
            done.append(best)
            break
        filled = best.groupBy("anchor", "no").agg(F.count("*").alias("n"))
        # the threshold of an anchor is never above what its norm asks for, so a window that starts there has been seen whole
        lowest = anchors.select(F.col("row").alias("r"), F.ceil(F.lit(share * top) * F.col("norm")).alias("seen"))
        state = (open_.join(lowest, F.col("anchor") == F.col("r")).join(filled, ["anchor", "no"], "left")
                 .withColumn("full", (F.coalesce("n", F.lit(0)) >= k) | (F.col("seen") <= F.col("low"))))
        state = stage_table(state.select("anchor", "no", "low", "high", "full"))
        done.append(best.join(state.where("full").select("anchor", "no"), ["anchor", "no"], "left_semi"))
        open_ = state.where("not full").drop("full")
        if open_.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mine(rows: DataFrame, is_anchor: Column, *, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    Rows without a label or with a vector that is null or has a null or non-finite component take no part; components become
    floor(scale * x), vectors of different lengths are padded with zeros. Rows that repeat id, label and vector are one row. An id that
    different rows share names each of them; null ids come last among equal scores. Scores have to fit a long: a longer vector is an error.
    Columns beyond those named are not read; without rows or anchors the result is empty. Positives with a
    negative score have no window, so the thresholds end at zero.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kind_of_id = rows.select(col(vec_id)).schema[0].dataType
    id_type = kind_of_id.simpleString()
    used = rows.where(col(label).isNotNull() & col(vector).isNotNull() & finite)
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    used = used.select(col(vec_id).alias("id"), col(label).alias("label"), whole.alias("v"), is_anchor.alias("anchor"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    used = used.dropDuplicates(["id", "label", "v"]).withColumn("norm", F.sqrt(square))
    used = used.withColumn("norm", F.when(F.col("norm") < 2.0 ** 31, F.col("norm")).otherwise(F.raise_error(F.lit("a vector is too long for scores in a long"))))
    used = used.withColumn("row", F.monotonically_increasing_id())
    used = stage_table(used.select("id", "row", "label", "v", "norm", F.coalesce("anchor", F.lit(False)).alias("anchor")))
    anchors = used.where("anchor").drop("anchor")
    n, asked, top, longest = used.agg(F.count("*"), F.count_if("anchor"), F.percentile_approx("norm", 0.99), F.max("norm")).first()
    energy = used.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x").cast("double") * F.col("x")).alias("e"))
    order = [r.d for r in energy.orderBy(F.desc("e"), "d").select("d").collect()]  # one row per dimension
    grid = max(1, -(-asked // CELL)), max(1, -(-n // CELL), min(SPREAD, -(-n // 512)))
    kind = np.float64 if (longest or 0) ** 2 < 2 ** 52 else np.int64  # partial scores are exact in either

    def search(some: DataFrame, level: float, same: bool, k: int) -> DataFrame:
        return _level(used.select("id", "row", "label", "v"), some, grid, _search(order, level, same, k, kind, to_arrow_type(kind_of_id)), id_type)

    everything = anchors.select(F.col("row").alias("anchor"), F.lit(0).alias("no"), F.lit(0).cast("long").alias("low"), F.lit((1 << 63) - 1).alias("high"))
    near = stage_table(_falling(used, anchors, everything, top or 0.0, search, True, positives)
                       .select("anchor", F.col("rank").alias("no"), F.col("id").alias("positive_id"), F.col("score").alias("p")))
    windows = near.select("anchor", "no", F.expr(f"({low} * cast(p as decimal(20, 0)) + 99) div 100").alias("low"),
                          F.expr(f"{high} * cast(p as decimal(20, 0)) div 100").alias("high"))
    hard = _falling(used, anchors, windows, top or 0.0, search, False, negatives)
    named = near.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(hard, ["anchor", "no"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), F.col("p").alias("positive_score"),
                                                     F.col("score").alias("negative_score"))
