"""Exact quantiles in two passes: a quantile sketch brackets every wanted rank, a count inside the bracket decides.

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here the first pass builds one
mergeable KLL sketch per group, a few kilobytes whatever the group's size, and takes from it two values that enclose each
wanted rank by several times the sketch's error. The second pass counts, per group and rank, how many values lie below
the bracket (one number per task) and how often each value inside it occurs (about 1.5 % of the rows, before they are counted
on the map side). Inside a bracket a histogram of 65,536 cells leads to the cell of the rank, so that only a few
values are put in order. A rank outside its bracket would be an error, never a wrong value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.session import stage_table

_SKETCH = 2048  # the sketch's k
_ERROR = 2.296 / _SKETCH ** 0.9021  # of a normalised rank, in 99 of 100 cases
_MARGIN = 3 * _ERROR  # nearly eight standard errors on each side
_GRID = 1024  # ranks whose values are read off a sketch
_CELLS = 65_536


def quantile(q: float) -> Callable[[Column], Column]:
    """0-based position of a linearly interpolated quantile among n values."""
    return lambda n: (n - 1) * F.lit(float(q))


def upper_median(n: Column) -> Column:
    """Position n div 2: the upper of the two middle values."""
    return F.floor(n / 2).cast("double")


def _brackets(values: DataFrame, keys: Sequence[str], positions: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, _total, _i, _first, _last, _lo, _hi): per position its one or two ranks, and two values that enclose them."""
    sketches = values.groupBy(*keys).agg(F.count("*").alias("_total"), F.kll_sketch_agg_double("_v", F.lit(_SKETCH)).alias("_sketch"))
    # the function takes constant ranks only: a grid of them, of which the ones around a bracket are used
    grid = F.kll_sketch_get_quantile_double("_sketch", F.lit([i / _GRID for i in range(_GRID + 1)]))
    spots = F.array(*[F.struct(F.lit(i).alias("_i"), F.floor(p).cast("bigint").alias("_first"), F.ceil(p).cast("bigint").alias("_last"))
                      for i, p in enumerate(at(F.col("_total").cast("double")) for at in positions.values())])
    low, high = F.col("_first") / F.col("_total") - _MARGIN, (F.col("_last") + 1) / F.col("_total") + _MARGIN
    first, last = F.floor(F.greatest(F.lit(0.0), low) * _GRID), F.ceil(F.least(F.lit(1.0), high) * _GRID)
    return (sketches.select(*keys, "_total", grid.alias("_grid"), F.inline(spots))
            .select(*keys, "_total", "_i", "_first", "_last", F.get("_grid", first.cast("int")).alias("_lo"), F.get("_grid", last.cast("int")).alias("_hi")))


def _ranked(counted: DataFrame, within: Sequence[str], by: str) -> DataFrame:
    """Cells or values with how many rows come before them; those that hold the wanted rank stay."""
    before = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.where((F.col("_left") >= F.col("_start")) & (F.col("_left") < F.col("_start") + F.col("_n")))


def _match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal keys, null being a key like any other."""
    named = right.withColumnsRenamed({c: f"_m{c}" for c in on})
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_m{c}")) for c in on], "left").drop(*[f"_m{c}" for c in on])


def exact_quantiles(
    df: DataFrame, value: str, positions: Mapping[str, Callable[[Column], Column]],
    groups: Sequence[str] = (),
) -> DataFrame:
    """One row per group (one row in all without groups) with a column per position; null and NaN are no values."""
    names = list(groups) or ["_all"]
    keys = [f"_g{i}" for i in range(len(names))]
    base = df if groups else df.withColumn("_all", F.lit(0))
    v = F.col(value).cast("double")
    values = base.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    brackets = stage_table(_brackets(values, keys, positions))  # a row per group and position

    bounds = brackets.select(*[F.col(k).alias(f"_b{k}") for k in keys], "_i", "_lo", "_hi")
    same = [F.col(k).eqNullSafe(F.col(f"_b{k}")) for k in keys]
    counted = (values.join(bounds, [*same, F.col("_v") <= F.col("_hi")])
               .select(*keys, "_i", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_in"))
               .groupBy(*keys, "_i", "_in").agg(F.count("*").alias("_n")))

    spot = [*keys, "_i"]
    span = counted.groupBy(*spot).agg(F.coalesce(F.sum(F.when(F.col("_in").isNull(), F.col("_n"))), F.lit(0)).alias("_below"),
                                      F.min("_in").alias("_from"), F.max("_in").alias("_to"))
    ranks = brackets.select(*keys, "_i", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_rank"))
    at = [*spot, "_rank"]
    wanted = _match(ranks, span, spot).select(*[F.col(c).alias(f"_c{c}") for c in at], (F.col("_rank") - F.col("_below")).alias("_left"), "_from", "_to")
    width = F.col("_to") - F.col("_from")
    cell = F.when((width > 0) & (width < float("inf")), F.floor((F.col("_in") - F.col("_from")) / width * (_CELLS - 1))).otherwise(0).cast("bigint")
    placed = counted.where("_in is not null").join(wanted, [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in spot])
    placed = placed.select(*[F.col(f"_c{c}").alias(c) for c in at], "_in", "_n", cell.alias("_cell"), "_left")
    chosen = _ranked(placed.groupBy(*at, "_cell", "_left").agg(F.sum("_n").alias("_n")), at, "_cell")
    chosen = chosen.select(*at, "_cell", (F.col("_left") - F.col("_start")).alias("_left"))
    few = _match(placed.drop("_left"), chosen, [*at, "_cell"]).where("_left is not null")
    exact = _ranked(few, at, "_in")

    by_rank = exact.groupBy(*keys).agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("_rank", "_in")))).alias("_at"))  # two ranks per position
    totals = brackets.where("_i = 0").select(*keys, "_total")
    found = _match(totals, by_rank, keys)
    out = []
    for name, place in positions.items():
        p = place(F.col("_total").cast("double"))
        low, high = (F.coalesce(F.col("_at")[r.cast("bigint")], F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")) for r in (F.floor(p), F.ceil(p)))
        out.append((low + (high - low) * (p - F.floor(p))).alias(name))
    return found.select(*[F.col(k).alias(n) for k, n in zip(keys, names) if groups], *out)
