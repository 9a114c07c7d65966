"""Exact-size balancing, oversampling and splitting, all seeded by md5 of a row key.

Every operator needs columns that identify a row; the draw then does not depend on
partitioning, cluster size or run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import as_col, py_round, seeded_int, seeded_key
from opsgrain.operators.quantiles import exact_quantiles
from opsgrain.session import attach_row

_DRAWS_PER_TASK = 500_000
_PREFIX = 4  # hex digits of a hash bucket: 65,536 buckets per class


def with_class_index(df: DataFrame, class_col: str, key: Sequence[str], seed: int = rules.SEED,
                     name: str = "class_index", parts: int | None = None) -> DataFrame:
    """0-based position inside the class, in seeded random order; ``parts`` tasks sort, if given.

    Rows are ranked inside (class, hash bucket), so a class with a third of all rows still
    spreads over 65,536 window groups; the bucket offsets are added by a join.
    """
    keyed = df.withColumn("_key", seeded_key(seed, *key)) \
        .withColumn("_bucket", F.substring("_key", 1, _PREFIX))
    sizes = keyed.groupBy(class_col, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(class_col).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(class_col, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(class_col, "_bucket").orderBy("_key")
    return (
        (keyed.repartition(parts, class_col, "_bucket") if parts else keyed).withColumn("_local", F.row_number().over(local) - 1)
        .join(offsets, [class_col, "_bucket"])
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_key", "_bucket", "_local", "_offset")
    )


def draw_with_replacement(indexed: DataFrame, class_col: str, plan: DataFrame, seed: int = rules.SEED,
                          index: str = "class_index", copy: str = "copy", parts: int | None = None) -> DataFrame:
    """``plan`` has (class, size, draws): exactly ``draws`` rows come back per class.

    Draw d picks position md5(seed:class:d) mod size. The draws are counted per position
    before the join, so each drawn row crosses it once with its number of copies; ``copy``
    numbers them. Ranges of the draw list are dealt to ``parts`` tasks (default: the shuffle partitions); the number
    is given, as Spark would put the few small rows that stand for all draws together into one task. With ``parts``
    the join runs in as many tasks, and no side of it is broadcast: both grow with the input.
    """
    step, joined_in = 100_000, parts
    parts = parts or int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = plan.where(F.col("draws") > 0).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("draws") - 1) / step).cast("bigint"))))
    drawn = chunks.repartition(parts).select(class_col, "size", F.explode(F.sequence(
        F.col("_from") * step, F.least((F.col("_from") + 1) * step, F.col("draws")) - 1)).alias("_draw"))
    picked = drawn.select(class_col, (seeded_int(seed, class_col, "_draw") % F.col("size")).alias(index))
    if joined_in:
        picked, indexed = picked.repartition(parts, class_col, index), indexed.repartition(parts, class_col, index).hint("merge")
    times = picked.groupBy(class_col, index).agg(F.count("*").alias("_times"))
    return indexed.join(times, [class_col, index]).withColumn(
        copy, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1))).drop("_times")


def class_plan(df: DataFrame, class_col: str = "label") -> DataFrame:
    """Per class: size, rows to keep once, rows to draw with replacement. At most five rows.

    The target T is the largest failure class; normal rows are cut to 3 T, smaller failure
    classes are drawn up to T; without failures everything stays.
    """
    sizes = df.groupBy(class_col).agg(F.count("*").alias("size"))
    target = sizes.agg(F.max(F.when(F.col(class_col).between(1, 4), F.col("size"))).alias("t"))
    t, size, normal = F.col("_t.t"), F.col("size"), F.col(class_col) == 0
    planned = attach_row(sizes, target, "_t")
    draws = F.when(~normal & (size < t), t).otherwise(F.lit(0))
    keep = F.when(t.isNull(), size).when(normal, F.least(size, t * 3)) \
        .when(draws > 0, F.lit(0)).otherwise(size)
    return planned.where(F.col(class_col).between(0, 4)).select(
        class_col, "size", F.coalesce(draws, F.lit(0)).cast("bigint").alias("draws"), keep.alias("keep"))


def balance_classes(df: DataFrame, key: Sequence[str], seed: int = rules.SEED, class_col: str = "label") -> DataFrame:
    """Normal rows cut without replacement, small failure classes drawn with replacement.

    Row order is not part of the result; ``copy`` numbers the copies of a drawn row. The plan, five rows at
    most, is read first. Classes that stay whole pass a filter, the one that is cut is compared with its cut
    key, and only the small classes that are drawn get an index.
    """
    plan = {r[class_col]: r for r in class_plan(df, class_col).collect()}
    whole = [c for c, r in plan.items() if not r.draws and r.keep == r["size"]]
    drawn = [c for c, r in plan.items() if r.draws]
    label, copy = F.col(class_col), F.lit(0).cast("bigint").alias("copy")
    stays = label.isin(whole)
    for c, r in plan.items():
        if not r.draws and 0 < r.keep < r["size"]:
            cut = _hash_cut(df.where(label == c), key, seed, F.lit(r.keep)).first().cut
            stays = stays | ((label == c) & (seeded_key(seed, *key) <= F.lit(cut)))
    out = df.where(stays).select("*", copy)
    if drawn:
        wanted = df.sparkSession.createDataFrame([(c, plan[c]["size"], plan[c].draws) for c in drawn], f"{class_col} {dict(df.dtypes)[class_col]}, size bigint, draws bigint")
        # a drawn class has fewer rows than draws, so this bounds the rows of a task as well
        parts = math.ceil(sum(plan[c].draws for c in drawn) / _DRAWS_PER_TASK)
        indexed = with_class_index(df.where(label.isin(drawn)), class_col, key, seed, parts=parts)
        out = out.unionByName(draw_with_replacement(indexed, class_col, wanted, seed, parts=parts).select(*df.columns, "copy"))
    return out


def _hash_cut(df: DataFrame, key: Sequence[str], seed: int, first_rows: Column) -> DataFrame:
    """One row with the largest row key that still belongs to the first rows; their number may use ``_all``, that of all rows.

    Radix descent: count 65,536 buckets by the first four hex digits, then the same inside the
    bucket that holds the cut, then order the few keys that are left. No row is sorted.
    """
    keys = df.select(seeded_key(seed, *key).alias("_key"))

    def level(part: DataFrame, start: int, want: Column, carry: list[str]) -> DataFrame:
        counted = part.groupBy(F.substring("_key", start, _PREFIX).alias("_p"), *carry).agg(F.count("*").alias("_n"))
        run = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = counted.withColumn("_end", F.sum("_n").over(run)) \
            .withColumn("_all", F.sum("_n").over(Window.partitionBy()))
        return summed.withColumn("_want", want) \
            .where((F.col("_end") >= F.col("_want")) & (F.col("_end") - F.col("_n") < F.col("_want"))) \
            .select("_p", (F.col("_want") - (F.col("_end") - F.col("_n"))).alias("_left"))

    first = level(keys, 1, first_rows, [])
    second_keys = attach_row(keys, first, "_c1").where(F.substring("_key", 1, _PREFIX) == F.col("_c1._p"))
    second = level(second_keys.select("_key", F.col("_c1._left").alias("_need")), 1 + _PREFIX, F.col("_need"), ["_need"])
    both = attach_row(attach_row(keys, first, "_c1"), second, "_c2")
    final = both.where((F.substring("_key", 1, _PREFIX) == F.col("_c1._p"))
                       & (F.substring("_key", 1 + _PREFIX, _PREFIX) == F.col("_c2._p")))
    # about n / 2^32 different keys share eight hex digits; a key that repeats is counted, not collected
    run = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = final.groupBy("_key", "_c2._left").agg(F.count("*").alias("_n")).withColumn("_end", F.sum("_n").over(run))
    return counted.where((F.col("_end") >= F.col("_left")) & (F.col("_end") - F.col("_n") < F.col("_left"))).select(F.col("_key").alias("cut"))


def train_test_split(df: DataFrame, key: Sequence[str], test_ratio: float = 0.2, seed: int = rules.SEED) -> DataFrame:
    """Adds ``split``: exactly int(n * (1 - test_ratio)) rows are train, the rest test.

    ``key`` has to identify a row. The rows are not shuffled: each one is compared with the
    cut key, which three counting passes find.
    """
    cut = _hash_cut(df, key, seed, F.floor(F.col("_all") * F.lit(1 - test_ratio)))
    mine = seeded_key(seed, *key)
    return attach_row(df, cut, "_cut").withColumn(
        "split", F.when(mine <= F.col("_cut.cut"), "train").otherwise("test")).drop("_cut")


def sampling_weight(pct: Column) -> Column:
    raw = F.least(pct, F.lit(rules.MAX_SLICE_PCT)) / pct
    return F.when(pct <= 0, F.lit(1.0)).otherwise(py_round(F.greatest(F.lit(0.1), F.least(F.lit(5.0), raw)), 4))


def _class_shares(df: DataFrame, col: str, cap: float) -> DataFrame:
    sizes = df.groupBy(col).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("n"))
    pct = F.col("_n") / F.col("_t.n") * 100
    return attach_row(sizes, total, "_t").select(
        col, pct.alias("class_pct"), F.when(pct > cap, F.lit(cap) / pct).otherwise(F.lit(1.0)).alias("keep_ratio"))


def capped_downsample(df: DataFrame, col: str, key: Sequence[str], cap: float = rules.MAX_SLICE_PCT,
                      seed: int = rules.SEED) -> DataFrame:
    """Thin every class above ``cap`` percent to about that share; adds ``sampling_weight``.

    A row stays when its seeded hash, as a number in 0..1, does not exceed the keep ratio.
    The ratios are one row per value; Spark broadcasts them while they are small.
    """
    shares = _class_shares(df, col, cap)
    draw = seeded_int(seed, *key) / F.lit(float(16 ** 15))
    kept = df.join(shares, col).where(draw <= F.col("keep_ratio"))
    return kept.withColumn("sampling_weight", sampling_weight(F.col("class_pct"))).select(
        *df.columns, "sampling_weight")


def _race_time(weight: Column, seed: int, key: Sequence[str]) -> Column:
    """Exponential with rate ``weight``, seeded by the row key; null where the weight gives no chance at all."""
    w = weight.cast("double")
    drawn = (seeded_int(seed, *key) + 1) / F.lit(float(16 ** 15 + 1))  # in (0, 1)
    return F.when((w > 0) & ~F.isnan(w) & (w < float("inf")), -F.log(drawn) / w)


def weighted_sample(df: DataFrame, weight: Column | str, size: int | float, key: Sequence[str], seed: int = rules.SEED) -> DataFrame:
    """Exactly ``size`` rows (a float: that share of the rows that can be drawn) without replacement, each draw in proportion to weight.

    Every row gets an exponential time whose rate is its weight; the rows with the earliest times are what drawing one
    row after another would give. The time of the last of them is an exact quantile, so no row is sorted or moved: each
    is compared with that one time. ``key`` has to identify a row. Rows with a null, non-positive or non-finite
    weight are never drawn; with fewer rows than asked for all others come back.
    """
    time = _race_time(as_col(weight), seed, key)
    timed = df.select(time.alias("_time"))
    can = timed.agg(F.count("_time")).first()[0]
    wanted = min(size, can) if isinstance(size, int) else math.floor(can * size)
    if wanted < 1:
        return df.limit(0)
    cut = exact_quantiles(timed, "_time", {"cut": lambda n: F.lit(float(wanted - 1))}).first().cut
    return df.where(time <= F.lit(cut))


def slice_pairs(dimension: str, values: Column) -> Column:
    """array<struct<dimension, value>> of the distinct values of one row; null is no value."""
    known = F.array_distinct(F.array_compact(F.coalesce(values, F.array().cast("array<string>"))))
    return F.transform(known, lambda v: F.struct(F.lit(dimension).alias("dimension"), v.alias("value")))


def oversample_slices(df: DataFrame, suggestions: DataFrame, key: Sequence[str], max_slices: int | None = None,
                      small: int = rules.SLICE_MIN_ROWS, seed: int = rules.SEED, most_draws: int | None = None) -> DataFrame:
    """Add 2 n drawn rows, at most ``most_draws``, for the slices that ask for augmentation, or the first ``max_slices`` of them.

    ``suggestions`` has dimension, value, strategy, priority, position; only multi-valued
    dimensions (tags, error_signatures, infra_components) can be augmented and only slices with
    fewer than ``small`` rows are. ``drawn_for`` is null on the original rows.
    """
    dims = {"tags": "tag_", "error_signatures": "error_", "infra_components": "infra_"}
    chosen = suggestions.where((F.col("strategy") == "data_augmentation") & (F.col("priority") == "high")) \
        .where(F.col("dimension").isin(*dims) if max_slices is None else F.lit(True))
    if max_slices is not None:
        chosen = chosen.orderBy("position").limit(max_slices).where(F.col("dimension").isin(*dims))
    pairs = F.concat(*[slice_pairs(d, F.col(d)) for d in dims])
    members = df.withColumn("_s", F.explode(pairs)).withColumn("dimension", F.col("_s.dimension")) \
        .withColumn("value", F.col("_s.value")).drop("_s") \
        .join(chosen.select("dimension", "value").distinct(), ["dimension", "value"])
    tagged = members.withColumn("drawn_for", F.concat_ws("=", "dimension", "value")).drop("dimension", "value")
    sizes = tagged.groupBy("drawn_for").agg(F.count("*").alias("size")).where(F.col("size") < small)
    draws = F.col("size") * 2 if most_draws is None else F.least(F.col("size") * 2, F.lit(most_draws))
    plan = sizes.withColumn("draws", draws.cast("bigint"))
    indexed = with_class_index(tagged, "drawn_for", key, seed)
    drawn = draw_with_replacement(indexed, "drawn_for", plan, seed)
    cols = [*df.columns, "drawn_for", "copy"]
    original = df.withColumn("drawn_for", F.lit(None).cast("string")).withColumn("copy", F.lit(0).cast("bigint"))
    return original.select(*cols).unionByName(drawn.select(*cols))
