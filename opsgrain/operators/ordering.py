"""Global row index, count windows, time windows, top-n, first-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import telemetry as tok
from opsgrain.operators.winners import first_rows
from opsgrain.session import attach_row, stage_table

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def with_global_index(df: DataFrame, order: Sequence[Column | str], name: str = "row_index",
                      partitions: int | None = None) -> DataFrame:
    """Exact 0-based position in a total order, without a single-task sort.

    Range partitioning spreads the rows (a hot prefix is split because the order is total),
    every partition numbers its own rows while it is written to the shared folder, and the
    partition offsets, one row per partition, are added back. Stages one table.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stored = stage_table(placed.withColumn("_spot", F.monotonically_increasing_id()))
    part = F.shiftright("_spot", _ROW_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # one row per partition, so the broadcast is bounded by the partition count
    return (
        stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_spot").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_part", "_spot", "_offset")
    )


def count_windows(usage: DataFrame, order: Sequence[str] = ("time_stamp", "machine_id"), size: int = 5,
                  partitions: int | None = None) -> DataFrame:
    """Tumbling blocks of ``size`` rows in global time order; a short tail is dropped.

    The blocks are put together by ``max(when(slot = i))`` instead of a collected list: the
    rows of a block are neighbours after the sort, so nearly all of them meet in the map-side
    aggregation and one row per block is shuffled. ``order`` has to be a total order.
    """
    slim = usage.select(*order, tok.cpu_token("cpu_util_percent").alias("_cpu"),
                        tok.mem_token("mem_util_percent").alias("_mem"))
    placed = with_global_index(slim, order, "_i", partitions)
    slot = F.col("_i") % size
    aggs = [F.count("*").alias("_rows")]
    for i in range(size):
        aggs += [F.max(F.when(slot == i, F.col("_cpu"))).alias(f"_cpu{i}"),
                 F.max(F.when(slot == i, F.col("_mem"))).alias(f"_mem{i}")]
    blocks = placed.groupBy(F.floor(F.col("_i") / size).alias("window_index")).agg(*aggs)
    tokens = [F.col(f"_{kind}{i}") for i in range(size) for kind in ("cpu", "mem")]
    return blocks.where(F.col("_rows") == size).select(
        "window_index", F.array(*tokens).alias("sequence_ids"),
        tok.usage_label(F.col(f"_cpu{size - 1}"), F.col(f"_mem{size - 1}")).alias("label"),
    )


def pad_or_truncate(arr: Column | str, length: int = rules.MAX_SEQUENCE_LENGTH) -> Column:
    """Keep the last ``length`` items, or fill up with zeros on the right."""
    a = F.col(arr) if isinstance(arr, str) else arr
    missing = F.greatest(F.lit(length) - F.size(a), F.lit(0))
    return F.when(F.size(a) > length, F.slice(a, -length, length)).otherwise(
        F.concat(a, F.array_repeat(F.lit(0), missing)))


def _first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key with their ``_rank``; a hot key is cut to a bounded number of rows before one task sees it.

    Spark applies the limit of a rank before the shuffle only up to a threshold; for a larger n the
    rows are first cut inside salted parts of their key.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > threshold:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(256)).alias("_salt")
        salted = df.select("*", salt)
        inside = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rank", F.row_number().over(inside)).where(F.col("_rank") <= n).drop("_rank", "_salt")
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n)


def time_windows(events: DataFrame, width: str, length: int) -> DataFrame:
    """Per system and window the last ``length`` event numbers in time order, and the highest class.

    ``events`` has system, ts, raw_id, event_int and event_class; rows without a time drop out.
    The kept events are chosen by rank, which is limited before the shuffle and so keeps a hot
    window small. The class is the maximum over all rows of the window.
    """
    timed = events.where(F.col("ts").isNotNull()).select(
        "system", F.window("ts", width)["start"].alias("window_start"), "ts",
        F.col("raw_id").try_cast("bigint").alias("_pos"), "raw_id", "event_int", "event_class")
    keys = ["system", "window_start"]
    labels = timed.groupBy(*keys).agg(F.max("event_class").alias("label"))
    kept = _first_ranked(timed, keys, [F.desc("ts"), F.desc("_pos"), F.desc("raw_id")], length)
    lists = kept.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.negative("_rank").alias("r"), "event_int"))).alias("_seq"))
    return lists.join(labels, keys).select(
        *keys, F.transform("_seq", lambda x: x["event_int"]).alias("sequence_ids"), "label")


def top_n_per_group(counted: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key in the given order; the limit is applied before the shuffle."""
    return _first_ranked(counted, keys, order, n).drop("_rank")


def top_k_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """Most frequent values; ties go to the smaller value. Null is no value."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(col)).limit(k)


def top_values_only(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """Rows whose value is among the k most frequent."""
    return df.join(top_k_values(df, col, k).select(col), col, "left_semi")


def minmax_weight(df: DataFrame, col: str, name: str = "sample_weight") -> DataFrame:
    """Scale to 0.5..1.5; equal values all weigh 1."""
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    weight = F.when(hi > lo, F.lit(0.5) + (F.col(col) - lo) / (hi - lo)).otherwise(F.lit(1.0))
    return attach_row(df, bounds, "_b").withColumn(name, weight).drop("_b")


def dedup_by_hash(df: DataFrame, key: str, order: str, limit: int | None = None) -> DataFrame:
    """First row per key by ``order``; with a limit the first ``limit`` keys in that order.

    Winners are chosen on key, order and place, then fetched by place. Of rows that tie on both, the one with the
    smallest hash of its content stays. Null is a key like any other, and the last in order.
    """
    return first_rows(df, [key], order, limit)


def take_sample(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def rank_by_quality(df: DataFrame, score: str = "quality_score", tie: str = "question_id") -> DataFrame:
    return df.orderBy(F.desc(score), F.asc(tie))
