"""Distributions, statistics and counts, each in as few passes as the result allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain import rules
from opsgrain.functions import telemetry as tok
from opsgrain.functions.core import np_round, py_round
from opsgrain.operators.ordering import top_k_values
from opsgrain.operators.quantiles import exact_quantiles, quantile, upper_median
from opsgrain.session import attach_row


def unpivot(one_row: DataFrame, names: dict[str, str], key: str, value: str) -> DataFrame:
    """Columns of a short frame to rows (key, value); ``names`` maps column to key text."""
    pairs = F.array(*[F.struct(F.lit(label).alias(key), F.col(f"`{c}`").cast("double").alias(value))
                      for c, label in names.items()])
    return one_row.select(F.inline(pairs))


def with_share(counted: DataFrame, total: DataFrame, name: str = "pct", digits: int = 2) -> DataFrame:
    """Adds the share of ``count`` in the one-row frame ``total`` (column n) in percent."""
    raw = attach_row(counted, total, "_t").withColumn("_share", F.col("count") / F.col("_t.n") * 100)
    return raw.withColumn(name, py_round("_share", digits)).drop("_t", "_share")


def _counted(df: DataFrame, *keys: Column) -> DataFrame:
    """Counts per key; ``known`` is 0 for the null value. Filters on it stay above the aggregation, so that the
    counts and their total share one scan."""
    return df.groupBy(*keys).agg(F.count("*").alias("count"), F.count(keys[-1]).alias("known"))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """value, count, share in percent of all rows (null values count in the total only)."""
    counted = _counted(df, F.col(col).alias("value"))
    total = counted.agg(F.sum(F.when(F.col("known") >= 0, F.col("count"))).alias("n"))
    return with_share(counted, total).where("known > 0").drop("known")


def value_distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Several distributions of one frame in one scan: (column, value, count, pct)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counted = _counted(df.select(F.inline(pairs)), F.col("column"), F.col("value"))
    total = counted.agg(F.sum(F.when((F.col("known") >= 0) & (F.concat("column", F.lit("")) == cols[0]), F.col("count"))).alias("n"))
    return with_share(counted, total).where("known > 0").drop("known")


def dominant_values(df: DataFrame, col: str, pct: float = 80.0) -> DataFrame:
    return value_distribution(df, col).where(F.col("pct") > pct)


def label_imbalance(sequences: DataFrame, limit: float = 70.0) -> DataFrame:
    """Label shares, with the flag of the normal class above ``limit`` percent."""
    named = sequences.select(tok.label_name("label").alias("label_name"))
    shares = value_distribution(named, "label_name").withColumnRenamed("value", "label_name")
    return shares.withColumn("bias_detected", (F.col("label_name") == "Normal") & (F.col("pct") > limit))


def failure_rate_by(tasks: DataFrame, col: str) -> DataFrame:
    rate = np_round(F.count_if(F.col("status") == "Failed") / F.count("*") * 100, 2)
    return tasks.groupBy(col).agg(rate.alias("failure_pct"))


def selection_rate_by(df: DataFrame, col: str, flag: Column) -> DataFrame:
    return df.groupBy(F.col(col).cast("string").alias("group")).agg(
        (F.count_if(flag) / F.count("*")).alias("selection_rate"), F.count("*").alias("count"))


def between_group_difference(rates: DataFrame, limit: float = 0.1) -> DataFrame:
    spread = F.max("selection_rate") - F.min("selection_rate")
    return rates.agg(spread.alias("disparity"), (spread > limit).alias("bias_detected"))


def sequence_stats(sequences: DataFrame) -> DataFrame:
    """(metric, value): sizes, label counts, token counts and quality counts."""
    length = F.coalesce(F.size("sequence_ids"), F.lit(0))
    rows = sequences.agg(
        F.count("*").alias("total_sequences"),
        F.min(length).alias("length_min"), F.max(length).alias("length_max"),
        py_round(F.avg(length), 2).alias("length_mean"),
        F.count_if(F.size("sequence_ids") == 0).alias("empty_sequences"),
        F.count_if(~F.col("label").between(0, 4)).alias("invalid_labels"),
        F.count_if(F.col("sequence_ids").isNull() | F.col("label").isNull()).alias("missing_fields"),
        *[F.count_if(F.col("label") == k).alias(f"label_{name}") for k, name in rules.LABEL_NAMES.items()])
    # counted per token first: the vocabulary is small, so nothing wide is shuffled
    vocabulary = sequences.select(F.explode("sequence_ids").alias("t")).groupBy("t").agg(F.count("*").alias("n"))

    def in_range(lo: int, hi: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("t").between(lo, hi), F.col("n"))), F.lit(0))

    tokens = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"), in_range(100, 109).alias("cpu_tokens"),
        in_range(200, 209).alias("memory_tokens"), F.count("*").alias("unique_tokens"))
    names = {c: c for c in rows.columns}
    both = unpivot(rows, names, "metric", "value").unionByName(
        unpivot(tokens, {c: c for c in tokens.columns}, "metric", "value"))
    return both


def null_rates(df: DataFrame) -> DataFrame:
    rates = df.agg(*[np_round(F.count_if(F.col(c).isNull()) / F.count("*") * 100, 2).alias(c) for c in df.columns])
    return unpivot(rates, {c: c for c in df.columns}, "column", "null_pct")


def profile_events(events: DataFrame) -> DataFrame:
    """(section, name, value) of the unified table: one narrow aggregation for rows and nulls, one grouping
    of five columns for their values and how many different ones there are."""
    summary = events.agg(
        F.count("*").alias("total_rows"), F.lit(len(events.columns)).alias("total_columns"),
        *[np_round(F.count_if(F.col(c).isNull()) / F.count("*") * 100, 2).alias(f"null_{c}") for c in events.columns])
    table = [("table", c, c) for c in ("total_rows", "total_columns")]
    table += [("null_rates_pct", c, f"null_{c}") for c in events.columns]
    rows = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"),
                              F.col(c).cast("double").alias("value")) for s, n, c in table])
    listed, unique = ["system", "severity", "event_type"], {"event_id": "unique_event_ids", "event_template": "unique_event_templates"}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in (*listed, *unique)])
    counted = _counted(events.select(F.inline(pairs)), F.col("column"), F.col("value")).where("known > 0")
    one = F.col("column").isin(*listed)
    named = F.when(one, F.col("column")).otherwise("table").alias("section")
    label = F.when(one, F.col("value"))
    for c, name in unique.items():
        label = label.when(F.col("column") == c, name)
    found = counted.select(named, label.alias("name"), F.when(one, F.col("count")).otherwise(1).alias("n")) \
        .groupBy("section", "name").agg(F.sum("n").cast("double").alias("value"))
    return summary.select(F.inline(rows)).unionByName(found)


def _long(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*extra, F.inline(pairs))


_QUARTILES = {"q25": quantile(0.25), "median": quantile(0.5), "q75": quantile(0.75)}


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample std, min, quartiles, max."""
    long = _long(df, cols)
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(long, "value", _QUARTILES, ["column"])
    return basic.join(quartiles, "column", "left")


def describe_text(df: DataFrame, cols: Sequence[str], short: dict[str, int] | None = None) -> DataFrame:
    """Per text column: length statistics and the share check of short texts."""
    limits = short or {"question_body": 50, "answer_body": 100}
    lengths = df.select(*[F.length(c).alias(c) for c in cols])
    long = _long(lengths, cols)
    limit = F.lit(None).cast("int")
    for c, n in limits.items():
        limit = F.when(F.col("column") == c, F.lit(n)).otherwise(limit)
    few = F.count_if(F.col("value") < limit)
    basic = long.groupBy("column").agg(
        F.avg("value").alias("avg_length"), F.min("value").cast("bigint").alias("min_length"),
        F.max("value").cast("bigint").alias("max_length"), F.sum("value").cast("bigint").alias("total_chars"),
        few.alias("short_texts"), (few > F.count("*") * 0.1).alias("too_many_short"))
    return basic.join(exact_quantiles(long, "value", {"median_length": quantile(0.5)}, ["column"]), "column")


def column_statistics(df: DataFrame, cols: Sequence[str] | None = None, top_columns: Sequence[str] = (), top: int = 5) -> DataFrame:
    """(column, statistic, value) for every numeric, text and boolean column.

    Numeric columns get moments and quartiles, text columns lengths and distinct counts. The ``top`` most
    frequent values of the columns in ``top_columns`` are listed as ``top:<value>``.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    total = F.count("*")
    nulls = [F.struct(F.lit(f.name).alias("column"), F.lit(s).alias("statistic"), v.cast("double").alias("value"))
             for f in fields for s, v in (
                 ("count", F.count(f.name)), ("null_count", F.count_if(F.col(f.name).isNull())),
                 ("null_percentage", F.count_if(F.col(f.name).isNull()) / total * 100))]
    for c in texts:
        n = F.length(c)
        nulls += [F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), v.cast("double").alias("value"))
                  for s, v in (("min_length", F.min(n)), ("max_length", F.max(n)), ("mean_length", F.avg(n)))]
    out = df.agg(F.array(*nulls).alias("rows")).select(F.inline("rows"))
    if numeric:
        described = describe_numeric(df, numeric).drop("count")
        stats = [c for c in described.columns if c != "column"]
        pairs = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value")) for s in stats])
        out = out.unionByName(described.select("column", F.inline(pairs)))
    if texts:
        # different texts are told apart by 128 bits, so no text is shuffled
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.unhex(F.md5(c)).alias("text")) for c in texts])
        distinct = df.select(F.inline(pairs)).where(F.col("text").isNotNull()).distinct().groupBy("column").agg(F.count("*").alias("d"))
        out = out.unionByName(distinct.select("column", F.lit("unique_count").alias("statistic"),
                                              F.col("d").cast("double").alias("value")))
    for c in top_columns:
        best = top_k_values(df, c, top)
        out = out.unionByName(best.select(F.lit(c).alias("column"), F.concat(F.lit("top:"), F.col(c).cast("string")).alias("statistic"),
                                          F.col("n").cast("double").alias("value")))
    return out


def _row_hash(cols: Sequence[str]) -> list[Column]:
    """128 bits of the values and of where they are null."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(i), nulls, *cols).alias(f"_h{i}") for i in (1, 2)]


def dataset_info(df: DataFrame) -> DataFrame:
    """Rows, columns and rows that repeat an earlier row in full; rows are compared by 128 bits of their values."""
    groups = df.select(*_row_hash(df.columns)).groupBy("_h1", "_h2").agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                      F.lit(len(df.columns)).alias("column_count"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def array_value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    counted = df.select(F.explode(col).alias("value")).groupBy("value").agg(F.count("*").alias("count"))
    return counted if top is None else counted.orderBy(F.desc("count"), F.asc("value")).limit(top)


def outlier_bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    quartiles = exact_quantiles(_long(df, cols), "value", {"q1": quantile(0.25), "q3": quantile(0.75)}, ["column"])
    iqr = F.col("q3") - F.col("q1")
    return quartiles.select("column", (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
                            (F.col("q3") + 1.5 * iqr).alias("upper_bound"))


def iqr_outliers(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Rows outside Q1 - 1.5 IQR .. Q3 + 1.5 IQR: (key, column, value, bounds)."""
    # one row per listed column on the broadcast side
    judged = _long(df, cols, [key]).join(F.broadcast(outlier_bounds(df, cols)), "column")
    v = F.col("value")
    return judged.where((v < F.col("lower_bound")) | (v > F.col("upper_bound"))).select(
        key, "column", "value", "lower_bound", "upper_bound")


def outlier_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Outliers per column and whether they exceed five percent of the rows."""
    judged = _long(df, cols).join(F.broadcast(outlier_bounds(df, cols)), "column")
    out = F.count_if((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
    return judged.groupBy("column").agg(
        out.alias("outliers"), (out > F.count("*") * rules.OUTLIER_ROW_SHARE).alias("flagged"))


def duplicate_ratio(df: DataFrame, key: str, limit: float = rules.MAX_DUPLICATE_RATIO) -> DataFrame:
    """Rows beyond the first of their key; null is one key. Keys are compared by 128 bits, so no text is shuffled."""
    per_key = df.select(*_row_hash([key])).groupBy("_h1", "_h2").agg(F.count("*").alias("n"))
    extra, rows = F.sum(F.col("n") - 1), F.sum("n")
    return per_key.agg(extra.alias("duplicates"), (extra / rows).alias("duplicate_ratio"),
                       F.when(extra / rows > limit, "failed").when(extra > 0, "warning")
                       .otherwise("passed").alias("status"))


def missing_ratio(df: DataFrame, cols: Sequence[str], limit: float = rules.MAX_MISSING_RATIO) -> DataFrame:
    shares = df.agg(*[(F.count_if(F.col(c).isNull()) / F.count("*")).alias(c) for c in cols])
    ratio = F.col("missing_ratio")
    return unpivot(shares, {c: c for c in cols}, "column", "missing_ratio").withColumn(
        "status", F.when(ratio > limit, "failed").when(ratio > 0, "warning").otherwise("passed"))


def quality_feature_stats(qa: DataFrame) -> DataFrame:
    """(feature, value, number): mean quality, then the type and complexity distributions."""
    mean = qa.agg(F.avg("quality_score").alias("number")).select(
        F.lit("avg_quality_score").alias("feature"), F.lit("").alias("value"), "number")
    dist = value_distributions(qa, ["question_type", "complexity"])
    return mean.unionByName(dist.select(F.col("column").alias("feature"), "value",
                                        F.col("count").cast("double").alias("number")))


def combined_counts(combined: DataFrame, *by: str) -> DataFrame:
    return combined.groupBy(*by).agg(F.count("*").alias("count"))


def upper_median_stats(long: DataFrame) -> DataFrame:
    """(metric, count, min, max, mean 1 dp, upper median) of a (metric, value) frame."""
    basic = long.groupBy("metric").agg(
        F.count("*").alias("count"), F.min("value").cast("bigint").alias("min"),
        F.max("value").cast("bigint").alias("max"), py_round(F.avg("value"), 1).alias("mean"))
    median = exact_quantiles(long, "value", {"median": upper_median}, ["metric"])
    return basic.join(median.withColumn("median", F.col("median").cast("bigint")), "metric")
