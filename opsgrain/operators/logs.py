"""Structured logs of five systems to one event table, and the tables made from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import logs as lg
from opsgrain.functions.core import json_object, np_round, py_round, stable_hash_keep, strip
from opsgrain.operators.ordering import top_n_per_group
from opsgrain.session import attach_row


def _unified(raw: DataFrame, system: str, timestamp: Column, severity: Column, extras: Column,
             raw_id: Column | None = None, source: Column | None = None) -> DataFrame:
    return raw.withColumn("_low", lg.lowered("Content")).select(
        F.lit(system).alias("system"), timestamp.alias("timestamp"), severity.alias("severity"),
        (source if source is not None else F.col("Component")).alias("source"),
        F.col("EventId").alias("event_id"), F.col("EventTemplate").alias("event_template"),
        F.col("Content").alias("message"),
        (raw_id if raw_id is not None else F.col("LineId")).alias("raw_id"),
        extras.alias("extras"), F.lit("").alias("event_type"))


def normalize_linux(raw: DataFrame) -> DataFrame:
    return _unified(raw, "linux", F.concat_ws(" ", "Month", "Date", "Time"),
                    lg.severity_by_keywords(F.col("_low")), json_object(pid="PID", level_raw="Level"))


def normalize_hpc(raw: DataFrame) -> DataFrame:
    """The line number stands in for a blank log id; the time is an epoch text and stays one."""
    log_id = F.when(strip("LogId") != "", F.col("LogId")).otherwise(F.col("LineId"))
    return _unified(raw, "hpc", F.col("Time"), lg.severity_hpc("State", "Flag", F.col("_low")),
                    json_object(node="Node", component="Component", state="State", flag="Flag"),
                    raw_id=log_id, source=F.concat(F.col("Node"), F.lit("|"), F.col("Component")))


def _dated(raw: DataFrame, system: str, errors, warns, extras: Column) -> DataFrame:
    return _unified(raw, system, F.concat_ws(" ", "Date", "Time"),
                    lg.severity_by_level("Level", F.col("_low"), errors, warns), extras)


def normalize_hdfs(raw: DataFrame) -> DataFrame:
    return _dated(raw, "hdfs", rules.HDFS_ERROR_KEYWORDS, rules.HDFS_WARN_KEYWORDS,
                  json_object(pid="Pid", level_raw="Level"))


def normalize_hadoop(raw: DataFrame) -> DataFrame:
    return _dated(raw, "hadoop", rules.HADOOP_ERROR_KEYWORDS, rules.HADOOP_WARN_KEYWORDS,
                  json_object(process="Process", level_raw="Level"))


def normalize_spark_logs(raw: DataFrame) -> DataFrame:
    return _dated(raw, "spark", rules.SPARK_ERROR_KEYWORDS, rules.SPARK_WARN_KEYWORDS,
                  json_object(level_raw="Level"))


NORMALIZERS = {
    "linux": normalize_linux,
    "hpc": normalize_hpc,
    "hdfs": normalize_hdfs,
    "hadoop": normalize_hadoop,
    "spark": normalize_spark_logs,
}


def merge_events(normalized: Mapping[str, DataFrame]) -> DataFrame:
    """Union of all five systems; a missing one is an error."""
    missing = [s for s in rules.SYSTEMS if s not in normalized]
    if missing:
        raise ValueError(f"missing normalized events for: {', '.join(missing)}")
    out = normalized[rules.SYSTEMS[0]]
    for system in rules.SYSTEMS[1:]:
        out = out.unionByName(normalized[system])
    return out


def label_event_types(events: DataFrame) -> DataFrame:
    return events.withColumn("_low", lg.lowered("message", "event_template")) \
        .withColumn("event_type", lg.event_type(F.col("_low"), "severity")).drop("_low")


def sample_events(events: DataFrame, pct: int = 10) -> DataFrame:
    return events.where(stable_hash_keep("system", "raw_id", pct))


def with_sequence_columns(events: DataFrame) -> DataFrame:
    """What ``time_windows`` needs: parsed time, event number, event class."""
    return events.select("system", "raw_id", lg.parse_event_ts("timestamp").alias("ts"),
                         lg.event_int("event_id").alias("event_int"),
                         lg.event_class("event_type", "event_template").alias("event_class"))


def templates_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for system, table in tables.items():
        tagged = table.withColumn("system", F.lit(system))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def used_templates(templates: DataFrame, events: DataFrame) -> DataFrame:
    """Templates whose id occurs in any event, one row per (id, system): the first by text."""
    ids = events.select(F.col("event_id").alias("EventId")).distinct()
    used = templates.join(ids, "EventId", "left_semi")
    return used.groupBy("EventId", "system").agg(F.min("EventTemplate").alias("EventTemplate"))


def uncovered_event_ids(events: DataFrame, templates: DataFrame) -> DataFrame:
    return events.select("event_id").distinct().join(
        templates.select(F.col("EventId").alias("event_id")).distinct(), "event_id", "left_anti")


def event_counts_by_window(events: DataFrame) -> DataFrame:
    bucket = lg.time_bucket("timestamp", "system").alias("time_bucket")
    return events.groupBy("system", "severity", "event_type", bucket).agg(F.count("*").alias("count"))


def error_rate_by_system(events: DataFrame) -> DataFrame:
    """Totals and errors in one pass; a bucket without errors has rate 0."""
    bucket = lg.time_bucket("timestamp", "system").alias("time_bucket")
    counted = events.groupBy("system", bucket).agg(
        F.count("*").alias("total"), F.count_if(F.col("severity") == "ERROR").alias("error_count"))
    return counted.withColumn("error_rate", np_round(F.col("error_count") / F.col("total"), 4))


def top_templates(events: DataFrame, n: int = rules.TOP_TEMPLATES) -> DataFrame:
    counted = events.groupBy("system", "event_id", "event_template").agg(F.count("*").alias("count"))
    return top_n_per_group(counted, ["system"],
                           [F.desc("count"), F.asc("event_id"), F.asc("event_template")], n)


def event_type_by_system(events: DataFrame) -> DataFrame:
    """Counts per event type and system with the total of the type."""
    pairs = events.groupBy("event_type", "system").agg(F.count("*").alias("count"))
    totals = pairs.groupBy("event_type").agg(F.sum("count").alias("total"))
    return pairs.join(totals, "event_type")


def dominance_flags(pivot: DataFrame) -> DataFrame:
    """Event types with at least five events of which one system has more than 80 %."""
    share = F.col("count") / F.col("total")
    return pivot.where((F.col("total") >= rules.DOMINANCE_MIN_TOTAL) & (share > rules.DOMINANCE_SHARE)).select(
        F.concat_ws("/", "system", "event_type").alias("slice"), F.lit("event_type_dominance").alias("metric"),
        py_round(share, 4).alias("value"), F.lit(rules.DOMINANCE_SHARE).alias("threshold"),
        F.lit("BIASED").alias("status"))


def system_profile(events: DataFrame) -> DataFrame:
    """Per system: size, share, errors, error rate, most frequent event type and all counts."""
    pairs = events.groupBy("system", "event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("severity") == "ERROR").alias("e"))
    per_system = pairs.groupBy("system").agg(
        F.sum("n").alias("count"), F.sum("e").alias("error_count"),
        F.min_by("event_type", F.struct(F.negative("n"), F.col("event_type"))).alias("top_event_type"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "n")))).alias("event_type_distribution"))
    total = per_system.agg(F.sum("count").alias("n"))
    return attach_row(per_system, total, "_t").select(
        "system", "count", py_round(F.col("count") / F.col("_t.n") * 100, 2).alias("pct_of_total"),
        "error_count", np_round(F.col("error_count") / F.col("count"), 4).alias("error_rate"),
        "top_event_type", "event_type_distribution")


def error_rate_flags(profile: DataFrame) -> DataFrame:
    """Systems whose rounded error rate is above twice the global rate."""
    overall = profile.agg((F.sum("error_count") / F.sum("count")).alias("rate"))
    limit = F.col("_g.rate") * rules.ERROR_RATE_MULTIPLIER
    return attach_row(profile, overall, "_g").where((F.col("error_rate") > limit) & (limit > 0)).select(
        F.col("system").alias("slice"), F.lit("error_rate").alias("metric"), F.col("error_rate").alias("value"),
        np_round("_g.rate", 4).alias("global_mean"), np_round(limit, 4).alias("threshold"),
        F.lit("BIASED").alias("status"))
