"""Telemetry rows to token sequences (sequence_ids, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import telemetry as tok


def batch_sequences(tasks: DataFrame, *keep: str) -> DataFrame:
    """[cpu, planned memory, status] per task; ``keep`` names columns to carry along."""
    status = F.coalesce(F.col("status"), F.lit("Unknown"))
    cpu, mem = tok.cpu_token("plan_cpu"), tok.planned_mem_token("plan_mem")
    return tasks.select(
        *keep, F.array(cpu, mem, tok.status_token(status)).alias("sequence_ids"),
        tok.job_label(status, cpu, mem).alias("label"))


def event_sequences(events: DataFrame, *keep: str) -> DataFrame:
    """[event, cpu, planned memory] per server event; a failure is a network failure."""
    kind = F.coalesce(F.lower("event_type"), F.lit("unknown"))
    return events.select(
        *keep, F.array(tok.event_token(kind), tok.cpu_token("plan_cpu"),
                       tok.planned_mem_token("plan_mem")).alias("sequence_ids"),
        F.when(kind == "failure", F.lit(3)).otherwise(F.lit(0)).alias("label"))


def fill_job_defaults(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("status", F.coalesce("status", F.lit("Unknown"))) \
        .withColumn("task_type", F.coalesce(F.col("task_type").cast("int"), F.lit(-1)))


def all_telemetry_sequences(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def anomalous(sequences: DataFrame) -> DataFrame:
    return sequences.where(F.col("label") != 0).withColumn("label_name", tok.label_name("label"))


def critical(sequences: DataFrame) -> DataFrame:
    return anomalous(sequences.where(F.col("label").isin(*rules.CRITICAL_LABELS)))
