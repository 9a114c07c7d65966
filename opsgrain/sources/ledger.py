"""Incremental batches: an append-only table of processed ids instead of a flag per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.session import drop_table, stage_table


def unprocessed(prompts: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    return prompts.join(ledger.select(key).distinct(), key, "left_anti")


def mark_processed(ledger_path: str, done: DataFrame, prompts: DataFrame, ledger: DataFrame, key: str = "id") -> int:
    """Append the ids of existing prompts that were asked to be marked; the number of prompts
    touched comes back. An empty list writes nothing."""
    touched = stage_table(prompts.select(key).join(done.select(key).distinct(), key, "left_semi"))  # counted and written alike
    count = touched.count()
    if count:
        touched.join(ledger.select(key).distinct(), key, "left_anti").write.mode("append").parquet(ledger_path)
    drop_table(touched)
    return count


def reset(spark: SparkSession, ledger_path: str, key: str = "id") -> None:
    spark.createDataFrame([], f"{key} bigint").write.mode("overwrite").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str, key: str = "id") -> DataFrame:
    return spark.read.schema(f"{key} bigint").parquet(ledger_path).select(F.col(key))
