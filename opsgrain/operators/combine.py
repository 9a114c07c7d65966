"""Unions of finished datasets with their source name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.functions.core import as_col, json_text, json_valid


def combine_sequences(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Token sequences of all given datasets; none at all is an error."""
    if not inputs:
        raise FileNotFoundError("no input datasets found")
    out = None
    for source, df in inputs.items():
        part = df.select("sequence_ids", "label", F.lit(source).alias("source_dataset"))
        out = part if out is None else out.unionByName(part)
    return out


def tag_record(line: Column | str, source: Column | str) -> Column:
    """The JSON object text with a ``source_dataset`` member added last.

    The other members keep their text, so numbers, nulls and key order survive untouched. A
    record that already has the member ends up with ours, because readers take the last one.
    """
    body = F.regexp_replace(F.rtrim(as_col(line)), r"\}\s*$", "")
    comma = F.when(F.trim(body) == "{", F.lit("")).otherwise(F.lit(", "))
    return F.concat(body, comma, F.lit('"source_dataset": '), json_text(source), F.lit("}"))


def combine_chats(inputs: Mapping[str, DataFrame], col: str = "value") -> DataFrame:
    """JSON lines of differently shaped records: (source_dataset, value). Blank and malformed
    lines are skipped."""
    out = None
    for source, df in inputs.items():
        part = df.select(F.lit(source).alias("source_dataset"), F.trim(F.col(col)).alias("value"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError("no input datasets found")
    good = out.where(F.col("value").startswith("{") & json_valid("value"))
    return good.withColumn("value", tag_record("value", "source_dataset"))
