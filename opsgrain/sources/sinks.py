"""File sinks. Data sinks write one file per task; only small reports are put together."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.operators.quality import Check, judged
from opsgrain.session import hadoop_path


def write_sequences(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select("sequence_ids", "label", *[c for c in df.columns if c == "source_dataset"]).write.mode(mode).parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = False) -> None:
    """One object per line; absent members stay absent unless ``keep_nulls``."""
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path)


def write_json_lines(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    """Lines that already are JSON text."""
    df.select(col).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_report(rows: DataFrame, path: str, key: str, value: str, mode: str = "errorifexists", most_rows: int = 10_000) -> None:
    """A tidy (key, value) report as one JSON document; more than ``most_rows`` rows are an error, not a report."""
    few = rows.limit(most_rows + 1)
    if few.count() > most_rows:
        raise ValueError(f"a report has at most {most_rows} rows; write a table instead")
    doc = few.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v")))))).alias("value"))
    doc.coalesce(1).write.mode(mode).text(path)


def write_chunks(df: DataFrame, path: str, rows_per_file: int = rules.ROWS_PER_CHUNK, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("compression", "snappy").parquet(path)


def promote_if_valid(df: DataFrame, verdict: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write only when the one-row verdict says so."""
    valid = bool(verdict.select("is_valid").first()[0])
    if valid:
        df.write.mode(mode).parquet(path)
    return valid


def write_validated(df: DataFrame, checks: Sequence[Check], path: str, mode: str = "errorifexists") -> tuple[bool, DataFrame]:
    """Validate while writing: whether the rows were promoted to ``path``, and the rows of the suite.

    The rows are written once, to a folder beside ``path``, and the suite's values are observed as they pass; the input is never
    read again. Distinct counts cannot be observed: they read their own columns of what was written. If a check of severity error fails the
    folder is deleted and ``path`` stays as it was, else it is renamed to ``path``; with mode ``overwrite`` what was
    there gives way only then, and comes back if the renaming fails. A failed write leaves nothing behind either.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode} cannot be promoted as a whole")
    spark, tag = df.sparkSession, uuid.uuid4().hex
    target, files = hadoop_path(spark, path)
    if mode == "errorifexists" and files.exists(target):
        raise FileExistsError(path)
    parent, name = path.rstrip("/").rpartition("/")[::2]
    beside = f"{parent}/_{name}-{tag}"  # names with an underscore are hidden from readers of the folder above
    waiting, _ = hadoop_path(spark, beside)
    try:
        values = _write_observed(df, checks, beside)
        rows = spark.createDataFrame([values], ", ".join(f"c{i} double" for i in range(len(checks))))
        suite = judged(rows, checks)
        valid = suite.where("status = 'failed' and severity = 'error'").isEmpty()
        if valid:
            _promote(spark, files, waiting, target, f"{parent}/_{name}-{tag}-old")
        return valid, suite
    finally:
        files.delete(waiting, True)


def _write_observed(df: DataFrame, checks: Sequence[Check], path: str) -> tuple[float | None, ...]:
    seen = Observation()
    passing = {i: c for i, c in enumerate(checks) if not c.needs_all}
    observed = df.observe(seen, F.count("*").alias("rows"), *[c.value.cast("double").alias(f"c{i}") for i, c in passing.items()])
    observed.write.parquet(path)
    values = dict(seen.get)
    later = {i: c for i, c in enumerate(checks) if c.needs_all}
    if later:
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        values |= written.agg(*[c.value.cast("double").alias(f"c{i}") for i, c in later.items()]).first().asDict()
    return tuple(values[f"c{i}"] for i in range(len(checks)))


def _promote(spark, files, waiting, target, aside: str) -> None:
    old, _ = hadoop_path(spark, aside)
    replaces = files.exists(target)
    if replaces and not files.rename(target, old):
        raise OSError(f"cannot move {target.toString()} aside")
    if not files.rename(waiting, target):
        if replaces:
            files.rename(old, target)
        raise OSError(f"cannot promote to {target.toString()}")
    if replaces:
        files.delete(old, True)


def latest_alerts(history: DataFrame, new: DataFrame, ts: str = "ts", keep: int = rules.ALERT_HISTORY) -> DataFrame:
    """The last ``keep`` alerts of both; ties in time are ordered by all columns."""
    both = history.unionByName(new, allowMissingColumns=True)
    rest = [F.desc(c) for c in sorted(both.columns) if c != ts]
    return both.orderBy(F.desc(ts), *rest).limit(keep)


def append_alerts(history: DataFrame, new: DataFrame, path: str, ts: str = "ts",
                  keep: int = rules.ALERT_HISTORY) -> None:
    """Write the shortened history to a new path; the one being read is never overwritten."""
    latest_alerts(history, new, ts, keep).write.mode("errorifexists").json(path)
