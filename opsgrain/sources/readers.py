"""File sources with explicit schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain import rules
from opsgrain.functions.core import json_valid, strip

# fixed values: column names and types of the headerless telemetry files
TELEMETRY_COLUMNS: Mapping[str, Mapping[str, str]] = {
    "usage": {
        "time_stamp": "bigint", "machine_id": "string", "cpu_util_percent": "double", "mem_util_percent": "double",
        "net_in": "double", "net_out": "double", "disk_io_percent": "double", "extra": "string",
    },
    "batch": {
        "start_time": "bigint", "end_time": "bigint", "inst_num": "int", "task_type": "int", "job_id": "string",
        "status": "string", "plan_cpu": "double", "plan_mem": "double",
    },
    "event": {
        "time_stamp": "bigint", "machine_id": "string", "event_type": "string", "event_detail": "string",
        "plan_cpu": "double", "plan_mem": "double", "extra": "string",
    },
}


def _text_schema(cols: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def read_telemetry_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Headerless CSV; the usual missing-value texts are null, numbers that do not parse too."""
    cols = TELEMETRY_COLUMNS[kind]
    raw = spark.read.schema(_text_schema(cols)).option("escape", '"').csv(path, header=False)

    def typed(name: str, to: str):
        text = F.when(~F.col(name).isin(*rules.CSV_NULL_TOKENS), F.col(name))
        if to == "string":
            return text.alias(name)
        number = text.try_cast("double")
        return (number if to == "double" else number.try_cast(to)).alias(name)

    return raw.select(*[typed(c, t) for c, t in cols.items()])


def read_string_csv(spark: SparkSession, path: str, columns: Iterable[str], multi_line: bool = False) -> DataFrame:
    """CSV with a header; every column is text and an empty field is the empty text.

    ``multi_line`` allows line breaks inside quotes, at the price that a file is not split.
    """
    raw = spark.read.schema(_text_schema(columns)).option("escape", '"').option("multiLine", multi_line) \
        .option("enforceSchema", False).csv(path, header=True)
    return raw.fillna("")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, on_bad: str = "skip") -> DataFrame:
    """One JSON object per line; blank lines are ignored.

    ``on_bad="skip"`` drops malformed lines (``line_report`` counts and ``bad_lines`` returns them), ``"keep"`` adds
    them as rows with the line in ``_bad_line``, ``"fail"`` makes the first one an error when the rows are computed.
    """
    lines = spark.read.text(path).where(strip("value") != "")
    ok = json_valid("value")
    if on_bad == "keep":
        return lines.select(F.when(ok, F.from_json("value", schema)).alias("r"), F.when(~ok, F.col("value")).alias("_bad_line")).select("r.*", "_bad_line")
    if on_bad == "skip":
        lines = lines.where(ok)
    else:
        lines = lines.withColumn("value", F.when(ok, F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("malformed JSON line: "), F.substring("value", 1, 80))).cast("string")))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def bad_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The lines that are neither blank nor valid."""
    return lines.where((strip(col) != "") & ~json_valid(col))


def line_report(lines: DataFrame, col: str = "value") -> DataFrame:
    """(line_status, count) over blank, valid and malformed lines."""
    status = F.when(strip(col) == "", "blank").when(json_valid(col), "valid").otherwise("malformed")
    return lines.groupBy(status.alias("line_status")).agg(F.count("*").alias("count"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole-file JSON array. A file is one task, so this is an import path only."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_code_chunks(spark: SparkSession, folder: str, columns: Iterable[str] = rules.CODE_COLUMNS) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/chunk_*.parquet").select(*columns)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def require_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    missing = [p for p in paths if not _exists(spark, p)]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def optional_inputs(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, str]:
    """The inputs that exist; none at all is an error."""
    found = {name: p for name, p in paths.items() if _exists(spark, p)}
    if not found:
        raise FileNotFoundError("no input files found: " + ", ".join(paths.values()))
    return found
