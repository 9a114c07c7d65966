"""The jobs put the operators together in their usual order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.operators import code, combine, generated, logs, qa, quality, slices, telemetry
from opsgrain.operators import chats as chat_ops
from opsgrain.operators.ordering import count_windows, minmax_weight, pad_or_truncate, time_windows
from opsgrain.operators.sampling import balance_classes, capped_downsample, oversample_slices, train_test_split
from opsgrain.session import stage_table


def telemetry_sequences(usage: DataFrame, tasks: DataFrame, events: DataFrame, *,
                        usage_order: Sequence[str], task_key: Sequence[str], event_key: Sequence[str]) -> DataFrame:
    """Token sequences of the three telemetry tables with a row identity (source, row_id)."""

    def tagged(df: DataFrame, source: str, *key: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.concat_ws("-", *[F.col(k).cast("string") for k in key])
                         .alias("row_id"), "sequence_ids", "label")

    return telemetry.all_telemetry_sequences(
        tagged(count_windows(usage, usage_order), "usage", "window_index"),
        tagged(telemetry.batch_sequences(tasks, *task_key), "batch", *task_key),
        tagged(telemetry.event_sequences(events, *event_key), "event", *event_key))


def telemetry_training_table(sequences: DataFrame, seed: int = rules.SEED) -> DataFrame:
    """Balanced classes. The input is staged: balancing reads it several times."""
    return balance_classes(stage_table(sequences), ["source", "row_id"], seed).select("sequence_ids", "label")


def unified_events(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The five raw log tables as one labelled event table."""
    return logs.label_event_types(logs.merge_events({s: logs.NORMALIZERS[s](raw[s]) for s in rules.SYSTEMS}))


def log_windows(events: DataFrame, width: str = "1 minute", length: int = rules.MAX_SEQUENCE_LENGTH) -> DataFrame:
    """Windows of the events. The five narrow columns they need are staged, because the label
    and the sequence each read them."""
    return time_windows(stage_table(logs.with_sequence_columns(events)), width, length)


def log_sequences(events: DataFrame, width: str = "1 minute") -> DataFrame:
    windows = log_windows(events, width)
    return windows.select(pad_or_truncate("sequence_ids").alias("sequence_ids"), "label")


def log_gate(events: DataFrame) -> DataFrame:
    """One-row verdict of the log suite and the schema check."""
    return quality.verdict(quality.check_suite(events, quality.log_suite()).unionByName(
        quality.expect_columns(events, rules.UNIFIED_COLUMNS)))


def qa_training_table(pairs: DataFrame, *, mitigate: bool = True, test_ratio: float = 0.2, seed: int = rules.SEED,
                      min_rows: int = 1, system_prompt: str | None = rules.QA_SYSTEM_PROMPT,
                      layout: str = "chat") -> DataFrame:
    """Features, optional oversampling, weights, exact split, chat or completion records.

    The features are staged: the bias report, the weights and the split all read them.
    """
    rows = stage_table(qa.qa_features(pairs)).withColumn("copy", F.lit(0).cast("bigint")) \
        .withColumn("drawn_for", F.lit(None).cast("string"))
    if mitigate:
        base = rows.drop("copy", "drawn_for")
        judged = slices.slice_bias(slices.slice_vs_overall(
            slices.slice_metrics(base, min_rows=min_rows), slices.overall_metrics(base)))
        advice = slices.mitigation_suggestions(judged).withColumn(
            "position", F.concat_ws(":", "dimension", "value", F.col("position").cast("string")))
        # the report is a table of its own, a few rows per slice
        advice = stage_table(advice)
        # read again by the weights and by the split
        rows = stage_table(oversample_slices(base, advice, ["question_id"], small=rules.SLICE_MIN_ROWS, seed=seed))
    weighted = minmax_weight(rows, "quality_score")
    row = F.concat_ws("|", F.coalesce("drawn_for", F.lit("")), F.col("question_id").cast("string"),
                      F.col("copy").cast("string"))
    split = train_test_split(weighted.withColumn("_row", row), ["_row"], test_ratio, seed)
    if layout == "chat":
        return qa.qa_to_chat(split, system_prompt, "sample_weight", keep=["split"])
    return qa.qa_to_completion(split, keep=["split"])


def chat_training_table(raw: DataFrame, assistant_name: str = rules.ASSISTANT_NAME) -> DataFrame:
    features = chat_ops.chat_features(raw)
    return chat_ops.functions_to_chat(features, assistant_name).select(
        "messages", "complexity_tier", "has_error_handling", "num_turns", "num_calls")


def code_training_table(files: DataFrame, cfg: code.GateConfig = code.GateConfig(), balanced: bool = False) -> DataFrame:
    """Records of the files that pass every gate; ``balanced`` thins the dominant kinds."""
    records = code.code_records(files, cfg)
    if not balanced:
        return records
    kinds = code.record_slices(stage_table(records)).withColumn("_sha", F.col("_meta.hexsha"))
    kept = capped_downsample(kinds, "iac_type", ["_sha"])
    return kept.select("messages", F.col("_meta").withField("sampling_weight", F.col("sampling_weight"))
                       .withField("iac_type", F.col("iac_type")).alias("_meta"))


def generated_training_table(raw: DataFrame, assistant_name: str = rules.ASSISTANT_NAME) -> DataFrame:
    return generated.generated_to_chat(raw, assistant_name).select("messages")


def combined_chat_lines(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Typed chat tables of any shape as one JSON-lines table with their source."""
    lines = {name: df.select(F.to_json(F.struct("*")).alias("value")) for name, df in datasets.items()}
    return combine.combine_chats(lines)
