"""Generated workflows and chat tables: records, statistics, structural checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import explode_rows, json_valid

ROLES = ("system", "user", "assistant")
KINDS = ("array", "object", "string", "number", "NoneType")
TOO_SHORT = "short_record: fewer than three messages"
NO_ROLES = "roles_incomplete: a system, user or assistant turn is absent"
NO_ROLE = "role_absent: "
NOT_JSON = "answer_not_json: the assistant turn does not parse"


def generated_to_chat(raw: DataFrame, assistant_name: str = rules.ASSISTANT_NAME) -> DataFrame:
    """(user_intent, tool_context, workflow_json) rows to chat records."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    tools = F.concat(F.lit(f"{assistant_name} can use these tools: "), F.coalesce("tool_context", F.lit("")))
    answer = F.concat(F.lit('{"workflow": '), F.col("workflow_json"), F.lit("}"))
    return raw.withColumn("messages", F.array(
        turn("system", tools), turn("user", F.col("user_intent")), turn("assistant", answer)))


def format_b_stats(records: DataFrame, intent: str | None = None) -> DataFrame:
    short = F.col("messages").isNull() | (F.size("messages") < 3)
    missing = F.count_if(F.coalesce(F.col(intent), F.lit("")) == "") if intent else F.lit(0).cast("bigint")
    return records.agg(F.count("*").alias("row_count"), missing.alias("missing_user_intent"),
                       F.count_if(short).alias("records_missing_valid_messages"))


def infer_record_schema(lines: DataFrame, col: str = "value") -> DataFrame:
    """(field, kind) over all records, plus ``record_count``.

    Every record contributes its keys. A field with several kinds has the first of ``KINDS`` that occurs, so the
    result does not depend on row order. A record's field and kind are projected before anything is grouped.
    """
    doc = F.try_parse_json(col)
    keys = lines.select(F.explode(F.json_object_keys(col)).alias("field"), doc.alias("d"))
    kind_text = F.schema_of_variant(F.try_variant_get("d", F.concat(F.lit('$["'), F.col("field"), F.lit('"]')), "variant"))
    kind = F.when(kind_text.startswith("ARRAY"), "array").when(kind_text.startswith("OBJECT"), "object") \
        .when(kind_text == "STRING", "string").when(kind_text == "VOID", "NoneType").otherwise("number")
    seen = keys.select("field", kind.alias("kind")).groupBy("field").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    named = seen.select("field", F.coalesce(*[F.when(F.col(k) > 0, k) for k in KINDS]).alias("kind"))
    count = lines.agg(F.lit("record_count").alias("field"), F.count("*").cast("string").alias("kind"))
    return named.unionByName(count)


def _role_content(role: str) -> Column:
    """Content of the last message with that role."""
    hits = F.filter("messages", lambda m: m["role"] == role)
    return F.element_at(F.when(F.size(hits) > 0, hits), -1)["content"]


def _has_role(role: str) -> Column:
    return F.exists("messages", lambda m: m["role"] == role)


def _errors(df: DataFrame, key: str, conditions: list[tuple[Column, Column | str]]) -> DataFrame:
    parts = [F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in conditions]
    return explode_rows(df, F.array_compact(F.array(*parts)), "error", key)


def validate_sequences(sequences: DataFrame, key: str) -> DataFrame:
    """One row per broken rule: ids present, not empty, whole numbers; label 0..4."""
    ids, label = F.col("sequence_ids"), F.col("label")
    return _errors(sequences, key, [
        (ids.isNull(), "missing sequence_ids"),
        (label.isNull(), "missing label"),
        (F.coalesce(F.size(ids), F.lit(0)) <= 0, "sequence_ids is empty"),
        (~F.coalesce(label.between(0, 4), F.lit(False)), F.concat(F.lit("invalid label "), F.coalesce(label.cast("string"), F.lit("None")))),
        (F.coalesce(F.exists(ids, lambda t: t.isNull()), F.lit(False)), "non-integer token"),
    ])


def validate_chats(chats: DataFrame, key: str) -> DataFrame:
    """At least three messages; system, user and assistant all present. One row per bad record."""
    few = F.coalesce(F.size("messages"), F.lit(0)) < 3
    roles = F.lit(True)
    for r in ROLES:
        roles = roles & _has_role(r)
    return _errors(chats, key, [
        (few, TOO_SHORT),
        (~few & ~roles, NO_ROLES),
    ])


def chat_anomalies(chats: DataFrame, key: str) -> DataFrame:
    """Short records, every missing role, and assistant content that is no JSON."""
    few = F.coalesce(F.size("messages"), F.lit(0)) < 3
    answer = _role_content("assistant")
    return _errors(chats, key, [
        (few, TOO_SHORT),
        *[(~few & ~_has_role(r), NO_ROLE + r) for r in ROLES],
        (~few & (F.coalesce(answer, F.lit("")) != "") & ~json_valid(answer), NOT_JSON),
    ])
