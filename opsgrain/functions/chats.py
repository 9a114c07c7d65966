"""Function-calling chats: calls, signatures, error handling, tiers, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import as_col, first_match, json_text, json_valid


def function_calls(chat: Column | str, raw_chars: int | None = None) -> Column:
    """array<struct<name, arguments, raw, malformed>>; ``arguments`` is JSON text.

    A single-quoted argument object is unquoted before parsing. A call that still does not
    parse keeps its raw text, or as many characters of it as ``raw_chars`` says.
    """
    found = F.regexp_extract_all(as_col(chat), F.lit("(?d)" + rules.CALL_PATTERN), F.lit(1))
    fixed = F.transform(found, lambda m: F.struct(
        m.alias("raw"), F.regexp_replace(m, rules.UNQUOTE_PATTERN, "$1").alias("text")))
    judged = F.transform(fixed, lambda c: F.struct(c["raw"].alias("raw"), c["text"].alias("text"),
                                                   json_valid(c["text"]).alias("ok")))

    def call(c: Column) -> Column:
        arguments = F.get_json_object(c["text"], "$.arguments")
        has_name = F.array_contains(F.json_object_keys(c["text"]), "name")
        return F.struct(
            F.when(c["ok"] & has_name, F.get_json_object(c["text"], "$.name")).alias("name"),
            F.when(c["ok"], F.when(json_valid(arguments), arguments).otherwise(
                F.when(arguments.isNotNull(), json_text(arguments)))).alias("arguments"),
            F.when(c["ok"], c["text"]).otherwise(
                c["raw"] if raw_chars is None else F.substring(c["raw"], 1, raw_chars)).alias("raw"),
            (~c["ok"]).alias("malformed"),
        )

    return F.transform(judged, call)


def has_malformed(calls: Column) -> Column:
    return F.exists(calls, lambda c: c["malformed"])


def has_parallel(calls: Column) -> Column:
    return F.size(calls) > 1


def call_complexity(calls: Column) -> Column:
    first = F.get(calls, F.lit(0))
    args = F.coalesce(first["arguments"], F.lit("{}"))
    small = F.coalesce(F.size(F.json_object_keys(args)) <= 2, F.lit(False)) & args.startswith("{")
    return first_match(
        [
            (F.size(calls) == 0, "none"),
            (F.size(calls) > 1, "complex"),
            (first["malformed"], "malformed"),
            (small, "simple"),
        ],
        "moderate",
    )


def function_signatures(system: Column | str) -> Column:
    """map<name, struct<description, parameters, required>>; at most one entry, because the
    widest ``{...}`` span of the prompt has to be one JSON object with a name."""
    text = F.regexp_extract(as_col(system), r"(?s)\{.*\}", 0)
    usable = json_valid(text) & F.array_contains(F.json_object_keys(text), "name")
    parameters = F.get_json_object(text, "$.parameters")
    keys = F.json_object_keys(F.get_json_object(parameters, "$.properties"))
    required = F.from_json(F.get_json_object(parameters, "$.required"), "array<string>")
    empty = F.array().cast("array<string>")
    entry = F.struct(
        F.coalesce(F.get_json_object(text, "$.description"), F.lit("")).alias("description"),
        F.coalesce(keys, empty).alias("parameters"),
        F.coalesce(required, empty).alias("required"),
    )
    name = F.coalesce(F.get_json_object(text, "$.name"), F.lit("null"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(
        "array<struct<description:string,parameters:array<string>,required:array<string>>>"))
    return F.when(F.coalesce(usable, F.lit(False)), F.create_map(name, entry)).otherwise(none)


def error_keywords_found(chat: Column | str) -> Column:
    low = F.lower(as_col(chat))
    return F.array_compact(F.array(*[F.when(low.contains(k), F.lit(k)) for k in rules.ERROR_KEYWORDS]))


def has_function_error(chat: Column | str) -> Column:
    return F.lower(as_col(chat)).rlike(rules.FUNCTION_ERROR)


def has_conditional_error(chat: Column | str) -> Column:
    return F.lower(as_col(chat)).rlike("(?d)" + rules.CONDITIONAL_ERROR)


def count_turns(chat: Column | str) -> Column:
    return F.regexp_count(as_col(chat), F.lit("USER:"))


def turn_bucket(n: Column | str) -> Column:
    """Right-closed cuts with an open end; without a turn there is no bucket."""
    n = as_col(n)
    return F.when((n > 0) & (n <= 1), "single").when((n > 1) & (n <= 3), "short") \
        .when((n > 3) & (n <= 5), "medium").when(n > 5, "long")


def call_bucket(n: Column | str) -> Column:
    n = as_col(n)
    return F.when((n > -1) & (n <= 0), "no_calls").when((n > 0) & (n <= 1), "one_call") \
        .when((n > 1) & (n <= 2), "two_calls").when(n > 2, "many_calls")
