"""Data-quality checks: one aggregation per suite, one row per check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import code as cd
from opsgrain.functions.core import explode_rows, json_valid, np_round, py_round, strip
from opsgrain.operators.ordering import top_n_per_group
from opsgrain.operators.profile import unpivot
from opsgrain.session import attach_row

CHECK_SCHEMA = ("check string, column string, status string, value double, threshold double, "
                "severity string, message string")


@dataclass(frozen=True)
class Check:
    """An aggregate value and the rule that judges it.

    ``severity`` error decides validity; ``warning`` marks the row as a warning; ``soft``
    counts as a failure in the summary without making the dataset invalid. ``needs_all``
    marks values that rows passing by cannot give, such as distinct counts.
    """

    name: str
    column: str
    value: Column
    passes: Callable[[Column], Column]
    threshold: float | None = None
    severity: str = "error"
    needs_all: bool = False


def _zero(v: Column) -> Column:
    return v == 0


def expect_not_null(cols: Iterable[str], or_empty: bool = False, severity: str = "error") -> list[Check]:
    def bad(c: str) -> Column:
        return (F.col(c).isNull() | (F.col(c) == "")) if or_empty else F.col(c).isNull()
    return [Check("not_null", c, F.count_if(bad(c)), _zero, 0.0, severity) for c in cols]


def expect_in_set(col: str, values: Sequence) -> Check:
    return Check("in_set", col, F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*values)), _zero, 0.0)


def expect_between(col: str, lo: float, hi: float) -> list[Check]:
    return [Check("min_in_range", col, F.min(col), lambda v: v >= lo, float(lo)),
            Check("max_in_range", col, F.max(col), lambda v: v <= hi, float(hi))]


def expect_row_count(lo: float | None = None, hi: float | None = None) -> list[Check]:
    out = []
    if lo is not None:
        out.append(Check("min_row_count", "table", F.count("*"), lambda v: v >= lo, float(lo)))
    if hi is not None:
        out.append(Check("max_row_count", "table", F.count("*"), lambda v: v <= hi, float(hi)))
    return out


def expect_unique(*cols: str) -> Check:
    """Rows beyond the first per key; null is a key of its own."""
    key = F.struct(*[F.col(c) for c in cols])
    return Check("unique", ",".join(cols), F.count("*") - F.count_distinct(key), _zero, 0.0, needs_all=True)


def expect_regex(col: str, pattern: str) -> Check:
    return Check("matches", col, F.count_if(~F.coalesce(F.col(col).rlike(pattern), F.lit(False))), _zero, 0.0)


def expect_length(col: str, lo: int) -> Check:
    return Check("min_length", col, F.count_if(F.length(col) < lo), _zero, float(lo))


def expect_min_value(col: str, lo: float) -> Check:
    return Check("min_value", col, F.min(col), lambda v: v >= lo, float(lo), "soft")


def expect_no_markup(col: str) -> Check:
    return Check("no_markup", col, F.count_if(F.col(col).rlike(rules.LEFTOVER_MARKUP)), _zero, 0.0, "warning")


def expect_not_blank(cols: Iterable[str]) -> list[Check]:
    return [Check("not_blank", c, F.count_if(strip(c) == ""), _zero, 0.0, "warning") for c in cols]


def expect_score_variation(col: str) -> Check:
    return Check("variation", col, F.coalesce(F.stddev_samp(col), F.lit(1.0)), lambda v: v != 0, 0.0, "warning")


def check_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in one aggregation; null values (an empty table) do not fail a bound."""
    return judged(df.agg(*[c.value.cast("double").alias(f"c{i}") for i, c in enumerate(checks)]), checks)


def judged(values: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check from the one row of their values (c0, c1, ...)."""
    rows = []
    for i, c in enumerate(checks):
        v = F.col(f"c{i}")
        ok = F.coalesce(c.passes(v), F.lit(True))
        status = F.when(ok, "passed").otherwise("warning" if c.severity == "warning" else "failed")
        rows.append(F.struct(
            F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), status.alias("status"), v.alias("value"),
            F.lit(c.threshold).cast("double").alias("threshold"), F.lit(c.severity).alias("severity"),
            F.concat(F.lit(f"{c.name} on {c.column}: "), F.coalesce(v.cast("string"), F.lit("no rows"))).alias("message")))
    return values.select(F.inline(F.array(*rows)))


def expect_columns(df: DataFrame, required: Sequence[str], ordered: bool = False,
                   known: Sequence[str] | None = None) -> DataFrame:
    """Check rows from the schema alone; no data is read."""
    have = df.columns
    if ordered:
        bad = [] if list(required) == have else ["order"]
    else:
        bad = [c for c in required if c not in have]
    rows = [("columns", "table", "failed" if bad else "passed", float(len(bad)), 0.0, "error",
             f"missing: {', '.join(bad)}" if bad else "all required columns present")]
    extra = [c for c in have if known is not None and c not in known]
    if extra:
        rows.append(("extra_columns", "table", "warning", float(len(extra)), 0.0, "warning", ", ".join(extra)))
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


def expect_sample_ratio(sample: DataFrame, source: DataFrame, lo: float = 5.0, hi: float = 100.0) -> DataFrame:
    """Sample size in percent of the source; an empty source counts as the sample itself."""
    counts = attach_row(sample.agg(F.count("*").alias("s")), source.agg(F.count("*").alias("n")), "_src")
    whole = F.when(F.col("_src.n") == 0, F.col("s")).otherwise(F.col("_src.n"))
    pct = F.col("s") / whole * 100
    return counts.select(
        F.lit("sample_ratio").alias("check"), F.lit("table").alias("column"),
        F.when(pct.between(lo, hi), "passed").otherwise("failed").alias("status"),
        py_round(pct, 2).alias("value"), F.lit(lo).alias("threshold"), F.lit("error").alias("severity"),
        F.concat(F.lit("sample_ratio on table: "), F.col("s").cast("string"), F.lit(" of "),
                 whole.cast("string")).alias("message"))


def expect_variation(df: DataFrame, score: str = "score", tags: str = "tags", min_tags: int = 3) -> DataFrame:
    """Warns when all scores are equal or fewer than three different tags occur."""
    spread = check_suite(df, [expect_score_variation(score)])
    kinds = df.select(F.explode(tags).alias(tags)).agg(F.count_distinct(tags).cast("double").alias("v"))
    few = kinds.select(
        F.lit("variation").alias("check"), F.lit(tags).alias("column"),
        F.when(F.col("v") < min_tags, "warning").otherwise("passed").alias("status"), F.col("v").alias("value"),
        F.lit(float(min_tags)).alias("threshold"), F.lit("warning").alias("severity"),
        F.concat(F.lit(f"variation on {tags}: "), F.col("v").cast("string")).alias("message"))
    return spread.unionByName(few)


def unexpected_values(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed set.

    The test reads an aggregate, so it stays above the group-by: it runs once per distinct
    value instead of recomputing a derived column for every row.
    """
    values = df.groupBy(col).agg(F.max(col).alias("value")).select("value")
    return values.where(F.col("value").isNotNull() & ~F.col("value").isin(*allowed))


def log_suite() -> list[Check]:
    """What the event table has to satisfy before anything is built from it."""
    return [
        expect_in_set("system", rules.SYSTEMS), expect_in_set("severity", rules.SEVERITIES),
        expect_in_set("event_type", rules.EVENT_TYPES),
        *expect_not_null(["event_id", "event_template", "message", "raw_id"], or_empty=True),
        expect_regex("event_id", rules.EVENT_ID_PATTERN), *expect_row_count(lo=1),
    ]


def qa_suite(most_rows: int | None = None) -> list[Check]:
    """A table is not wrong for being large: there is an upper row bound only where one is given."""
    return [
        *expect_row_count(lo=rules.MIN_QA_ROWS, hi=most_rows),
        *expect_not_null(["question_id", "title", "question_body", "answer_body", "tags", "score", "quality_score"]),
        expect_unique("question_id"), expect_min_value("question_id", 1), expect_min_value("score", 0),
        expect_min_value("answer_score", 0), expect_min_value("quality_score", 0),
        expect_no_markup("question_body"), *expect_not_blank(["question_body", "answer_body", "title"]),
        expect_score_variation("score"),
    ]


def expect_flag(col: str) -> Check:
    """True or false, in a boolean column or as text."""
    return Check("is_flag", col, F.count_if(~F.lower(F.col(col).cast("string")).isin("true", "false")), _zero, 0.0)


def chat_suite(lo: int = 4000, hi: int | None = None) -> list[Check]:
    return [
        *[expect_flag(c) for c in rules.CHAT_FLAGS],
        *expect_not_null(["chat", "num_turns", "num_calls", "complexity_tier"]),
        expect_in_set("complexity_tier", rules.COMPLEXITY_TIERS),
        *expect_between("num_turns", 0, 50), *expect_between("num_calls", 0, 20),
        *expect_between("num_defined_functions", 0, 20), expect_length("chat", 10), *expect_row_count(lo, hi),
    ]


def chat_checks(features: DataFrame) -> DataFrame:
    """The chat suite and the check of its required columns."""
    return check_suite(features, chat_suite()).unionByName(expect_columns(features, rules.CHAT_REQUIRED_COLUMNS))


def chat_thresholds(features: DataFrame) -> DataFrame:
    """Six limits on a chat table: (check, value, threshold, is_anomaly)."""
    n = F.count("*")
    t = rules.CHAT_THRESHOLDS
    raw = {
        "malformed_rate": F.count_if("has_malformed") / n,
        "none_complexity_rate": F.count_if(F.col("complexity_tier") == "none") / n,
        "record_count": n,
        "avg_turns": F.avg("num_turns"),
        "avg_calls": F.avg("num_calls"),
        "defined_functions_coverage": F.count_if(F.col("num_defined_functions") > 0) / n,
    }
    below = {"record_count", "defined_functions_coverage"}
    values = unpivot(features.agg(*[v.alias(k) for k, v in raw.items()]), {k: k for k in raw}, "check", "value")
    limit, is_below = F.lit(None).cast("double"), F.lit(False)
    for k, v in t.items():
        limit = F.when(F.col("check") == k, F.lit(float(v))).otherwise(limit)
        is_below = is_below | F.lit(k in below) & (F.col("check") == k)
    anomaly = F.when(is_below, F.col("value") < limit).otherwise(F.col("value") > limit)
    return values.select("check", np_round("value", 4).alias("value"), limit.alias("threshold"),
                         anomaly.alias("is_anomaly"))


def validate_code_records(records: DataFrame, key: Column) -> DataFrame:
    """(key, violation) for every broken rule of a code record.

    Works on the typed record; ``_meta`` members count as missing when they are null.
    """
    user, answer = F.get("messages", F.lit(0)), F.get("messages", F.lit(1))
    staged = records.withColumn("_key", key).withColumn("_size", F.coalesce(F.size("messages"), F.lit(0))) \
        .withColumn("_json", (F.col("_size") == 2) & json_valid(answer["content"])) \
        .withColumn("_tool", F.get_json_object(answer["content"], "$.tool")) \
        .withColumn("_manifest", F.when(F.col("_json"), F.coalesce(
            F.get_json_object(answer["content"], "$.params.manifest_content"), F.lit(""))))
    two, parsed = F.col("_size") == 2, F.col("_json")
    filled = parsed & (F.col("_manifest") != "")
    before = [
        F.when(F.col("messages").isNull(), F.lit("missing_top_key:messages")),
        F.when(F.col("_meta").isNull(), F.lit("missing_top_key:_meta")),
        F.when(~two, F.concat(F.lit("wrong_message_count:"), F.col("_size").cast("string"))),
        F.when(two & (user["role"] != "user"), F.lit("first_role_not_user")),
        F.when(two & (answer["role"] != "assistant"), F.lit("second_role_not_assistant")),
        F.when(two & (strip(F.coalesce(user["content"], F.lit(""))) == ""), F.lit("empty_prompt")),
        F.when(two & ~parsed, F.lit("assistant_invalid_json")),
        F.when(parsed & (F.coalesce(F.col("_tool"), F.lit("")) != "apply_manifest"), F.lit("wrong_tool_name")),
        F.when(parsed & (F.col("_manifest") == ""), F.lit("empty_manifest_content")),
    ]
    after = [
        *[F.when(filled & hit, F.lit(f"pii_leaked:{n}")) for n, hit in cd.leaks_found("_manifest").items()],
        *[F.when(F.col(f"_meta.{k}").isNull(), F.lit(f"missing_meta_key:{k}")) for k in rules.META_KEYS],
    ]
    # the native rules are judged first: beside a text on its way to the parser waits one narrow row, not the record
    judged = staged.select("_key", F.array_compact(F.array(*before)).alias("_before"), F.array_compact(F.array(*after)).alias("_after"),
                           cd.yaml_valid("_manifest", F.col("_manifest") != "").alias("_yaml"))
    broken = F.when(~F.col("_yaml"), F.array(F.lit("manifest_invalid_yaml"))).otherwise(F.array().cast("array<string>"))
    return judged.select("_key", F.concat("_before", broken, "_after").alias("violations"))


def violation_counts(judged: DataFrame) -> DataFrame:
    """(violation, count) from a (key, violations) frame, with the totals and the pass rate."""
    bad = F.count_if(F.size("violations") > 0)
    n = F.count("*")
    totals = judged.agg(
        n.alias("total"), (n - bad).alias("valid"), bad.alias("invalid"),
        F.when(n > 0, py_round((n - bad) / n * 100, 2)).otherwise(F.lit(0.0)).alias("pass_rate_pct"))
    counts = explode_rows(judged, F.col("violations"), "violation").groupBy("violation") \
        .agg(F.count("*").cast("double").alias("value"))
    return unpivot(totals, {c: c for c in totals.columns}, "violation", "value").unionByName(counts)


def record_thresholds(report: DataFrame) -> DataFrame:
    """Alert rows from a violation report: (check, value, threshold, is_anomaly). All limits but the
    smallest number of records are shares or zero, so they mean the same at every size.

    The report has one row per kind of violation, so one aggregation sees it whole.
    """
    name, value = F.col("violation"), F.col("value")
    own = name.isin("total", "valid", "invalid", "pass_rate_pct")

    def pick(which: str) -> Column:
        return F.coalesce(F.max(F.when(name == which, value)), F.lit(0.0))

    t = rules.RECORD_THRESHOLDS
    facts = report.agg(
        pick("pass_rate_pct").alias("pass_rate"),
        F.coalesce(F.sum(F.when(name.startswith("pii_leaked"), value)), F.lit(0.0)).alias("pii_leakage"),
        F.when(pick("total") > 0, F.coalesce(F.max(F.when(~own, value)), F.lit(0.0)) / pick("total") * 100).otherwise(0.0)
        .alias("violation_share"),
        pick("total").alias("minimum_records"))
    judged = [
        ("pass_rate", t["min_pass_rate_pct"], F.col("pass_rate") < t["min_pass_rate_pct"]),
        ("pii_leakage", t["max_pii_leak_count"], F.col("pii_leakage") > t["max_pii_leak_count"]),
        ("violation_share", t["max_violation_pct"], F.col("violation_share") > t["max_violation_pct"]),
        ("minimum_records", t["min_total_records"], F.col("minimum_records") < t["min_total_records"]),
    ]
    return facts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(n).cast("double").alias("value"), F.lit(float(limit)).alias("threshold"),
                 bad.alias("is_anomaly")) for n, limit, bad in judged])))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: totals, success rate and validity (no failed check of severity error)."""
    judged = F.col("status") != "warning"
    passed, total = F.count_if(F.col("status") == "passed"), F.count_if(judged)
    return checks.agg(
        total.alias("total_checks"), passed.alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
        F.when(total > 0, passed / total).otherwise(F.lit(1.0)).alias("success_rate"),
        (F.count_if((F.col("status") == "failed") & (F.col("severity") == "error")) == 0).alias("is_valid"))


def alerts_from_findings(findings: DataFrame, names_shown: int) -> DataFrame:
    """Alert rows from (pipeline, kind, name, level) findings; kind is anomaly, bias or validation.

    The listed names are the first ``names_shown`` in order. They come from a ranked, limited list, so
    a source with very many findings does not collect them.
    """
    keys = ["pipeline", "kind"]
    names = top_n_per_group(findings.select(*keys, "name").distinct(), keys, [F.asc("name")], names_shown)
    shown = names.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("names"))
    sizes = findings.groupBy(*keys).agg(
        F.count("*").alias("findings"),
        *[F.count_if(F.col("level") == s).alias(f"{s}_severity") for s in ("high", "medium", "low")])
    error = (F.col("kind") == "validation") \
        | ((F.col("kind") == "anomaly") & (F.col("findings") > rules.ALERT_ERROR_ABOVE)) \
        | ((F.col("kind") == "bias") & (F.col("high_severity") > 0))
    return sizes.join(shown, keys).withColumn("severity", F.when(error, "error").otherwise("warning"))
