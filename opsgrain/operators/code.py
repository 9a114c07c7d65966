"""Code files: gates with a reason, records, corpus profile, slices."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import code as cd
from opsgrain.functions.core import as_col, first_match, json_valid, occurrences, py_round
from opsgrain.operators.ordering import top_n_per_group
from opsgrain.operators.profile import unpivot, upper_median_stats, with_share
from opsgrain.session import attach_row, stage_table


@dataclass(frozen=True)
class GateConfig:
    min_size: int = 200
    max_size: int = 500_000
    min_alphanum: float = 0.25
    extensions: tuple[str, ...] = ("yaml", "yml")
    require_api_version: bool = True
    require_kind: bool = True
    require_metadata: bool = True
    valid_yaml_only: bool = True
    require_license: bool = True
    licenses: tuple[str, ...] = rules.PERMISSIVE_LICENSES
    require_ml_infra: bool = True
    ml_mode: str = "strict"
    ml_groups: tuple[str, ...] = field(default_factory=lambda: tuple(rules.CODE_KEYWORDS))


def row_licenses() -> Column:
    return cd.collect_licenses("max_stars_repo_licenses", "max_issues_repo_licenses", "max_forks_repo_licenses")


def row_path() -> Column:
    return cd.best_path("max_stars_repo_path", "max_issues_repo_path", "max_forks_repo_path")


def license_gate(licenses: Column | str, allow: tuple[str, ...] = rules.PERMISSIVE_LICENSES,
                 require: bool = True) -> Column:
    """Reason or null; one permissive licence is enough."""
    arr = as_col(licenses)
    if not allow:
        return F.lit(None).cast("string")
    allowed = F.array(*[F.lit(x.lower()) for x in allow])
    reason = F.when((F.size(arr) > 0) & ~F.arrays_overlap(arr, allowed), "bad_license")
    return F.when(F.size(arr) == 0, "missing_license").otherwise(reason) if require else reason


def ml_gate(content: Column | str, low: Column | str, cfg: GateConfig = GateConfig()) -> Column:
    """Manifest markers in the content and keywords in its lower-case form: both, or either."""
    k8s = cd.k8s_ok(content, cfg.require_api_version, cfg.require_kind, cfg.require_metadata)
    word = cd.has_keyword(low, cfg.ml_groups)
    return (k8s & word) if cfg.ml_mode == "strict" else (k8s | word)


def _native_gates(files: DataFrame, cfg: GateConfig) -> DataFrame:
    """Adds ``_early`` and ``_late``: the first failed check before and after the YAML one, null where all pass."""
    content = F.coalesce(F.col("content"), F.lit(""))
    size = F.coalesce(F.col("size"), F.lit(0))
    ext = F.lower(F.regexp_replace(F.coalesce(F.col("ext"), F.lit("")), r"^\.+", ""))
    cheap: list[tuple[Column, str]] = [
        (content == "", "empty_content"), (size < cfg.min_size, "too_small"), (size > cfg.max_size, "too_large"),
        (F.coalesce(F.col("alphanum_fraction"), F.lit(0.0)) < cfg.min_alphanum, "low_alphanum"),
    ]
    if cfg.extensions:
        cheap.append(((ext != "") & ~ext.isin(*[e.lstrip(".").lower() for e in cfg.extensions]), "bad_extension"))
    if cfg.require_api_version:
        cheap.append((~content.contains("apiVersion"), "not_k8s"))
    if cfg.require_kind:
        cheap.append((~content.contains("kind:"), "missing_kind"))
    if cfg.require_metadata:
        cheap.append((~content.contains("metadata:"), "missing_metadata"))
    staged = files.withColumn("_early", first_match(cheap, F.lit(None).cast("string"))) \
        .withColumn("_lic", row_licenses()).withColumn("_low", F.lower(content))
    late = [license_gate("_lic", cfg.licenses, cfg.require_license)]
    if cfg.require_ml_infra:
        late.append(F.when(~ml_gate(content, "_low", cfg), "not_ml_infra"))
    return staged.withColumn("_late", F.coalesce(*late, F.lit(None).cast("string"))).drop("_lic", "_low")


def code_gate(files: DataFrame, cfg: GateConfig = GateConfig(), yaml_check: bool | None = None) -> DataFrame:
    """Adds ``status``: the first failed check, or ``ok``. Rows are kept.

    Only rows that pass every native check before the YAML one reach the Python parser.
    """
    staged, early = _native_gates(files, cfg), [F.col("_early")]
    if cfg.valid_yaml_only if yaml_check is None else yaml_check:
        staged = staged.withColumn("_yaml", cd.yaml_valid("content", F.col("_early").isNull()))
        early.append(F.when(~F.col("_yaml"), "invalid_yaml"))
    return staged.withColumn("status", F.coalesce(*early, F.col("_late"), F.lit("ok"))).drop("_early", "_late", "_yaml")


def process_code(files: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """Gate, redact, check again, wrap. Every row keeps its status; ``messages`` and ``_meta``
    are null unless it is ``ok``.

    Both YAML checks stand in one projection, so a task has one Python worker for them; a text that was
    parsed once and is not changed by the redaction is not parsed again.
    """
    early, late = F.col("_early"), F.col("_late")
    clean = _native_gates(files, cfg).withColumn("_clean", F.when(early.isNull() & late.isNull(), cd.redact("content")))
    if cfg.valid_yaml_only:
        changed = F.col("_clean") != F.col("content")
        judged = clean.withColumns({"_yaml": cd.yaml_valid("content", early.isNull()), "_again": cd.yaml_valid("_clean", changed)})
    else:
        judged = clean.withColumns({"_yaml": F.lit(True), "_again": cd.yaml_valid("_clean")})
    clean = judged.withColumn("status", F.coalesce(
        early, F.when(~F.col("_yaml"), "invalid_yaml"), late, F.when(~F.col("_again"), "invalid_yaml_post_redaction"), F.lit("ok")))
    path = row_path()
    clean = clean.withColumn("_slug", cd.prompt_slug(path)).withColumn("_prompt", cd.prompt_of_slug("_slug"))
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col("_prompt").alias("content")),
        F.struct(F.lit("assistant").alias("role"), cd.wrap_tool_call("_clean").alias("content")))
    meta = F.struct(F.col("hexsha"), path.alias("path"), F.col("size"), row_licenses().alias("licenses"))
    good = F.col("status") == "ok"
    return clean.select("hexsha", "status", F.when(good, messages).alias("messages"),
                        F.when(good, meta).alias("_meta"))


def code_records(files: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    return process_code(files, cfg).where(F.col("status") == "ok").select("messages", "_meta")


def gate_funnel(gated: DataFrame) -> DataFrame:
    """Rows and share per status; ``ok`` is what gets written."""
    counted = gated.groupBy("status").agg(F.count("*").alias("count"))
    total = counted.agg(F.sum("count").alias("n"))
    return attach_row(with_share(counted, total, digits=1), total, "_all").withColumn("total", F.col("_all.n")).drop("_all")


def roundtrip_counts(files: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """Records whose wrapped answer parses as JSON and whose manifest loads as YAML again."""
    content = F.col("messages")[1]["content"]
    # read back, as a round trip is
    judged = stage_table(code_records(files, cfg)).withColumn("_json", json_valid(content)).withColumn(
        "_yaml", cd.yaml_valid(F.get_json_object(content, "$.params.manifest_content"), F.col("_json")))
    good = F.col("_json") & F.coalesce(F.col("_yaml"), F.lit(False))
    return judged.agg(F.count_if(good).alias("wrap_ok"), F.count_if(~good).alias("wrap_fail"))


def roundtrip_samples(files: DataFrame, n: int, chars: int, cfg: GateConfig = GateConfig()) -> DataFrame:
    manifest = F.get_json_object(F.col("messages")[1]["content"], "$.params.manifest_content")
    return code_records(files, cfg).orderBy("_meta.hexsha").limit(n).select(
        F.col("_meta.path").alias("path"), F.col("messages")[0]["content"].alias("prompt"),
        F.replace(F.substring(manifest, 1, chars), F.lit("\n"), F.lit("↵")).alias("manifest_preview"))


def keyword_hits(files: DataFrame, top: int, groups: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Occurrences per (group, keyword), all keywords summed in one aggregation."""
    groups = groups or rules.CODE_KEYWORDS
    low = files.select(F.lower(F.coalesce(F.col("content"), F.lit(""))).alias("_low"))
    pairs = [(g, k) for g, words in groups.items() for k in words]
    sums = low.agg(*[F.sum(occurrences(F.col("_low"), k.lower())).alias(f"k{i}") for i, (_, k) in enumerate(pairs)])
    rows = sums.select(F.inline(F.array(*[
        F.struct(F.lit(g).alias("group"), F.lit(k).alias("keyword"), F.col(f"k{i}").alias("hits"))
        for i, (g, k) in enumerate(pairs)]))).where(F.col("hits") > 0)
    return top_n_per_group(rows, ["group"], [F.desc("hits"), F.asc("keyword")], top)


def pii_exposure(files: DataFrame) -> DataFrame:
    found = cd.pii_found("content")
    counts = files.agg(*[F.count_if(c).alias(n) for n, c in found.items()])
    return unpivot(counts, {n: n for n in found}, "pattern", "files").withColumn("files", F.col("files").cast("bigint"))


def code_corpus_profile(files: DataFrame, top_licenses: int) -> DataFrame:
    """(section, name, count, pct): classes, null fields, files with personal data, the most frequent licences.

    One scan: every file says what it counts for, and one aggregation adds it up.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    present = [c for c in rules.CODE_COLUMNS if c in files.columns]
    # the costly columns get a projection of their own, so that no rule on them repeats the text work
    told = files.select(
        cd.iac_type(content).alias("_iac"), cd.escape_score(content).alias("_score"), F.coalesce("size", F.lit(0)).alias("_size"),
        cd.has_pii(content).alias("_pii"), F.col("max_stars_repo_licenses").alias("_licenses"),
        *[F.col(c).isNull().alias(f"_null_{c}") for c in present])

    def item(section: str, name: Column, n: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), name.alias("name"), n.cast("bigint").alias("n"))

    one = F.lit(1)
    items = [item("iac_type", F.col("_iac"), one), item("escape_difficulty", cd.escape_difficulty("_score"), one),
             item("size_distribution", cd.size_bucket("_size"), one), item("total", F.lit("rows"), one), item("pii", F.lit("files"), F.col("_pii")),
             *[item("null", F.lit(c), F.col(f"_null_{c}")) for c in present]]
    licenses = F.transform(F.coalesce("_licenses", F.array().cast("array<string>")), lambda name: item("license", F.lower(name), one))
    counted = told.select(F.inline(F.concat(F.array(*items), licenses))).groupBy("section", "name").agg(F.sum("n").alias("count"))
    licensed = F.col("section") == "license"
    # one row per distinct name; the window over them needs the total of all files only
    placed = counted.withColumn("_n", F.max(F.when(F.col("section") == "total", F.col("count"))).over(Window.partitionBy())) \
        .withColumn("_place", F.when(licensed, F.row_number().over(Window.partitionBy("section").orderBy(F.desc("count"), F.asc("name"))))) \
        .withColumn("_share", F.col("count") / F.col("_n") * 100)
    return placed.where(~licensed | (F.col("_place") <= top_licenses)).select(
        "section", "name", "count", F.when(~licensed, py_round("_share", 2)).alias("pct"))


def record_slices(records: DataFrame) -> DataFrame:
    """Records with two turns and readable answers: key, four classes, manifest length."""
    answer = F.col("messages")[1]["content"]
    manifest = F.coalesce(F.get_json_object(answer, "$.params.manifest_content"), F.lit(""))
    return records.where((F.size("messages") == 2) & json_valid(answer)).select(
        "messages", "_meta", cd.iac_type(manifest, with_terraform=False).alias("iac_type"),
        cd.license_class("_meta.licenses").alias("license"),
        cd.size_bucket(F.coalesce("_meta.size", F.lit(0))).alias("size_bucket"),
        cd.prompt_type(F.col("messages")[0]["content"]).alias("prompt_type"),
        F.length(manifest).alias("manifest_chars"))


def slice_summary(records: DataFrame) -> DataFrame:
    """(dimension, value, count, mean size, share) of four classifications. The records are staged: the rules on
    their answers would otherwise be pushed into the gates that make them."""
    records = stage_table(records)
    dims = ("iac_type", "license", "size_bucket", "prompt_type")
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims])
    grouped = record_slices(records).select("manifest_chars", F.inline(pairs)).groupBy("dimension", "value").agg(
        F.count("*").alias("count"), py_round(F.avg("manifest_chars"), 1).alias("mean_manifest_chars"))
    total = records.agg(F.count("*").alias("n"))
    return with_share(grouped, total, "pct_of_total") \
        .withColumn("underrepresented", F.col("pct_of_total") < rules.MIN_SLICE_PCT) \
        .withColumn("overrepresented", F.col("pct_of_total") > rules.MAX_SLICE_PCT)


def imbalance_messages(summary: DataFrame) -> DataFrame:
    """Per dimension the values below 5 % and above 40 %; the classifiers have at most eleven values."""
    both = F.array(F.struct(F.lit("Underrepresented (<5.0%)").alias("kind"), F.col("underrepresented").alias("hit")),
                   F.struct(F.lit("Overrepresented (>40.0%)").alias("kind"), F.col("overrepresented").alias("hit")))
    hits = summary.select("dimension", "value", F.inline(both)).where("hit")
    return hits.groupBy("dimension", "kind").agg(F.sort_array(F.collect_list("value")).alias("values"))


def length_stats(records: DataFrame) -> DataFrame:
    """Prompt, manifest and source sizes; source sizes of 0 do not count."""
    answer = F.col("messages")[1]["content"]
    manifest = F.when(json_valid(answer), F.length(F.coalesce(
        F.get_json_object(answer, "$.params.manifest_content"), F.lit(""))))
    two = F.size("messages") == 2
    pairs = F.array(
        F.struct(F.lit("prompt_length_chars").alias("metric"),
                 F.when(two, F.length(F.col("messages")[0]["content"])).cast("bigint").alias("value")),
        F.struct(F.lit("manifest_length_chars").alias("metric"), F.when(two, manifest).cast("bigint").alias("value")),
        F.struct(F.lit("source_file_size").alias("metric"),
                 F.nullif(F.col("_meta.size"), F.lit(0)).cast("bigint").alias("value")))
    return upper_median_stats(records.select(F.inline(pairs)).where(F.col("value").isNotNull()))
