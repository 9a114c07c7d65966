"""Code-file queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import in_list, kw, lit, py_round, query, sql_view
from checks.views import raw_logs, view
from opsgrain import rules
from opsgrain.functions import code as cd
from opsgrain.functions.core import explode_rows, json_valid
from opsgrain.operators import code, logs, ordering, profile, quality, sampling
from opsgrain.plans import jobs
from opsgrain.session import scratch_dir, stage_table
from opsgrain.sources import readers, sinks

SP, NSP = rules.SPACE, rules.NON_SPACE
W = r"\p{L}\p{N}_"


def files(spark, sf):
    return view(spark, sf, "code_files")


# --- SQL snippets -----------------------------------------------------------------

_EMAIL = rf"(^|[^/{W}])[{W}.+-]{{2,}}@[{W}-]+\.[{W}.-]+"
_CREDS = rf"(password|token|api_key|secret){SP}*[:=]{SP}*{NSP}+"


def redact(x):
    out = f"regexp_replace({x}, {lit(rules.PII_IPV4)}, 'IPV4_REDACTED', 'g')"
    out = f"regexp_replace({out}, {lit(rules.PII_API_KEY)}, 'sk-REDACTED', 'g')"
    out = f"regexp_replace({out}, {lit(_EMAIL)}, '\\1EMAIL_REDACTED', 'g')"
    return f"regexp_replace({out}, {lit('(?i)' + _CREDS)}, '\\1: REDACTED', 'g')"


PII = {"ipv4": rules.PII_IPV4, "api_key": rules.PII_API_KEY, "email": _EMAIL, "creds": _CREDS}


def iac(x, terraform):
    extra = f"when regexp_matches({x}, {lit(rules.TERRAFORM_PATTERN)}) then 'terraform'" if terraform else ""
    return ("case " + " ".join(f"when regexp_matches({x}, {lit(p)}) then '{n}'" for n, p in rules.IAC_RULES) + f" {extra} else 'other' end")


def size_bucket(x):
    return f"case when {x} < 1000 then '<1KB' when {x} < 10000 then '1-10KB' when {x} < 100000 then '10-100KB' else '>100KB' end"


def count_char(x, c):
    return f"(length({x}) - length(replace({x}, {c}, '')))"


def escape(x):
    s = f"({count_char(x, 'chr(10)')} + {count_char(x, 'chr(34)')} * 2 + {count_char(x, 'chr(92)')} * 3)"
    return f"case when {s} > 5000 then 'hard' when {s} > 1000 then 'medium' else 'easy' end"


def prompt_type(x):
    return "case " + " ".join(f"when contains(lower({x}), '{k}') then '{k}'" for k in rules.PROMPT_TYPES) + " else 'fallback' end"


_LIC = """list_transform(list_filter(list_concat(list_concat(coalesce(max_stars_repo_licenses, []), coalesce(max_issues_repo_licenses, [])),
    coalesce(max_forks_repo_licenses, [])), lambda v: trim(v) <> ''), lambda v: lower(trim(v)))"""
_PATH = "coalesce(nullif(trim(max_stars_repo_path), ''), nullif(trim(max_issues_repo_path), ''), nullif(trim(max_forks_repo_path), ''), '')"
_SLUG = "trim(regexp_replace(regexp_replace(regexp_extract(case when path = '' then 'manifest.yaml' else path end, '[^/]*$', 0), '(?i)\\.(yaml|yml)$', ''), '[-_]+', ' ', 'g'))"
_PROMPT = ("case " + " ".join(f"when contains(lower(slug), '{m}') then replace('{t}', '{{slug}}', slug)" for m, t in rules.PROMPT_RULES)
           + f" else replace('{rules.PROMPT_FALLBACK}', '{{slug}}', slug) end")
_ALL_WORDS = [w for ws in rules.CODE_KEYWORDS.values() for w in ws]
_ALLOWED = "[" + ", ".join(lit(x) for x in rules.PERMISSIVE_LICENSES) + "]"


def gate(yaml):
    # which manifest heads load as YAML is known by construction: only the fifth does not
    y = "when doc_id % 8 = 4 then 'invalid_yaml'" if yaml else ""
    return f"""case when content = '' then 'empty_content' when size < 200 then 'too_small' when size > 500000 then 'too_large'
    when alphanum_fraction < 0.25 then 'low_alphanum' when ltrim(ext, '.') <> '' and lower(ltrim(ext, '.')) not in ('yaml', 'yml') then 'bad_extension'
    when not contains(content, 'apiVersion') then 'not_k8s' when not contains(content, 'kind:') then 'missing_kind' when not contains(content, 'metadata:') then 'missing_metadata' {y}
    when len(lic) = 0 then 'missing_license' when not list_has_any(lic, {_ALLOWED}) then 'bad_license' when not {kw('lower(content)', _ALL_WORDS)} then 'not_ml_infra' else 'ok' end"""


sql_view("code_base", f"select *, {_LIC} as lic, {_PATH} as path from code_files")
sql_view("code_named", f"select *, {_PROMPT} as prompt from (select *, {_SLUG} as slug from code_base)")
sql_view("code_gated", f"select *, {gate(True)} as status from code_named")
_WRAP = "'{\"tool\": \"apply_manifest\", \"params\": {\"manifest_content\": ' || to_json(clean) || '}}'"
sql_view("code_records", f"""select *, {_WRAP} as answer, {iac('clean', False)} as iac_type, case when len(lic) = 0 then 'unknown' else
    coalesce(list_filter(lic, lambda v: v in {in_list(rules.PERMISSIVE_LICENSES)})[1], 'other') end as license, {size_bucket('size')} as size_bucket, {prompt_type('prompt')} as prompt_type
    from (select *, {redact('content')} as clean from code_gated where status = 'ok')""")


def records(spark, sf):
    return code.code_records(files(spark, sf))


def staged_records(spark, sf):
    return stage_table(records(spark, sf))


# --- classifiers ------------------------------------------------------------------


@query("P23_size_bucket", f"select doc_id, {size_bucket('size')} as size_bucket from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.size_bucket("size").alias("size_bucket"))


@query("P24_iac_type", f"select doc_id, {iac('content', True)} as iac_type, {iac('content', False)} as bias_type from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.iac_type("content").alias("iac_type"), cd.iac_type("content", False).alias("bias_type"))


@query("P25_escape_difficulty", f"select doc_id, {escape('content')} as difficulty from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.escape_difficulty(cd.escape_score("content")).alias("difficulty"))


@query("P26_prompt_type", f"select doc_id, {prompt_type('prompt')} as prompt_type from code_named")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.prompt_type(cd.synthesize_prompt(code.row_path())).alias("prompt_type"))


@query("P27_license_class", f"""select doc_id, case when max_stars_repo_licenses is null or len(max_stars_repo_licenses) = 0 then 'unknown' else
    coalesce(list_filter(list_transform(max_stars_repo_licenses, lambda v: lower(trim(v))), lambda v: v in {in_list(rules.PERMISSIVE_LICENSES)})[1], 'other') end as license from code_files""")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.license_class("max_stars_repo_licenses").alias("license"))


@query("P28_collect_licenses", "select doc_id, array_to_string(lic, ',') as licenses from code_base")
def _(spark, sf):
    return files(spark, sf).select("doc_id", F.array_join(code.row_licenses(), ",").alias("licenses"))


@query("P29_best_path", "select doc_id, path from code_base")
def _(spark, sf):
    return files(spark, sf).select("doc_id", code.row_path().alias("path"))


# --- gates ------------------------------------------------------------------------


@query("C3_code_gate", f"select doc_id, {gate(False)} as status from code_base")
def _(spark, sf):
    return code.code_gate(files(spark, sf), yaml_check=False).select("doc_id", "status")


@query("C3_code_gate_with_yaml", "select doc_id, status from code_gated")
def _(spark, sf):
    return code.code_gate(files(spark, sf)).select("doc_id", "status")


@query("C4_k8s_ok", """select doc_id, contains(content, 'apiVersion') and contains(content, 'kind:') and contains(content, 'metadata:') as k8s,
    contains(content, 'kind:') as kind_only, true as none from code_files""")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.k8s_ok("content").alias("k8s"), cd.k8s_ok("content", False, True, False).alias("kind_only"),
                                   cd.k8s_ok("content", False, False, False).alias("none"))


@query("C5_has_keyword", f"select doc_id, {kw('lower(content)', _ALL_WORDS)} as any_group, {kw('lower(content)', rules.CODE_KEYWORDS['ml_gpu'])} as gpu_group from code_files")
def _(spark, sf):
    f = files(spark, sf).withColumn("low", F.lower("content"))
    return f.select("doc_id", cd.has_keyword("low").alias("any_group"), cd.has_keyword("low", ["ml_gpu"]).alias("gpu_group"))


_K8S = "(contains(content, 'apiVersion') and contains(content, 'kind:') and contains(content, 'metadata:'))"


@query("C6_ml_gate", f"select doc_id, {_K8S} and {kw('lower(content)', _ALL_WORDS)} as strict, {_K8S} or {kw('lower(content)', _ALL_WORDS)} as loose from code_files")
def _(spark, sf):
    f = files(spark, sf).withColumn("low", F.lower("content"))
    return f.select("doc_id", code.ml_gate("content", "low").alias("strict"),
                    code.ml_gate("content", "low", code.GateConfig(ml_mode="loose")).alias("loose"))


@query("C7_license_gate", f"""select doc_id, case when len(lic) = 0 then 'missing_license' when not list_has_any(lic, {_ALLOWED}) then 'bad_license' end as required,
    case when len(lic) > 0 and not list_has_any(lic, {_ALLOWED}) then 'bad_license' end as optional from code_base""")
def _(spark, sf):
    f = files(spark, sf).withColumn("lic", code.row_licenses())
    return f.select("doc_id", code.license_gate("lic").alias("required"), code.license_gate("lic", require=False).alias("optional"))


# --- text of code files -----------------------------------------------------------


@query("F18_redact", f"select doc_id, md5({redact('content')}) as h from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", F.md5(cd.redact("content")).alias("h"))


@query("F18_redact_documents", f"select doc_id, md5({redact('text')}) as h from documents")
def _(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.md5(cd.redact("text")).alias("h"))


@query("F19_synthesize_prompt", "select doc_id, prompt from code_named")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.synthesize_prompt(code.row_path()).alias("prompt"))


@query("F20_wrap_tool_call", "select doc_id, md5('{\"tool\": \"apply_manifest\", \"params\": {\"manifest_content\": ' || to_json(content) || '}}') as h from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", F.md5(cd.wrap_tool_call("content")).alias("h"))


@query("F21_process_code", """select hexsha, status, case when status = 'ok' then prompt end as prompt, case when status = 'ok' then path end as path, case when status = 'ok' then size end as size,
    case when status = 'ok' then array_to_string(lic, ',') end as licenses from code_gated""")
def _(spark, sf):
    p = code.process_code(files(spark, sf))
    return p.select("hexsha", "status", F.col("messages")[0]["content"].alias("prompt"), "_meta.path", "_meta.size", F.array_join("_meta.licenses", ",").alias("licenses"))


@query("F21_records", "select hexsha, prompt, md5(answer) as answer from code_records")
def _(spark, sf):
    r = records(spark, sf)
    return r.select("_meta.hexsha", F.col("messages")[0]["content"].alias("prompt"), F.md5(F.col("messages")[1]["content"]).alias("answer"))


_ANY_PII = " or ".join(f"regexp_matches(content, {lit(p)})" for p in PII.values())


@query("F22_has_pii", f"select doc_id, {_ANY_PII} as has_pii from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.has_pii("content").alias("has_pii"))


_LEAKS = "list_filter([" + ", ".join(f"case when regexp_matches(content, {lit(p)}) then '{n}' end" for n, p in rules.LEAK_PATTERNS) + "], lambda v: v is not null)"


@query("F23_pii_leaks", f"select doc_id, array_to_string({_LEAKS}, ',') as leaks from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", F.array_join(cd.pii_leaks("content"), ",").alias("leaks"))


@query("F28_yaml_valid", "select doc_id, content = '' or doc_id % 8 <> 4 as ok from code_files")
def _(spark, sf):
    return files(spark, sf).select("doc_id", cd.yaml_valid("content").alias("ok"))


# --- profile ----------------------------------------------------------------------


@query("G31_gate_funnel", f"""with c as (select status, count(*) as count, count(*) / (select count(*) from code_gated) * 100 as p from code_gated group by 1)
    select status, count, {py_round('p', 1)} as pct, (select count(*) from code_gated) as total from c""")
def _(spark, sf):
    return code.gate_funnel(code.process_code(files(spark, sf)))


def _dist(section, expr):
    return f"select '{section}' as section, {expr} as name, count(*) as count from code_files group by 2"


_NULLS = " union all ".join(f"select 'null', '{c}', count(*) filter (where {c} is null) from code_files" for c in rules.CODE_COLUMNS)


@query("G32_code_corpus_profile", f"""with c as ({_dist('iac_type', iac('content', True))} union all {_dist('escape_difficulty', escape('content'))} union all {_dist('size_distribution', size_bucket('size'))}
    union all select 'total', 'rows', count(*) from code_files union all select 'pii', 'files', count(*) filter (where {_ANY_PII}) from code_files union all {_NULLS}),
    d as (select *, count / (select count(*) from code_files) * 100 as p from c),
    l as (select lower(v) as name, count(*) as count from (select unnest(max_stars_repo_licenses) as v from code_files) group by 1 order by 2 desc, 1 limit 15)
    select section, name, count, {py_round('p', 2)} as pct from d union all select 'license', name, count, null from l""")
def _(spark, sf):
    return code.code_corpus_profile(files(spark, sf), 15)


_HITS = " union all ".join(
    f"""select '{g}' as "group", '{k}' as keyword, sum((length(lower(content)) - length(replace(lower(content), '{k}', ''))) // {len(k)})::bigint as hits from code_files"""
    for g, ws in rules.CODE_KEYWORDS.items() for k in ws)


@query("G33_keyword_hits", f"""with h as ({_HITS}) select "group", keyword, hits from h where hits > 0 qualify row_number() over (partition by "group" order by hits desc, keyword) <= 15""")
def _(spark, sf):
    return code.keyword_hits(files(spark, sf), 15)


@query("G34_pii_exposure", "\nunion all ".join(
    f"select '{n}' as pattern, count(*) filter (where regexp_matches(content, {lit(p)})) as files from code_files" for n, p in PII.items()))
def _(spark, sf):
    return code.pii_exposure(files(spark, sf))


@query("G40_roundtrip_counts", "select count(*) as wrap_ok, 0 as wrap_fail from code_records")
def _(spark, sf):
    return code.roundtrip_counts(files(spark, sf))


@query("G40_roundtrip_samples", """select path, prompt, replace(substr(clean, 1, 120), chr(10), '↵') as manifest_preview from code_records
    qualify row_number() over (order by hexsha) <= 3""")
def _(spark, sf):
    return code.roundtrip_samples(files(spark, sf), 3, 120)


@query("G35_length_stats", "with s as (" + "\nunion all ".join(
    f"select '{m}' as metric, count(*) as count, min({v}) as min, max({v}) as max, avg({v}) as a, list_sort(list({v}))[count(*) // 2 + 1] as median from code_records"
    for m, v in (("prompt_length_chars", "length(prompt)"), ("manifest_length_chars", "length(clean)"), ("source_file_size", "size")))
    + f") select metric, count, min, max, {py_round('a', 1)} as mean, median from s")
def _(spark, sf):
    return code.length_stats(staged_records(spark, sf))


_DIMS = ("iac_type", "license", "size_bucket", "prompt_type")
sql_view("code_slices", f"""with l as ({' union all '.join(f"select '{d}' as dimension, {d} as value, length(clean) as n from code_records" for d in _DIMS)}),
    g as (select dimension, value, count(*) as count, avg(n) as a, count(*) / (select count(*) from code_records) * 100 as p from l group by 1, 2),
    r as (select dimension, value, count, {py_round('a', 1)} as mean_manifest_chars, {py_round('p', 2)} as pct_of_total from g)
    select *, pct_of_total < 5 as underrepresented, pct_of_total > 40 as overrepresented from r""")


@query("G29_slice_summary", "select * from code_slices")
def _(spark, sf):
    return code.slice_summary(records(spark, sf))


@query("G30_imbalance_messages", """select dimension, 'Underrepresented (<5.0%)' as kind, string_agg(value, ',' order by value) as "values" from code_slices where underrepresented group by 1
    union all select dimension, 'Overrepresented (>40.0%)', string_agg(value, ',' order by value) from code_slices where overrepresented group by 1""")
def _(spark, sf):
    return code.imbalance_messages(code.slice_summary(records(spark, sf))).withColumn("values", F.array_join("values", ","))


# --- sampling ---------------------------------------------------------------------

sql_view("code_shares", """with c as (select iac_type, count(*) as n from code_records group by 1), p as (select iac_type, n / (select sum(n) from c) * 100 as pct from c)
    select *, case when pct > 40 then 40.0::double / pct else 1 end as ratio from p""")
_WEIGHT = py_round("case when pct <= 0 then 1 else greatest(0.1::double, least(5.0::double, least(pct, 40) / pct)) end", 4)


@query("B2_capped_downsample", f"""select hexsha, r.iac_type, {_WEIGHT} as sampling_weight from code_records r join code_shares s on s.iac_type = r.iac_type
    where ('0x' || substr(md5('42:' || hexsha), 1, 15))::bigint / 1152921504606846976::double <= ratio""")
def _(spark, sf):
    t = jobs.code_training_table(files(spark, sf), balanced=True)
    return t.select("_meta.hexsha", "_meta.iac_type", "_meta.sampling_weight")


@query("B3_sampling_weight", f"select iac_type, {_WEIGHT} as sampling_weight from code_shares")
def _(spark, sf):
    r = code.record_slices(staged_records(spark, sf)).select("iac_type")
    shares = sampling._class_shares(r, "iac_type", rules.MAX_SLICE_PCT)
    return shares.select("iac_type", sampling.sampling_weight(F.col("class_pct")).alias("sampling_weight"))


@query("W6_dedup_by_hash", "select doc_id, hexsha, size, md5(content) as content_md5 from code_files qualify row_number() over (partition by hexsha order by doc_id) = 1")
def _(spark, sf):
    return ordering.dedup_by_hash(files(spark, sf), "hexsha", "doc_id").select("doc_id", "hexsha", "size", F.md5("content").alias("content_md5"))


# --- record checks ----------------------------------------------------------------


def raw_records(spark, sf):
    """Every file as a record, not gated and not redacted, so that the rules have work."""
    f = files(spark, sf)
    role = F.when(F.col("doc_id") % 9 == 0, "assistant").otherwise("user")
    user = F.struct(role.alias("role"), F.when(F.col("doc_id") % 14 == 0, "  ").otherwise(cd.synthesize_prompt(code.row_path())).alias("content"))
    answer = F.when(F.col("doc_id") % 16 == 1, "no json").otherwise(cd.wrap_tool_call("content"))
    assistant = F.struct(F.lit("assistant").alias("role"), answer.alias("content"))
    messages = F.when(F.col("doc_id") % 21 == 0, F.array(user)).otherwise(F.array(user, assistant))
    meta = F.struct("hexsha", F.col("max_stars_repo_path").alias("path"), "size", code.row_licenses().alias("licenses"))
    # the checks read written records, as they do after an export
    return stage_table(f.select("doc_id", messages.alias("messages"), meta.alias("_meta")))


_TWO, _PARSED = "doc_id % 21 <> 0", "doc_id % 21 <> 0 and doc_id % 16 <> 1"
_RULES = [("wrong_message_count:1", "doc_id % 21 = 0"), ("first_role_not_user", f"{_TWO} and doc_id % 9 = 0"), ("empty_prompt", f"{_TWO} and doc_id % 14 = 0"),
          ("assistant_invalid_json", f"{_TWO} and doc_id % 16 = 1"), ("empty_manifest_content", f"{_PARSED} and content = ''"),
          ("manifest_invalid_yaml", f"{_PARSED} and content <> '' and doc_id % 8 = 4")]
_RULES += [(f"pii_leaked:{n}", f"{_PARSED} and regexp_matches(content, {lit(p)})") for n, p in rules.LEAK_PATTERNS]
_RULES += [("missing_meta_key:path", "max_stars_repo_path is null")]
sql_view("code_violations", "\nunion all ".join(f"select doc_id, '{n}' as violation from code_files where {c}" for n, c in _RULES))


def judged(spark, sf):
    return quality.validate_code_records(raw_records(spark, sf), F.col("doc_id"))


@query("D16_validate_code_records", "select doc_id as id, violation from code_violations")
def _(spark, sf):
    return explode_rows(judged(spark, sf).withColumnRenamed("_key", "id"), F.col("violations"), "violation", "id")


sql_view("code_report", f"""with b as (select count(distinct doc_id) as bad, (select count(*) from code_files) as n from code_violations)
    select 'total' as violation, n::double as value from b union all select 'valid', n - bad from b union all select 'invalid', bad from b
    union all select 'pass_rate_pct', {py_round('(n - bad) / n * 100', 2)} from b union all select violation, count(*) from code_violations group by 1""")


@query("D17_violation_counts", "select violation, value from code_report")
def _(spark, sf):
    return quality.violation_counts(stage_table(judged(spark, sf)))


_OWN = "('total', 'valid', 'invalid', 'pass_rate_pct')"


@query("D19_record_thresholds", f"""select 'pass_rate' as "check", value, 80::double as threshold, value < 80 as is_anomaly from code_report where violation = 'pass_rate_pct'
    union all select 'pii_leakage', sum(value), 0, sum(value) > 0 from code_report where violation like 'pii_leaked%'
    union all select 'violation_share', max(value) / (select value from code_report where violation = 'total') * 100, 0.25,
    max(value) / (select value from code_report where violation = 'total') * 100 > 0.25 from code_report where violation not in {_OWN}
    union all select 'minimum_records', value, 10, value < 10 from code_report where violation = 'total'""")
def _(spark, sf):
    return quality.record_thresholds(quality.violation_counts(stage_table(judged(spark, sf))))


# --- file sources and sinks -------------------------------------------------------


@query("S1_read_telemetry_usage", "select time_stamp, machine_id, cpu_util_percent, mem_util_percent from usage")
def _(spark, sf):
    path = scratch_dir(spark)
    u = view(spark, sf, "usage")
    u.select("time_stamp", "machine_id", "cpu_util_percent", "mem_util_percent", F.lit("0.5").alias("a"), F.lit("n/a").alias("b"), F.lit("").alias("c"), F.lit("x").alias("d")) \
        .write.option("emptyValue", "").csv(path)
    return readers.read_telemetry_csv(spark, path, "usage").where("net_out is null and disk_io_percent is null and net_in = 0.5") \
        .select("time_stamp", "machine_id", "cpu_util_percent", "mem_util_percent")


@query("S1_read_telemetry_batch", "select job_id, inst_num, start_time, end_time, status, plan_cpu, plan_mem from batch_task")
def _(spark, sf):
    path = scratch_dir(spark)
    cols = ["start_time", "end_time", "inst_num", "task_type", "job_id", "status", "plan_cpu", "plan_mem"]
    view(spark, sf, "batch_task").select(*cols).write.option("nullValue", "NA").csv(path)
    return readers.read_telemetry_csv(spark, path, "batch").select("job_id", "inst_num", "start_time", "end_time", "status", "plan_cpu", "plan_mem")


@query("S1_read_telemetry_event", "select time_stamp, machine_id, event_type, plan_cpu, plan_mem from server_event")
def _(spark, sf):
    path = scratch_dir(spark)
    cols = ["time_stamp", "machine_id", "event_type", "event_detail", "plan_cpu", "plan_mem", "extra"]
    view(spark, sf, "server_event").select(*cols).write.option("nullValue", "null").csv(path)
    return readers.read_telemetry_csv(spark, path, "event").select("time_stamp", "machine_id", "event_type", "plan_cpu", "plan_mem")


@query("S2_read_string_csv", "select system, raw_id, severity, event_template from log_events")
def _(spark, sf):
    read = {}
    for system, raw in raw_logs(spark, sf).items():
        path = scratch_dir(spark)
        raw.select(*[F.trim(c).alias(c) for c in raw.columns]).write.option("header", True).option("emptyValue", "").csv(path)
        read[system] = readers.read_string_csv(spark, path, raw.columns)
    return jobs.unified_events(read).select("system", "raw_id", "severity", "event_template")


@query("S7_read_code_chunks", "select hexsha, size, array_to_string(max_stars_repo_licenses, ',') as licenses from code_files")
def _(spark, sf):
    folder = scratch_dir(spark)
    f = files(spark, sf)
    sinks.write_chunks(f, f"{folder}/chunk_0000.parquet")
    return readers.read_code_chunks(spark, folder).select("hexsha", "size", F.array_join("max_stars_repo_licenses", ",").alias("licenses"))


@query("K3_write_csv", "select system, count(*)::varchar as total from log_events group by 1")
def _(spark, sf):
    path = scratch_dir(spark)
    events = jobs.unified_events(raw_logs(spark, sf))
    sinks.write_csv(events.groupBy("system").agg(F.count("*").alias("total")), path)
    return readers.read_string_csv(spark, path, ["system", "total"])


@query("K5_write_chunks", "select count(*) as n_rows, true as bounded from lineitem")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.write_chunks(view(spark, sf, "batch_task"), path, 1000)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).alias("bounded"))


@query("S8_optional_inputs", "select count(*) as n from events")
def _(spark, sf):
    readers.require_inputs(spark, [f"{sf}/events.parquet"])
    found = readers.optional_inputs(spark, {"events": f"{sf}/events.parquet", "gone": f"{sf}/gone.parquet"})
    parts = [spark.read.parquet(p) for p in found.values()]
    return parts[0].agg(F.count("*").alias("n"))


@query("U3_training_tables", """select 'chats' as source_dataset, count(*) as count from chats union all select 'generated', count(*) from prompts where id % 5 <> 4
    union all select 'qa', count(*) from qa union all select 'code', count(*) from code_records""")
def _(spark, sf):
    prompts = view(spark, sf, "prompts").where(json_valid("workflow_json"))
    lines = jobs.combined_chat_lines({"chats": jobs.chat_training_table(view(spark, sf, "chats")),
                                      "generated": jobs.generated_training_table(prompts),
                                      "qa": jobs.qa_training_table(view(spark, sf, "qa_pairs"), mitigate=False),
                                      "code": jobs.code_training_table(view(spark, sf, "code_files"))})
    return profile.combined_counts(lines, "source_dataset")
