"""Chat, generated-workflow and combine queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import in_list, kw, lit, np_round, py_round, query, sql_view
from checks.telemetry import sequences
from checks.views import Q, pick, view
from opsgrain import rules
from opsgrain.functions import chats as ch
from opsgrain.functions.core import json_valid
from opsgrain.functions.workflow import valid_workflow
from opsgrain.operators import chats, combine, generated, ordering, profile, quality, slices
from opsgrain.plans import jobs
from opsgrain.session import scratch_dir
from opsgrain.sources import ledger, readers, sinks

_FIXED = f"regexp_replace(m, {lit(rules.UNQUOTE_PATTERN)}, '\\1', 'g')"
sql_view("chat_calls", f"""select conv_id, pos, m, f, json_valid(f) as ok, case when json_valid(f) then json_extract_string(f, '$.name') end as name,
    case when json_valid(f) then json_extract(f, '$.arguments')::varchar end as arguments from (
      select conv_id, pos, m, {_FIXED} as f from (
        select conv_id, unnest(regexp_extract_all(chat, {lit(rules.CALL_PATTERN)}, 1)) as m,
        unnest(range(len(regexp_extract_all(chat, {lit(rules.CALL_PATTERN)}, 1)))) as pos from chats))""")
sql_view("chat_sigs", r"""select conv_id, system, case when json_valid(j) then j end as j from (select conv_id, system, regexp_extract(system, '(?s)\{.*\}', 0) as j from chats)""")
_KEYWORDS = "list_filter([" + ", ".join(f"case when contains(lower(chat), {lit(k)}) then {lit(k)} end" for k in rules.ERROR_KEYWORDS) + "], lambda v: v is not null)"
sql_view("chat_features", f"""with c as (select conv_id, count(*) as n, bool_or(not ok) as bad, first(arguments order by pos) as args,
      '[' || string_agg(case when ok then f else '{{"__malformed__": ' || to_json(m) || '}}' end, ', ' order by pos) || ']' as texts,
      string_agg('{{"tool": ' || to_json(name) || ', "params": ' || arguments || '}}', ', ' order by pos) as steps from chat_calls group by 1),
    s as (select conv_id, case when j is not null then 1 else 0 end as fns, case when j is null then '{{}}' else '{{"' || json_extract_string(j, '$.name') || '":{{"description":' ||
      json_extract(j, '$.description') || ',"parameters":' || to_json(json_keys(j, '$.parameters.properties')) || ',"required":' || json_extract(j, '$.parameters.required') || '}}}}' end as sig,
      case when j is null then '[]' else '["' || json_extract_string(j, '$.name') || '"]' end as fn_names from chat_sigs)
    select h.conv_id, h.system, h.chat, len(regexp_extract_all(chat, 'USER:')) as num_turns, coalesce(n, 0) as num_calls,
    case when coalesce(n, 0) = 0 then 'none' when n > 1 then 'complex' when bad then 'malformed' when len(json_keys(args)) <= 2 then 'simple' else 'moderate' end as complexity_tier,
    coalesce(n, 0) > 1 as has_parallel, coalesce(bad, false) as has_malformed, coalesce(texts, '[]') as function_calls, fns as num_defined_functions,
    fn_names as defined_function_names, sig as function_signatures, len({_KEYWORDS}) > 0 as has_error_handling,
    regexp_matches(lower(chat), {lit(rules.FUNCTION_ERROR)}) as has_function_error_response, regexp_matches(lower(chat), {lit(rules.CONDITIONAL_ERROR)}) as has_conditional_error,
    array_to_string({_KEYWORDS}, ',') as error_keywords_found, steps
    from chats h left join c on c.conv_id = h.conv_id join s on s.conv_id = h.conv_id""")


def features(spark, sf):
    return chats.chat_features(view(spark, sf, "chats"))


@query("F11_extract_function_calls", """select conv_id, pos, name, arguments, case when ok then f else m end as raw, not ok as malformed from chat_calls""")
def _(spark, sf):
    c = view(spark, sf, "chats").select("conv_id", F.posexplode(ch.function_calls("chat")).alias("pos", "c"))
    return c.select("conv_id", "pos", "c.*")


@query("F12_function_signatures", """select conv_id, json_extract_string(j, '$.name') as name, json_extract_string(j, '$.description') as description,
    array_to_string(json_keys(j, '$.parameters.properties'), ',') as parameters, json_extract(j, '$.parameters.required')::varchar as required from chat_sigs where j is not null""")
def _(spark, sf):
    s = view(spark, sf, "chats").select("conv_id", F.explode(ch.function_signatures("system")).alias("name", "s"))
    return s.select("conv_id", "name", "s.description", F.array_join("s.parameters", ",").alias("parameters"),
                    F.to_json("s.required").alias("required"))


@query("F13_error_handling", """select conv_id, has_error_handling, has_function_error_response, has_conditional_error, error_keywords_found from chat_features""")
def _(spark, sf):
    c = view(spark, sf, "chats")
    found = ch.error_keywords_found("chat")
    return c.select("conv_id", (F.size(found) > 0).alias("has_error_handling"), ch.has_function_error("chat").alias("has_function_error_response"),
                    ch.has_conditional_error("chat").alias("has_conditional_error"), F.array_join(found, ",").alias("error_keywords_found"))


@query("F14_count_turns", "select conv_id, num_turns from chat_features")
def _(spark, sf):
    return view(spark, sf, "chats").select("conv_id", ch.count_turns("chat").alias("num_turns"))


@query("F15_call_complexity", "select conv_id, complexity_tier from chat_features")
def _(spark, sf):
    c = view(spark, sf, "chats").withColumn("calls", ch.function_calls("chat"))
    return c.select("conv_id", ch.call_complexity(F.col("calls")).alias("complexity_tier"))


@query("F16_call_flags", "select conv_id, has_malformed, has_parallel from chat_features")
def _(spark, sf):
    c = view(spark, sf, "chats").withColumn("calls", ch.function_calls("chat"))
    return c.select("conv_id", ch.has_malformed(F.col("calls")).alias("has_malformed"), ch.has_parallel(F.col("calls")).alias("has_parallel"))


_COLS = ["conv_id", "num_turns", "num_calls", "complexity_tier", "has_parallel", "has_malformed", "function_calls", "num_defined_functions",
         "defined_function_names", "function_signatures", "has_error_handling", "has_function_error_response", "has_conditional_error"]


@query("F17_chat_features", f"select {', '.join(_COLS)}, error_keywords_found from chat_features")
def _(spark, sf):
    f = features(spark, sf)
    return f.select(*_COLS, F.array_join(F.from_json("error_keywords_found", "array<string>"), ",").alias("error_keywords_found"))


@query("F25_functions_to_chat", f"""select conv_id, {lit(f'{rules.ASSISTANT_NAME}: {rules.TOOL_PROMPT}')} || chr(10) || 'Tools: ' || function_signatures as system_turn,
    case when contains(chat, 'USER:') then trim(regexp_extract(chat, {lit(rules.FIRST_USER)}, 1), ' ' || chr(10)) else chat end as user_turn,
    case when num_calls > 0 and not has_malformed then '{{"workflow": {{"steps": [' || steps || ']}}}}'
    else '{{"workflow": {{"steps": []}}, "message": ' || to_json(trim(regexp_extract(chat, {lit(rules.FIRST_REPLY)}, 1), ' ' || chr(10))) || '}}' end as assistant_turn from chat_features""")
def _(spark, sf):
    c = chats.functions_to_chat(features(spark, sf))
    return c.select("conv_id", *[F.col("messages")[i]["content"].alias(f"{r}_turn") for i, r in enumerate(generated.ROLES)])


_TURNS = """case when num_turns > 0 and num_turns <= 1 then 'single' when num_turns > 1 and num_turns <= 3 then 'short' when num_turns > 3 and num_turns <= 5 then 'medium'
    when num_turns > 5 then 'long' end"""
_CALLS = """case num_calls when 0 then 'no_calls' when 1 then 'one_call' when 2 then 'two_calls' else 'many_calls' end"""


@query("P22_chat_buckets", f"select conv_id, {_TURNS} as turn_bucket, {_CALLS} as call_bucket from chat_features")
def _(spark, sf):
    return features(spark, sf).select("conv_id", ch.turn_bucket("num_turns").alias("turn_bucket"), ch.call_bucket("num_calls").alias("call_bucket"))


_DIMS = {"complexity_tier": "complexity_tier", "turn_bucket": _TURNS, "call_bucket": _CALLS, "has_error_handling": "has_error_handling",
         "has_parallel": "has_parallel", "has_defined_functions": "num_defined_functions > 0"}
sql_view("chat_slices", f"""with l as ({' union all '.join(f"select '{k}' as slice_column, cast({v} as varchar) as slice_value, * from chat_features" for k, v in _DIMS.items())}),
    g as (select slice_column, slice_value, count(*) as count, avg(num_turns) as t, avg(num_calls) as c, count(*) filter (where has_malformed) as malformed_count,
      count(*) filter (where has_error_handling) / count(*) as e, count(*) / (select count(*) from chat_features) as p from l where slice_value is not null group by 1, 2)
    select slice_column, slice_value, count, {np_round('t', 2)} as avg_turns, {np_round('c', 2)} as avg_calls, malformed_count, {np_round('e', 4)} as error_handling_pct,
    {py_round('p', 4)} as proportion, p < 0.05 as is_underrepresented from g""")
# most malformed chats are relabelled, so that a rare slice exists at every size; no chat is left out
_TIER = "case when complexity_tier = 'malformed' and conv_id % 90 <> 4 then 'none' else complexity_tier end"


@query("G26_representation", "select * from chat_slices")
def _(spark, sf):
    return slices.representation(features(spark, sf))


sql_view("chat_rare", f"""with l as ({' union all '.join(f"select '{k}' as slice_column, cast({v} as varchar) as slice_value from chat_features" for k, v in (_DIMS | {'complexity_tier': _TIER}).items())}),
    g as (select slice_column, slice_value, count(*) as count, count(*) / (select count(*) from chat_features) as p from l where slice_value is not null group by 1, 2)
    select slice_column, slice_value, count, {py_round('p', 4)} as proportion from g where p < 0.05""")


def _findings(spark, sf):
    return slices.representation_findings(slices.representation(features(spark, sf).withColumn("complexity_tier", F.expr(_TIER))))


@query("G27_representation_findings", "select *, case when proportion < 0.01 then 'high' else 'medium' end as severity from chat_rare")
def _(spark, sf):
    return _findings(spark, sf)


@query("G27_representation_mitigations", "select slice_column, slice_value, case when proportion < 0.01 then 'oversample' else 'collect_more' end as strategy from chat_rare")
def _(spark, sf):
    return slices.representation_mitigations(_findings(spark, sf))


@query("G28_chat_dataset_stats", f"""with a as (select avg(num_turns) as t, avg(num_calls) as c, avg(num_defined_functions) as f, count(*) as n from chat_features)
    select n as total_records, {py_round('t', 2)} as avg_turns, {py_round('c', 2)} as avg_calls, {py_round('f', 2)} as avg_defined_functions,
    {', '.join(f"(select count(*) from chat_features where complexity_tier = '{t}') as tier_{t}" for t in rules.COMPLEXITY_TIERS)},
    (select count(*) from chat_features where has_malformed) as malformed_calls, (select count(*) from chat_features where has_parallel) as parallel_calls,
    (select count(*) from chat_features where has_error_handling) as error_handling, (select count(*) from chat_features where has_function_error_response) as function_errors from a""")
def _(spark, sf):
    return chats.chat_dataset_stats(features(spark, sf))


@query("W7_take_sample", "select conv_id, system from chats order by conv_id limit 5000")
def _(spark, sf):
    return ordering.take_sample(view(spark, sf, "chats"), "conv_id", 5000).select("conv_id", "system")


def _between(c, lo, hi):
    return [f"""select 'min_in_range' as "check", '{c}' as "column", case when min({c}) >= {lo} then 'passed' else 'failed' end as status, min({c})::double as value from chat_features""",
            f"""select 'max_in_range', '{c}', case when max({c}) <= {hi} then 'passed' else 'failed' end, max({c}) from chat_features"""]


@query("D4_expect_between", "\nunion all ".join(_between("num_turns", 2, 50) + _between("num_calls", 0, 1)))
def _(spark, sf):
    checks = [*quality.expect_between("num_turns", 2, 50), *quality.expect_between("num_calls", 0, 1)]
    return quality.check_suite(features(spark, sf), checks).select("check", "column", "status", "value")


@query("D5_expect_row_count", """select 'min_row_count' as "check", case when count(*) >= 4000 then 'passed' else 'failed' end as status, count(*)::double as value, 4000::double as threshold from chats
    union all select 'max_row_count', case when count(*) <= 6000 then 'passed' else 'failed' end, count(*), 6000 from chats""")
def _(spark, sf):
    return quality.check_suite(view(spark, sf, "chats"), quality.expect_row_count(4000, 6000)).select("check", "status", "value", "threshold")


@query("D8_expect_length", """select 'chat' as "column", case when count(*) filter (where length(chat) < 300) = 0 then 'passed' else 'failed' end as status,
    count(*) filter (where length(chat) < 300)::double as value from chats union all
    select 'system', case when count(*) filter (where length(system) < 10) = 0 then 'passed' else 'failed' end, count(*) filter (where length(system) < 10) from chats""")
def _(spark, sf):
    checks = [quality.expect_length("chat", 300), quality.expect_length("system", 10)]
    return quality.check_suite(view(spark, sf, "chats"), checks).select("column", "status", "value")


_T = rules.CHAT_THRESHOLDS


@query("D18_chat_thresholds", f"""with a as (select count(*) filter (where has_malformed) / count(*) as m, count(*) filter (where complexity_tier = 'none') / count(*) as n, count(*)::double as r,
      avg(num_turns) as t, avg(num_calls) as c, count(*) filter (where num_defined_functions > 0) / count(*) as d from chat_features)
    select 'malformed_rate' as "check", {np_round('m', 4)} as value, {_T['malformed_rate']}::double as threshold, m > {_T['malformed_rate']} as is_anomaly from a
    union all select 'none_complexity_rate', {np_round('n', 4)}, {_T['none_complexity_rate']}, n > {_T['none_complexity_rate']} from a
    union all select 'record_count', r, {_T['record_count']}, r < {_T['record_count']} from a
    union all select 'avg_turns', {np_round('t', 4)}, {_T['avg_turns']}, t > {_T['avg_turns']} from a
    union all select 'avg_calls', {np_round('c', 4)}, {_T['avg_calls']}, c > {_T['avg_calls']} from a
    union all select 'defined_functions_coverage', {np_round('d', 4)}, {_T['defined_functions_coverage']}, d < {_T['defined_functions_coverage']} from a""")
def _(spark, sf):
    return quality.chat_thresholds(features(spark, sf))


_BROKEN = [
    *[f"count(*) filter (where {c} is null) > 0" for c in ("chat", "num_turns", "num_calls", "complexity_tier")],
    f"count(*) filter (where complexity_tier not in {in_list(rules.COMPLEXITY_TIERS)}) > 0",
    "min(num_turns) < 0", "max(num_turns) > 50", "min(num_calls) < 0", "max(num_calls) > 20", "min(num_defined_functions) < 0",
    "max(num_defined_functions) > 20", "min(length(chat)) < 10", "count(*) < 4000",
    *[f"count(*) filter (where lower({c}::varchar) not in ('true', 'false')) > 0" for c in rules.CHAT_FLAGS],
    "false",  # the required columns are there
]


@query("D4_chat_suite", f"select count(*) as checks, count(*) filter (where bad) as failed from (select unnest([{', '.join(_BROKEN)}]) as bad from chat_features)")
def _(spark, sf):
    return quality.chat_checks(features(spark, sf)).agg(
        F.count("*").alias("checks"), F.count_if(F.col("status") == "failed").alias("failed"))


# --- generated workflows and prompts ----------------------------------------------


@query("S9_unprocessed", "select id, tool_context from prompts where id not in (select id from ledger)")
def _(spark, sf):
    return ledger.unprocessed(view(spark, sf, "prompts"), view(spark, sf, "ledger")).select("id", "tool_context")


@query("S9_mark_processed", "select id from prompts where id not in (select id from ledger) and id % 2 = 1")
def _(spark, sf):
    path = scratch_dir(spark)
    prompts, done = view(spark, sf, "prompts"), view(spark, sf, "ledger")
    ledger.reset(spark, path)
    ledger.mark_processed(path, done, prompts, ledger.read_ledger(spark, path))
    ledger.mark_processed(path, prompts.where("id % 2 = 0").select("id"), prompts, ledger.read_ledger(spark, path))
    return ledger.unprocessed(prompts, ledger.read_ledger(spark, path)).select("id")


@query("F24_generated_to_chat", f"""select id, '{rules.ASSISTANT_NAME} can use these tools: ' || tool_context as system_turn, user_intent as user_turn,
    '{{"workflow": ' || workflow_json || '}}' as assistant_turn from prompts""")
def _(spark, sf):
    c = generated.generated_to_chat(view(spark, sf, "prompts"))
    return c.select("id", *[F.col("messages")[i]["content"].alias(f"{r}_turn") for i, r in enumerate(generated.ROLES)])


@query("F29_valid_workflow", "select id, id % 5 in (0, 3) as ok from prompts")
def _(spark, sf):
    return view(spark, sf, "prompts").select("id", valid_workflow("workflow_json").alias("ok"))


@query("G36_format_b_stats", """select count(*) as row_count, count(*) filter (where user_intent = '') as missing_user_intent, count(*) filter (where id % 8 in (0, 3)) as records_missing_valid_messages from prompts""")
def _(spark, sf):
    # some records have lost their messages or a turn
    rows, kind = generated.generated_to_chat(view(spark, sf, "prompts")), F.col("id") % 8
    cut = F.when(kind == 3, F.slice("messages", 1, 2)).when(kind != 0, F.col("messages"))
    return generated.format_b_stats(rows.withColumn("messages", cut), "user_intent")


@query("G36_message_stats", """select count(*) as row_count, 0 as missing_user_intent, count(*) filter (where len(messages) < 3) as records_missing_valid_messages from messages""")
def _(spark, sf):
    return generated.format_b_stats(view(spark, sf, "messages"))


_FEW = "len(messages) < 3"


def _no(role):
    return f"len(list_filter(messages, lambda m: m.role = '{role}')) = 0"


@query("D14_validate_chats", f"""select conv_id, {lit(generated.TOO_SHORT)} as error from messages where {_FEW}
    union all select conv_id, {lit(generated.NO_ROLES)} from messages where not ({_FEW}) and ({_no('system')} or {_no('user')} or {_no('assistant')})""")
def _(spark, sf):
    return generated.validate_chats(view(spark, sf, "messages"), "conv_id")


@query("D15_chat_anomalies", f"""select conv_id, {lit(generated.TOO_SHORT)} as error from messages where {_FEW}
    {' '.join(f"union all select conv_id, {lit(generated.NO_ROLE + r)} from messages where not ({_FEW}) and {_no(r)}" for r in generated.ROLES)}
    union all select conv_id, {lit(generated.NOT_JSON)} from messages where not ({_FEW}) and not ({_no('assistant')})
    and not json_valid(list_filter(messages, lambda m: m.role = 'assistant')[-1].content)""")
def _(spark, sf):
    return generated.chat_anomalies(view(spark, sf, "messages"), "conv_id")


# --- JSON lines -------------------------------------------------------------------


def _lines(spark, sf):
    """Conversations as JSON lines; some cut short, some with trailing text, some blank."""
    line = F.to_json(F.struct("conv_id", "messages"))
    kind = F.col("conv_id") % 10
    return view(spark, sf, "messages").withColumn("line", line).select(
        "conv_id", F.when(kind == 3, F.expr("substring(line, 1, length(line) - 5)")).when(kind == 4, F.concat("line", F.lit(" x")))
        .when(kind == 5, F.lit("  ")).otherwise(F.col("line")).alias("value"))


_GOOD = "conv_id % 10 not in (3, 4, 5)"


@query("S5_read_jsonl", f"select conv_id, len(messages) as n, messages[1].content as first_text from messages where {_GOOD}")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.write_json_lines(_lines(spark, sf), path)
    schema = "conv_id bigint, messages array<struct<role: string, content: string>>"
    return readers.read_jsonl(spark, path, schema).select("conv_id", F.size("messages").alias("n"), F.col("messages")[0]["content"].alias("first_text"))


@query("S6_read_json_array", "select conv_id, len(messages) as n, messages[1].content as first_text from messages")
def _(spark, sf):
    path = scratch_dir(spark)
    # one array of at most 500 conversations per file
    lines = view(spark, sf, "messages").select(F.expr("conv_id div 500").alias("file"), F.to_json(F.struct("conv_id", "messages")).alias("line"))
    arrays = lines.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("line"), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = "conv_id bigint, messages array<struct<role: string, content: string>>"
    return readers.read_json_array(spark, path, schema).select("conv_id", F.size("messages").alias("n"), F.col("messages")[0]["content"].alias("first_text"))


@query("S5_line_report", """select case when conv_id % 10 = 5 then 'blank' when conv_id % 10 in (3, 4) then 'malformed' else 'valid' end as line_status, count(*) as count from messages group by 1""")
def _(spark, sf):
    return readers.line_report(_lines(spark, sf))


_JSON_CASES = [
    "'{\"a\": \"' || md5(text) || '\"}'", "'[1, 2] x'", "'{\"a\": NaN}'", f"'{{' || {Q} || 'a' || {Q} || ': 1}}'", "'\"' || md5(text) || '\"'",
    "'{\"a\": 1'", "'  {\"b\": [1, {\"c\": null}]} '", "'{\"a\": 1}} x'", f"'{{\"it\": \"can' || {Q} || 't\"}}'", "'[1, 2]] x'", "'tru'",
    "'-1.5e3'", "'{\"a\": \"NaN, Infinity\"}'", "'{\"a\" 1}'", "text",
    f"'{{\"a\": \"it' || {Q} || 's\", \"a\": 2}}'", "'{' || chr(10) || '\"a\": 1,' || chr(10) || '\"a\": 2}'", "'{\"a\": \"x' || chr(10) || 'y\"}'", "'{\"a\": \"x' || chr(92) || 'ny\"} '",
]


def _cases(spark, sf):
    return spark.sql(f"select doc_id, {pick(f'doc_id % {len(_JSON_CASES)}', _JSON_CASES, 'text')} as s from parquet.`{sf}/documents.parquet`")


@query("F27_json_valid", f"select doc_id, json_valid(s) as ok from (select doc_id, {pick(f'doc_id % {len(_JSON_CASES)}', _JSON_CASES, 'text')} as s from documents)")
def _(spark, sf):
    return _cases(spark, sf).select("doc_id", json_valid("s").alias("ok"))


@query("U3_combine_chats", f"""select 'conversations' as source_dataset, conv_id as id, 'conversations' as tagged from messages where {_GOOD}
    union all select 'prompts', id, 'prompts' from prompts""")
def _(spark, sf):
    prompts = view(spark, sf, "prompts").select(F.to_json(F.struct("id", "user_intent")).alias("value"))
    both = combine.combine_chats({"conversations": _lines(spark, sf), "prompts": prompts})
    ident = F.coalesce(F.get_json_object("value", "$.conv_id"), F.get_json_object("value", "$.id")).cast("bigint")
    return both.select("source_dataset", ident.alias("id"), F.get_json_object("value", "$.source_dataset").alias("tagged"))


@query("G38_combined_counts", f"""select 'conversations' as source_dataset, count(*) as count from messages where {_GOOD} union all select 'prompts', count(*) from prompts""")
def _(spark, sf):
    prompts = view(spark, sf, "prompts").select(F.to_json(F.struct("id", "user_intent")).alias("value"))
    return profile.combined_counts(combine.combine_chats({"conversations": _lines(spark, sf), "prompts": prompts}), "source_dataset")


# records with a field of every kind; some fields change their kind or are absent
_KINDS = """select conv_id, case when conv_id % 7 = 0 then '{"conv_id": ' || conv_id || ', "flag": true, "note": null, "size": "big", "tags": []}'
    else '{"conv_id": ' || conv_id || ', "flag": false, "note": null, "size": 1.5, "meta": {"n": ' || len || '}, "text": "x"}' end as value
    from (select conv_id, {size} as len from {t})"""
sql_view("kind_lines", _KINDS.replace("{size}", "len(messages)").replace("{t}", "messages"))


@query("G39_infer_record_schema", """with k as (select value, unnest(json_keys(value)) as field from kind_lines),
    f as (select field, json_type(value, '$.' || field) as t from k),
    g as (select field, min(case when t = 'ARRAY' then 0 when t = 'OBJECT' then 1 when t = 'VARCHAR' then 2 when t = 'NULL' then 4 else 3 end) as i from f group by 1)
    select field, ['array', 'object', 'string', 'number', 'NoneType'][i + 1] as kind from g union all select 'record_count', count(*)::varchar from kind_lines""")
def _(spark, sf):
    view(spark, sf, "messages").createOrReplaceTempView("_kind_messages")
    return generated.infer_record_schema(spark.sql(_KINDS.replace("{size}", "size(messages)").replace("{t}", "_kind_messages")))


_COMBINED = """select source || '_rows' as source_dataset, label, count(*) as count from sequences group by 1, 2"""


@query("U2_combine_sequences", _COMBINED)
def _(spark, sf):
    s = sequences(spark, sf)
    parts = {f"{p}_rows": s.where(F.col("source") == p) for p in ("usage", "batch", "event")}
    return profile.combined_counts(combine.combine_sequences(parts), "source_dataset", "label")


# --- sinks ------------------------------------------------------------------------


@query("K1_write_sequences", "select seq, label, count(*) as n from sequences group by 1, 2")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.write_sequences(sequences(spark, sf), path)
    return spark.read.parquet(path).groupBy(F.array_join("sequence_ids", ",").alias("seq"), "label").agg(F.count("*").alias("n"))


@query("K2_write_jsonl", "select conv_id, len(messages) as n, messages[1].content as first_text from messages")
def _(spark, sf):
    path = scratch_dir(spark)
    sinks.write_jsonl(view(spark, sf, "messages"), path)
    schema = "conv_id bigint, messages array<struct<role: string, content: string>>"
    return readers.read_jsonl(spark, path, schema, "fail").select("conv_id", F.size("messages").alias("n"), F.col("messages")[0]["content"].alias("first_text"))


@query("K4_write_report", "select status, count(*)::bigint as n from batch_task where status is not null group by 1")
def _(spark, sf):
    path = scratch_dir(spark)
    rows = profile.value_distribution(view(spark, sf, "batch_task"), "status")
    sinks.write_report(rows, path, "value", "count")
    return spark.read.text(path).select(F.explode(F.from_json("value", "map<string, bigint>")).alias("status", "n"))


@query("K6_promote_if_valid", "select count(*) as written from messages")
def _(spark, sf):
    path = scratch_dir(spark)
    m = view(spark, sf, "messages")
    ok = sinks.promote_if_valid(m, quality.verdict(quality.check_suite(m, [quality.expect_unique("conv_id")])), path)
    refused = sinks.promote_if_valid(m, quality.verdict(quality.check_suite(m, quality.expect_row_count(hi=0))), scratch_dir(spark))
    if not ok or refused:
        raise AssertionError("the verdict was not followed")
    return spark.read.parquet(path).agg(F.count("*").alias("written"))


@query("K6_write_validated", """select 'row_count' as what, 'passed' as status, count(*)::double as value from messages
union all select 'repeated', 'passed', (count(*) - count(distinct conv_id))::double from messages
union all select 'no_messages', 'passed', count(*) filter (where messages is null)::double from messages
union all select 'written', 'promoted', count(*)::double from messages
union all select 'refused', 'failed', count(*)::double from messages""")
def _(spark, sf):
    path = scratch_dir(spark)
    m = view(spark, sf, "messages")
    suite = [*quality.expect_row_count(lo=1), quality.expect_unique("conv_id"), *quality.expect_not_null(["messages"])]
    ok, rows = sinks.write_validated(m, suite, path)
    refused, why = sinks.write_validated(m, quality.expect_row_count(hi=0), path, mode="overwrite")
    names = F.create_map(*[F.lit(x) for x in ("min_row_count", "row_count", "unique", "repeated", "not_null", "no_messages")])
    out = rows.select(names[F.col("check")].alias("what"), "status", "value")
    kept = spark.read.schema(m.schema).parquet(path).agg(F.count("*").cast("double").alias("value"))
    out = out.unionByName(kept.select(F.lit("written").alias("what"), F.lit("promoted" if ok else "refused").alias("status"), "value"))
    return out.unionByName(why.select(F.lit("refused").alias("what"), F.when(F.lit(refused), "promoted").otherwise(F.col("status")).alias("status"), "value"))


@query("K7_append_alerts", "select event_id, user_id, event_type from events order by ts desc, event_id desc limit 1000")
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    return sinks.latest_alerts(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1")).select("event_id", "user_id", "event_type")


_FINDINGS = """select source as pipeline, case doc_id % 3 when 0 then 'anomaly' when 1 then 'bias' else 'validation' end as kind,
    concat('finding_', cast(doc_id % 17 as string)) as name, case when doc_id % 4 = 0 and source <> 'web' then 'high' when doc_id % 4 = 1 then 'medium' else 'low' end as level from {t}"""


@query("D21_alerts_from_findings", f"""with f as ({_FINDINGS.format(t='documents')}),
    n as (select pipeline, kind, array_to_string(list_sort(list(distinct name))[1:5], ', ') as names, count(*) as findings, count(*) filter (where level = 'high') as high_severity,
      count(*) filter (where level = 'medium') as medium_severity, count(*) filter (where level = 'low') as low_severity from f group by 1, 2)
    select *, case when kind = 'validation' or (kind = 'anomaly' and findings > 10) or (kind = 'bias' and high_severity > 0) then 'error' else 'warning' end as severity from n""")
def _(spark, sf):
    return quality.alerts_from_findings(spark.sql(_FINDINGS.format(t=f"parquet.`{sf}/documents.parquet`")), 5)
