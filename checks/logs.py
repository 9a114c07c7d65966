"""Log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case_map, in_list, kw, lit, np_round, py_round, query, sql_view
from checks.views import raw_logs, view
from opsgrain import rules
from opsgrain.functions import core
from opsgrain.functions import logs as lg
from opsgrain.operators import logs, ordering, profile, quality
from opsgrain.plans import jobs
from opsgrain.session import stage_table


def events(spark, sf):
    return jobs.unified_events(raw_logs(spark, sf))


def _by_words(text, error, warn):
    return f"case when {kw(text, error)} then 'ERROR' when {kw(text, warn)} then 'WARN' else 'INFO' end"


def _by_level(error, warn):
    return f"coalesce({case_map('upper(trim(lvl))', rules.LEVEL_MAP, 'null')}, {_by_words('lower(sentence)', error, warn)})"


_HPC = f"""case when {kw('lower(state)', rules.HPC_STATE_ERROR)} or trim(flag) = '1'
    or {kw('lower(sentence)', rules.HPC_MESSAGE_ERROR)} then 'ERROR'
    when {kw('lower(state)', rules.HPC_STATE_WARN)} or {kw('lower(sentence)', rules.HPC_MESSAGE_WARN)} then 'WARN' else 'INFO' end"""
_TYPE = ("case " + " ".join(f"when {kw('both_texts', words)} then {lit(name)}" for name, words in rules.EVENT_TYPE_RULES)
         + " when severity = 'INFO' then 'normal_ops' else 'unknown' end")


def _obj(**fields):
    return "'{' || " + " || ', ' || ".join(f"'\"{k}\": \"' || {v} || '\"'" for k, v in fields.items()) + " || '}'"


sql_view("log_events", f"""select *, {_TYPE} as event_type from (select *, lower(message || ' ' || event_template) as both_texts from (
    select system, k,
    case system when 'linux' then mon || ' ' || dom || ' ' || hms when 'hpc' then cast(epoch_s as varchar)
      when 'hdfs' then ymd6 || ' ' || hms6 when 'hadoop' then iso || ' ' || hmsms else slashed || ' ' || hms end as timestamp,
    case system when 'linux' then {_by_words('lower(sentence)', rules.LINUX_ERROR_KEYWORDS, rules.LINUX_WARN_KEYWORDS)}
      when 'hpc' then {_HPC}
      when 'hdfs' then {_by_level(rules.HDFS_ERROR_KEYWORDS, rules.HDFS_WARN_KEYWORDS)}
      when 'hadoop' then {_by_level(rules.HADOOP_ERROR_KEYWORDS, rules.HADOOP_WARN_KEYWORDS)}
      else {_by_level(rules.SPARK_ERROR_KEYWORDS, rules.SPARK_WARN_KEYWORDS)} end as severity,
    case system when 'hpc' then node || '|' || component else component end as source,
    eid as event_id, sentence as event_template, sentence as message,
    case when system = 'hpc' and k % 5 <> 0 then 'L' || line_id else line_id end as raw_id,
    case system when 'linux' then {_obj(pid='pid', level_raw='lvl')}
      when 'hpc' then {_obj(node='node', component='component', state='state', flag='flag')}
      when 'hdfs' then {_obj(pid='pid', level_raw='lvl')}
      when 'hadoop' then {_obj(process="'main'", level_raw="' ' || lower(lvl) || ' '")}
      else {_obj(level_raw='lvl')} end as extras
    from log_base))""")
_CLASS = (f"case when {kw('lower(event_template)', rules.EVENT_CLASS_OVERRIDES[0][1])} then 3 "
          f"when {kw('lower(event_template)', rules.EVENT_CLASS_OVERRIDES[1][1])} then 4 "
          f"else {case_map('event_type', rules.EVENT_CLASSES, '0')} end")
_BUCKET = """case system when 'hpc' then substr(timestamp, 1, 7)
    when 'hdfs' then split_part(timestamp, ' ', 1) || ' ' || substr(split_part(timestamp, ' ', 2), 1, 4)
    else regexp_replace(timestamp, ':[^:]*$', '') end"""
sql_view("log_timed", f"""select *, {_BUCKET} as time_bucket, {_CLASS} as event_class,
    cast(regexp_extract(event_id, 'E([0-9]+)', 1) as int) as event_int,
    case system when 'hpc' then make_timestamp(cast(timestamp as bigint) * 1000000)
      when 'linux' then strptime('1900 ' || timestamp, '%Y %b %d %H:%M:%S')
      when 'hdfs' then strptime(timestamp, '%y%m%d %H%M%S')
      when 'hadoop' then strptime(timestamp, '%Y-%m-%d %H:%M:%S,%g')
      else strptime(timestamp, '%y/%m/%d %H:%M:%S') end as ts from log_events""")

_COLS = ["system", "timestamp", "severity", "source", "event_id", "event_template", "message", "raw_id", "extras"]
for _i, _s in enumerate(rules.SYSTEMS):
    def _one(spark, sf, system=_s):
        return logs.NORMALIZERS[system](raw_logs(spark, sf)[system]).drop("event_type")
    _fn = "spark_logs" if _s == "spark" else _s
    query(f"P{8 + _i}_normalize_{_fn}", f"select {', '.join(_COLS)} from log_events where system = '{_s}'")(_one)


@query("P13_severity_by_keywords", f"""select line_id, {_by_words('lower(sentence)', rules.LINUX_ERROR_KEYWORDS, rules.LINUX_WARN_KEYWORDS)}
    as severity from log_base""")
def _(spark, sf):
    return view(spark, sf, "log_base").select("line_id", lg.severity_by_keywords(lg.lowered("sentence")).alias("severity"))


@query("P14_severity_hpc", f"select line_id, {_HPC} as severity from log_base")
def _(spark, sf):
    return view(spark, sf, "log_base").select("line_id", lg.severity_hpc("state", "flag", lg.lowered("sentence")).alias("severity"))


@query("P15_severity_by_level", f"select line_id, {_by_level(rules.HADOOP_ERROR_KEYWORDS, rules.HADOOP_WARN_KEYWORDS)} as severity from log_base")
def _(spark, sf):
    return view(spark, sf, "log_base").select("line_id", lg.severity_by_level(
        "lvl", lg.lowered("sentence"), rules.HADOOP_ERROR_KEYWORDS, rules.HADOOP_WARN_KEYWORDS).alias("severity"))


@query("P16_event_type", "select system, raw_id, event_type from log_events")
def _(spark, sf):
    return events(spark, sf).select("system", "raw_id", "event_type")


@query("P17_event_class", "select system, raw_id, event_class from log_timed")
def _(spark, sf):
    return events(spark, sf).select("system", "raw_id", lg.event_class("event_type", "event_template").alias("event_class"))


@query("P18_event_int", "select event_id, event_int, count(*) as n from log_timed group by all")
def _(spark, sf):
    return events(spark, sf).groupBy("event_id", lg.event_int("event_id").alias("event_int")).agg(F.count("*").alias("n"))


@query("P19_time_bucket", "select system, raw_id, time_bucket from log_timed")
def _(spark, sf):
    return events(spark, sf).select("system", "raw_id", lg.time_bucket("timestamp", "system").alias("time_bucket"))


@query("P20_parse_event_ts", "select system, raw_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as ts from log_timed")
def _(spark, sf):
    return events(spark, sf).select("system", "raw_id", F.date_format(
        lg.parse_event_ts("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"))


@query("P21_combine_ts", """select line_id, mon || ' ' || dom || ' ' || hms as joined,
    case when trim(flag) = '1' then mon || ' ' ||  hms else mon || ' ' || flag || ' ' || hms end as skipped, trim(flag) as flag
    from log_base""")
def _(spark, sf):
    b = view(spark, sf, "log_base")
    maybe = F.when(core.strip("flag") == "1", F.lit("  ")).otherwise(F.col("flag"))
    return b.select("line_id", core.combine_ts("mon", "dom", "hms").alias("joined"),
                    core.combine_ts("mon", maybe, "hms").alias("skipped"), core.safe_str("flag").alias("flag"))


@query("U1_merge_events", f"select {', '.join(_COLS)}, event_type from log_events")
def _(spark, sf):
    return events(spark, sf)


@query("U1_events_per_system", "select system, count(*) as n from log_events group by 1")
def _(spark, sf):
    return events(spark, sf).groupBy("system").agg(F.count("*").alias("n"))


@query("U5_templates_union", "select system, EventId, EventTemplate from templates")
def _(spark, sf):
    t = view(spark, sf, "templates")
    return logs.templates_union({s: t.where(F.col("system") == s).drop("system") for s in rules.SYSTEMS})


@query("U6_unexpected_values", f"select distinct event_type as value from log_events where event_type not in {in_list(rules.EVENT_TYPES[:6])}")
def _(spark, sf):
    return quality.unexpected_values(events(spark, sf), "event_type", rules.EVENT_TYPES[:6])


@query("J4_used_templates", """select EventId, system, min(EventTemplate) as EventTemplate from templates
    where EventId in (select event_id from log_events) group by 1, 2""")
def _(spark, sf):
    return logs.used_templates(view(spark, sf, "templates"), events(spark, sf))


@query("J5_uncovered_event_ids", """select distinct event_id from log_events
    where event_id not in (select EventId from templates where EventTemplate like '%e%o%' )""")
def _(spark, sf):
    return logs.uncovered_event_ids(events(spark, sf), view(spark, sf, "templates").where("EventTemplate like '%e%o%'"))


@query("G1_event_counts_by_window", """select system, severity, event_type, time_bucket, count(*) as count
    from log_timed group by all""")
def _(spark, sf):
    return logs.event_counts_by_window(events(spark, sf))


@query("J3_error_rate_by_system", f"""select system, time_bucket, count(*) as total,
    count(*) filter (where severity = 'ERROR') as error_count,
    {np_round("count(*) filter (where severity = 'ERROR') / count(*)", 4)} as error_rate from log_timed group by system, time_bucket""")
def _(spark, sf):
    return logs.error_rate_by_system(events(spark, sf))


@query("W2_top_n_per_group", """with c as (select system, event_id, event_template, count(*) as count from log_events group by all)
    select * from c qualify row_number() over (partition by system order by count desc, event_id, event_template) <= 10""")
def _(spark, sf):
    return logs.top_templates(events(spark, sf))


sql_view("log_windows", """select system, time_bucket('1 minute'::interval, ts, timestamp '1900-01-01') as w,
    list(event_int order by ts, try_cast(raw_id as bigint) nulls first, raw_id) as a, max(event_class) as label
    from log_timed group by 1, 2""")


@query("W3_time_windows", """select system, strftime(w, '%Y-%m-%d %H:%M') as window_start, array_to_string(a[-512:], ',') as seq, label
    from log_windows""")
def _(spark, sf):
    w = jobs.log_windows(events(spark, sf))
    return w.select("system", F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
                    F.array_join("sequence_ids", ",").alias("seq"), "label")


@query("W4_pad_or_truncate", """select array_to_string(list_concat(a[-512:], list_transform(range(0, 512 - len(a)), lambda x: 0)), ',') as seq,
    label from log_windows""")
def _(spark, sf):
    return jobs.log_sequences(events(spark, sf)).select(F.array_join("sequence_ids", ",").alias("seq"), "label")


@query("W3_time_windows_month", """with d as (select system, time_bucket('30 days'::interval, ts, timestamp '1970-01-01') as w,
    list(event_int order by ts, try_cast(raw_id as bigint) nulls first, raw_id) as a, max(event_class) as label from log_timed group by 1, 2)
    select system, strftime(w, '%Y-%m-%d') as window_start, len(a) > 512 as cut, md5(array_to_string(a[-512:], ',')) as seq, label from d""")
def _(spark, sf):
    # windows that hold more than the default length
    e = stage_table(logs.with_sequence_columns(events(spark, sf)))
    n = e.where("ts is not null").groupBy("system", F.window("ts", "30 days")["start"].alias("window_start")).agg((F.count("*") > 512).alias("cut"))
    w = ordering.time_windows(e, "30 days", rules.MAX_SEQUENCE_LENGTH).join(n, ["system", "window_start"])
    return w.select("system", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "cut",
                    F.md5(F.array_join("sequence_ids", ",")).alias("seq"), "label")


@query("W4_truncate_to_last", """with d as (select system, time_bucket('1 day'::interval, ts, timestamp '1900-01-01') as w,
    list(event_int order by ts, try_cast(raw_id as bigint) nulls first, raw_id) as a, max(event_class) as label from log_timed group by 1, 2)
    select system, strftime(w, '%Y-%m-%d') as window_start, array_to_string(a[-50:], ',') as seq, label from d""")
def _(spark, sf):
    w = jobs.log_windows(events(spark, sf), "1 day", 50)
    return w.select("system", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
                    F.array_join("sequence_ids", ",").alias("seq"), "label")


sql_view("log_profile", f"""with p as (select system, event_type, count(*) as n, count(*) filter (where severity = 'ERROR') as e
    from log_events group by all),
    q as (select system, sum(n)::bigint as count, sum(n) / (select count(*) from log_events) * 100 as share,
    sum(e)::bigint as error_count, sum(e) / sum(n) as rate, first(event_type order by n desc, event_type) as top_event_type,
    string_agg(event_type || '=' || n, ',' order by event_type) as event_types from p group by 1)
    select system, count, {py_round('share', 2)} as pct_of_total, error_count, {np_round('rate', 4)} as error_rate,
    top_event_type, event_types from q""")


def _profile_text(df):
    pairs = F.transform(F.map_entries("event_type_distribution"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return df.withColumn("event_types", F.array_join(F.array_sort(pairs), ",")).drop("event_type_distribution")


@query("G8_system_profile", "select * from log_profile")
def _(spark, sf):
    return _profile_text(logs.system_profile(events(spark, sf)))


sql_view("log_pivot", """with c as (select event_type, system, count(*) as count from log_events group by all)
    select *, sum(count) over (partition by event_type)::bigint as total from c""")


@query("G9_event_type_by_system", "select event_type, system, count, total from log_pivot")
def _(spark, sf):
    return logs.event_type_by_system(events(spark, sf))


@query("G10_error_rate_flags", f"""with h as (select case when system = 'hpc' then 'hpc' else 'rest' end as system, count(*) as n,
    count(*) filter (where severity = 'ERROR' and system = 'hpc') as e from log_events group by 1),
    g as (select sum(e) / sum(n) as rate from h)
    select system as slice, 'error_rate' as metric, {np_round('e / n', 4)} as value, {np_round('rate', 4)} as global_mean,
    {np_round('rate * 2', 4)} as threshold, 'BIASED' as status from h, g where {np_round('e / n', 4)} > rate * 2""")
def _(spark, sf):
    # one system against all the others, whose errors are taken as warnings
    e = events(spark, sf).withColumn("severity", F.when(
        (F.col("severity") == "ERROR") & (F.col("system") != "hpc"), "WARN").otherwise(F.col("severity"))) \
        .withColumn("system", F.when(F.col("system") == "hpc", "hpc").otherwise("rest"))
    return logs.error_rate_flags(logs.system_profile(e))


@query("G11_dominance_flags", f"""with e as (select case when system = 'hpc' and event_type = 'normal_ops' then 'hpc' when system = 'hpc' then 'rest'
    when event_type = 'normal_ops' and k < 10 then 'rest' when event_type = 'normal_ops' then 'hpc' else 'rest' end as system, event_type from log_events),
    c as (select event_type, system, count(*) as count from e group by all),
    p as (select *, sum(count) over (partition by event_type) as total from c)
    select system || '/' || event_type as slice, 'event_type_dominance' as metric, {py_round('count / total', 4)} as value,
    0.8::double as threshold, 'BIASED' as status from p where total >= 5 and count / total > 0.8""")
def _(spark, sf):
    e = events(spark, sf)
    small = F.regexp_extract("event_id", r"E(\d+)", 1).cast("int")
    k = view(spark, sf, "log_base").select(F.col("line_id"), F.col("k"))
    joined = e.withColumn("line_id", F.regexp_replace("raw_id", "^L", "")).join(k, "line_id").where(small > 0)
    quiet = F.col("event_type") == "normal_ops"
    system = F.when((F.col("system") == "hpc") & quiet, "hpc").when(F.col("system") == "hpc", "rest") \
        .when(quiet & (F.col("k") < 10), "rest").when(quiet, "hpc").otherwise("rest")
    return logs.dominance_flags(logs.event_type_by_system(joined.withColumn("system", system)))


@query("G12_null_rates", "\nunion all ".join(
    f"""select '{c}' as "column", {np_round(f"count(*) filter (where {c} is null) / count(*) * 100", 2)} as null_pct from batch_task"""
    for c in ("status", "plan_cpu", "plan_mem")))
def _(spark, sf):
    return profile.null_rates(view(spark, sf, "batch_task").select("status", "plan_cpu", "plan_mem"))


@query("G13_profile_events", "select 'table' as section, 'total_rows' as name, count(*)::double as value from log_events"
       " union all select 'table', 'total_columns', 10 union all select 'table', 'unique_event_ids', count(distinct event_id) from log_events"
       " union all select 'table', 'unique_event_templates', count(distinct event_template) from log_events"
       + "".join(f" union all select 'null_rates_pct', '{c}', round(count(*) filter (where {c} is null) / count(*) * 100, 2) from log_events"
                 for c in rules.UNIFIED_COLUMNS)
       + "".join(f" union all select '{c}', {c}, count(*) from log_events group by {c}" for c in ("system", "severity", "event_type")))
def _(spark, sf):
    return profile.profile_events(events(spark, sf))


def _md5_chunks(text):
    h = f"md5({text})"
    out = "0"
    for start in (1, 9, 17, 25):
        out = f"(({out}) * {16 ** 8 % 100} + ('0x' || substr({h}, {start}, 8))::bigint) % 100"
    return out


@query("F30_stable_hash_keep", f"""select system, raw_id from log_events where {_md5_chunks("system || ':' || raw_id")} < 10""")
def _(spark, sf):
    return logs.sample_events(events(spark, sf)).select("system", "raw_id")


@query("D2_expect_not_null", "\nunion all ".join(
    f"""select 'not_null' as "check", '{c}' as "column", case when count(*) filter (where {c} is null or {c} = '') = 0
    then 'passed' else 'failed' end as status, count(*) filter (where {c} is null or {c} = '')::double as value from log_events"""
    for c in ("event_id", "event_template", "message", "raw_id")))
def _(spark, sf):
    checks = quality.expect_not_null(["event_id", "event_template", "message", "raw_id"], or_empty=True)
    return quality.check_suite(events(spark, sf), checks).select("check", "column", "status", "value")


@query("D3_expect_in_set", f"""select 'in_set' as "check", 'severity' as "column", case when count(*) = 0 then 'passed' else 'failed' end as status, count(*)::double as value
    from log_events where severity not in {in_list(rules.SEVERITIES[:2])} union all select 'in_set', 'event_type', case when count(*) = 0 then 'passed' else 'failed' end, count(*) from log_events
    where event_type not in {in_list(rules.EVENT_TYPES[:6])}""")
def _(spark, sf):
    checks = [quality.expect_in_set("severity", rules.SEVERITIES[:2]), quality.expect_in_set("event_type", rules.EVENT_TYPES[:6])]
    return quality.check_suite(events(spark, sf), checks).select("check", "column", "status", "value")


@query("D7_expect_regex", """select 'matches' as "check", 'event_id' as "column", case when count(*) filter (where not regexp_matches(event_id, '^E[0-9]+$')) = 0 then 'passed' else 'failed' end as status,
    count(*) filter (where not regexp_matches(event_id, '^E[0-9]+$'))::double as value from log_events
    union all select 'matches', 'raw_id', case when count(*) filter (where not regexp_matches(raw_id, '^[0-9]+$')) = 0 then 'passed' else 'failed' end,
    count(*) filter (where not regexp_matches(raw_id, '^[0-9]+$')) from log_events""")
def _(spark, sf):
    checks = [quality.expect_regex("event_id", rules.EVENT_ID_PATTERN), quality.expect_regex("raw_id", r"^\d+$")]
    return quality.check_suite(events(spark, sf), checks).select("check", "column", "status", "value")


@query("D10_expect_sample_ratio", f"""with s as (select count(*) as s from log_events where {_md5_chunks("system || ':' || raw_id")} < 10),
    n as (select count(*) as n from log_events)
    select 'sample_ratio' as "check", case when s / n * 100 between 5 and 100 then 'passed' else 'failed' end as status,
    {py_round('s / n * 100', 2)} as value from s, n""")
def _(spark, sf):
    e = events(spark, sf)
    return quality.expect_sample_ratio(logs.sample_events(e), e).select("check", "status", "value")


@query("D20_verdict", f"""with f as (select count(*) filter (where system not in {in_list(rules.SYSTEMS)}) = 0 as a, count(*) filter (where event_type not in {in_list(rules.EVENT_TYPES[:6])}) = 0 as b,
      count(*) filter (where event_id is null or event_id = '') = 0 as c, min(length(message)) >= 1000 as soft, count(*) filter (where trim(extras) = '') = 0 as w1,
      count(*) filter (where trim(message) = '') = 0 as w2 from log_events),
    n as (select a::int + b::int + c::int + soft::int + w1::int + w2::int as passed, 6 - (not w1)::int - (not w2)::int as total,
      (not a)::int + (not b)::int + (not c)::int + (not soft)::int as failed, (not w1)::int + (not w2)::int as warnings, a and b and c as is_valid from f)
    select total::bigint as total_checks, passed::bigint as passed, failed::bigint as failed, warnings::bigint as warnings, passed / total as success_rate, is_valid from n""")
def _(spark, sf):
    # a failing rule, a failing soft one and a warning beside rules that hold
    checks = [quality.expect_in_set("system", rules.SYSTEMS), quality.expect_in_set("event_type", rules.EVENT_TYPES[:6]),
              *quality.expect_not_null(["event_id"], or_empty=True), quality.expect_min_value("size", 1000), *quality.expect_not_blank(["extras", "message"])]
    return quality.verdict(quality.check_suite(events(spark, sf).withColumn("size", F.length("message")), checks))


@query("D20_log_gate", f"""with f as (select count(*) as n, {', '.join(f"count(*) filter (where {c} not in {in_list(v)}) = 0 as in_{c}" for c, v in (('system', rules.SYSTEMS), ('severity', rules.SEVERITIES), ('event_type', rules.EVENT_TYPES)))},
      {', '.join(f"count(*) filter (where {c} is null or {c} = '') = 0 as has_{c}" for c in ('event_id', 'event_template', 'message', 'raw_id'))},
      count(*) filter (where not regexp_matches(event_id, '^E[0-9]+$')) = 0 as matches from log_events),
    p as (select [in_system, in_severity, in_event_type, has_event_id, has_event_template, has_message, has_raw_id, matches, n >= 1, true] as ok from f),
    c as (select len(ok) as total, len(list_filter(ok, lambda x: x)) as passed from p)
    select total as total_checks, passed, total - passed as failed, 0::bigint as warnings, passed / total as success_rate, passed = total as is_valid from c""")
def _(spark, sf):
    return jobs.log_gate(events(spark, sf))
