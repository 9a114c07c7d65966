"""Telemetry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import case_map, np_round, py_round, query, sql_view
from checks.views import view
from opsgrain import rules
from opsgrain.functions import telemetry as tok
from opsgrain.operators import generated, ordering, profile, sampling, telemetry
from opsgrain.plans import jobs

TASK_KEY = ["job_id", "inst_num", "start_time", "end_time"]


def seq(col="sequence_ids"):
    return F.array_join(col, ",").alias("seq")


def sequences(spark, sf):
    return jobs.telemetry_sequences(
        view(spark, sf, "usage"), view(spark, sf, "batch_task"), view(spark, sf, "server_event"),
        usage_order=["time_stamp", "event_id"], task_key=TASK_KEY, event_key=["event_id"])


def _bin(expr: str, base: int) -> str:
    return f"(case when {expr} is null then {base + 4} else {base} + cast(floor(least({expr} / 10, 9.0)) as int) end)"


_STATUS = "coalesce(status, 'Unknown')"
sql_view("usage_tokens", f"""select time_stamp, event_id, {_bin('cpu_util_percent', 100)} as cpu,
    {_bin('mem_util_percent', 200)} as mem, row_number() over (order by time_stamp, event_id) - 1 as i from usage""")
sql_view("usage_seq", """select i // 5 as window_index, list(cpu order by i) as c, list(mem order by i) as m,
    case when last(mem order by i) >= 207 or last(cpu order by i) >= 208 then 1 else 0 end as label
    from usage_tokens group by 1 having count(*) = 5""")
sql_view("batch_seq", f"""select *, case when st = 'Failed' and cpu <= 103 then 2
    when st = 'Terminated' and mem >= 207 then 1 when st in ('Failed', 'Waiting') then 4 else 0 end as label from (
    select *, {_STATUS} as st, {_bin('plan_cpu', 100)} as cpu, {_bin('coalesce(plan_mem * 100, 0)', 200)} as mem,
    {case_map(_STATUS, rules.STATUS_TOKENS, '304')} as tok from batch_task)""")
sql_view("event_seq", f"""select event_id, {case_map("lower(coalesce(event_type, 'unknown'))", rules.EVENT_TOKENS, '403')} as tok,
    {_bin('plan_cpu', 100)} as cpu, {_bin('coalesce(plan_mem * 100, 0)', 200)} as mem,
    case when lower(event_type) = 'failure' then 3 else 0 end as label from server_event""")
sql_view("sequences", """select 'usage' as source, cast(window_index as varchar) as row_id,
    concat_ws(',', c[1], m[1], c[2], m[2], c[3], m[3], c[4], m[4], c[5], m[5]) as seq, label from usage_seq
    union all select 'batch', concat_ws('-', job_id, inst_num, start_time, end_time), concat_ws(',', cpu, mem, tok), label from batch_seq
    union all select 'event', cast(event_id as varchar), concat_ws(',', tok, cpu, mem), label from event_seq""")
_NAME = case_map("label", rules.LABEL_NAMES, "null")


@query("P1_bin_token", f"""select event_id, {_bin('cpu_util_percent', 100)} as cpu_token,
    {_bin('mem_util_percent', 200)} as mem_token from usage""")
def _(spark, sf):
    u = view(spark, sf, "usage")
    return u.select("event_id", tok.cpu_token("cpu_util_percent").alias("cpu_token"),
                    tok.bin_token(F.col("mem_util_percent").cast("string"), 200).alias("mem_token"))


@query("P2_code_token", f"""select 'status' as kind, status as value, {case_map('status', rules.STATUS_TOKENS, '304')} as token,
    count(*) as n from batch_task group by all union all
    select 'event', event_type, {case_map('lower(event_type)', rules.EVENT_TOKENS, '403')}, count(*) from server_event group by all""")
def _(spark, sf):
    b = view(spark, sf, "batch_task").select(F.lit("status").alias("kind"), F.col("status").alias("value"),
                                             tok.status_token("status").alias("token"))
    e = view(spark, sf, "server_event").select(F.lit("event").alias("kind"), F.col("event_type").alias("value"),
                                               tok.event_token("event_type").alias("token"))
    return b.unionByName(e).groupBy("kind", "value", "token").agg(F.count("*").alias("n"))


@query("P3_batch_sequences", """select job_id, inst_num, start_time, end_time, concat_ws(',', cpu, mem, tok) as seq, label
    from batch_seq""")
def _(spark, sf):
    return telemetry.batch_sequences(view(spark, sf, "batch_task"), *TASK_KEY).select(*TASK_KEY, seq(), "label")


@query("P4_event_sequences", "select event_id, concat_ws(',', tok, cpu, mem) as seq, label from event_seq")
def _(spark, sf):
    return telemetry.event_sequences(view(spark, sf, "server_event"), "event_id").select("event_id", seq(), "label")


@query("P5_job_label", "select st as status, label, count(*) as n from batch_seq group by all")
def _(spark, sf):
    b = telemetry.fill_job_defaults(view(spark, sf, "batch_task"))
    label = tok.job_label(F.col("status"), tok.cpu_token("plan_cpu"), tok.planned_mem_token("plan_mem"))
    return b.groupBy("status", label.alias("label")).agg(F.count("*").alias("n"))


@query("P6_usage_label", "select event_id, case when mem >= 207 or cpu >= 208 then 1 else 0 end as label from usage_tokens")
def _(spark, sf):
    return view(spark, sf, "usage").select("event_id", tok.usage_label(
        tok.cpu_token("cpu_util_percent"), tok.mem_token("mem_util_percent")).alias("label"))


@query("P7_label_name", f"select label, {_NAME} as label_name, count(*) as n from batch_seq group by all")
def _(spark, sf):
    b = telemetry.batch_sequences(view(spark, sf, "batch_task"))
    return b.groupBy("label", tok.label_name("label").alias("label_name")).agg(F.count("*").alias("n"))


@query("P30_fill_job_defaults", """select coalesce(status, 'Unknown') as status, coalesce(task_type, -1) as task_type,
    count(*) as n from batch_task group by all""")
def _(spark, sf):
    return telemetry.fill_job_defaults(view(spark, sf, "batch_task")).groupBy("status", "task_type") \
        .agg(F.count("*").alias("n"))


@query("W1_count_windows", """select window_index, concat_ws(',', c[1], m[1], c[2], m[2], c[3], m[3], c[4], m[4], c[5], m[5]) as seq,
    label from usage_seq""")
def _(spark, sf):
    return ordering.count_windows(view(spark, sf, "usage"), ["time_stamp", "event_id"]).select(
        "window_index", seq(), "label")


@query("U4_all_telemetry_sequences", "select source, row_id, seq, label from sequences")
def _(spark, sf):
    return sequences(spark, sf).select("source", "row_id", seq(), "label")


@query("C1_anomalous", f"select source, row_id, seq, label, {_NAME} as label_name from sequences where label <> 0")
def _(spark, sf):
    return telemetry.anomalous(sequences(spark, sf)).select("source", "row_id", seq(), "label", "label_name")


@query("C1_critical", f"select source, row_id, label, {_NAME} as label_name from sequences where label in (1, 2)")
def _(spark, sf):
    return telemetry.critical(sequences(spark, sf)).select("source", "row_id", "label", "label_name")


@query("G2_value_distribution", f"""with c as (select {_STATUS} as value, count(*) as count from batch_task group by 1),
    d as (select *, count / (select sum(count) from c) * 100 as p from c) select value, count, {py_round('p', 2)} as pct from d""")
def _(spark, sf):
    return profile.value_distribution(telemetry.fill_job_defaults(view(spark, sf, "batch_task")), "status")


@query("G3_sequence_stats", f"""with t as (select cast(unnest(string_split(seq, ',')) as int) as t from sequences where row_id not like '%13' and row_id not like '%17'),
    n as (select case when row_id like '%13' then 0 when row_id like '%17' then null else len(string_split(seq, ',')) end as n,
      case when row_id like '%19' then null when row_id like '%23' then 9 else label end as label from sequences)
    select 'total_sequences' as metric, cast(count(*) as double) as value from n
    union all select 'length_min', min(coalesce(n, 0)) from n union all select 'length_max', max(n) from n
    union all select 'length_mean', {py_round('a', 2)} from (select avg(coalesce(n, 0)) as a from n)
    union all select 'empty_sequences', count(*) filter (where n = 0) from n union all select 'missing_fields', count(*) filter (where n is null or label is null) from n
    union all select 'invalid_labels', count(*) filter (where label not between 0 and 4) from n
    union all select 'label_Normal', count(*) filter (where label = 0) from n
    union all select 'label_Resource_Exhaustion', count(*) filter (where label = 1) from n
    union all select 'label_System_Crash', count(*) filter (where label = 2) from n
    union all select 'label_Network_Failure', count(*) filter (where label = 3) from n
    union all select 'label_Data_Drift', count(*) filter (where label = 4) from n
    union all select 'total_tokens', count(*) from t
    union all select 'cpu_tokens', count(*) filter (where t between 100 and 109) from t
    union all select 'memory_tokens', count(*) filter (where t between 200 and 209) from t
    union all select 'unique_tokens', count(distinct t) from t""")
def _(spark, sf):
    # some sequences are empty or missing, some labels missing or unknown
    s, row = sequences(spark, sf), F.col("row_id")
    return profile.sequence_stats(s.withColumns({
        "sequence_ids": F.when(row.endswith("13"), F.array().cast("array<int>")).when(~row.endswith("17"), F.col("sequence_ids")),
        "label": F.when(row.endswith("23"), 9).when(~row.endswith("19"), F.col("label"))}))


@query("G4_failure_rate_by", f"""select task_type, {np_round("count(*) filter (where status = 'Failed') / count(*) * 100", 2)} as failure_pct
    from batch_task group by 1""")
def _(spark, sf):
    return profile.failure_rate_by(telemetry.fill_job_defaults(view(spark, sf, "batch_task")), "task_type")


def _rates(spark, sf, col):
    b = telemetry.fill_job_defaults(view(spark, sf, "batch_task"))
    return profile.selection_rate_by(b, col, F.col("status") == "Failed")


@query("G5_selection_rate_by", """select cast(task_type as varchar) as "group",
    round(count(*) filter (where status = 'Failed') / count(*), 9) as selection_rate, count(*) as count
    from batch_task group by 1""")
def _(spark, sf):
    return _rates(spark, sf, "task_type").withColumn("selection_rate", F.round("selection_rate", 9))


@query("G5_between_group_difference", f"""with r as (select {_STATUS} as s, count(*) filter (where status = 'Failed') / count(*) as r
    from batch_task group by 1) select round(max(r) - min(r), 9) as disparity, max(r) - min(r) > 0.1 as bias_detected from r""")
def _(spark, sf):
    return profile.between_group_difference(_rates(spark, sf, "status")).withColumn(
        "disparity", F.round("disparity", 9))


@query("G6_dominant_values", f"""with c as (select case when plan_mem > 0.1 then 'planned' else 'tiny' end as value, count(*) as count from batch_task group by 1),
    d as (select *, count / (select sum(count) from c) * 100 as p from c), e as (select value, count, {py_round('p', 2)} as pct from d)
    select * from e where pct > 80""")
def _(spark, sf):
    b = view(spark, sf, "batch_task").select(
        F.when(F.col("plan_mem") > 0.1, "planned").otherwise("tiny").alias("v"))
    return profile.dominant_values(b, "v")


@query("G7_label_imbalance", f"""with c as (select {_NAME} as label_name, count(*) as count from sequences group by label),
    d as (select *, count / (select sum(count) from c) * 100 as p from c), e as (select label_name, count, {py_round('p', 2)} as pct from d)
    select *, label_name = 'Normal' and pct > 70 as bias_detected from e""")
def _(spark, sf):
    return profile.label_imbalance(sequences(spark, sf))


@query("J6_top_values_only", """with t as (select machine_id from usage group by 1 order by count(*) desc, machine_id limit 5)
    select event_id, machine_id from usage where machine_id in (select machine_id from t)""")
def _(spark, sf):
    return ordering.top_values_only(view(spark, sf, "usage"), "machine_id", 5).select("event_id", "machine_id")


@query("O2_top_k_values", "select job_id, count(*) as n from batch_task group by 1 order by n desc, job_id limit 15")
def _(spark, sf):
    return ordering.top_k_values(view(spark, sf, "batch_task"), "job_id", 15)


_KEY = "concat_ws(':', '42', source, row_id)"
sql_view("balanced", f"""with s as (select *, md5({_KEY}) || ':' || {_KEY} as k from sequences),
    i as (select *, row_number() over (partition by label order by k) - 1 as idx, count(*) over (partition by label) as size from s),
    t as (select max(n) as t from (select label, count(*) as n from sequences where label between 1 and 4 group by 1)),
    p as (select distinct label, size, t, case when label <> 0 and size < t then t else 0 end as draws,
          case when label = 0 then least(size, 3 * t) when size < t then 0 else size end as keep from i, t),
    d as (select label, size, unnest(range(0, draws)) as dr from p where draws > 0),
    x as (select label, ('0x' || substr(md5('42:' || label || ':' || dr), 1, 15))::bigint % size as idx, count(*) as times
          from d group by all)
    select source, row_id, i.label, 0 as copy from i join p on p.label = i.label where idx < keep
    union all select source, row_id, i.label, unnest(range(0, times)) as copy from i join x on x.label = i.label and x.idx = i.idx""")


@query("B1_balance_classes", "select source, row_id, label, copy from balanced")
def _(spark, sf):
    from opsgrain.session import stage_table
    return sampling.balance_classes(stage_table(sequences(spark, sf)), ["source", "row_id"]).select(
        "source", "row_id", "label", "copy")


@query("B1_balanced_counts", "select label, count(*) as n from balanced group by 1")
def _(spark, sf):
    return jobs.telemetry_training_table(sequences(spark, sf)).groupBy("label").agg(F.count("*").alias("n"))


@query("D13_validate_sequences", """select source || '/' || row_id as id, 'invalid label ' || (label * 2) as error
    from sequences where label * 2 not between 0 and 4""")
def _(spark, sf):
    # doubled labels, so that the rule has something to report
    s = sequences(spark, sf).select(F.concat_ws("/", "source", "row_id").alias("id"), "sequence_ids",
                                    (F.col("label") * 2).alias("label"))
    return generated.validate_sequences(s, "id")
