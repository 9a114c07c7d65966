"""Adapter views: the given tables projected into the shapes the operators read.

One SQL text per view serves both engines; ``Dialect`` holds the few spellings that differ.
Spark reads the parquet files, the oracle reads the registered tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dialect:
    name: str
    sf_dir: str = ""

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def table(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`" if self.spark else name

    def array(self, *items: str) -> str:
        body = ", ".join(items)
        return f"array({body})" if self.spark else f"[{body}]"

    def no_text(self) -> str:
        return "cast(null as array<string>)" if self.spark else "cast(null as varchar[])"

    def join(self, arr: str, sep: str) -> str:
        return f"array_join({arr}, '{sep}')" if self.spark else f"array_to_string({arr}, '{sep}')"

    def seconds(self, ts: str) -> str:
        if self.spark:
            return f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})"
        return f"cast(floor(epoch({ts})) as bigint)"

    def fmt(self, ts: str, java: str, c: str) -> str:
        return f"date_format({ts}, '{java}')" if self.spark else f"strftime({ts}, '{c}')"

    def ordered(self, order: str, **fields: str) -> str:
        """Aggregate: list of structs in the given order."""
        if self.spark:
            pairs = ", ".join(f"'{k}', {v}" for k, v in fields.items())
            out = ", ".join(f"'{k}', x.{k}" for k in fields)
            return (f"transform(array_sort(collect_list(named_struct('_o', {order}, {pairs}))), "
                    f"x -> named_struct({out}))")
        pairs = ", ".join(f"'{k}': {v}" for k, v in fields.items())
        return f"list({{{pairs}}} order by {order})"

    def joined_lines(self, order: str, text: str) -> str:
        if self.spark:
            return (f"array_join(transform(array_sort(collect_list(named_struct('_o', {order}, 't', {text}))), "
                    "x -> x.t), chr(10))")
        return f"string_agg({text}, chr(10) order by {order})"


K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
NL = "chr(10)"
Q = "chr(39)"

# fixed values: one sentence per event-type rule, then three for the class overrides and the rest
SENTENCES = (
    "authentication failure for user root",
    "Permission denied while opening file",
    "Component State Change: Component is unavailable",
    "java.lang.OutOfMemoryError: Java heap space",
    "Connection refused by remote host",
    "failed to read input split",
    "Executor lost on worker node",
    "kernel panic on boot",
    "Unhandled exception in worker",
    "request timeout on host",
    "checksum mismatch",
    "heartbeat ok",
)


def pick(expr: str, values: list[str], default: str) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {expr} {whens} else {default} end"


def lines(*parts: str) -> str:
    """SQL expression for lines of text (no quotes inside)."""
    return f" || {NL} || ".join(f"'{p}'" for p in parts)


def _usage(d: Dialect) -> str:
    return f"""select {d.seconds('ts')} as time_stamp, cast(user_id as string) as machine_id,
        value as cpu_util_percent, cast({K} as double) as mem_util_percent, event_id
        from {d.table('events')}"""


def _batch_task(d: Dialect) -> str:
    return f"""select l_partkey as start_time, l_suppkey as end_time, l_linenumber as inst_num,
        l_linenumber as task_type, cast(l_orderkey as string) as job_id,
        case when l_returnflag = 'R' and l_linestatus = 'F' then 'Failed'
             when l_returnflag = 'A' and l_linestatus = 'F' then 'Terminated'
             when l_returnflag = 'N' and l_linestatus = 'F' then 'Running'
             when l_returnflag = 'R' and l_linestatus = 'O' then 'Waiting'
             when l_returnflag = 'N' and l_linestatus = 'O' then 'Terminated' end as status,
        l_quantity * 2 as plan_cpu, l_discount * 10 as plan_mem,
        l_extendedprice as price, l_tax as tax from {d.table('lineitem')}"""


def _server_event(d: Dialect) -> str:
    return f"""select {d.seconds('ts')} as time_stamp, cast(user_id as string) as machine_id,
        case event_type when 'signup' then 'add' when 'purchase' then 'remove' when 'error' then 'Failure'
             when 'view' then 'reboot' end as event_type,
        '' as event_detail, value as plan_cpu,
        case when k % 10 = 0 then null else cast(k as double) / 100 end as plan_mem,
        '' as extra, event_id from (select *, {K} as k from {d.table('events')}) a"""


def _log_base(d: Dialect) -> str:
    sentence = pick("kk", [f"'{s}'" for s in SENTENCES], "''")
    return f"""select cast(event_id as string) as line_id, cast(user_id as string) as pid, k,
        case user_id % 5 when 0 then 'linux' when 1 then 'hpc' when 2 then 'hdfs' when 3 then 'hadoop'
             else 'spark' end as system,
        case event_type when 'error' then 'FATAL' when 'signup' then 'WARNING' when 'click' then 'INFO'
             when 'view' then 'DEBUG' else 'notice' end as lvl,
        event_type as component, concat('node-', cast(user_id as string)) as node,
        case event_type when 'error' then 'unavailable' when 'signup' then 'degraded' else 'running' end as state,
        case when k % 7 = 0 then ' 1 ' else '0' end as flag,
        {d.seconds('ts')} as epoch_s,
        {d.fmt('ts', 'MMM', '%b')} as mon, {d.fmt('ts', 'd', '%-d')} as dom, {d.fmt('ts', 'HH:mm:ss', '%H:%M:%S')} as hms,
        {d.fmt('ts', 'yyMMdd', '%y%m%d')} as ymd6, {d.fmt('ts', 'HHmmss', '%H%M%S')} as hms6,
        {d.fmt('ts', 'yyyy-MM-dd', '%Y-%m-%d')} as iso, {d.fmt('ts', 'HH:mm:ss,SSS', '%H:%M:%S,%g')} as hmsms,
        {d.fmt('ts', 'yy/MM/dd', '%y/%m/%d')} as slashed,
        concat('E', cast(kk + 1 as string)) as eid, {sentence} as sentence
        from (select *, k % 12 as kk from (select *, {K} as k from {d.table('events')}) a) b"""


def _templates(d: Dialect) -> str:
    return f"""select distinct system, eid as EventId, sentence as EventTemplate from log_base
        union all select 'linux' as system, concat('E', cast(100 + n_nationkey as string)) as EventId,
        n_name as EventTemplate from {d.table('nation')}"""


def _qa_pairs(d: Dialect) -> str:
    mode = "(u.conv_id + u.turn) % 8"
    q = pick(mode, [
        "' how do I fix the CrashLoopBackOff?'",
        "' why is the connection refused at http://example.com/a?x=1 today'",
        "' what is a terraform module'",
        "' OOMKilled with CUDA out of memory'",
        "' please debug the 403 unauthorized response'",
        "' recommend a tool'",
        "' the dns is unreachable <b>bold</b>'",
    ], "''")
    a = pick(mode, [
        "' Use `kubectl describe pod` now.'",
        "' See https://docs.example.com/page for docker.'",
        f"' Run ```terraform' || {NL} || 'plan``` and `terraform apply` then.'",
        "' Set limits!'",
        "' Check iam on aws.'",
        "''",
        "' prometheus and grafana... ok?'",
    ], "''")
    tags = pick("u.conv_id % 4", [
        d.array("'kubernetes'", "'docker'"), d.array("'terraform'"), d.array("'gpu'", "'mlops'", "'kubernetes'"),
    ], d.array("'airflow'"))
    return f"""select u.conv_id * 100 + u.turn as question_id, substr(u.text, 1, 40) as title,
        u.text || {q} as question_body, a.text || {a} as answer_body, {tags} as tags,
        u.conv_id % 40 as score, (u.turn * 7) % 30 as answer_score, u.conv_id * 37 as view_count,
        u.conv_id as conv_id, u.turn as turn
        from {d.table('conversations')} u join {d.table('conversations')} a
        on a.conv_id = u.conv_id and a.turn = u.turn + 1
        where u.role = 'user' and a.role = 'assistant'"""


def _question_posts(d: Dialect) -> str:
    return f"""select cast(question_id as string) as Id, '<h1>' || title || '</h1>' as Title,
        '<p>' || question_body || '</p> &amp;amp; &lt;x&gt; <code>a</code>' as Body,
        '<' || {d.join('tags', '><')} || '>' as Tags,
        case when conv_id % 17 = 0 then 'n/a' when conv_id % 13 = 0 then '' else cast(score as string) end as Score,
        case when conv_id % 11 = 0 then '' else cast(view_count as string) end as ViewCount,
        case when conv_id % 5 = 0 then '  ' else cast(question_id * 10 + 1 as string) end as AcceptedAnswerId,
        '2024-01-01' as CreationDate from qa_pairs"""


def _answer_posts(d: Dialect) -> str:
    return """select cast(question_id * 10 + 1 as string) as AnswerId, cast(question_id as string) as QuestionId,
        '<p>' || answer_body || '</p>' as AnswerBody, cast(answer_score as string) as AnswerScore from qa_pairs
        union all
        select cast(question_id * 10 + 2 as string), cast(question_id as string),
        '<p>Second: ' || answer_body || '</p>', case when conv_id % 2 = 0 then '' else cast(answer_score + 1 as string) end
        from qa_pairs where conv_id % 3 = 0"""


def _html_posts(d: Dialect) -> str:
    return f"select page_id, html from {d.table('pages')}"


SIGNATURE = ('{"name": "get_weather", "description": "Get it", "parameters": {"type": "object", '
             '"properties": {"city": {"type": "string"}, "unit": {"type": "string"}}, "required": ["city"]}}')
END = "<|endoftext|>"


def _chats(d: Dialect) -> str:
    call = f"{NL} || 'ASSISTANT: <functioncall> "
    quoted = f"""{call}{{"name": "get_weather", "arguments": ' || {Q} || '{{"city": "Paris"}}' || {Q} || '}} {END}'"""
    three = f"""{call}{{"name": "book", "arguments": {{"a": 1, "b": "x", "c": [1, 2]}}}} {END}'"""
    broken = f"""{call}{{"name": "broken", "arguments": {{oops}} {END}'"""
    response = f"{NL} || 'FUNCTION RESPONSE: <functionresponse> an error came </functionresponse> if the request did fail'"
    suffix = pick("conv_id % 6", ["''", quoted, three, f"{quoted} || {three}", broken], response)
    system = pick("conv_id % 3", [
        f"'You are helpful. Tools: {SIGNATURE} use them'", "'Plain assistant'",
    ], f"'Tools: {SIGNATURE} {SIGNATURE}'")
    line = "case role when 'user' then 'USER: ' when 'assistant' then 'ASSISTANT: ' else 'NOTE: ' end || text"
    return f"""select conv_id, {system} as system, body || {suffix} as chat from (
        select conv_id, {d.joined_lines('turn', line)} as body from {d.table('conversations')} group by conv_id) t"""


def _messages(d: Dialect) -> str:
    return f"""select conv_id, {d.ordered('turn', role='role', content='text')} as messages
        from {d.table('conversations')} group by conv_id"""


# fixed values: manifest heads; two are broken or no manifest
MANIFESTS = (
    ("apiVersion: apps/v1", "kind: Deployment", "metadata:", "  name: trainer", "spec:", "  limits:",
     "    nvidia.com/gpu: 1"),
    ("apiVersion: serving.kserve.io/v1beta1", "kind: InferenceService", "metadata:", "  name: m", "spec:",
     "  predictor:", "    storageUri: s3://models/x"),
    ("apiVersion: machinelearning.seldon.io/v1", "kind: SeldonDeployment", "metadata:", "  name: s"),
    ("apiVersion: v1", "kind: Service", "metadata:", "  name: web", "spec:", "  type: \"LoadBalancer\""),
    ("apiVersion: v1", "kind: ConfigMap", "metadata:", "  name: [unclosed"),
    ("name: ci", "on: push", "jobs:", "  build: {}"),
    ("apiVersion: v1", "metadata:", "  name: nokind"),
    ("apiVersion: batch/v1", "kind: Job", "metadata:", "  name: mlflow-run", "data:",
     "  key: sk-abcdefghijklmnopqrstuvwx", "  db_password: hunter2", "  mail: ops.team@example.com",
     "  peer: 10.0.0.1", "  API_KEY: abc"),
)
PATHS = (
    "k8s/my-deploy.yaml", "svc/web_service.yml", "ml/inference-server.yaml", "gpu-node.YAML", "train_job.yaml",
    "ci/pipeline.yaml", "net/ingress.yaml", "app-secret.yaml", "config.yaml", "misc/thing__one.yaml",
)


def _code_files(d: Dialect) -> str:
    head = pick("doc_id % 8", [lines(*m) for m in MANIFESTS], "''")
    path = pick("doc_id % 10", [f"'{p}'" for p in PATHS], "''")
    lic = (f"case when text like '%MIT License%' then {d.array(chr(39) + 'MIT' + chr(39))} "
           f"when text like '%Apache License%' then {d.array(chr(39) + 'Apache-2.0' + chr(39))} "
           f"when doc_id % 5 = 0 then {d.no_text()} "
           f"when doc_id % 5 = 1 then {d.array(chr(39) + 'GPL-3.0' + chr(39))} "
           f"else {d.array(chr(39) + 'MIT' + chr(39), chr(39) + ' BSD-3-Clause ' + chr(39))} end")
    return f"""select doc_id, md5(text) as hexsha,
        case when doc_id % 23 = 0 then '' else {head} || {NL} || '# ' || replace(text, {NL}, {NL} || '# ') end as content,
        case when doc_id % 11 = 0 then 'json' when doc_id % 7 = 0 then '' else '.YAML' end as ext,
        'yaml' as lang,
        cast(case when doc_id % 13 = 0 then 100 when doc_id % 29 = 0 then 600000 else length(text) + 200 end as bigint) as size,
        cast(20.5 as double) as avg_line_length, cast(80 as bigint) as max_line_length,
        cast(case when doc_id % 19 = 0 then 0.1 else 0.6 end as double) as alphanum_fraction,
        case when doc_id % 6 = 0 then null else {path} end as max_stars_repo_path,
        concat('r/', cast(doc_id % 3 as string)) as max_stars_repo_name, {lic} as max_stars_repo_licenses,
        '  ' as max_issues_repo_path,
        case when doc_id % 12 = 0 then null else concat(' alt/', {path}, ' ') end as max_forks_repo_path,
        case when doc_id % 15 = 0 then {d.array("'ISC'")} else {d.no_text()} end as max_issues_repo_licenses,
        case when doc_id % 10 = 0 then {d.array("'  '")} else {d.no_text()} end as max_forks_repo_licenses
        from {d.table('documents')}"""


WORKFLOWS = (
    '{"steps": [{"step_id": 1, "tool": "scale", "params": {"deployment": "web", "replicas": 3}}]}',
    '{"steps": [{"step_id": "x", "tool": "scale", "params": {}}]}',
    '{"steps": [{"step_id": 2, "tool": "restart", "params": {"pod": "p", "extra": 1}}]}',
    '{"steps": []}',
    'no json',
)


def _prompts(d: Dialect) -> str:
    flow = pick("conv_id % 5", [f"'{w}'" for w in WORKFLOWS], "''")
    return f"""select conv_id as id, case when conv_id % 9 = 0 then '' else text end as user_intent,
        '["scale", "restart"]' as tool_context, {flow} as workflow_json
        from (select *, row_number() over (partition by conv_id order by turn) as nth from {d.table('conversations')} where role = 'user') as u where nth = 1"""


def _ledger(d: Dialect) -> str:
    return f"select distinct conv_id as id from {d.table('conversations')} where conv_id % 3 = 0"


VIEWS: dict[str, tuple[tuple[str, ...], Callable[[Dialect], str]]] = {
    "usage": ((), _usage),
    "batch_task": ((), _batch_task),
    "server_event": ((), _server_event),
    "log_base": ((), _log_base),
    "templates": (("log_base",), _templates),
    "qa_pairs": ((), _qa_pairs),
    "question_posts": (("qa_pairs",), _question_posts),
    "answer_posts": (("qa_pairs",), _answer_posts),
    "html_posts": ((), _html_posts),
    "chats": ((), _chats),
    "messages": ((), _messages),
    "code_files": ((), _code_files),
    "prompts": ((), _prompts),
    "ledger": ((), _ledger),
}


def _closure(name: str, seen: list[str]) -> list[str]:
    for dep in VIEWS[name][0]:
        _closure(dep, seen)
    if name not in seen:
        seen.append(name)
    return seen


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    d = Dialect("spark", sf_dir)
    names = _closure(name, [])
    if len(names) == 1:  # one scan under a projection, as a user's own table would be
        return spark.sql(VIEWS[name][1](d))
    ctes = ",\n".join(f"{n} as ({VIEWS[n][1](d)})" for n in names)
    return spark.sql(f"with {ctes} select * from {name}")


def raw_logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables with the columns of their systems."""
    base = view(spark, sf_dir, "log_base")
    common = ["line_id as LineId", "component as Component", "sentence as Content", "eid as EventId",
              "sentence as EventTemplate"]
    own = {
        "linux": ["mon as Month", "dom as Date", "hms as Time", "lvl as Level", "pid as PID"],
        "hpc": ["case when k % 5 = 0 then '  ' else concat('L', line_id) end as LogId", "node as Node",
                "state as State", "flag as Flag", "cast(epoch_s as string) as Time"],
        "hdfs": ["ymd6 as Date", "hms6 as Time", "lvl as Level", "pid as Pid"],
        "hadoop": ["iso as Date", "hmsms as Time", "concat(' ', lower(lvl), ' ') as Level", "'main' as Process"],
        "spark": ["slashed as Date", "hms as Time", "lvl as Level"],
    }
    return {s: base.where(f"system = '{s}'").selectExpr(*common, *cols) for s, cols in own.items()}
