"""Column functions on small cases, against Python where Python is the model."""

import html
import json
import random
import re
import time

import numpy as np
import pytest
import yaml
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import chats as ch
from opsgrain.functions import code as cd
from opsgrain.functions import core
from opsgrain.functions import logs as lg
from opsgrain.functions import telemetry as tok
from opsgrain.functions import text as tx
from opsgrain.functions.workflow import valid_workflow


def run(spark, values, fn, kind="string"):
    """fn over one column ``v``; results in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", fn("v").alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def test_bin_token(spark):
    texts = ["0", "9.99", "10", "95", "100", "250", "-5", "abc", None, "nan", "inf", "-inf", " 42 ", "1e1", "1f"]
    assert run(spark, texts, lambda c: tok.bin_token(c, 100)) == [
        100, 100, 101, 109, 109, 109, 99, 104, 104, 104, 104, 104, 104, 101, 104]
    numbers = [0.0, 69.99, 70.0, 490.0, -0.5, None, float("nan"), float("inf")]
    assert run(spark, numbers, tok.mem_token, "double") == [200, 206, 207, 209, 199, 204, 204, 204]


def test_codes_and_labels(spark):
    assert run(spark, ["Failed", "failed", "Other", None], tok.status_token) == [301, 304, 304, 304]
    assert run(spark, ["ADD", "Failure", "reboot", None], tok.event_token) == [400, 402, 403, 403]
    rows = spark.createDataFrame([("Failed", 103, 200), ("Failed", 104, 200), ("Terminated", 109, 207),
                                  ("Terminated", 100, 206), ("Waiting", 100, 200), ("Running", 100, 209)], "s string, c int, m int")
    got = rows.select(tok.job_label(F.col("s"), F.col("c"), F.col("m")).alias("r")).collect()
    assert [r.r for r in got] == [2, 4, 1, 0, 4, 0]


def test_severity(spark):
    low = lambda c: lg.lowered(c)
    assert run(spark, ["Failed password for x", "session timed out", "all good", None],
               lambda c: lg.severity_by_keywords(low(c))) == ["ERROR", "WARN", "INFO", "INFO"]
    df = spark.createDataFrame([(" fatal ", "x"), ("Warning", "x"), ("debug", "error"), ("notice", "block corrupt"),
                                ("", "slow disk"), (None, "fine")], "l string, m string")
    got = df.select(lg.severity_by_level("l", lg.lowered("m"), rules.HDFS_ERROR_KEYWORDS, rules.HDFS_WARN_KEYWORDS).alias("r"))
    assert [r.r for r in got.collect()] == ["ERROR", "WARN", "INFO", "ERROR", "WARN", "INFO"]


def test_event_type_order_and_class(spark):
    texts = ["authentication failure; permission denied", "disk failure", "oom killed", "task failed", "plain failure", "ok"]
    kinds = run(spark, texts, lambda c: lg.event_type(lg.lowered(c), F.lit("INFO")))
    assert kinds == ["auth_failure", "storage_unavailable", "compute_oom", "executor_failure", "job_failed", "normal_ops"]
    assert run(spark, ["ok"], lambda c: lg.event_type(lg.lowered(c), F.lit("WARN"))) == ["unknown"]
    assert run(spark, ["host unreachable", "CHECKSUM bad", "x"], lambda c: lg.event_class(F.lit("auth_failure"), c)) == [3, 4, 5]


BUCKETS = [  # text, then its bucket for hpc, hdfs and the others
    ("2015-10-18 18:01:47,978", "2015-10", "2015-10-18 18:0", "2015-10-18 18:01"), ("17/06/09 20:10:40", "17/06/0", "17/06/09 20:1", "17/06/09 20:10"),
    ("081109 203615", "081109 ", "081109 2036", "081109 203615"), ("Jun 14 15:16:01", "Jun 14 ", "Jun 14 15", "Jun 14 15:16"),
    ("1077804742", "1077804", "107780474", "1077804742"), ("081109", "081109", "081109", "081109"), ("a b c", "a b c", "a b c", "a b c"),
    ("x 18:01,5", "x 18:01", "x 18:0", "x 18:01.5"), ("x 18", "x 18", "x 18", "x 18"), ("123", "123", "123", "123"), ("", "", "", ""),
    (" 17/06/09 20:10:40 ", "17/06/0", "17/06/09 20:1", "17/06/09 20:10"), ("081109\t203615", "081109\t", "081109 2036", "081109\t203"),
    ("d 1:2:3:4", "d 1:2:3", "d 1:2:", "d 1:2"),
]


@pytest.mark.parametrize("system, place", [("hpc", 1), ("hdfs", 2), ("spark", 3)])
def test_time_bucket(spark, system, place):
    got = run(spark, [case[0] for case in BUCKETS], lambda c: lg.time_bucket(c, F.lit(system)))
    assert got == [case[place] for case in BUCKETS]


def test_parse_event_ts(spark):
    texts = ["1077804742", "Jun 14 15:16:01", "Jun  4 15:16:01", "081109 203615", "2015-10-18 18:01:47,978", "17/06/09 20:10:40",
             "690101 000000", "2015-13-18 18:01:47", "junk", "", None, "Foo 14 15:16:01"]
    got = run(spark, texts, lambda c: lg.parse_event_ts(c).cast("string"))
    assert got == ["2004-02-26 14:12:22", "1900-06-14 15:16:01", "1900-06-04 15:16:01", "2008-11-09 20:36:15", "2015-10-18 18:01:47.978",
                   "2017-06-09 20:10:40", "1969-01-01 00:00:00", None, None, None, None, None]


SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0  　​"


def test_whitespace_like_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab.!?" + SPACES) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    assert run(spark, texts, core.normalize_whitespace) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert run(spark, texts, core.word_count) == [len(t.split()) for t in texts]
    assert run(spark, texts, core.strip) == [t.strip() for t in texts]


def test_clean_text_and_metrics(spark):
    texts = ["see http://a.b/c?d=1 now  ", "`x` and ```y\nz``` end.", None, "", "https://é.com/ü next", "no `open tick"]
    assert run(spark, texts, tx.clean_text) == ["see [URL] now", "`x` and ```y z``` end.", "", "", "[URL] next", "no `open tick"]
    assert run(spark, texts, lambda c: tx.clean_text(c, remove_code=True))[1] == "and end."
    m = run(spark, ["One. Two!? `c` ```d```", ""], tx.text_metrics)
    assert tuple(m[0]) == (22, 4, 2, 2) and tuple(m[1]) == (0, 0, 0, 0)


def test_clean_html(spark):
    texts = ["<p>a &amp;lt; b</p>", "x&nbsp;y &eacute; &#233; &copy; <br/>z", None, "plain", "&ltb &notin;"]
    want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", t or ""))).strip() for t in texts]
    assert run(spark, texts, tx.clean_html) == want


def test_signatures_and_types(spark):
    texts = ["Pod in CrashLoopBackOff, room 4015", "CUDA out of memory, OutOfMemory", "quiet"]
    low = lambda c: F.lower(c)
    assert run(spark, texts, lambda c: tx.error_signatures(low(c))) == [
        ["CrashLoopBackOff", "OOMKilled", "PermissionDenied"], ["OOMKilled", "GPUError"], []]
    assert run(spark, ["How do I", "why is it", "what are", "debug it", "it crashed", "should i", "hm"],
               lambda c: tx.question_type(F.lower(c))) == [
        "how_to", "explanation", "definition", "troubleshooting", "error_resolution", "best_practice", "general"]


JSON_CASES = ['{"a": 1}', "[1, 2] x", '{"a": NaN}', "{'a': 1}", '"x"', '{"a": 1', ' {"b": [1]} ', '{"a": 1}} x', "[1]] x", '{"it": "can\'t"}',
              "tru", "true", "null", "-1.5e3", "[1,]", "", "  ", '{"a" 1}', '{"a": 1, "a": 2}', "Infinity", "-Infinity", "-NaN", '["NaN, Infinity"]',
              "01", "1 2", '"a\nb"', '"\\u12"', "[]", "{}", '{"a": [{}]}', "nan", "[1 2]", '{"a": 1}, {"b": 2}',
              '{"a": "it\'s", "a": 2}', '{\n"a": 1,\n"a": "x"\n}', '{"a": "it\'s"} x', "{\"a\": 'x'}", "['x']", '{"a": "\x01"}', '{"a":\x0b1}', '"\\\n"',
              '"' + "\\n" * 40_000 + '"', '"unclosed', '{"a": "b"c"}', '[' + '"it\'s", ' * 100_000 + '"end"]', '"\\\\"', '"\\\\\\"', '"a" \'b\'']


def test_json_valid_like_python(spark):
    def ok(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False
    assert run(spark, JSON_CASES, core.json_valid) == [ok(t) for t in JSON_CASES]
    assert run(spark, [None], core.json_valid) == [False]


def test_json_text_and_object(spark):
    texts = ['a"b\\c\n\té', "", "x/y", "\x01"]
    got = run(spark, texts, core.json_text)
    assert [json.loads(g) for g in got] == texts and run(spark, [None], core.json_text) == ["null"]
    assert run(spark, ['p"'], lambda c: core.json_object(pid=c, level_raw=c)) == [json.dumps({"pid": 'p"', "level_raw": 'p"'})]


def test_hash_sample(spark):
    import hashlib
    ids = [str(i) for i in range(2000)]
    got = run(spark, ids, lambda c: core.md5_mod(F.concat(F.lit("linux:"), c), 100))
    assert got == [int(hashlib.md5(f"linux:{i}".encode()).hexdigest(), 16) % 100 for i in ids]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=200))
def test_rounding_like_python(spark, values):
    values = values + [2.675, 0.03125, 1.005, -2.5, 0.125, 99.995]
    for d in (1, 2, 4):
        assert run(spark, values, lambda c: core.py_round(c, d), "double") == [round(v, d) for v in values]
        assert run(spark, values, lambda c: core.np_round(c, d), "double") == [float(np.round(v, d)) for v in values]


def test_function_calls(spark):
    end = "<|endoftext|>"
    texts = [
        f"USER: hi ASSISTANT: <functioncall> {{\"name\": \"f\", \"arguments\": '{{\"a\": 1}}'}} {end}",
        f"<functioncall> {{\"name\": \"g\", \"arguments\": {{\"a\": 1, \"b\": 2, \"c\": 3}}}} {end} <functioncall> {{\"name\": \"h\"}}",
        f"<functioncall> {{\"name\": {{oops}} {end}", "nothing",
        f"<functioncall> {{\"name\": \"s\", \"arguments\": \"text\"}} {end}",
    ]
    got = run(spark, texts, ch.function_calls)
    assert [[(c.name, c.arguments, c.malformed) for c in r] for r in got] == [
        [("f", '{"a":1}', False)], [("g", '{"a":1,"b":2,"c":3}', False), ("h", None, False)], [(None, None, True)], [],
        [("s", '"text"', False)]]
    tiers = run(spark, texts, lambda c: ch.call_complexity(ch.function_calls(c)))
    assert tiers == ["simple", "complex", "malformed", "none", "moderate"]


def test_signatures(spark):
    one = 'Use {"name": "f", "description": "d", "parameters": {"properties": {"b": {}, "a": {}}, "required": ["b"]}} ok'
    got = run(spark, [one, "no", '{"name": "f"} {"name": "g"}', '{"x": 1}', '{"name": "n"}', None], ch.function_signatures)
    assert {k: tuple(v) for k, v in got[0].items()} == {"f": ("d", ["b", "a"], ["b"])}
    assert got[1:4] == [{}, {}, {}] and {k: tuple(v) for k, v in got[4].items()} == {"n": ("", [], [])} and got[5] == {}


def test_buckets(spark):
    assert run(spark, [0, 1, 2, 3, 4, 5, 6, 100, 101], ch.turn_bucket, "int") == [
        None, "single", "short", "short", "medium", "medium", "long", "long", "long"]
    assert run(spark, [-1, 0, 1, 2, 3, 101], ch.call_bucket, "int") == [None, "no_calls", "one_call", "two_calls", "many_calls", "many_calls"]


def py_redact(text):
    text = re.sub(rules.PII_IPV4, "IPV4_REDACTED", text)
    text = re.sub(rules.PII_API_KEY, "sk-REDACTED", text)
    text = re.sub(rules.PII_EMAIL, "EMAIL_REDACTED", text)
    return re.sub(rules.PII_CREDS, r"\1: REDACTED", text, flags=re.I)


def test_redact_like_python(spark):
    texts = ["ip 10.0.0.1, 999.1.1.1 v1.2.3", "sk-" + "a" * 20 + " sk-short", "mail a.b@c.de,x@y.z /no@path.com réé@é.fr", "Password = hunter2 TOKEN:abc",
             "api_key:\n v secret=", "a@b.c d.e@f.g", "1.2.3.4.5", "é1.2.3.4", "PAſſWORD: x", "two@a.bb;three@c.dd", "", "paßword: x token : y"]
    assert run(spark, texts, cd.redact) == [py_redact(t) for t in texts]


def test_prompt_and_wrap(spark):
    paths = ["k8s/My-deploy_app.yaml", "a/web.YML", "", None, "x/y/gpu--train.yaml", "secret"]
    assert run(spark, paths, cd.synthesize_prompt) == [
        "Deploy the My deploy app configuration", "Apply the following Kubernetes manifest for web",
        "Apply the following Kubernetes manifest for manifest", "Apply the following Kubernetes manifest for manifest",
        "Provision a GPU workload for gpu train", "Apply the secret secret manifest"]
    texts = ['a: "b"\n\\x é', "tab\t/"]
    assert run(spark, texts, cd.wrap_tool_call) == [
        json.dumps({"tool": "apply_manifest", "params": {"manifest_content": t}}, ensure_ascii=False) for t in texts]


def test_leaks_of_long_words(spark):
    texts = ["", None, "a@b.c", "@b.c", "x@.c", "a@b.", "a@b-1.-", "é@b.c", "e+@b..", "1.2.3.4", "1234.5.6.7890", "1.2.3.", "٣.٣.٣.٣", "sk-" + "a" * 20,
             "sk-" + "a" * 19, "sk-x sk-" + "B" * 25 + " q@r.s 9.9.9.9", "a @b.c", "a@b@c.d"]
    want = [None if t is None else [n for n, p in rules.LEAK_PATTERNS if re.search(p, t)] for t in texts]
    got = run(spark, texts, cd.pii_leaks)
    assert [g or [] for g in got] == [w or [] for w in want]
    assert set(rules.LEAK_TESTS) == {n for n, _ in rules.LEAK_PATTERNS}
    began = time.time()
    assert run(spark, ["a" * 300_000, "a" * 300_000 + " x@y.z"], cd.pii_leaks) == [[], ["email"]]
    assert time.time() - began < 10  # 45 billion steps with the pattern as it is written


def test_yaml_valid(spark):
    texts = ["a: 1", "a: [1", "a: 1\n---\nb: 2", "", "d: 2001-99-99", "- x\n- y", None, "\tbad: tab"]

    def ok(t):
        try:
            yaml.safe_load(t)
            return True
        except Exception:
            return False
    assert run(spark, texts, cd.yaml_valid) == [None if t is None else ok(t) for t in texts]


def test_classes(spark):
    assert run(spark, [999, 1000, 9999, 10000, 100000], cd.size_bucket, "int") == ["<1KB", "1-10KB", "1-10KB", "10-100KB", ">100KB"]
    heads = ["kind:  Deployment", "kind: Service", "apiVersion", 'resource "x"', "terraform {", "x" * 2000 + "kserve", "seldon kserve"]
    assert run(spark, heads, cd.iac_type) == ["k8s_workload", "k8s_config", "k8s_other", "terraform", "terraform", "kserve", "kserve"]
    assert run(spark, heads, lambda c: cd.iac_type(c, head=2000))[5] == "other"
    assert run(spark, [["GPL"], [], None, [" MIT ", "isc"]], cd.license_class, "array<string>") == ["other", "unknown", "unknown", "mit"]


def test_workflow(spark):
    docs = ['{"steps": []}', '{"steps": [{"step_id": 1, "tool": "t", "params": {}}]}', '{"steps": [{"step_id": "7", "tool": "t", "params": {"pod": null}}], "x": 1}',
            '{"steps": [{"step_id": 1.5, "tool": "t", "params": {}}]}', '{"steps": [{"step_id": 1, "tool": 5, "params": {}}]}',
            '{"steps": [{"step_id": 1, "tool": "t", "params": {"other": 1}}]}', '{"steps": [{"step_id": 1, "tool": "t"}]}', '{"steps": {}}', "[]", "bad", None,
            '{"steps": [{"step_id": 1, "tool": "t", "params": {"replicas": "x"}}]}', '{"steps": [{"step_id": 1, "tool": "t", "params": {"replicas": 2, "deployment": "d"}}]}']
    assert run(spark, docs, valid_workflow) == [True, True, True, False, False, False, False, False, False, False, False, False, True]
