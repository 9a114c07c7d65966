"""Operators against brute force on small fixtures: exactness, skew, partition independence."""

import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import logs as lg
from opsgrain.functions import telemetry as tok
from opsgrain.operators import code, combine, generated, ordering, profile, quality, sampling
from opsgrain.operators.quantiles import exact_quantiles, quantile, upper_median
from opsgrain.plans import jobs
from opsgrain.session import attach_row, scratch_dir
from opsgrain.sources import ledger, readers, sinks


def skewed(n=900, seed=5):
    """A third of the rows share one group and one value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append((i, "hot" if hot else rng.choice("abc"), 7.0 if hot and i % 2 else rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-4, 6)))
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quantiles(spark, parts):
    rows = skewed()
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(parts)
    got = {r.g: r for r in exact_quantiles(df, "v", {"q1": quantile(0.25), "m": quantile(0.5), "q9": quantile(0.9), "u": upper_median}, ["g"]).collect()}
    for g in ("hot", "a", "b", "c"):
        values = sorted(v for _, k, v in rows if k == g)
        want = np.quantile(values, [0.25, 0.5, 0.9])
        assert np.allclose([got[g].q1, got[g].m, got[g].q9], want, rtol=1e-12, atol=0)
        assert got[g].u == values[len(values) // 2]


def test_exact_quantiles_of_narrow_ranges(spark):
    """Many different values in a small range, large or tiny: the last step still orders only a few of them."""
    rng = random.Random(4)
    day = sorted({1_700_000_000 + rng.random() * 86_400 for _ in range(20_000)})
    tiny = sorted({rng.random() ** 40 * 1e-3 for _ in range(20_000)})
    rows = [("day", v) for v in day] + [("tiny", v) for v in tiny] + [("signs", v) for v in (-1e300, -2.0, -1e-300, 0.0, 1e-300, 2.0, float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double")
    spots = {"q1": quantile(0.25), "m": quantile(0.5), "q9": quantile(0.9), "u": upper_median}
    got = {r.g: r for r in exact_quantiles(df, "v", spots, ["g"]).collect()}
    for g, values in (("day", day), ("tiny", tiny)):
        assert np.allclose([got[g].q1, got[g].m, got[g].q9], np.quantile(values, [0.25, 0.5, 0.9]), rtol=1e-15)
        assert got[g].u == values[len(values) // 2]
    assert (got["signs"].m, got["signs"].q1) == (0.0, -1.0)


def test_exact_quantiles_ignores_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert exact_quantiles(df, "v", {"m": quantile(0.5)}).first().m == 2.0
    assert exact_quantiles(df.where("v > 9 and not isnan(v)"), "v", {"m": quantile(0.5)}).count() == 0


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_global_index(spark, parts):
    rows = [(i % 3, (i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, id int").repartition(parts)
    got = {r.id: r.row_index for r in ordering.with_global_index(df, ["a", "b"], partitions=parts).collect()}
    want = {r[2]: i for i, r in enumerate(sorted(rows))}
    assert got == want


@pytest.mark.parametrize("parts", [1, 6])
def test_count_windows(spark, parts):
    rng = random.Random(1)
    rows = [(rng.randint(0, 20), f"m{i}", rng.choice([rng.random() * 120, None]), rng.random() * 100) for i in range(103)]
    df = spark.createDataFrame(rows, "time_stamp bigint, machine_id string, cpu_util_percent double, mem_util_percent double").repartition(parts)
    got = [tuple(r) for r in ordering.count_windows(df, partitions=parts).orderBy("window_index").collect()]
    bins = lambda v, base: base + 4 if v is None else base + min(int(v // 10), 9)
    ordered = sorted(rows, key=lambda r: (r[0], r[1]))
    want = []
    for w in range(len(rows) // 5):
        block = ordered[w * 5:w * 5 + 5]
        tokens = [t for r in block for t in (bins(r[2], 100), bins(r[3], 200))]
        want.append((w, tokens, int(tokens[-1] >= 207)))
    assert got == want


@pytest.mark.parametrize("parts", [1, 6])
def test_time_windows_hot_minute(spark, parts):
    rows = []
    for i in range(1500):
        minute = 0 if i % 3 else i % 50
        rows.append(("hot" if i % 3 else "cold", f"2024-01-01 00:{minute:02d}:{i % 60:02d}", str(i), i % 90, 3 if i == 1 else i % 2))
    df = spark.createDataFrame(rows, "system string, t string, raw_id string, event_int int, event_class int") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz")).repartition(parts)
    got = {(r.system, str(r.window_start)): (r.sequence_ids, r.label) for r in ordering.time_windows(df, "1 minute", 100).collect()}
    groups = defaultdict(list)
    for s, t, rid, n, c in rows:
        groups[s, t[:17] + "00"].append((t, int(rid), n, c))
    want = {k: ([n for _, _, n, _ in sorted(v)][-100:], max(c for *_, c in v)) for k, v in groups.items()}
    assert got == want
    plan = ordering.time_windows(df, "1 minute", 100)._jdf.queryExecution().executedPlan().toString()
    if parts > 1:
        assert plan.count("WindowGroupLimit") == 2  # the limit also runs before the shuffle
    else:  # the rows already are in one place: nothing is shuffled, and the limit is there
        at = plan.index("WindowGroupLimit")
        assert "hashpartitioning" not in plan[at:plan.index("Scan ExistingRDD", at)]
    # beyond the threshold of Spark's own limit, parts of the window are cut first
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "99")
    try:
        assert {(r.system, str(r.window_start)): (r.sequence_ids, r.label) for r in ordering.time_windows(df, "1 minute", 100).collect()} == want
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_pad_or_truncate(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), ([1, 2, 3, 4, 5],)], "a array<int>")
    assert [r.p for r in df.select(ordering.pad_or_truncate("a", 4).alias("p")).collect()] == [[1, 2, 3, 0], [0, 0, 0, 0], [2, 3, 4, 5]]


def balanced_input(spark, counts, parts):
    rows = [(f"{label}-{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "id string, label int").repartition(parts), rows


@pytest.mark.parametrize("counts", [{0: 600, 1: 50, 2: 20, 4: 1}, {0: 60, 3: 50}, {0: 40}, {1: 10, 2: 30}])
def test_balance_classes(spark, counts):
    df, rows = balanced_input(spark, counts, 1)
    got = sampling.balance_classes(df, ["id"]).collect()
    failures = [n for label, n in counts.items() if label]
    target = max(failures) if failures else None
    want = {label: (n if target is None else min(n, 3 * target)) if label == 0 else target for label, n in counts.items()}
    assert Counter(r.label for r in got) == want
    assert {(r.id, r.label) for r in got} <= set(rows)
    assert len({(r.id, r.copy) for r in got}) == len(got)
    assert all(r.copy == 0 for r in got if counts[r.label] >= want[r.label])
    other, _ = balanced_input(spark, counts, 8)
    again = sampling.balance_classes(other, ["id"]).collect()
    assert sorted((r.id, r.copy) for r in got) == sorted((r.id, r.copy) for r in again)


def test_draws_cover_the_class(spark):
    df, _ = balanced_input(spark, {1: 1000, 2: 50}, 4)
    got = Counter(r.id for r in sampling.balance_classes(df, ["id"]).where("label = 2").collect())
    assert len(got) == 50 and sum(got.values()) == 1000 and max(got.values()) < 60


@pytest.mark.parametrize("n,ratio", [(1000, 0.2), (7, 0.2), (1, 0.2), (333, 0.5), (40, 0.0), (40, 1.0)])
def test_train_test_split(spark, n, ratio):
    df = spark.range(n).repartition(3)
    got = {r.id: r.split for r in sampling.train_test_split(df, ["id"], ratio).collect()}
    assert len(got) == n and sum(s == "train" for s in got.values()) == int(n * (1 - ratio))
    again = {r.id: r.split for r in sampling.train_test_split(spark.range(n).coalesce(1), ["id"], ratio).collect()}
    assert got == again


def test_capped_downsample(spark):
    df = spark.range(4000).withColumn("kind", F.when(F.col("id") % 10 < 8, "big").otherwise("small"))
    got = sampling.capped_downsample(df, "kind", ["id"]).collect()
    counts = Counter(r.kind for r in got)
    assert counts["small"] == 800 and abs(counts["big"] - 1600) < 120
    assert {(r.kind, r.sampling_weight) for r in got} == {("big", 0.5), ("small", 1.0)}


def test_oversample_slices(spark):
    rows = [(i, ["rare"] if i < 4 else ["common"], [], ["x"] if i < 12 else []) for i in range(100)]
    df = spark.createDataFrame(rows, "question_id int, tags array<string>, error_signatures array<string>, infra_components array<string>")
    advice = spark.createDataFrame([("tags", "rare", "data_augmentation", "high", 1), ("infra_components", "x", "data_augmentation", "high", 2),
                                    ("tags", "common", "data_augmentation", "high", 3), ("tags", "x", "data_augmentation", "medium", 0)],
                                   "dimension string, value string, strategy string, priority string, position int")
    got = sampling.oversample_slices(df, advice, ["question_id"], max_slices=3, most_draws=100).collect()
    assert Counter(r.drawn_for for r in got) == {None: 100, "tags=rare": 8, "infra_components=x": 24}
    assert all(r.question_id < 4 for r in got if r.drawn_for == "tags=rare")


def test_dedup_and_topk(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string").repartition(5)
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    assert {r.k: r.id for r in ordering.dedup_by_hash(df, "k", "id", None).collect()} == first
    assert sorted(r.id for r in ordering.dedup_by_hash(df, "k", "id", 5).collect()) == sorted(first.values())[:5]
    assert ordering.top_k_values(df, "k", 1).first().k == "hot"
    assert ordering.top_values_only(df, "k", 1).count() == 100


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup_of_ties_and_null_order(spark, parts):
    rows = [(1, "a", "x")] * 3 + [(2, "a", "w"), (5, "b", "x"), (5, "b", "y"), (None, "c", "x"), (None, "c", "x"), (None, "c", None), (4, "d", "x"),
            (None, "d", "x"), (3, None, "x"), (3, None, "x"), (None, None, "y")]
    df = spark.createDataFrame(rows, "id int, k string, v string").repartition(parts)
    out = ordering.dedup_by_hash(df, "k", "id")
    got = {r.k: (r.id, r.v) for r in out.collect()}
    assert out.columns == df.columns and out.count() == 5
    assert {k: i for k, (i, _) in got.items()} == {"a": 1, "b": 5, "c": None, "d": 4, None: 3}
    assert all((i, k, v) in rows for k, (i, v) in got.items())
    assert got == {r.k: (r.id, r.v) for r in ordering.dedup_by_hash(df.repartition(3), "k", "id").collect()}
    assert sorted(r.id for r in ordering.dedup_by_hash(df, "k", "id", 4).collect()) == [1, 3, 4, 5]  # null is last


def test_minmax_weight(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (2.0,)], "v double")
    assert sorted(r.sample_weight for r in ordering.minmax_weight(df, "v").collect()) == [0.5, 1.0, 1.5]
    assert ordering.minmax_weight(df.where("v = 1"), "v").first().sample_weight == 1.0


def test_attach_row_refuses_more_rows(spark):
    with pytest.raises(Exception):
        attach_row(spark.range(3), spark.range(2), "x").collect()


def test_profile_small(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, v int")
    assert {r.value: (r["count"], r.pct) for r in profile.value_distribution(df, "k").collect()} == {"a": (2, 50.0), "b": (1, 25.0)}
    assert tuple(profile.dataset_info(df).first()) == (4, 2, 1)
    assert {r["column"]: r.null_pct for r in profile.null_rates(df).collect()} == {"k": 25.0, "v": 25.0}
    assert profile.duplicate_ratio(df, "k").first().status == "failed"


def test_code_gate_reasons(spark):
    good = "apiVersion: v1\nkind: Job\nmetadata:\n  name: gpu\n"
    base = dict(content=good, ext="yaml", size=300, alphanum_fraction=0.5, hexsha="h", max_stars_repo_path="a/x.yaml", max_issues_repo_path=None,
                max_forks_repo_path=None, max_stars_repo_licenses=["MIT"], max_issues_repo_licenses=None, max_forks_repo_licenses=None)
    cases = [({}, "ok"), ({"content": ""}, "empty_content"), ({"content": None}, "empty_content"), ({"size": 199}, "too_small"), ({"size": None}, "too_small"),
             ({"size": 200}, "ok"), ({"size": 500001}, "too_large"), ({"alphanum_fraction": 0.24}, "low_alphanum"), ({"ext": "json"}, "bad_extension"),
             ({"ext": ""}, "ok"), ({"ext": "..YML"}, "ok"), ({"content": "x"}, "not_k8s"), ({"content": "apiVersion"}, "missing_kind"),
             ({"content": "apiVersion kind:"}, "missing_metadata"), ({"content": good + "x: [1"}, "invalid_yaml"), ({"max_stars_repo_licenses": None}, "missing_license"),
             ({"max_stars_repo_licenses": ["  ", "GPL"]}, "bad_license"), ({"max_stars_repo_licenses": ["GPL", " mit "]}, "ok"),
             ({"content": good.replace("gpu", "web")}, "not_ml_infra"), ({"content": good + "x: [1", "max_stars_repo_licenses": None}, "invalid_yaml")]
    schema = ("content string, ext string, size bigint, alphanum_fraction double, hexsha string, max_stars_repo_path string, max_issues_repo_path string, "
              "max_forks_repo_path string, max_stars_repo_licenses array<string>, max_issues_repo_licenses array<string>, max_forks_repo_licenses array<string>, i int")
    df = spark.createDataFrame([tuple({**base, **c}.values()) + (i,) for i, (c, _) in enumerate(cases)], schema)
    got = [r.status for r in code.code_gate(df).orderBy("i").collect()]
    assert got == [want for _, want in cases]
    record = code.code_records(df.where("i = 0")).first()
    assert json.loads(record.messages[1].content) == {"tool": "apply_manifest", "params": {"manifest_content": good}}
    assert record._meta.licenses == ["mit"] and record._meta.path == "a/x.yaml"


def test_code_yaml_checks_share_one_worker(spark, capsys):
    head = "apiVersion: v1\nkind: Job\nmetadata:\n  name: gpu\n"
    cases = [(head, "ok"), (head + "token: abc\n", "ok"), (head + "x: {token: a, b: c}\n", "invalid_yaml_post_redaction"), (head + "x: [1", "invalid_yaml"),
             (head.replace("gpu", "web") + "x: [1", "invalid_yaml"), (head.replace("gpu", "web"), "not_ml_infra"), (head + "x: [1\ntoken: a", "invalid_yaml"), (None, "empty_content")]
    files = spark.createDataFrame([(c, "yaml", 300, 0.5, str(i), "a/x.yaml", ["MIT"]) for i, (c, _) in enumerate(cases)],
                                  "content string, ext string, size bigint, alphanum_fraction double, hexsha string, max_stars_repo_path string, max_stars_repo_licenses array<string>")
    files = files.selectExpr("*", *[f"cast(null as string) as max_{k}_repo_path" for k in ("issues", "forks")], *[f"cast(null as array<string>) as max_{k}_repo_licenses" for k in ("issues", "forks")])
    done = code.process_code(files)
    assert [r.status for r in done.orderBy("hexsha").collect()] == [want for _, want in cases]
    loose = code.process_code(files, code.GateConfig(valid_yaml_only=False)).orderBy("hexsha").collect()
    broken = {"invalid_yaml": "invalid_yaml_post_redaction"}
    assert [r.status for r in loose] == [broken.get(want, want) if i != 4 else "not_ml_infra" for i, (_, want) in enumerate(cases)]
    capsys.readouterr()
    done.explain()
    # two nodes would be two Python workers per task, each with its own batches
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_draws_are_dealt_to_many_tasks(spark, capsys):
    rows = [(label, str(i)) for label, n in ((0, 50), (1, 40), (2, 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "label int, id string")
    plan = spark.createDataFrame([(1, 40, 1_250_000), (2, 7, 30)], "label int, size bigint, draws bigint")
    drawn = sampling.draw_with_replacement(sampling.with_class_index(df, "label", ["id"]), "label", plan)
    assert {r.label: r["count"] for r in drawn.groupBy("label").count().collect()} == {1: 1_250_000, 2: 30}
    capsys.readouterr()
    drawn.explain()
    # a number that is not given is cut down to one task, which then makes, hashes and counts all draws
    assert "RoundRobinPartitioning(4), REPARTITION_BY_NUM" in capsys.readouterr().out
    balanced = sampling.balance_classes(df, ["id"])
    balanced.explain()
    plan = capsys.readouterr().out
    # neither the rows nor the draws, which both grow with the input, are sent to every executor
    assert plan.count("SortMergeJoin [label") >= 1 and plan.count("REPARTITION_BY_NUM") == 4
    assert {r.label: r["count"] for r in balanced.groupBy("label").count().collect()} == {0: 50, 1: 40, 2: 40}


def test_sequence_and_chat_rules(spark):
    seqs = spark.createDataFrame([(1, [1], 0), (2, [], 5), (3, None, None), (4, [1, None], 1)], "id int, sequence_ids array<int>, label int")
    got = defaultdict(list)
    for r in generated.validate_sequences(seqs, "id").collect():
        got[r.id].append(r.error)
    assert dict(got) == {2: ["sequence_ids is empty", "invalid label 5"],
                         3: ["missing sequence_ids", "missing label", "sequence_ids is empty", "invalid label None"], 4: ["non-integer token"]}
    m = "array<struct<role string, content string>>"
    full = [("system", "s"), ("user", "u"), ("assistant", '{"a": 1}')]
    chats = spark.createDataFrame([(1, full), (2, full[:2]), (3, full[:2] + [("user", "x")]), (4, full[:2] + [("assistant", "bad")])], f"id int, messages {m}")
    assert {r.id for r in generated.validate_chats(chats, "id").collect()} == {2, 3}
    assert {(r.id, r.error) for r in generated.chat_anomalies(chats, "id").collect()} == {
        (2, generated.TOO_SHORT), (3, generated.NO_ROLE + "assistant"), (4, generated.NOT_JSON)}


def test_check_suite_and_verdict(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "  ")], "k int, t string")
    checks = [*quality.expect_not_null(["t"]), quality.expect_unique("k"), quality.expect_min_value("k", 2), *quality.expect_not_blank(["t"]),
              *quality.expect_between("k", 0, 5), *quality.expect_row_count(1)]
    rows = quality.check_suite(df, checks)
    assert {(r.check, r.status) for r in rows.collect()} == {("not_null", "failed"), ("unique", "failed"), ("min_value", "failed"), ("not_blank", "warning"),
                                                               ("min_in_range", "passed"), ("max_in_range", "passed"), ("min_row_count", "passed")}
    v = quality.verdict(rows).first()
    assert (v.total_checks, v.passed, v.failed, v.warnings, v.is_valid) == (6, 3, 3, 1, False)
    soft = quality.check_suite(df, [quality.expect_min_value("k", 2)])
    assert quality.verdict(soft).first().is_valid  # counts as failed, does not make the data invalid
    extra = quality.expect_columns(df, ["k", "z"], known=["k"]).collect()
    assert [(r.check, r.status) for r in extra] == [("columns", "failed"), ("extra_columns", "warning")]


def test_threshold_boundaries(spark):
    def report(**kw):
        return spark.createDataFrame([(k, float(v)) for k, v in kw.items()], "violation string, value double")
    flags = lambda df: {r.check: r.is_anomaly for r in quality.record_thresholds(df).collect()}
    assert not any(flags(report(total=10, valid=8, invalid=2, pass_rate_pct=80, x=0.025)).values())
    assert not any(flags(report(total=20_000_000, valid=16_000_000, invalid=4_000_000, pass_rate_pct=80, x=50_000)).values())
    bad = flags(report(total=9, pass_rate_pct=79.99, **{"pii_leaked:ipv4": 1, "x": 51}))
    assert all(bad.values())


def test_combine(spark):
    a = spark.createDataFrame([('{"a": 1}',), ("bad",), ("",), ('{}',), ('{"source_dataset": "old", "n": null}',), ("[1]",)], "value string")
    out = combine.combine_chats({"first": a, "second": a.limit(1)})
    docs = [json.loads(r.value) for r in out.collect()]
    assert sorted(d["source_dataset"] for d in docs) == ["first", "first", "first", "second"]
    assert {"n": None, "source_dataset": "first"} in docs
    with pytest.raises(FileNotFoundError):
        combine.combine_chats({})


def test_jsonl_and_arrays(spark):
    path = scratch_dir(spark)
    spark.createDataFrame([('{"a": 1}',), ("{bad",), ("  ",), ('{"a": 2} x',)], "value string").coalesce(1).write.text(path)
    assert [r.a for r in readers.read_jsonl(spark, path, "a int").collect()] == [1]
    with pytest.raises(Exception):
        readers.read_jsonl(spark, path, "a int", "fail").collect()
    folder = scratch_dir(spark)
    spark.createDataFrame([('[{"a": 1}, {"a": 2}]',)], "value string").coalesce(1).write.text(folder)
    assert sorted(r.a for r in readers.read_json_array(spark, folder, "a int").collect()) == [1, 2]


def test_staging(spark, monkeypatch):
    from opsgrain import session

    table = session.stage_table(spark.range(5))
    assert table.count() == 5
    session.drop_table(table)
    with pytest.raises(Exception):
        table.count()

    class Cluster:  # what a session on a cluster without a shared folder says
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster)


def test_inputs(spark, tmp_path):
    (tmp_path / "x").write_text("1")
    readers.require_inputs(spark, [str(tmp_path / "x")])
    with pytest.raises(FileNotFoundError, match="gone"):
        readers.require_inputs(spark, [str(tmp_path / "x"), str(tmp_path / "gone")])
    assert list(readers.optional_inputs(spark, {"a": str(tmp_path / "x"), "b": str(tmp_path / "no")})) == ["a"]
    with pytest.raises(FileNotFoundError):
        readers.optional_inputs(spark, {"b": str(tmp_path / "no")})


def test_ledger(spark):
    path = scratch_dir(spark)
    prompts = spark.range(6)
    ledger.reset(spark, path)
    read = lambda: ledger.read_ledger(spark, path)
    assert ledger.mark_processed(path, spark.range(0), prompts, read()) == 0
    assert ledger.mark_processed(path, spark.range(2, 4), prompts, read()) == 2
    assert ledger.mark_processed(path, spark.range(3, 9), prompts, read()) == 3
    assert sorted(r.id for r in ledger.unprocessed(prompts, read()).collect()) == [0, 1]
    ledger.reset(spark, path)
    assert ledger.unprocessed(prompts, read()).count() == 6


def test_alert_history(spark):
    old = spark.createDataFrame([(i, "a") for i in range(1200)], "ts int, k string")
    path = scratch_dir(spark)
    sinks.append_alerts(old, spark.createDataFrame([(5000, "b")], "ts int, k string"), path)
    kept = [r.ts for r in spark.read.schema("ts int, k string").json(path).collect()]
    assert len(kept) == 1000 and max(kept) == 5000 and min(kept) == 201


def test_stateless_operators_run_on_a_stream(spark):
    folder = scratch_dir(spark)
    spark.createDataFrame([("linux", "Jun 14 15:16:01", "failed password"), ("hpc", "1077804742", "ok")],
                          "system string, timestamp string, message string").write.parquet(folder)
    stream = spark.readStream.schema("system string, timestamp string, message string").parquet(folder)
    out = stream.select(lg.severity_by_keywords(lg.lowered("message")).alias("s"), lg.time_bucket("timestamp", "system").alias("b"),
                        tok.cpu_token(F.lit(55.0)).alias("c"))
    q = out.writeStream.format("memory").queryName("stateless").option("checkpointLocation", scratch_dir(spark)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.sql("select * from stateless").collect()} == {("ERROR", "Jun 14 15:16", 105), ("INFO", "1077804", 105)}


def test_qa_training_table(spark):
    body = "How do I fix the CrashLoopBackOff in my deployment " + "word " * 20
    rows = [(i + 1, f"t{i}", body, body + " `x`", ["kubernetes"], i % 7, i % 5, i * 100) for i in range(60)]
    pairs = spark.createDataFrame(rows, "question_id bigint, title string, question_body string, answer_body string, tags array<string>, "
                                        "score bigint, answer_score bigint, view_count bigint")
    out = jobs.qa_training_table(pairs).collect()
    assert Counter(r.split for r in out) == {"train": 48, "test": 12}
    assert [m.role for m in out[0].messages] == ["system", "user", "assistant"] and 0.5 <= out[0].metadata.sample_weight <= 1.5
    assert jobs.qa_training_table(pairs, layout="completion").columns == ["prompt", "completion", "metadata", "split"]


def test_rules_cover_each_other():
    assert set(rules.EVENT_CLASSES) == set(rules.EVENT_TYPES)
    assert {n for n, _ in rules.EVENT_TYPE_RULES} < set(rules.EVENT_TYPES)
