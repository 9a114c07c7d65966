"""Winner rows by locator, validation while writing."""

import os

import pytest
from pyspark.sql import functions as F

from opsgrain.operators import quality, winners
from opsgrain.sources import sinks

ROWS = [(k, o, f"text {k} {o} {i}" * 20, i) for i, (k, o) in enumerate(
    [("a", 2), ("a", 1), ("a", None), ("b", None), (None, 5), (None, 3), ("c", 7), ("c", 7), ("c", 8)] + [("hot", i % 50) for i in range(400)])]


@pytest.fixture
def stored(spark, tmp_path):
    rows = ROWS + [("twin", 1, "same", 1)] * 3
    spark.createDataFrame(rows, "k string, o int, text string, i int").repartition(4).write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def _brute(last=False):
    best = {}
    for k, o, _, _ in ROWS + [("twin", 1, "same", 1)]:
        held = best.get(k, None)
        if k not in best or held is None or (o is not None and (o > held if last else o < held)):
            best[k] = o
    return best


@pytest.mark.parametrize("last", [False, True])
def test_first_rows(stored, last):
    for df in (stored, stored.where("i >= 0").select("*"), stored.repartition(3), stored.unionByName(stored.limit(0))):
        out = winners.first_rows(df, ["k"], "o", last=last)
        assert out.columns == df.columns
        got = [(r.k, r.o) for r in out.collect()]
        assert sorted(got, key=repr) == sorted(_brute(last).items(), key=repr)
        assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in stored.collect()}


def test_ties_do_not_depend_on_layout(stored):
    chosen = [{r.k: r.i for r in winners.first_rows(stored.repartition(n), ["k"], "o").collect()} for n in (1, 2, 5)]
    assert chosen[0] == chosen[1] == chosen[2] == {r.k: r.i for r in winners.first_rows(stored, ["k"], "o").collect()}


def test_texts_stay_out_of_buffers(stored):
    plan = winners.first_rows(stored, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan and "LeftSemi" in plan


def test_one_stored_row_may_be_several_rows(stored):
    many = stored.where("k = 'c'").select("k", F.explode(F.array(F.col("o"), F.col("o") - 5)).alias("o"), "i")
    assert not winners._keeps_rows(many) and winners._keeps_rows(stored.where("i > 3").select("k"))
    assert [(r.k, r.o) for r in winners.first_rows(many, ["k"], "o").collect()] == [("c", 2)]


def test_other_formats_and_names(spark, stored, tmp_path):
    stored.select("k", "o").write.json(f"{tmp_path}/j")
    lines = spark.read.schema("k string, o int").json(f"{tmp_path}/j")
    assert sorted([tuple(r) for r in winners.first_rows(lines, ["k"], "o").collect()], key=repr) == sorted(_brute().items(), key=repr)
    clash = stored.withColumnsRenamed({"i": "_at", "text": "a.b"}).withColumn("_k0", F.lit(1)).withColumn("_o", F.lit(2))
    assert winners.first_rows(clash, ["k"], "o").columns == clash.columns
    assert winners.first_rows(clash, ["k"], "o").count() == len(_brute())
    with pytest.raises(ValueError):
        winners.first_rows(stored.withColumn("_metadata", F.lit(1)), ["k"], "o")
    assert winners.first_rows(stored.limit(0), ["k"], "o").collect() == []
    assert [r.k for r in winners.first_rows(stored, ["k"], "o", limit=2).orderBy("o").collect()] == ["hot", "a"]


@pytest.fixture
def suite_checks(spark):
    return [*quality.expect_row_count(lo=1, hi=1000), *quality.expect_between("o", 0, 99), quality.expect_unique("i"), *quality.expect_not_null(["text"])]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_write_validated(spark, stored, suite_checks, tmp_path):
    path = f"{tmp_path}/out"
    valid, suite = sinks.write_validated(stored.where("k <> 'twin'"), suite_checks, path)
    assert valid and _rows(suite) == _rows(quality.check_suite(stored.where("k <> 'twin'"), suite_checks))
    before = _rows(spark.read.parquet(path).select("i"))
    assert len(before) == 407
    valid, suite = sinks.write_validated(stored, suite_checks, path, mode="overwrite")  # the twins fail the unique check
    assert not valid and _rows(suite) == _rows(quality.check_suite(stored, suite_checks))
    assert _rows(spark.read.parquet(path).select("i")) == before
    assert sinks.write_validated(stored.where("i < 3"), suite_checks[:3], path, mode="overwrite")[0]
    assert spark.read.parquet(path).count() == stored.where("i < 3").count()
    with pytest.raises(FileExistsError):
        sinks.write_validated(stored, suite_checks, path)
    with pytest.raises(ValueError):
        sinks.write_validated(stored, suite_checks, path, mode="append")
    assert sorted(n for n in os.listdir(tmp_path) if not n.startswith("t")) == ["out"]


def test_failed_write_leaves_nothing(spark, stored, suite_checks, tmp_path):
    broken = stored.withColumn("x", F.when(F.col("i") == 5, F.raise_error(F.lit("no"))).otherwise(F.lit("y")))
    with pytest.raises(Exception, match="no"):
        sinks.write_validated(broken, suite_checks, f"{tmp_path}/out")
    assert [n for n in os.listdir(tmp_path) if "out" in n] == []
    valid, suite = sinks.write_validated(stored.limit(0), suite_checks[3:], f"{tmp_path}/out")
    assert valid and spark.read.parquet(f"{tmp_path}/out").count() == 0


def test_input_is_read_once(spark, stored, suite_checks, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        reads.add(1)
        yield from batches

    passed = stored.coalesce(1).mapInArrow(count, stored.schema)
    sinks.write_validated(passed, suite_checks, f"{tmp_path}/out")
    assert reads.value == 1
