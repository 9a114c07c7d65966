"""Extra columns may have any name, those that an operator uses itself included, and come back unchanged."""

import pytest
from cases import documents, frame
from pyspark.sql import functions as F

import corpus_pipeline
from opsgrain.llm import filter_audit, line_dedup, lsh_forest, sharding

NAMES = ("n_lines", "n_widespread", "n_removed", "size", "shard", "slot", "p", "s", "parts", "rows", "start", "part", "prefix", "h2", "id", "n", "kept0", "kept",
         "copies", "fails", "digest", "before", "bit", "node", "sig", "root", "group", "chunk", "tree", "leaf", "first", "component_id", "n_shingles", "_c0", "key")


@pytest.fixture(scope="module")
def clashing(spark):
    return frame(spark).withColumns({n: F.xxhash64(F.lit(n), "doc_id") for n in NAMES}).persist()


def _unchanged(out, names=NAMES):
    wrong = " or ".join(f"`{n}` <> xxhash64('{n}', doc_id)" for n in names)
    return out.where(wrong).isEmpty()


def test_shard(clashing):
    out = sharding.shard(clashing, 3)
    assert out.columns == [*clashing.columns, "_size", "_shard", "_slot"]
    assert out.count() == len(documents()) and _unchanged(out)
    plain = {(r.doc_id, r.size) for r in sharding.shard(clashing.drop("size"), 3).collect()}
    assert plain == {(r.doc_id, r._size) for r in out.collect()}


def test_strip_lines(clashing):
    out = line_dedup.strip_lines(clashing)
    assert out.columns == [*clashing.columns, "_n_lines", "_n_widespread", "_n_removed"]
    assert out.count() == len(documents()) and _unchanged(out)


def test_strip_pages(clashing):
    out = line_dedup.strip_pages(clashing)
    assert out.columns == clashing.columns and out.count() == len(documents()) and _unchanged(out)


def test_pair_operators(spark, clashing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int, key int")
    assert filter_audit.audit(clashing, labels).count() == filter_audit.audit(frame(spark), labels).count()
    assert {tuple(r) for r in lsh_forest.near_duplicates(clashing).collect()} == {tuple(r) for r in lsh_forest.near_duplicates(frame(spark)).collect()}


def test_stages_keep_columns(spark, clashing):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, sf)
        assert out.columns == clashing.columns, name
        assert _unchanged(out), name
