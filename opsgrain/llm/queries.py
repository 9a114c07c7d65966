"""One query per corpus operator over its whole table, the pipeline, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from opsgrain.llm import (byte_bpe, decontaminate, filter_audit, hard_negatives, hidden_markov, line_dedup, lsh_forest, pseudonyms, quality, secret_scan,
                          sharding, simhash, sql, substrings)
from opsgrain.llm.common import table, text_or_empty

DEMO_KEY = b"demonstration key, replace in production"  # of op9's query alone

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


@query("op1_line_spread", sql.LINES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.strip_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_widespread", "n_removed", F.sha2(text_or_empty("text"), 256).alias("kept_sha256"))


@query("op2_hidden_markov")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score(table(spark, sf_dir, "documents"))


@query("op3_suffix_automata", sql.REPEATS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality_rules", sql.QUALITY)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_histogram_sort", sql.SHARDS)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(text_or_empty("text").cast("binary")))
    placed = sharding.shard(docs, 8, keep=["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op6_simhash_grid")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op8_benchmark_containment", sql.CONTAINMENT)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.held_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query("op9_feistel_pseudonyms")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key=DEMO_KEY)


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", sql.NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % hard_negatives.NOISY == 0, (F.col("label") + 1) % hard_negatives.LABELS).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", noisy), F.col("vec_id") % hard_negatives.EVERY == 0)


@query("op12_filter_audit", sql.AUDIT)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_lsh_forest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
