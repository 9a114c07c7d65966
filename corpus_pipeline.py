"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each
result as Parquet to the shared folder and reads it back, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm import byte_bpe, decontaminate, line_dedup, near_texts, quality
from opsgrain.llm.common import table
from opsgrain.session import stage_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff of their language go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share go, except from copies of whole documents; n_chars follows the text."""
    return line_dedup.strip_pages(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word sets with a similarity of 0.8 or more."""
    return near_texts.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_holders(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of token ids and decoded bytes of what is left."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_dup_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level bpe", token_stage),
]

ORACLE_SQL = None  # fingerprints, components and byte-pair merges have no SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir))
    return docs
