"""Quality rules with risk-controlled cutoffs.

Every text gets integer measures. For each stratum (a language, say) and each rule the labelled
documents are a holdout on which cutoffs are tested from the loosest to the strictest: the
null hypothesis "this cutoff rejects more than ``risk`` of the clean documents" is rejected while the
exact binomial tail P(Bin(n, risk) <= k) stays at or below ``delta``; that is the Clopper-Pearson bound
read the other way round. Testing in a fixed order needs no correction over cutoffs, rules and strata are
corrected by Bonferroni. Of the certified cutoffs the one that best separates the labels is used.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import col, fresh, small_batches, text_or_empty
from opsgrain.session import stage_table

# fixed values
SYMBOLS = b"#*$%&|<>"
BREAKS = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
# rule: numerator, denominator, scale; the value is floor(scale * numerator / denominator), at most 1000
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "upper": ("n_upper", "word_chars", 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000),
    "repeats": ("n_repeat_words", "n_words", 1000),
    "word_length": ("word_chars", "n_words", 10),
}
TOP = 1000
RISK = 0.03  # over all rules of one stratum
DELTA = 0.05  # over all rules and strata

_CONTINUATION = bytes(range(0x80, 0xC0))


def measure(data: bytes) -> tuple[int, ...]:
    """The measures of one UTF-8 text, in the order of MEASURES."""
    words = data.split()
    solid = data.translate(None, BREAKS + _CONTINUATION)
    lines = [line for line in data.split(b"\n") if line.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        seen = Counter(triples)
        end = 0  # first word that no repeated window has covered yet
        for i, triple in enumerate(triples):
            if seen[triple] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(words), len(solid), len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated, len(lines), len(solid) - len(solid.translate(None, UPPER)))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    found = [measure(t) for t in texts.to_pylist()]
    columns = list(zip(*found)) or [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def measures(text: str) -> Column:
    """Struct of the measures of a whole text; a null text is empty."""
    return _measures(text_or_empty(text).cast("binary"))


def base_failed(m: str) -> Column:
    n, r = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def _value(m: str, rule: str) -> Column:
    up, down, scale = RULES[rule]
    return F.when(F.col(f"{m}.{down}") > 0,
                  F.least(F.lit(TOP), F.floor(scale * F.col(f"{m}.{up}") / F.col(f"{m}.{down}")))).otherwise(0).cast("int")


def allowed(n: int, risk: float, delta: float) -> int:
    """The most rejections k among n clean documents with P(Bin(n, risk) <= k) <= delta; -1 if none."""
    total, k = 0.0, -1
    for j in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
                          + j * math.log(risk) + (n - j) * math.log1p(-risk))
        if total > delta:
            break
        k = j
    return k


def choose(counts: list[tuple[int, int, int]], risk: float, delta: float) -> int | None:
    """Cutoff of one rule in one stratum from (value, clean, bad) counts; values above it are rejected."""
    clean, bad = sum(c for _, c, _ in counts), sum(b for _, _, b in counts)
    limit = allowed(clean, risk, delta) if clean else -1
    best, gain, k, caught = None, 0.0, 0, 0
    for value, c, b in sorted(counts, reverse=True):
        k, caught = k + c, caught + b
        if k > limit:  # this and every stricter cutoff fails the test
            break
        if bad and caught / bad - k / clean > gain:
            best, gain = value - 1, caught / bad - k / clean
    return best


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, *, m: str, doc_id: str = "doc_id",
            label_id: str = "doc_id", quality: str = "quality", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``_stratum`` and a cutoff (or null) for each rule.

    ``measured`` holds the id, the stratum and the struct ``m`` of every document. A document that is
    labelled more than once counts as its lowest label; null labels and ids are no labels. Only the
    counts per stratum, rule and value (at most 1,001 values) leave the workers' partial sums.
    """
    marks = labels.select(col(label_id).alias("_id"), col(quality).alias("_good")).where("_id is not null and _good is not null")
    marks = marks.groupBy("_id").agg((F.min("_good") > 0).alias("_clean"))
    held = (measured.select(col(doc_id).alias("_id"), F.coalesce(col(stratum).cast("string"), F.lit("")).alias("_stratum"), F.col(m))
            .join(marks, "_id").where(~base_failed(m)))
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _value(m, r).alias("value")) for r in RULES]))
    counts = (held.select("_stratum", "_clean", cells.alias("_cell"))
              .groupBy("_stratum", "_cell.rule", "_cell.value")
              .agg(F.count(F.when(F.col("_clean"), 1)).alias("clean"), F.count(F.when(~F.col("_clean"), 1)).alias("bad")))
    strata = counts.select(F.count_distinct("_stratum").alias("n")).scalar()

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        tests = len(RULES) * int(first["_strata"])
        cut = choose(list(zip(frame["value"], frame["clean"], frame["bad"])), risk / len(RULES), delta / tests)
        return pd.DataFrame({"_stratum": [first["_stratum"]], "rule": [first["rule"]], "cutoff": pd.array([cut], "Int64")})

    picked = (counts.withColumn("_strata", strata).groupBy("_stratum", "rule")
              .applyInPandas(pick, "_stratum string, rule string, cutoff long"))
    return picked.groupBy("_stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES])


def judged(measured: DataFrame, cuts: DataFrame, stratum: str, *, m: str, verdict: str) -> DataFrame:
    """Add the boolean ``verdict``: False for texts that fail the base or a rule of their stratum.

    ``cuts`` is a staged table, so Spark knows its size and broadcasts it only while it is small.
    """
    c = fresh(measured.columns, "_cuts")
    packed = cuts.select(F.struct(*cuts.columns).alias(c))
    passed = F.lit(True)
    for rule in RULES:
        cut = F.col(f"{c}._cut_{rule}")
        passed = passed & (cut.isNull() | (_value(m, rule) <= cut))
    joined = measured.join(packed, F.coalesce(col(stratum).cast("string"), F.lit("")) == F.col(f"{c}._stratum"), "left")
    return joined.withColumn(verdict, ~base_failed(m) & passed).drop(c)


def assess(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
           risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Measures, base verdict and verdict of every document.

    Null ids, strata and texts are allowed (a null text is empty and fails for want of words; null
    strata are a stratum of their own); repeated rows are judged alike; an empty input gives no rows.
    A stratum with too few labelled documents for the bound gets no cutoff, so it loses only base failures.
    Texts are read once: the measures are staged, a few numbers per document.
    """
    narrow = stage_table(small_batches(docs).select(col(doc_id).alias("doc_id"), col(stratum).alias("stratum"), measures(text).alias("m")))
    cuts = stage_table(cutoffs(narrow, labels, "stratum", m="m", risk=risk, delta=delta))
    out = judged(narrow, cuts, "stratum", m="m", verdict="kept")
    return out.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in MEASURES], base_failed("m").alias("base_failed"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
              risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The documents that pass, with all their columns. Cutoffs are learnt from the measures of all
    labelled documents, then each document is measured where it is read, so no text is shuffled."""
    m, verdict = fresh(docs.columns, "_measures"), fresh(docs.columns, "_kept")
    marked = labels.select(col("doc_id").alias("_id")).distinct()
    narrow = small_batches(docs).select(col(doc_id).alias("doc_id"), col(stratum).alias("stratum"), measures(text).alias("m"))
    narrow = stage_table(narrow.join(marked, F.col("doc_id") == F.col("_id"), "left_semi"))
    cuts = stage_table(cutoffs(narrow, labels, "stratum", m="m", risk=risk, delta=delta))
    measured = docs.withColumn(m, measures(text))
    return judged(measured, cuts, stratum, m=m, verdict=verdict).where(col(verdict)).select(*[col(c) for c in docs.columns])
