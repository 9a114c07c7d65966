"""Filter interaction audit: what every filter removes, repeats and loses, in every order of the filters.

Every filter writes the keys of the documents that fail it to an id table of its own. A prefix of an order acts
as the set of its filters, so the 2**k sets stand for all orders: the documents that survive a set are the ids
left after a left-anti join with the id tables of the set, what the next filter removes from them is a left-semi
join with its id table. All sets go through the same two joins, as rows; ids and id tables are exchanged once, by
key, and no text moves after the one pass that judges it. Only counts per part, set and filter reach the orders.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgrain.llm.common import col, row_key, text_or_empty
from opsgrain.session import scratch_dir, stage_table

# fixed values
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"

MEASURES = ("n_words", "n_distinct", "n_upper", "n_chars", "n_symbols")
_CONTINUATION = bytes(range(0x80, 0xC0))


def measure(data: bytes) -> tuple[int, ...]:
    """Words, distinct words, capitals, code points and symbols of one UTF-8 text."""
    words = data.split()
    return (len(words), len(set(words)), len(data) - len(data.translate(None, UPPER)), len(data.translate(None, _CONTINUATION)),
            len(data) - len(data.translate(None, SYMBOLS)))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    found = [measure(t.as_py()) for t in texts]
    columns = list(zip(*found)) or [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def text_rules(m: str) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text alone, over the struct of its measures."""
    n = {name: F.col(f"{m}.{name}") for name in MEASURES}
    return {"A": n["n_words"] < MIN_WORDS, "B": 100 * n["n_distinct"] < MIN_DISTINCT_PERCENT * n["n_words"],
            "C": 100 * n["n_upper"] > MAX_UPPER_PERCENT * n["n_chars"], "D": n["n_symbols"] > 0}


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(key, id, part, digest, fails, copies): the text filters that a document fails; equal rows are one row with their number."""
    judged = docs.select(row_key(doc_id, text).alias("key"), col(doc_id).alias("id"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"),
                         F.unhex(F.md5(text_or_empty(text))).alias("digest"), _measures(text_or_empty(text).cast("binary")).alias("m"))
    fails = F.concat_ws("", *[F.when(failed, F.lit(name)) for name, failed in text_rules("m").items()]).alias("fails")
    return judged.select("key", "id", "part", "digest", fails).groupBy("key", "id", "part", "digest", "fails").agg(F.count("*").alias("copies"))


def id_tables(judged: DataFrame) -> DataFrame:
    """(key, filter): one table of failing ids per filter, each in a folder of its own.

    A text fails E unless its id is the smallest that has the text; that one row per text is taken off by a left-anti
    join on text and id, so that a text with very many copies is no hot key. Null ids have no order and pass E.
    """
    own = judged.select("key", F.explode(F.filter(F.split("fails", ""), lambda x: x != "")).alias("filter"))
    named = judged.where("id is not null")
    first = named.groupBy("digest").agg(F.min("id").alias("id"))
    repeats = named.join(first, ["digest", "id"], "left_anti").select("key", F.lit("E").alias("filter"))
    spark, path = judged.sparkSession, scratch_dir(judged.sparkSession)
    own.unionByName(repeats).write.partitionBy("filter").parquet(path)
    return spark.read.schema("key binary, filter string").parquet(path)


def marked(judged: DataFrame, labels: DataFrame, *, label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(key, part, copies, good, toxic): a document counts as labelled if any row of its id says so."""
    marks = (labels.where(col(label_id).isNotNull()).groupBy(col(label_id).alias("id"))
             .agg(F.max((F.coalesce(col(quality), F.lit(0)) == 1).cast("long")).alias("good"),
                  F.max((F.coalesce(col(toxic), F.lit(0)) == 1).cast("long")).alias("toxic")))
    counted = judged.select("key", "id", "part", "copies").join(marks, "id", "left")
    return counted.select("key", "part", "copies", (F.col("copies") * F.coalesce("good", F.lit(0))).alias("good"),
                          (F.col("copies") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def removals(ids: DataFrame, failing: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """(part, before, bit, removed, good, toxic): what each filter removes from the survivors of each set of other filters.

    ``before`` and ``bit`` number sets and filters by bits. Ids that fail nothing survive every set, and are left out by the first join.
    """
    bits = F.create_map(*[F.lit(x) for i, name in enumerate(filters) for x in (name, 1 << i)])
    tables = failing.where(F.col("filter").isin(*filters)).select(F.col("key").alias("k"), bits[F.col("filter")].alias("b")).repartition("k")
    some = ids.repartition("key").join(tables, F.col("key") == F.col("k"), "left_semi")
    sets = some.withColumn("before", F.explode(F.lit(list(range((1 << len(filters)) - 1)))))
    survivors = sets.join(tables, (F.col("key") == F.col("k")) & (F.col("before").bitwiseAND(F.col("b")) != 0), "left_anti")
    nexts = survivors.withColumn("bit", F.explode(F.lit([1 << i for i in range(len(filters))]))).where(F.col("before").bitwiseAND(F.col("bit")) == 0)
    gone = nexts.join(tables, (F.col("key") == F.col("k")) & (F.col("bit").bitwiseAND(F.col("b")) != 0), "left_semi")
    return gone.groupBy("part", "before", "bit").agg(F.sum("copies").alias("removed"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def orders(parts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """(part, docs, filter_order, step, before, bit): every part with every step of every order."""
    every = F.explode(F.array(*[F.lit([filters.index(x) for x in order]) for order in permutations(filters)])).alias("o")
    names = F.lit(list(filters))
    steps = parts.select("part", "docs", every).select("part", "docs", "o", F.posexplode("o").alias("at", "x"))
    return steps.select(
        "part", "docs", F.array_join(F.transform("o", lambda x: F.element_at(names, x + 1)), "").alias("filter_order"), (F.col("at") + 1).alias("step"),
        F.aggregate(F.slice("o", F.lit(1), F.col("at")), F.lit(0), lambda s, x: s + F.call_function("shiftleft", F.lit(1), x)).alias("before"),
        F.call_function("shiftleft", F.lit(1), F.col("x")).alias("bit"))


def audit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang", label_id: str = "doc_id",
          quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    Null texts are empty, null parts are the empty string, null ids pass E and have no labels; rows that repeat id, text and
    part count as often as they occur. Ids may have any type that has an order. Columns beyond those named are not read, so their names cannot
    clash; an empty input has no parts and gives no rows.
    """
    judged = stage_table(judge(docs, doc_id=doc_id, text=text, part=part))
    failing = id_tables(judged)
    ids = marked(judged, labels, label_id=label_id, quality=quality, toxic=toxic)
    found = stage_table(removals(ids, failing))
    parts = judged.groupBy("part").agg(F.sum("copies").alias("docs"))
    full = (1 << len(FILTERS)) - 1
    alone = found.where(F.col("before") == 0).select("part", "bit", F.col("removed").alias("fails"))
    last = found.where(F.col("before") + F.col("bit") == full).select("part", "bit", F.col("removed").alias("unique"))
    steps = (orders(parts).join(found, ["part", "before", "bit"], "left").join(alone, ["part", "bit"], "left").join(last, ["part", "bit"], "left")
             .na.fill(0, ["removed", "good", "toxic", "fails", "unique"]))
    letters = F.element_at(F.split("filter_order", ""), F.col("step"))
    so_far = "sum(removed) over (partition by part, filter_order order by step rows between unbounded preceding and current row)"
    return steps.select(
        "part", "filter_order", "step", letters.alias("filter"), (F.col("docs") - F.expr(so_far)).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), F.col("unique").alias("unique_fails"), F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), F.expr("sum(removed) over (partition by part, bit)").alias("shapley"))
