"""Cross-site line removal: HyperLogLog spread per line, exact counts near the threshold.

A line's spread is the number of distinct sites that hold it. Partial sketches are merged per line hash; the
sketch's error is known, so only lines whose estimate lies near the threshold are counted exactly. Lines that
are widespread are boilerplate: ``strip_lines`` removes them from every document. A copy of a whole document is
the near-duplicate stage's matter, so before that stage ``strip_pages`` leaves documents whole that consist mostly
of widespread lines and have near copies on other sites.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.llm import simhash
from opsgrain.llm.common import SPACES, col, fresh, row_key, text_or_empty
from opsgrain.session import stage_table

MIN_SITES = 10
SKETCH_BITS = 12  # 2 ** 12 registers: a relative standard error of 1.04 / 64
SIGMAS = 4.0  # the band in which lines are counted exactly, in standard errors
PAGE_SHARE = 0.5  # of a document's characters on widespread lines, beyond which near copies of it are searched
NAMES = ("key", "bad", "flags", "lines", "kept")  # columns beside those of the documents
COUNTS = ("n_lines", "n_widespread", "n_removed")  # columns of the result


def line_key(line: Column | str) -> Column:
    """128 bits of a line without white space at its ends; null for a blank line."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def _lines(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    keys = F.transform(F.split(text_or_empty(text), "\n"), line_key)
    return docs.select(*more, F.explode(keys).alias("line")).where("line is not null")


def widespread(docs: DataFrame, *, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
               sketch_bits: int = SKETCH_BITS, sigmas: float = SIGMAS) -> DataFrame:
    """(line, sites): keys of the lines on at least ``min_sites`` sites; null sites are none.

    The sketches merge on the map side, so a line in every document is one row per task. ``sites`` is exact
    for lines near the threshold and an estimate beyond.
    """
    lines = _lines(docs, text, col(site).cast("string").alias("site"))
    error = sigmas * 1.04 / math.sqrt(2 ** sketch_bits)
    low, high = math.floor(min_sites * (1 - error)), math.ceil(min_sites * (1 + error))
    spread = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", sketch_bits)).alias("sites"))
    likely = stage_table(spread.where(F.col("sites") >= low))
    near = likely.where(F.col("sites") < high).select("line")
    exact = (lines.where("site is not null").join(near, "line", "left_semi").distinct()  # one row per line and site first
             .groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites))
    return likely.where(F.col("sites") >= high).unionByName(exact)


def _names(docs: DataFrame) -> dict[str, str]:
    return {n: fresh(docs.columns, f"_{n}") for n in (*NAMES, "copy")} | {n: fresh(docs.columns, n) for n in COUNTS}


def _marked(docs: DataFrame, names: dict[str, str], doc_id: str, text: str, site: str, min_sites: int, max_share: float) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_widespread``, the set of widespread lines (null without any), whether they are few
    enough to go at once, and the text without them."""
    found = stage_table(widespread(docs, text=text, site=site, min_sites=min_sites).select("line"))
    held = _lines(docs, text, row_key(doc_id, text).alias("key")).join(found, "line")
    sets = held.groupBy("key").agg(F.collect_set("line").alias("set"))  # at most the lines of one text
    bad, lines = F.col(names["bad"]), F.col(names["lines"])
    joined = docs.withColumn(names["key"], row_key(doc_id, text)).join(
        sets.select(F.col("key").alias(names["key"]), F.col("set").alias(names["bad"])), names["key"], "left")
    split = joined.withColumn(names["lines"], F.split(text_or_empty(text), "\n"))
    length = F.aggregate(F.filter(lines, lambda l: line_key(l).isNotNull()), F.lit(0), lambda n, l: n + F.char_length(F.btrim(l, F.lit(SPACES))))
    gone = F.filter(lines, lambda l: F.array_contains(bad, line_key(l)))
    gone_length = F.aggregate(gone, F.lit(0), lambda n, l: n + F.char_length(F.btrim(l, F.lit(SPACES))))
    n_widespread = F.when(bad.isNull(), 0).otherwise(F.size(gone))
    counted = split.withColumns({
        names["n_lines"]: F.size(F.filter(lines, lambda l: line_key(l).isNotNull())).cast("long"), names["n_widespread"]: n_widespread.cast("long"),
        names["flags"]: F.when(bad.isNull(), False).otherwise(gone_length <= max_share * length)})
    kept = F.array_join(F.filter(lines, lambda l: ~F.coalesce(F.array_contains(bad, line_key(l)), F.lit(False))), "\n")
    return counted.withColumn(names["kept"], kept)


def strip_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                max_share: float = 1.0) -> DataFrame:
    """All columns of ``docs`` with the shortened text, plus ``n_lines``, ``n_widespread`` and ``n_removed``; where the input
    has one of these names its column stays and the new one gets an underscore in front.

    Lines end at a line feed; blank lines stay, are never widespread and do not count in ``n_lines``. A null text
    stays null. Documents with more than ``max_share`` of their characters on widespread lines are left whole, none by
    default. Null ids and sites, repeated rows and empty inputs are fine. Two joins move data: widespread
    lines to the rows that hold them (keys only), and the rows' sets of such lines back to the texts.
    """
    names = _names(docs)
    flags = F.col(names["flags"])
    counted = _marked(docs, names, doc_id, text, site, min_sites, max_share)
    out = counted.withColumn(names["n_removed"], F.when(flags, F.col(names["n_widespread"])).otherwise(0)).withColumn(
        text, F.when(flags, F.col(names["kept"])).otherwise(col(text)))
    return out.select(*[col(c) for c in docs.columns], *[names[c] for c in COUNTS])


def strip_pages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` without widespread lines, also where they are most or all of a document.

    Left whole is only what is a copy by evidence: a document mostly of widespread lines that the near-duplicate
    search links to one on another site. That stage keeps one of each such group, boilerplate alone earns nothing.
    Beyond ``strip_lines`` the texts are written once; only documents mostly of widespread lines are searched.
    """
    names = _names(docs)
    flags, kept, copy = (F.col(names[n]) for n in ("flags", "kept", "copy"))
    marked = _marked(docs, names, doc_id, text, site, min_sites, PAGE_SHARE)
    mostly = F.col(names["bad"]).isNotNull() & ~flags  # kept stays beside the text of these alone
    marked = stage_table(marked.select(
        *[F.when(flags, kept).otherwise(col(c)).alias(c) if c == text else col(c) for c in docs.columns], F.when(mostly, kept).alias(names["kept"])))
    pages = marked.where(kept.isNotNull())
    copies = _copies(pages, doc_id, text, site).select(F.col("key").alias(names["key"]), F.lit(True).alias(names["copy"]))
    judged = pages.withColumn(names["key"], row_key(doc_id, text)).join(copies, names["key"], "left")
    bare = judged.withColumn(text, F.when(copy, col(text)).otherwise(kept))
    columns = [col(c) for c in docs.columns]
    return marked.where(kept.isNull()).select(*columns).unionByName(bare.select(*columns))


def _copies(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """Row keys of the documents whose group of near copies spans several sites; null sites are none."""
    groups = simhash.near_duplicates(docs.select(*{c: col(c) for c in (doc_id, text)}.values()), doc_id=doc_id, text=text)
    # a component without any id has no name; there equal fingerprints are the group
    named = stage_table(groups.select("key", F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).alias("g")).distinct())
    sites = docs.select(row_key(doc_id, text).alias("key"), col(site).cast("string").alias("site")).distinct()
    spread = named.join(sites, "key").groupBy("g").agg(F.min("site").alias("low"), F.max("site").alias("high")).where("low <> high")
    return named.join(spread, "g", "left_semi").select("key")
