"""Winner rows by late materialisation: winners are chosen on narrow columns, their rows are fetched once by locator.

A locator is where a row is stored, file and position. A frame that selects from and filters one Parquet scan has it for
free; any other frame is written once to the shared folder, which also fixes its rows. Only keys, order and locators are
aggregated and shuffled to choose; whole rows meet the winners in a semi join on the locator, whose keys are all different,
so neither a hot key nor a long text reaches an aggregation buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.functions.core import as_col
from opsgrain.session import stage_table

_ROW_BITS = 48  # of a locator, for the position in a file

# plan nodes that give at most one row for each row of the scan below
_ONE_TO_ONE = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation"}


def _keeps_rows(df: DataFrame) -> bool:
    """The frame is one file scan under projections and filters, so a stored row is at most one of its rows."""
    node = df._jdf.queryExecution().analyzed()
    while True:
        if node.getClass().getSimpleName() not in _ONE_TO_ONE or node.children().size() > 1:
            return False
        if node.children().isEmpty():
            return True
        node = node.children().head()


def located(df: DataFrame) -> tuple[DataFrame, str]:
    """The frame with a decimal column that tells its rows apart (hash of the file, position in it), and its name."""
    taken = {c.lower() for c in df.columns}
    if "_metadata" in taken:
        raise ValueError("a column _metadata hides where rows are stored; rename it")
    name = next(n for k in range(len(taken) + 1) if (n := "_" * k + "_at") not in taken)
    file = F.xxhash64("_metadata.file_path").cast("decimal(20, 0)") + F.lit(str(1 << 63)).cast("decimal(19, 0)")
    at = (file.cast("decimal(20, 0)") * F.lit(1 << _ROW_BITS).cast("decimal(15, 0)") + F.col("_metadata.row_index")).cast("decimal(38, 0)")
    if _keeps_rows(df):
        try:
            return df.select("*", at.alias(name)), name
        except AnalysisException:  # files of a format without row positions
            pass
    return stage_table(df).select("*", at.alias(name)), name


def _content(df: DataFrame) -> Column:
    """64 bits of a row's content; maps have no hash and do not take part."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashed) if hashed else F.lit(0).cast("long")


def first_rows(df: DataFrame, keys: Sequence[str], order: Column | str, limit: int | None = None, last: bool = False) -> DataFrame:
    """The first (or last) whole row of every key by ``order``; with a limit those of the first ``limit`` keys in that order.

    A null order comes after all others. Rows that tie in the order are told apart by their content, equal rows by their place,
    so every key has exactly one row. Null is a key like any other.
    """
    source, at = located(df)
    names = [f"_k{i}" for i in range(len(keys))]
    narrow = [*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], as_col(order).alias("_o")]
    ranked = F.desc_nulls_last("_o") if last else F.asc_nulls_last("_o")
    # rows of one key and order collapse before the shuffle, however many there are
    counted = source.select(*narrow, F.col(at).alias("_at")).groupBy(*names, "_o").agg(F.count("*").alias("_n"), F.min("_at").alias("_at"))
    best = counted.withColumn("_rank", F.row_number().over(Window.partitionBy(*names).orderBy(ranked))).where("_rank <= 1").drop("_rank")
    if limit is not None:
        best = best.orderBy(ranked, *names).limit(limit)
    best = stage_table(best)
    tied = best.where("_n > 1")
    winners = best.select("_at")
    if not tied.isEmpty():  # only rows that tie show their content
        same = [F.col(f"r.{n}").eqNullSafe(F.col(f"t.{n}")) for n in (*names, "_o")]
        rivals = source.select(*narrow, _content(df).alias("_content"), F.col(at).alias("_at")).alias("r").join(tied.alias("t"), same, "left_semi")
        chosen = rivals.withColumn("_rank", F.row_number().over(Window.partitionBy(*names).orderBy("_content", "_at"))).where("_rank <= 1")
        winners = best.where("_n = 1").select("_at").union(chosen.select("_at"))
    fetched = source.alias("s").join(winners.alias("w"), F.col(f"s.{at}") == F.col("w._at"), "left_semi")
    return fetched.select(*[F.col(f"s.`{c}`") for c in df.columns])
