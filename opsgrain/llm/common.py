"""What the corpus operators share: words, row keys, free column names, Arrow rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: white space of the word pattern [^\x20\x09-\x0D]+; bytes.split() cuts at the same six
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


# Arrow batches of rows with texts, in bytes: two workers with long texts have to fit beside a small heap
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT, BATCH_SMALL = "67108864b", "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """The same frame; Spark's default size of the batches for Python is lowered in its session, a size that was set stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES) == BATCH_DEFAULT:
        conf.set(BATCH_BYTES, BATCH_SMALL)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that no column of the input has, whatever extra columns it carries."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name), F.lit(""))


def row_key(doc_id: str, text: str) -> Column:
    """128 bits that tell rows apart by id and text; rows that share both may share their key.

    Unlike a generated number it is the same after a lost task is run again.
    """
    value = text_or_empty(text)
    return F.unhex(F.md5(F.concat(F.coalesce(col(doc_id).cast("string"), F.lit("-")), F.lit("\x01"), value)))


def rows(batches: Iterable[pa.RecordBatch], step: int = 512) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few hundred at a time, so that long texts are not all copied at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            piece = batch.slice(at, step)
            yield from zip(*(column.to_pylist() for column in piece.columns))


def batches_of(records: Iterable[tuple], schema: pa.Schema, size: int = 2048, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` records, cut early once strings and bytes reach ``limit``."""
    held: list[tuple] = []
    weight = 0
    for record in records:
        held.append(record)
        weight += sum(len(v) for v in record if isinstance(v, (str, bytes)))
        if len(held) >= size or weight >= limit:
            yield arrow_batch(held, schema)
            held, weight = [], 0
    if held:
        yield arrow_batch(held, schema)


def arrow_batch(records: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(values, type=field.type) for values, field in zip(zip(*records), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
