"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# local defaults; on a cluster the submitted configuration wins
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "opsgrain") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master may go without that setting: there one machine runs everything, so a
    private folder is as good. On a cluster a missing or machine-local folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = _local_folder()
    mine = f"{named.rstrip('/')}/opsgrain-{spark.sparkContext.applicationId}"
    target, files = hadoop_path(spark, mine)
    if not files.exists(target):
        files.mkdirs(target)
        files.deleteOnExit(target)  # with all that was put there, when the application ends
    return f"{mine}/{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever store it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="opsgrain-")


def stage_table(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and survives lost executors.

    The table goes when the application ends, or earlier through ``drop_table``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop_table(*staged: DataFrame) -> None:
    """Delete tables of ``stage_table`` whose consumers have run."""
    for df in staged:
        target, files = hadoop_path(df.sparkSession, df._staged_at)
        files.delete(target, True)


def attach_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add a one-row frame to every row as a struct column.

    It becomes a scalar subquery: no cross join, and a frame that turned out to have more
    than one row is an error instead of a product.
    """
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("row"))
    return df.withColumn(name, packed.scalar())
