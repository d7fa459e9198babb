"""Limits shared by the operators and the shared folder used to cut lineage."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A table is only hinted for broadcast if its stored bytes stay within this bound.
BROADCAST_BYTES = 16 << 20

#: Beyond the bound a row of a hot key goes to one of this many copies of the table's row, so a
#: key with a third of all rows is spread over as many tasks.
SALTS = 16

#: A key is hot if it has more rows than this.
HOT_ROWS = 200_000

SEED = 42


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="breachline-")


def work_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is only made up for a local master, where driver and
    executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder(spark.conf.get("spark.app.id", ""))


def _own_folder(spark: SparkSession) -> str:
    return f"{work_folder(spark)}/breachline/{spark.conf.get('spark.app.id')}"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path of this application below the work folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def release(spark: SparkSession) -> None:
    """Remove the tables this application wrote to the work folder, once nothing reads them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the work folder and continue from the written table.

    Later readers scan the table instead of repeating the work behind it, and a lost
    executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``cut``, then let go of the shuffle files behind the table that was written.

    Spark deletes them once the driver has collected the plans that made them, which a
    driver with little to do may put off until the disks are full.
    """
    spark, out = df.sparkSession, cut(df, name)
    del df
    gc.collect()
    spark._jvm.System.gc()
    return out


def stored_bytes(df: DataFrame) -> int:
    """Bytes of a table by Spark's own statistics: exact for files, huge where unknown."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
