"""Reading layers: delimited bronze files, Parquet layers, mixed folders and splits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLITS = ("train", "val", "test")


def read_csv_inferred(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Header CSV. Inference costs one more pass over the file: pass ``schema`` at scale."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_quoted(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV whose quoted fields double the quote character.

    ``multiline`` makes every file one task, so it stays off unless fields hold newlines.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multiline)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _read_or_none(load) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as error:
        absent = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
        if (error.getCondition() or "").split(".")[0] in absent:
            return None
        raise


def read_mixed(spark: SparkSession, prefix: str) -> DataFrame | None:
    """All Parquet and CSV files below ``prefix`` as one table, matched by column name.

    ``None`` when the folder holds neither kind.
    """
    kinds = (
        lambda: spark.read.option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .option("mergeSchema", True)
        .parquet(prefix),
        lambda: spark.read.option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .options(header=True, inferSchema=True)
        .csv(prefix),
    )
    found = [t for t in map(_read_or_none, kinds) if t is not None and t.columns]
    if not found:
        return None
    table = found[0]
    for other in found[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    return table


def read_table_file(spark: SparkSession, key: str) -> DataFrame | None:
    """One Parquet object by its exact name, ``None`` when it is missing."""
    return _read_or_none(lambda: spark.read.parquet(key))


def read_splits(spark: SparkSession, base: str) -> DataFrame:
    """The splits below ``base`` as one table with a ``split`` column.

    A table written with :func:`breachline.sources.writers.write_splits` is pruned by
    partition; three plain folders ``train``, ``val``, ``test`` are accepted as well.
    """
    base = base.rstrip("/")
    partitioned = _read_or_none(lambda: spark.read.parquet(base))
    if partitioned is not None and "split" in partitioned.columns:
        return partitioned
    parts = [
        spark.read.parquet(f"{base}/{name}").withColumn("split", F.lit(name))
        for name in SPLITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
