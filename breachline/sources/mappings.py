"""Fitted maps kept as a table, so that scoring looks up what training saw.

``maps``     (map_name, key, key_2, value), partitioned by map_name
``globals``  one row of overall statistics
``order``    (pos, feature)
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from breachline.operators.joins import attach_salted
from breachline.settings import BROADCAST_BYTES

MAP_SCHEMA = "key string, key_2 string, value double, map_name string"


def as_maps(table: DataFrame, values: Mapping[str, str], *keys: str) -> DataFrame:
    """Columns of a fitted table in long form, as ``{map name: column}``.

    Unknown keys and values are left out.
    """
    second = F.col(keys[1]).cast("string") if len(keys) > 1 else F.lit(None).cast("string")
    entries = F.array(
        *[
            F.struct(F.col(column).cast("double").alias("value"), F.lit(name).alias("map_name"))
            for name, column in values.items()
        ]
    )
    long = table.select(
        F.col(keys[0]).cast("string").alias("key"), second.alias("key_2"), F.inline(entries)
    )
    return long.dropna(subset=["key", "value", *(["key_2"] if len(keys) > 1 else [])])


def nested_lookup_to_table(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) pairs of a table without unknown keys and values."""
    return df.select(F.col(key).alias("key"), F.col(value).alias("value")).dropna()


def save_mappings(maps: DataFrame, path: str, mode: str = "overwrite") -> None:
    maps.write.mode(mode).partitionBy("map_name").parquet(f"{path}/maps")


def save_globals(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").parquet(f"{path}/globals")


def save_feature_order(spark: SparkSession, features: Sequence[str], path: str) -> None:
    rows = list(enumerate(features))
    spark.createDataFrame(rows, "pos int, feature string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/order"
    )


@dataclass(frozen=True)
class Fitted:
    """Stored maps of one training run, with the rows and bytes of each."""

    maps: DataFrame
    overall: Row
    sizes: dict[str, int]
    stored: dict[str, int]
    path: str

    def value(self, name: str) -> float | None:
        return self.overall[name]

    def lit(self, name: str, default: float = 0.0) -> Column:
        known = self.overall[name]
        return F.lit(float(default if known is None else known))

    def table(self, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
        """The maps side by side, one row per key."""
        rows = self.maps.where(F.col("map_name").isin(*names))
        if len(names) == 1:
            wide = rows.select("key", "key_2", F.col("value").alias(names[0]))
        else:
            wide = rows.groupBy("key", "key_2").agg(
                *[F.max(F.when(F.col("map_name") == n, F.col("value"))).alias(n) for n in names]
            )
        renamed = wide.withColumnsRenamed(dict(zip(("key", "key_2"), keys)))
        return renamed if len(keys) == 2 else renamed.drop("key_2")

    def attach(
        self, df: DataFrame, names: Sequence[str], *keys: Column, counted: DataFrame | None = None
    ) -> DataFrame:
        """Left join of maps sharing a key. Their stored bytes decide about a broadcast.

        ``counted`` is what ``df`` was before columns were added, to find hot keys in.
        """
        at = [f"_key{i}" for i in range(len(keys))]
        text = {a: k.cast("string") for a, k in zip(at, keys)}
        keyed = df.withColumns(text)
        table = self.table(names, at)
        if sum(self.stored.get(n, 0) for n in names) <= BROADCAST_BYTES:
            joined = keyed.join(F.broadcast(table), at, "left")
        else:
            source = df if counted is None else counted
            joined = attach_salted(keyed, table, at, counted=source.withColumns(text))
        return joined.drop(*at)


def load_mappings(spark: SparkSession, path: str) -> Fitted:
    maps = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/maps")
    row = 24 + F.octet_length("key") + F.coalesce(F.octet_length("key_2"), F.lit(0))
    found = maps.groupBy("map_name").agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("bytes")).collect()
    sizes, stored = ({r["map_name"]: r[c] for r in found} for c in ("n", "bytes"))
    return Fitted(maps, spark.read.parquet(f"{path}/globals").first(), sizes, stored, path)


def load_feature_order(spark: SparkSession, path: str) -> list[str]:
    return [r.feature for r in spark.read.parquet(f"{path}/order").orderBy("pos").collect()]


union_maps = functools.partial(functools.reduce, DataFrame.unionByName)
