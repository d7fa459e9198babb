"""Fitted group statistics and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breachline.operators.ordering import group_quantiles


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables with one row per group side by side; NULL is a group like any other."""
    if not keys:  # one row each
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_{k}`")) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"_{k}" for k in keys])


def _percentile(
    df: DataFrame, keys: Sequence[str], value: str, share: float, name: str, accuracy: int | None
) -> DataFrame:
    """One percentile per group: exact, or a sketch of the accuracy asked for."""
    if accuracy is None:
        return group_quantiles(df, keys, value, [share]).withColumnRenamed("q_0", name)
    return df.groupBy(*keys).agg(F.percentile_approx(value, share, accuracy).alias(name))


def group_percentile(
    df: DataFrame,
    key: str,
    value: str,
    share: float = 0.75,
    minimum: float = 0.001,
    name: str = "p75_resolution_time_days",
    accuracy: int | None = None,
) -> DataFrame:
    """The percentile of valid durations per group, one row per group."""
    return _percentile(df.where(F.col(value) >= minimum), [key], value, share, name, accuracy)


def group_stats(
    df: DataFrame, key: str | Sequence[str], value: str, accuracy: int | None = None
) -> DataFrame:
    """Mean, sample deviation, 75th percentile and rows of the valid durations per group."""
    keys = [key] if isinstance(key, str) else list(key)
    valid = df.where(F.col(value) >= 0)
    moments = valid.groupBy(*keys).agg(
        F.avg(value).alias("avg_dias"), F.stddev(value).alias("std_dias"), F.count(F.lit(1)).alias("n")
    )
    joined = _joined(moments, _percentile(valid, keys, value, 0.75, "p75_dias", accuracy), keys)
    return joined.select(*keys, "avg_dias", "std_dias", "p75_dias", "n")


def global_stats(df: DataFrame, value: str, accuracy: int | None = None) -> DataFrame:
    valid = df.where(F.col(value) >= 0)
    moments = valid.agg(F.avg(value).alias("global_avg"), F.stddev(value).alias("global_std"))
    return _joined(moments, _percentile(valid, [], value, 0.75, "global_p75", accuracy), [])


def group_mean(df: DataFrame, key: str | Sequence[str], value: str, name: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(F.col(value) >= 0).groupBy(*keys).agg(F.avg(value).alias(name))


def group_median(
    df: DataFrame, keys: str | Sequence[str], value: str, name: str, accuracy: int | None = None
) -> DataFrame:
    """Median per group, a value of the column; an empty key list gives the global median."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _percentile(df, keys, value, 0.5, name, accuracy)


def group_centroid(
    df: DataFrame, keys: Sequence[str], lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(lat).alias("centroid_lat"), F.avg(lon).alias("centroid_lon"))


def group_count(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def daily_volume(df: DataFrame, ts: str, name: str = "quejas_por_dia", day: str = "day") -> DataFrame:
    return df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias(day)).agg(
        F.count(F.lit(1)).alias(name)
    )


def rolling_range_sum(
    df: DataFrame,
    key: str,
    day: str,
    low: int = -30,
    high: int = -1,
    name: str = "densidad_zip_30d",
) -> DataFrame:
    """Requests per key over the days ``low`` … ``high`` relative to each day with requests.

    Rows are counted per (key, day) first, so a window holds at most one row per day.
    NULL where no earlier day falls in the range.
    """
    daily = group_count(df, [key, day], "_n")
    span = Window.partitionBy(key).orderBy(day).rangeBetween(low, high)
    return daily.withColumn(name, F.sum("_n").over(span)).drop("_n")


def correlation_long(df: DataFrame, columns: Sequence[str], drop_null_rows: bool = False) -> DataFrame:
    """Pearson r of every pair, in one aggregation, as (feature_1, feature_2, r).

    Pairs ignore rows where either value is NULL; ``drop_null_rows`` ignores rows with
    any NULL among all columns.
    """
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if drop_null_rows:
        df = df.dropna(subset=columns)
    double = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return double.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("feature_1"),
                    F.lit(b).alias("feature_2"),
                    F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias("r"),
                )
                for a, b in pairs
            ]
        ).alias("m")
    ).select(F.inline("m"))


def lower_triangle(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The pair table as a lower-triangle matrix: one row per feature, diagonal 1."""
    columns = list(columns)
    cells = (
        long.groupBy(F.col("feature_2").alias("feature"))
        .pivot("feature_1", columns)
        .agg(F.first("r"))
    )
    names = cells.sparkSession.createDataFrame(
        [(c, i) for i, c in enumerate(columns)], "feature string, _at int"
    )
    matrix = names.join(cells, "feature", "left")
    diagonal = {
        c: F.when(F.col("_at") == i, F.lit(1.0)).otherwise(F.col(f"`{c}`"))
        for i, c in enumerate(columns)
    }
    return matrix.select("feature", "_at", *[v.alias(c) for c, v in diagonal.items()]).orderBy("_at").drop("_at")


def correlation_matrix_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full matrix for wide tables from one pass over assembled vectors, NULL rows dropped."""
    columns = list(columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="_v", handleInvalid="skip").transform(df)
    matrix = Correlation.corr(vectors.select("_v"), "_v").head()[0].toArray()
    rows = [(c, *map(float, line)) for c, line in zip(columns, matrix)]
    schema = "feature string, " + ", ".join(f"`{c}` double" for c in columns)
    return df.sparkSession.createDataFrame(rows, schema)


def correlated_pairs(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.7, digits: int = 3
) -> DataFrame:
    return (
        correlation_long(df, columns)
        .where(F.abs("r") > threshold)
        .withColumn("r", F.round("r", digits))
        .orderBy(F.desc(F.abs("r")), "feature_1", "feature_2")
    )


def target_correlation(
    df: DataFrame, columns: Sequence[str], target: str, top: int = 15
) -> DataFrame:
    """r of every column with the target, ranked by strength."""
    wide = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "r")
    strongest = Window.orderBy(F.desc_nulls_last(F.abs("r")), "feature")  # one row per feature
    return long.withColumn("rank", F.row_number().over(strongest)).where(F.col("rank") <= top)


def strongest_partners(df: DataFrame, columns: Sequence[str], feature: str, top: int = 3) -> DataFrame:
    """The columns most correlated with one feature."""
    others = [c for c in columns if c != feature]
    return target_correlation(df, others, feature, top)


def drop_redundant_features(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float = 0.7
) -> DataFrame:
    """From each strongly correlated pair, the feature that says less about the target.

    Returns (dropped, kept, r): the pair's weaker member first. On equal strength the
    later name goes.
    """
    strength = target_correlation(df, columns, target, len(columns)).select(
        "feature", F.coalesce(F.abs("r"), F.lit(0.0)).alias("s")
    )
    pairs = correlation_long(df, columns).where(F.abs("r") > threshold)
    graded = pairs.join(
        strength.select(F.col("feature").alias("feature_1"), F.col("s").alias("s1")), "feature_1"
    ).join(strength.select(F.col("feature").alias("feature_2"), F.col("s").alias("s2")), "feature_2")
    first_goes = (F.col("s1") < F.col("s2")) | (
        (F.col("s1") == F.col("s2")) & (F.col("feature_1") > F.col("feature_2"))
    )
    return graded.select(
        F.when(first_goes, F.col("feature_1")).otherwise(F.col("feature_2")).alias("dropped"),
        F.when(first_goes, F.col("feature_2")).otherwise(F.col("feature_1")).alias("kept"),
        "r",
    )


# Features left out of the final model.
REDUNDANT_FEATURES = ["presion_sla", "dia_semana_cos"]
