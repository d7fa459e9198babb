"""Encodings of categories and numbers, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachline.operators.joins import attach
from breachline.operators.ordering import prefix_sums
from breachline.settings import cut


def fold_sums(train: DataFrame, columns: Sequence[str], target: str, fold: Column) -> DataFrame:
    """(column, key, fold, s, c): known targets and their sum, for several columns in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("key"))
            for c in columns
        ]
    )
    long = train.select(F.col(target).alias("y"), fold.alias("fold"), F.inline(pairs))
    return (
        long.where(F.col("key").isNotNull())
        .groupBy("column", "key", "fold")
        .agg(F.coalesce(F.sum("y"), F.lit(0)).alias("s"), F.count("y").alias("c"))
    )


def target_means(sums: DataFrame) -> DataFrame:
    """(column, key, value): mean target per category over all training rows."""
    mean = F.try_divide(F.sum("s").cast("double"), F.sum("c"))
    return sums.groupBy("column", "key").agg(mean.alias("value"))


def out_of_fold_means(sums: DataFrame) -> DataFrame:
    """(column, key, fold, value): mean target of the category's rows outside the fold.

    NULL where the other folds hold no known target. A window sees one row per fold.
    """
    whole = Window.partitionBy("column", "key")
    others = F.sum("c").over(whole) - F.col("c")
    mean = F.try_divide((F.sum("s").over(whole) - F.col("s")).cast("double"), others)
    return sums.select("column", "key", "fold", mean.alias("value"))


def _attach_encoding(
    df: DataFrame, table: DataFrame, column: str, name: str, fallback, settled: bool = False
) -> DataFrame:
    keyed = df.withColumn("key", F.col(f"`{column}`").cast("string"))
    joined = attach(keyed, table.select("key", "value"), "key", settled=settled)
    return joined.withColumn(name, F.coalesce("value", fallback)).drop("key", "value")


def target_encode_oof(
    train: DataFrame, column: str, target: str, fold: str, name: str | None = None
) -> DataFrame:
    """Encode training rows by the targets of the other folds; otherwise the overall mean."""
    overall = train.agg(F.avg(target)).scalar()
    sums = fold_sums(train, [column], target, F.col(fold))
    table = out_of_fold_means(sums).drop("column").withColumnRenamed("fold", "_fold")
    keyed = train.withColumns({"key": F.col(f"`{column}`").cast("string"), "_fold": F.col(fold)})
    joined = attach(keyed, table, ["key", "_fold"])
    return joined.withColumn(name or f"{column}_te", F.coalesce("value", overall)).drop(
        "key", "_fold", "value"
    )


def target_encode_full(
    train: DataFrame, df: DataFrame, column: str, target: str, name: str | None = None
) -> DataFrame:
    """Encode other rows by all training targets; unseen categories take the overall mean."""
    overall = train.agg(F.avg(target)).scalar()
    means = target_means(fold_sums(train, [column], target, F.lit(0)))
    return _attach_encoding(df, means, column, name or f"{column}_te", overall)


def category_counts(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, key, n) of the known categories of several columns in one aggregation."""
    as_text = train.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return (
        as_text.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "key")
        .where(F.col("key").isNotNull())
        .groupBy("column", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_index(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, key, value): position by falling frequency, equal counts by name."""
    counted = category_counts(train, columns).withColumn("one", F.lit(1))
    placed = prefix_sums(counted, [F.desc("n"), F.col("key")], ["one"], by=["column"])
    return placed.select("column", "key", (F.col("cum_one") - 1).cast("double").alias("value"))


def index_categories(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_idx``; unseen categories and NULL share the index after the last one."""
    index = cut(category_index(train, columns), "index")
    for column in columns:
        own = index.where(F.col("column") == column)
        size = own.agg(F.count(F.lit(1)).cast("double")).scalar()
        df = _attach_encoding(df, own, column, f"{column}_idx", size, settled=True)
    return df


def one_hot_levels(train: DataFrame, column: str) -> list[str]:
    """Levels in name order, for columns whose levels are to become column names."""
    named = F.col(f"`{column}`")
    rows = train.select(named.alias("level")).dropna().distinct().orderBy("level").collect()
    return [r.level for r in rows]


def one_hot_columns(
    df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = True
) -> DataFrame:
    """0/1 columns for the given levels; other levels and NULL are 0 everywhere."""
    dummies = {}
    for column, listed in levels.items():
        for level in listed[1 if drop_first else 0 :]:
            hit = F.coalesce(F.col(f"`{column}`") == F.lit(level), F.lit(False))
            dummies[f"{column}_{level}"] = hit.cast("int")
    return df.withColumns(dummies)


def one_hot(
    train: DataFrame, df: DataFrame, columns: Sequence[str], drop_first: bool = True
) -> DataFrame:
    """Add ``<column>_onehot``, a sparse vector over the training levels in name order.

    Any number of levels: their positions are running counts over blocks, only their number
    comes to the driver. A level unseen in training and NULL give the zero vector. The only
    level of a column is not dropped.
    """
    spark = train.sparkSession
    for column in columns:
        out, code = f"{column}_onehot", f"_{column}_code"
        levels = category_counts(train, [column]).select("key").withColumn("one", F.lit(1))
        places = cut(
            prefix_sums(levels, [F.col("key")], ["one"]).select("key", (F.col("cum_one") - 1).alias("value")),
            "levels",
        )
        n = places.count()
        first = 1 if drop_first and n > 1 else 0
        keyed = df.withColumn("key", F.col(f"`{column}`").cast("string"))
        joined = attach(keyed, places, "key", settled=True)
        # the position after the last one is the zero vector
        known = F.when(F.col("value") >= first, F.col("value") - first)
        df = joined.withColumn(code, F.coalesce(known, F.lit(n - first)).cast("double")).drop("key", "value")
        encoder = OneHotEncoder(inputCol=code, outputCol=out, dropLast=True, handleInvalid="keep")
        greatest = spark.createDataFrame([(float(max(n - first, 1) - 1),)], f"`{code}` double")
        df = encoder.fit(greatest).transform(df).drop(code)
    return df


def standardize(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores by training mean and population deviation; constant columns keep scale 1."""
    moments = train.agg(
        F.struct(
            *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(columns)],
        )
    ).scalar()
    scaled = {}
    for i, c in enumerate(columns):
        spread = F.when(moments[f"s{i}"] == 0, 1.0).otherwise(moments[f"s{i}"])
        scaled[c] = (F.col(f"`{c}`") - moments[f"m{i}"]) / spread
    return df.withColumns(scaled)


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """Balanced weights n/(2·n_class) and the ratio of negatives to positives."""
    n = F.count(target).cast("double")
    pos, neg = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    return df.agg(
        neg.alias("n_neg"),
        pos.alias("n_pos"),
        F.try_divide(n, neg * 2).alias("weight_neg"),
        F.try_divide(n, pos * 2).alias("weight_pos"),
        F.try_divide(neg.cast("double"), pos).alias("scale_pos_weight"),
    )


def with_class_weight(df: DataFrame, target: str = "target", name: str = "weight") -> DataFrame:
    w = class_weights(df, target).select(F.struct("weight_neg", "weight_pos")).scalar()
    return df.withColumn(
        name, F.when(F.col(target) == 1, w["weight_pos"]).otherwise(w["weight_neg"])
    )
