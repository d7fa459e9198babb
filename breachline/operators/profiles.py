"""Per-column quality profiles, computed in one or two passes for any number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachline.functions.text import SENTINEL
from breachline.operators.cleaning import select_by_type
from breachline.operators.ordering import discrete_quantiles_of, exact_quantiles, value_counts
from breachline.settings import cut


#: Buckets of a sketch of distinct values, as a power of two.
SKETCH_LOG_BUCKETS = 14


def _quoted(names: Sequence[str]) -> list:
    return [F.col(f"`{c}`") for c in names]


def _one_row_per_column(wide: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    return wide.unpivot([], _quoted(names), "columna", value)


def field_table(df: DataFrame) -> DataFrame:
    """(columna, tipo_dato) from the schema; one row per column."""
    rows = [(f.name, str(f.dataType), isinstance(f.dataType, T.StringType)) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "columna string, tipo_dato string, is_text boolean")


def audit_step(df: DataFrame, kept) -> DataFrame:
    """Rows before, after and removed by a filter condition, counted in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counted.select(
        "rows_before",
        "rows_after",
        removed.alias("rows_removed"),
        F.try_divide(removed * 100.0, F.col("rows_before")).alias("pct_removed"),
    )


def audit_dedupe(df: DataFrame, key: str) -> DataFrame:
    """The same audit for a de-duplication by key."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, kept = F.sum("n"), F.count(F.lit(1))
    return groups.agg(
        F.coalesce(total, F.lit(0)).alias("rows_before"),
        kept.alias("rows_after"),
        F.coalesce(total - kept, F.lit(0)).alias("rows_removed"),
        F.try_divide((total - kept) * 100.0, total).alias("pct_removed"),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*_quoted(df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def value_range(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(column).alias("first_value"), F.max(column).alias("last_value"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column: one aggregation, then one row per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    long = wide.unpivot(["_rows"], _quoted(df.columns), "columna", "nulos_n")
    return long.select(
        "columna", "nulos_n", F.try_divide(F.col("nulos_n") * 100.0, F.col("_rows")).alias("nulos_pct")
    ).orderBy(F.desc("nulos_n"), "columna")


def drop_sparse_columns(df: DataFrame, max_null_pct: float = 30.0) -> DataFrame:
    """Drop columns whose NULL share exceeds the limit. Reads one number per column."""
    sparse = null_profile(df).where(F.col("nulos_pct") > max_null_pct).select("columna")
    return df.drop(*[row.columna for row in sparse.collect()])


def _as_text(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        column = column + F.lit(0).cast(field.dataType)  # -0.0 and 0.0 are one value
    return column.cast("string")


def text_value_counts(df: DataFrame) -> DataFrame:
    """(columna, valor, n) over all columns, NULL being one of the values."""

    as_text = df.select(*[_as_text(field).alias(field.name) for field in df.schema])
    return (
        as_text.unpivot([], _quoted(df.columns), "columna", "valor")
        .groupBy("columna", "valor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def missing_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, missing values, their share, distinct values and rows of every column.

    Exact distinct counts come from one two-step aggregation over (column, value);
    ``approximate`` keeps everything in a single pass of sketches instead. An empty table
    has a row of zeros per column, without a share.
    """
    fields = field_table(df)
    if approximate:
        per_column = sketched_counts(profile_sketch(df))
    else:
        gone = F.col("valor").isNull() | (F.col("is_text") & F.col("valor").isin("", SENTINEL))
        per_column = (
            text_value_counts(df)
            .join(F.broadcast(fields.select("columna", "is_text")), "columna")  # schema-sized
            .groupBy("columna")
            .agg(
                F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("nulos_n"),
                F.count(F.lit(1)).alias("unicos_n"),
                F.sum("n").alias("total_filas_dataset"),
            )
        )
    counts = {n: F.coalesce(F.col(n), F.lit(0)) for n in ("nulos_n", "unicos_n", "total_filas_dataset")}
    share = F.try_divide(counts["nulos_n"] * 100.0, counts["total_filas_dataset"])
    return fields.join(per_column, "columna", "left").select(
        "columna",
        "tipo_dato",
        counts["nulos_n"].alias("nulos_n"),
        F.round(share, 2).alias("nulos_pct"),
        counts["unicos_n"].alias("unicos_n"),
        counts["total_filas_dataset"].alias("total_filas_dataset"),
    )


def profile_sketch(df: DataFrame, log_buckets: int = SKETCH_LOG_BUCKETS) -> DataFrame:
    """One small row per column from one pass: counts, and a sketch of the distinct values.

    Stored beside a load, it is all that a profile needs of it: the profile of a layer is
    ``merged_sketches`` over the rows of its loads, without reading the loads again.
    """
    metrics = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        gone = column.isNull()
        if isinstance(field.dataType, T.StringType):
            gone = gone | column.isin("", SENTINEL)
        metrics.append(
            F.struct(
                F.lit(field.name).alias("columna"),
                F.lit(str(field.dataType)).alias("tipo_dato"),
                F.count_if(gone).alias("nulos_n"),
                F.count_if(column.isNull()).alias("sin_valor_n"),
                F.count(F.lit(1)).alias("total_filas_dataset"),
                # an empty text is a value too, but sketches leave empty ones out
                F.hll_sketch_agg(F.concat(F.lit("="), _as_text(field)), F.lit(log_buckets)).alias("sketch"),
            )
        )
    return df.agg(F.array(*metrics).alias("m")).select(F.inline("m"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The same row per column for all loads whose sketches are given."""
    return sketches.groupBy("columna", "tipo_dato").agg(
        *[F.sum(c).alias(c) for c in ("nulos_n", "sin_valor_n", "total_filas_dataset")],
        F.hll_union_agg("sketch").alias("sketch"),
    )


def sketched_counts(sketches: DataFrame) -> DataFrame:
    """``columna, nulos_n, unicos_n, total_filas_dataset`` of sketches, NULL being a value.

    The distinct count of ``2 ** log_buckets`` buckets has a relative deviation of about
    ``1.04 / 2 ** (log_buckets / 2)``; three of them are 2.5 % with the default.
    """
    distinct = F.hll_sketch_estimate("sketch") + (F.col("sin_valor_n") > 0).cast("long")
    return sketches.select("columna", "nulos_n", distinct.alias("unicos_n"), "total_filas_dataset")


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Tukey fences per numeric column and the values strictly outside them.

    Quartiles are exact (the least value with a quarter of the rows at or below it). They
    and the values outside come from one table of value counts, whatever the columns.
    """
    columns = list(columns or select_by_type(df))
    counts = cut(value_counts(df, columns), "value-counts")
    quartiles = discrete_quantiles_of(counts, [0.25, 0.75])
    reach = (F.col("q_1") - F.col("q_0")) * 1.5
    fences = quartiles.select(
        "columna", (F.col("q_0") - reach).alias("low"), (F.col("q_1") + reach).alias("high")
    )
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    found = counts.join(F.broadcast(fences), "columna").groupBy("columna").agg(  # a row per column
        F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers_n"),
        F.max("low").alias("low"),
        F.max("high").alias("high"),
    )
    named = df.agg(F.count(F.lit(1)).alias("_rows")).select(
        "_rows", F.explode(F.array(*map(F.lit, columns))).alias("columna")
    )
    n = F.coalesce("outliers_n", F.lit(0))
    return named.join(found, "columna", "left").select(
        "columna",
        n.alias("outliers_n"),
        F.round(F.try_divide(n * 100.0, F.col("_rows")), 2).alias("outliers_pct"),
        F.coalesce("low", F.lit(0.0)).alias("iqr_lower"),
        F.coalesce("high", F.lit(0.0)).alias("iqr_upper"),
    )


def health_report(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Missing values, distinct values, outliers and table-wide duplicates, per column."""
    duplicates = duplicate_count(df).select("duplicate_rows").scalar()
    outliers = iqr_outliers(df)
    return (
        missing_profile(df, approximate)
        .join(F.broadcast(outliers), "columna", "left")  # one row per numeric column
        .select(
            "columna",
            "tipo_dato",
            "nulos_n",
            "nulos_pct",
            "unicos_n",
            F.coalesce("outliers_n", F.lit(0)).alias("outliers_n"),
            F.coalesce("outliers_pct", F.lit(0.0)).alias("outliers_pct"),
            F.coalesce("iqr_lower", F.lit(0.0)).alias("iqr_lower"),
            F.coalesce("iqr_upper", F.lit(0.0)).alias("iqr_upper"),
            "total_filas_dataset",
            duplicates.alias("duplicados_dataset"),
        )
    )


def eda_report(df: DataFrame) -> DataFrame:
    """Least, greatest, mean and most frequent value of every column, as text.

    The most frequent value is the least text among those with the highest count.
    """
    numeric = select_by_type(df)
    moda = (
        text_value_counts(df)
        .where(F.col("valor").isNotNull())
        .groupBy("columna")
        .agg(F.min_by("valor", F.struct(-F.col("n"), "valor")).alias("moda"))
    )
    extremes = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("columna"),
                    F.min(F.col(f"`{c}`")).cast("string").alias("minimo"),
                    F.max(F.col(f"`{c}`")).cast("string").alias("maximo"),
                    (
                        F.round(F.avg(F.col(f"`{c}`")), 4).cast("string")
                        if c in numeric
                        else F.lit(None).cast("string")
                    ).alias("media"),
                )
                for c in df.columns
            ]
        ).alias("m")
    ).select(F.inline("m"))
    return extremes.join(moda, "columna", "left")


def skewness_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int = 22) -> DataFrame:
    """Absolute bias-corrected skewness, greatest first; defined from three values on."""
    columns = list(columns or select_by_type(df))
    wide = []
    for c in columns:
        n = F.count(F.col(f"`{c}`")).cast("double")
        corrected = F.skewness(F.col(f"`{c}`")) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
        # a constant column is not skewed; Spark leaves its skewness undefined
        settled = F.when(n > 2, F.coalesce(F.nanvl(corrected, F.lit(0.0)), F.lit(0.0)))
        wide.append(F.abs(settled).alias(c))
    long = _one_row_per_column(df.agg(*wide), columns, "abs_skew").where(F.col("abs_skew").isNotNull())
    level = F.when(F.col("abs_skew") > 2, "severe").when(F.col("abs_skew") > 1, "moderate").otherwise("ok")
    return long.withColumn("level", level).orderBy(F.desc("abs_skew"), "columna").limit(top)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    """count, mean, std, min, interpolated quartiles and max of every numeric column."""
    columns = list(columns or select_by_type(df))
    moments = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("columna"),
                    F.count(F.col(f"`{c}`")).alias("count"),
                    F.round(F.avg(F.col(f"`{c}`")), digits).alias("mean"),
                    F.round(F.stddev(F.col(f"`{c}`")), digits).alias("std"),
                    F.round(F.min(F.col(f"`{c}`")).cast("double"), digits).alias("min"),
                    F.round(F.max(F.col(f"`{c}`")).cast("double"), digits).alias("max"),
                )
                for c in columns
            ]
        ).alias("m")
    ).select(F.inline("m"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "columna", *[F.round(f"q_{i}", digits).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    )
    return moments.join(quartiles, "columna", "left")


