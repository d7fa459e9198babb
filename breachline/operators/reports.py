"""Analytics over quality reports. A report has one row per profiled column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.functions.sla import clip

TARGET_SCORE = 80.0


def quality_score(report: DataFrame) -> DataFrame:
    """100 minus the mean share of missing values, not below 0."""
    return report.agg(F.greatest(F.lit(0.0), 100 - F.avg("nulos_pct")).alias("score"))


def gold_quality_score(df: DataFrame) -> DataFrame:
    """The same score straight from a table, counting NULL only, in one aggregation."""
    share = sum((F.avg(F.col(f"`{c}`").isNull().cast("double")) for c in df.columns), F.lit(0.0))
    mean_pct = share / len(df.columns) * 100
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        mean_pct.alias("mean_null_pct"),
        F.greatest(F.lit(0.0), 100 - mean_pct).alias("score"),
    )


def quality_band(score: Column) -> dict[str, Column]:
    """Colour of the score, its band on the gauge and whether it meets the target."""
    return {
        "color": F.when(score >= 85, "success").when(score >= 60, "warning").otherwise("danger"),
        "band": F.when(score >= 80, "Óptimo").when(score >= 50, "Aceptable").otherwise("Crítico"),
        "meets_target": score >= TARGET_SCORE,
    }


def null_severity(pct: Column) -> Column:
    return F.when(pct == 0, "ok").when(pct < 10, "warn").when(pct < 30, "orange").otherwise("bad")


def null_chip(pct: Column) -> Column:
    return F.when(pct == 0, "chip-ok").when(pct < 10, "chip-warn").otherwise("chip-bad")


def type_family_quality(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("tipo_dato")
        .agg(F.count("columna").alias("n_campos"), F.avg("nulos_pct").alias("nulidad_prom"))
        .withColumn("completitud", 100 - F.col("nulidad_prom"))
        .orderBy(F.desc("nulidad_prom"), "tipo_dato")
    )


def outlier_severity(report: DataFrame) -> DataFrame:
    """Fields with outliers, graded against the quartiles of their counts."""
    found = report.where(F.col("outliers_n") > 0)
    cuts = found.agg(F.percentile("outliers_n", F.array(F.lit(0.25), F.lit(0.75)))).scalar()
    level = (
        F.when(F.col("outliers_n") > cuts[1], "danger")
        .when(F.col("outliers_n") > cuts[0], "warning")
        .otherwise("low")
    )
    return found.select("columna", "outliers_n", level.alias("severity")).orderBy(
        F.desc("outliers_n"), "columna"
    )


def cardinality_profile(report: DataFrame) -> DataFrame:
    share = F.round(F.col("unicos_n") * 100.0 / F.col("total_filas_dataset"), 1)
    return report.select("columna", "unicos_n", share.alias("unicos_pct")).orderBy(
        F.desc("unicos_n"), "columna"
    )


def completeness_rank(report: DataFrame) -> DataFrame:
    """Completeness, its colour and the quartile class of the distinct count."""
    cuts = report.agg(
        F.percentile("unicos_n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    ).scalar()
    complete = clip(100 - F.col("nulos_pct"), 0.0, 100.0)
    size = (
        F.when(F.col("unicos_n") <= cuts[0], "baja")
        .when(F.col("unicos_n") <= cuts[1], "media")
        .when(F.col("unicos_n") <= cuts[2], "alta")
        .otherwise("muy alta")
    )
    color = F.when(complete >= 90, "success").when(complete >= 60, "warning").otherwise("danger")
    return report.select(
        "columna",
        complete.alias("completitud"),
        "unicos_n",
        size.alias("cardinalidad"),
        color.alias("color"),
    ).orderBy("completitud", "columna")


def _side(report: DataFrame, suffix: str, columns: Sequence[str]) -> DataFrame:
    return report.select("columna", *[F.col(c).alias(f"{c}_{suffix}") for c in columns])


def _common(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _side(first, "b", columns).join(_side(second, "s", columns), "columna")


def layer_completeness_delta(
    first: DataFrame, second: DataFrame, top: int = 20, at_least: int = 3
) -> DataFrame:
    """Completeness of the first ``top`` common fields by name in both layers.

    Empty when the layers share fewer than ``at_least`` fields.
    """
    common = _common(first, second, ["nulos_pct"])
    enough = common.agg(F.count(F.lit(1))).scalar() >= at_least
    before = clip(100 - F.coalesce("nulos_pct_b", F.lit(0.0)), 0.0, 100.0)
    after = clip(100 - F.coalesce("nulos_pct_s", F.lit(0.0)), 0.0, 100.0)
    return (
        common.where(enough)
        .select(
            "columna",
            before.alias("completitud_b"),
            after.alias("completitud_s"),
            (after - before).alias("delta_pp"),
        )
        .withColumns(
            {
                "emphasised": F.abs("delta_pp") > 5,
                "labelled": F.abs("delta_pp") > 10,
                "improved": F.col("delta_pp") >= 0,
            }
        )
        .orderBy("columna")
        .limit(top)
    )


def layer_null_delta(first: DataFrame, second: DataFrame, top: int = 20) -> DataFrame:
    """Fields whose missing share changed most for the better, first."""
    delta = F.col("nulos_pct_b") - F.col("nulos_pct_s")
    sign = F.when(delta > 0, "mejora").when(delta == 0, "igual").otherwise("regresión")
    return (
        _common(first, second, ["nulos_pct"])
        .withColumns({"delta": delta, "direction": sign})
        .orderBy(F.desc("delta"), "columna")
        .limit(top)
    )


def layer_scoreboard(first: DataFrame, second: DataFrame) -> DataFrame:
    delta = F.round(F.col("nulos_pct_s") - F.col("nulos_pct_b"), 2)
    state = F.when(delta < 0, "Mejoró").when(delta == 0, "Igual").otherwise("Empeoró")
    return (
        _common(first, second, ["nulos_pct", "unicos_n"])
        .withColumns({"delta_nulos_pct": delta, "estado": state})
        .orderBy("delta_nulos_pct", "columna")
    )


def layer_overview(first: DataFrame, second: DataFrame) -> DataFrame:
    """Scores, their change, field overlap and the share of rows the second layer lost."""
    sides = ["nulos_pct", "total_filas_dataset"]
    both = (
        _side(first, "b", sides)
        .withColumn("_in_b", F.lit(True))
        .join(_side(second, "s", sides).withColumn("_in_s", F.lit(True)), "columna", "full")
    )
    score_b = F.greatest(F.lit(0.0), 100 - F.avg("nulos_pct_b"))
    score_s = F.greatest(F.lit(0.0), 100 - F.avg("nulos_pct_s"))
    rows_b, rows_s = F.max("total_filas_dataset_b"), F.max("total_filas_dataset_s")
    in_b, in_s = F.col("_in_b").isNotNull(), F.col("_in_s").isNotNull()
    return both.agg(
        score_b.alias("score_b"),
        score_s.alias("score_s"),
        (score_s - score_b).alias("delta_score"),
        F.count_if(in_b & in_s).alias("n_common"),
        F.count_if(in_b & ~in_s).alias("n_only_b"),
        F.count_if(~in_b & in_s).alias("n_only_s"),
        F.try_divide((rows_b - rows_s) * 100.0, rows_b).alias("reduction_pct"),
    )


def metric_long(
    layers: dict[str, DataFrame], metric: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """One metric of several layers stacked as (columna, value, capa).

    ``fields=None`` keeps the fields all layers share.
    """
    reports = list(layers.items())
    if fields is None:
        shared = reports[0][1].select("columna")
        for _, other in reports[1:]:
            shared = shared.join(other.select("columna"), "columna", "left_semi")
    stacked = None
    for tag, report in reports:
        picked = report.select("columna", F.col(metric).alias("value"), F.lit(tag).alias("capa"))
        if fields is None:
            picked = picked.join(shared, "columna", "left_semi")
        elif fields:
            picked = picked.where(F.col("columna").isin(*fields))
        stacked = picked if stacked is None else stacked.unionByName(picked)
    return stacked.where(F.col("value").isNotNull())


def leading_values(report: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The most frequent value of selected fields, matched without regard to letter case."""
    wanted = [f.lower() for f in fields]
    return report.where(F.lower("columna").isin(*wanted)).select("columna", "moda")


def detail_table(report: DataFrame) -> DataFrame:
    wanted = ["columna", "tipo_dato", "nulos_n", "nulos_pct", "unicos_n", "outliers_n"]
    return report.select(*[c for c in wanted if c in report.columns]).orderBy(
        F.desc("nulos_pct"), "columna"
    )
