"""Metrics, ranking curves, thresholds and money over a long predictions table.

A predictions table holds one row per model and scored request:
``model, split, key, y, score, penalty``. Every operator groups by ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachline.operators.ordering import global_row_index, prefix_sums

BY = ("model",)
FALSE_ALARM_COST = 500.0
BUDGETS = (10, 15, 20, 25, 30, 40, 50)
RECOMMENDED_BUDGET = 30
TOLERANCE = -0.005

# The threshold grid starts at .05 and adds this step 89 times.
GRID_START = 0.05
GRID_STEP = (0.05 + 0.01) - 0.05
GRID_SIZE = 90


def _ratio(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    share = F.try_divide(part.cast("double"), whole)
    return share if empty is None else F.coalesce(share, F.lit(empty))


def _metric_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Rates are 0 where their denominator is empty."""
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(tp * 2, tp * 2 + fp + fn),
    }


def with_decision(pred: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    return pred.withColumn("yhat", (F.col(score) >= threshold).cast("int"))


def _quadrants(y: str = "y", yhat: str = "yhat") -> dict[str, Column]:
    real, said = F.col(y), F.col(yhat)
    return {
        "tn": F.count_if((real == 0) & (said == 0)),
        "fp": F.count_if((real == 0) & (said == 1)),
        "fn": F.count_if((real == 1) & (said == 0)),
        "tp": F.count_if((real == 1) & (said == 1)),
    }


def classification_metrics(
    decided: DataFrame, by: Sequence[str] = BY, y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    counted = decided.groupBy(*by).agg(*[v.alias(k) for k, v in _quadrants(y, yhat).items()])
    return counted.withColumns(_metric_columns(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def confusion_matrix(
    decided: DataFrame, by: Sequence[str] = BY, y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """(real, predicho, count) with the quadrant's name and share of all rows; empty cells show 0."""
    counted = decided.groupBy(*by).agg(*[v.alias(k) for k, v in _quadrants(y, yhat).items()])
    cells = F.array(
        *[
            F.struct(
                F.lit(real).alias("real"),
                F.lit(said).alias("predicho"),
                F.lit(name).alias("cuadrante"),
                F.col(column).alias("count"),
            )
            for real, said, name, column in (
                (0, 0, "VN", "tn"),
                (0, 1, "FP", "fp"),
                (1, 0, "FN", "fn"),
                (1, 1, "VP", "tp"),
            )
        ]
    )
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counted.select(*by, total.alias("_n"), F.inline(cells)).select(
        *by, "real", "predicho", "cuadrante", "count", _ratio(F.col("count") * 100, F.col("_n")).alias("pct")
    )


# ---- curves ----------------------------------------------------------------------------


def score_counts(pred: DataFrame, by: Sequence[str] = BY, y: str = "y", score: str = "score") -> DataFrame:
    """Positives and negatives at every distinct score: all later steps work on these rows."""
    return pred.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


def cumulative_counts_by_score(
    pred: DataFrame, by: Sequence[str] = BY, y: str = "y", score: str = "score"
) -> DataFrame:
    """Add ``cum_pos`` and ``cum_neg``: hits and false alarms from this score upwards.

    ``all_pos`` and ``all_neg`` hold the model's totals.
    """
    return prefix_sums(score_counts(pred, by, y, score), [F.desc("score")], ["pos", "neg"], by=by)


def ranking_summary(cumulative: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Trapezoid ROC-AUC and step-wise average precision per model.

    Both are NULL for a constant score, and NULL where a class they need is absent.
    """
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    pos, neg = F.sum("pos"), F.sum("neg")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return cumulative.groupBy(*by).agg(
        F.when(F.count(F.lit(1)) > 1, F.try_divide(area, pos.cast("double") * neg)).alias("roc_auc"),
        F.when(F.count(F.lit(1)) > 1, F.try_divide(F.sum(F.col("pos") * precision), pos)).alias(
            "average_precision"
        ),
        pos.alias("n_pos"),
        neg.alias("n_neg"),
    )


def ranking_metrics(pred: DataFrame, by: Sequence[str] = BY, y: str = "y", score: str = "score") -> DataFrame:
    return ranking_summary(cumulative_counts_by_score(pred, by, y, score), by)


def roc_curve(cumulative: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; each curve starts at the origin."""
    points = cumulative.select(
        *by,
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_neg"), F.col("all_neg"), None).alias("fpr"),
        _ratio(F.col("cum_pos"), F.col("all_pos"), None).alias("tpr"),
    )
    origin = cumulative.select(*by).distinct() if by else cumulative.limit(1)
    start = origin.select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def pr_curve(cumulative: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(threshold, recall, precision) at every distinct score."""
    return cumulative.select(
        *by,
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_pos"), F.col("all_pos"), None).alias("recall"),
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"), None).alias("precision"),
    )


def lift_curve(roc: DataFrame, low: float = 0.001, high: float = 0.50) -> DataFrame:
    """tpr over fpr between the two false-alarm rates."""
    return roc.where(F.col("fpr").between(low, high)).withColumn(
        "lift", F.col("tpr") / F.greatest("fpr", F.lit(low))
    )


def lift_by_decile(pred: DataFrame, key: str, y: str = "y", score: str = "score", parts: int = 10) -> DataFrame:
    """Positive rate of each tenth of the requests, riskiest first, over the overall rate."""
    placed = global_row_index(pred.select(key, y, score), [F.desc(score), F.col(key)])
    whole = pred.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg(y).alias("rate"))).scalar()
    part = F.floor(F.col("row_index") * parts / whole["n"]).cast("int")
    return (
        placed.groupBy((part + 1).alias("decile"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("rate"))
        .withColumn("lift", F.try_divide("rate", whole["rate"]))
    )


# ---- thresholds ------------------------------------------------------------------------


def grid_threshold(index: Column) -> Column:
    return F.lit(GRID_START) + index * F.lit(GRID_STEP)


def _grid_index(score: Column) -> Column:
    """The last grid threshold the score reaches, -1 below the grid.

    The quotient can be off by one step, so its neighbours are compared exactly.
    """
    guess = F.floor((score - GRID_START) / GRID_STEP)
    reached = (
        F.when(score >= grid_threshold(guess + 1), guess + 1)
        .when(score >= grid_threshold(guess), guess)
        .otherwise(guess - 1)
    )
    return F.greatest(F.lit(-1), F.least(F.lit(GRID_SIZE - 1), reached)).cast("int")


def threshold_sweep(
    pred: DataFrame,
    by: Sequence[str] = BY,
    y: str = "y",
    score: str = "score",
    penalty: str = "penalty",
    false_alarm_cost: float = FALSE_ALARM_COST,
) -> DataFrame:
    """Counts, rates and costs at each grid threshold that raises any alert.

    One pass over the predictions counts rows per grid step; the sums over higher steps
    then run over at most 91 rows per model.
    """
    steps = pred.groupBy(*by, _grid_index(F.col(score)).alias("step")).agg(
        F.count_if(F.col(y) == 1).alias("pos"),
        F.count_if(F.col(y) == 0).alias("neg"),
        F.sum(F.when(F.col(y) == 1, F.col(penalty)).cast("decimal(18,2)")).alias("owed"),
    )
    # every step of the grid gets a row, counted or not
    every = pred.sparkSession.range(-1, GRID_SIZE).agg(F.collect_list(F.col("id").cast("int"))).scalar()
    grid = steps.select(*by).distinct().select(*by, F.explode(every).alias("step"))
    whole = Window.partitionBy(*by)
    above = whole.orderBy(F.desc("step"))
    counted = (
        grid.join(steps, [*by, "step"], "left")
        .fillna(0, ["pos", "neg"])
        .select(
            *by,
            "step",
            F.sum("pos").over(above).alias("tp"),
            F.sum("neg").over(above).alias("fp"),
            F.sum("pos").over(whole).alias("_pos"),
            F.sum("neg").over(whole).alias("_neg"),
            (F.sum("owed").over(whole).cast("double") / F.sum("pos").over(whole)).alias("_mean_owed"),
        )
    )
    swept = counted.where((F.col("step") >= 0) & (F.col("tp") + F.col("fp") > 0)).withColumns(
        {
            "threshold": grid_threshold(F.col("step")),
            "fn": F.col("_pos") - F.col("tp"),
            "tn": F.col("_neg") - F.col("fp"),
        }
    )
    return (
        swept.withColumns(_metric_columns(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))
        .withColumns(
            {
                "costo_fn": F.col("fn") * F.col("_mean_owed"),
                "costo_fp": F.col("fp") * F.lit(false_alarm_cost),
                "pct_alertas": (F.col("tp") + F.col("fp")) * 100.0 / (F.col("_pos") + F.col("_neg")),
            }
        )
        .withColumn("costo_total", F.col("costo_fn") + F.col("costo_fp"))
        .drop("step", "_pos", "_neg", "_mean_owed")
    )


def threshold_for_budget(
    sweep: DataFrame, budgets: Sequence[float] = BUDGETS, by: Sequence[str] = BY
) -> DataFrame:
    """Per alert budget: the lowest threshold with the best recall that keeps within it."""
    kept = sweep.withColumn(
        "budget_pct", F.explode(F.array(*[F.lit(float(b)) for b in budgets]))
    ).where(F.col("pct_alertas") <= F.col("budget_pct"))
    picked = [c for c in sweep.columns if c not in by]
    best = F.min_by(F.struct(*picked), F.struct(-F.col("recall"), F.col("threshold")))
    return kept.groupBy(*by, "budget_pct").agg(best.alias("_b")).select(*by, "budget_pct", "_b.*")


# ---- money -----------------------------------------------------------------------------


def fiscal_impact(
    decided: DataFrame, by: Sequence[str] = BY, y: str = "y", yhat: str = "yhat", penalty: str = "penalty"
) -> DataFrame:
    """Loss through missed breaches, by mean penalty and by the penalties themselves."""
    breach = F.col(y) == 1
    owed = F.sum(F.when(breach, F.col(penalty)).cast("decimal(18,2)")).cast("double")
    missed = F.sum(F.when(breach & (F.col(yhat) == 0), F.col(penalty)).cast("decimal(18,2)"))
    counted = decided.groupBy(*by).agg(
        *[v.alias(k) for k, v in _quadrants(y, yhat).items()],
        F.coalesce(owed, F.lit(0.0)).alias("exposure_usd"),
        F.coalesce(missed.cast("double"), F.lit(0.0)).alias("true_loss_usd"),
    )
    mean = F.coalesce(F.try_divide("exposure_usd", F.col("fn") + F.col("tp")), F.lit(0.0))
    return (
        counted.withColumn("mean_penalty_usd", mean)
        .withColumn("loss_usd", F.col("fn") * F.col("mean_penalty_usd"))
        .withColumns(
            {
                "saving_usd": F.col("exposure_usd") - F.col("loss_usd"),
                "true_saving_usd": F.col("exposure_usd") - F.col("true_loss_usd"),
            }
        )
        .withColumns(
            {
                "avoided_pct": F.try_divide(F.col("saving_usd") * 100, F.col("exposure_usd")),
                "true_avoided_pct": F.try_divide(F.col("true_saving_usd") * 100, F.col("exposure_usd")),
            }
        )
    )


def fiscal_scenarios(impact: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The three bars of the loss chart as (escenario, perdida_usd)."""
    bars = F.array(
        *[
            F.struct(F.lit(name).alias("escenario"), F.col(column).alias("perdida_usd"))
            for name, column in (
                ("Sin modelo (todo incumple)", "exposure_usd"),
                ("Ahorro estimado", "saving_usd"),
                ("Con modelo final", "loss_usd"),
            )
        ]
    )
    return impact.select(*by, F.inline(bars))


def least_loss(impact: DataFrame, key: str = "model") -> DataFrame:
    return impact.agg(
        F.min_by(key, F.struct("loss_usd", key)).alias(key), F.min("loss_usd").alias("loss_usd")
    )


# ---- model tables ----------------------------------------------------------------------


def model_metrics(pred: DataFrame, threshold: float = 0.5, by: Sequence[str] = BY) -> DataFrame:
    """Threshold metrics and ranking metrics of every model in one table."""
    ranking = ranking_metrics(pred, by).select(*by, "roc_auc", "average_precision")
    decided = classification_metrics(with_decision(pred, threshold), by)
    return decided.join(ranking, list(by)).select(
        *by, "average_precision", "roc_auc", "f1", "recall", "precision", "accuracy"
    )


def metrics_table(metrics: DataFrame, final_model: str) -> DataFrame:
    """The ranking table the model page reads."""
    return metrics.select(
        F.col("model").alias("modelo"),
        F.col("average_precision").alias("pR_AUC"),
        F.col("roc_auc").alias("roc_AUC"),
        "f1",
        "recall",
        "precision",
        (F.col("model") == final_model).alias("es_final"),
    )


def compare_strategies(
    metrics: DataFrame, metric: str, family: str, strategy: str, strategies: Sequence[str]
) -> DataFrame:
    """One metric as a family × balancing-strategy matrix with the best strategy."""
    matrix = metrics.groupBy(family).pivot(strategy, list(strategies)).agg(F.max(metric))
    best = F.greatest(*[F.col(f"`{s}`") for s in strategies])
    pick = F.coalesce(*[F.when(F.col(f"`{s}`") == best, F.lit(s)) for s in strategies])
    return matrix.withColumn("best", pick)


def compare_pairs(
    metrics: DataFrame,
    pairs: Sequence[tuple[str, str]],
    metric: str = "average_precision",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Base against variant: difference, whether it stays in tolerance, and the winner.

    The base wins ties.
    """
    spark = metrics.sparkSession
    wanted = spark.createDataFrame(list(pairs), "base string, variant string")
    values = metrics.select("model", F.col(metric).alias("value"))
    return (
        wanted.join(values.withColumnsRenamed({"model": "base", "value": "base_value"}), "base")
        .join(values.withColumnsRenamed({"model": "variant", "value": "variant_value"}), "variant")
        .withColumn("delta", F.col("variant_value") - F.col("base_value"))
        .withColumns(
            {
                "acceptable": F.col("delta") >= tolerance,
                "winner": F.when(F.col("base_value") >= F.col("variant_value"), F.col("base")).otherwise(
                    F.col("variant")
                ),
            }
        )
        .select("base", "variant", "base_value", "variant_value", "delta", "acceptable", "winner")
    )


def generalization(val: DataFrame, test: DataFrame, metric: str = "metrica") -> DataFrame:
    """Metrics on validation and test side by side, with the overall verdict."""
    joined = (
        val.select(metric, F.col("value").alias("val"))
        .join(test.select(metric, F.col("value").alias("test")), metric)
        .withColumn("delta", F.col("test") - F.col("val"))
    )
    worst = joined.agg(F.max(F.abs("delta"))).scalar()
    verdict = (
        F.when(worst < 0.02, "EXCELENTE")
        .when(worst < 0.05, "BUENA")
        .when(worst < 0.10, "MODERADA")
        .otherwise("ATENCIÓN")
    )
    return joined.withColumns({"stable": F.col("delta") >= TOLERANCE, "verdict": verdict})
