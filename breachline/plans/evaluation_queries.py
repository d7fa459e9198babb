"""Queries over predictions: metrics, curves, thresholds and money."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.operators import dashboards as D
from breachline.operators import evaluation as V
from breachline.operators.scoring import priority_and_risk
from breachline.plans.fixture import rounded, table
from breachline.plans.registry import query
from breachline.settings import cut

# Two stand-in models: one with few distinct scores, one with many. A third is constant.
SCORES = {
    "ties": "(l_discount + l_tax) * 5",
    "fine": "l_extendedprice / 110000",
    "flat": "CAST(0.5 AS DOUBLE)",
}
PREDICTIONS = (
    "pred AS ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, CASE WHEN l_suppkey % 2 = 0 THEN 'val' ELSE 'test' END AS split,"
        f" l_orderkey * 10 + l_linenumber AS key, CAST(l_returnflag = 'R' AS INTEGER) AS y, {s} AS score,"
        f" CASE WHEN l_returnflag = 'R' THEN l_quantity * 1000 ELSE 0 END AS penalty FROM lineitem"
        for m, s in SCORES.items()
    )
    + ")"
)
COUNTS = f"""{PREDICTIONS},
counts AS (SELECT model, score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM pred GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM counts
        WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
tot AS (SELECT model, sum(pos) AS p, sum(neg) AS n FROM counts GROUP BY 1)"""


def predictions(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    scores = F.array(
        *[F.struct(F.lit(m).alias("model"), F.expr(s).cast("double").alias("score")) for m, s in SCORES.items()]
    )
    late = F.col("l_returnflag") == "R"
    return items.select(
        F.when(F.col("l_suppkey") % 2 == 0, "val").otherwise("test").alias("split"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"),
        late.cast("int").alias("y"),
        F.when(late, F.col("l_quantity") * 1000).otherwise(0.0).alias("penalty"),
        F.inline(scores),
    )


def _metrics_sql(threshold: str = "0.5", by: str = "model") -> str:
    return f"""q AS (SELECT {by}, count_if(y = 1 AND score >= {threshold}) AS tp, count_if(y = 0 AND score >= {threshold}) AS fp,
  count_if(y = 1 AND score < {threshold}) AS fn, count_if(y = 0 AND score < {threshold}) AS tn,
  CAST(sum(CAST(CASE WHEN y = 1 THEN penalty END AS DECIMAL(18,2))) AS DOUBLE) AS owed,
  CAST(coalesce(sum(CAST(CASE WHEN y = 1 AND score < {threshold} THEN penalty END AS DECIMAL(18,2))), 0) AS DOUBLE) AS missed
  FROM pred GROUP BY {by}),
m AS (SELECT *, (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision,
  coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall, coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1 FROM q)"""


RANKING = """rank_m AS (
  SELECT cum.model, CASE WHEN count(*) > 1 THEN sum(neg * (cum_pos - pos / 2.0)) / (CAST(max(p) AS DOUBLE) * max(n)) END AS roc_auc,
         CASE WHEN count(*) > 1 THEN sum(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) / max(p) END AS average_precision
  FROM cum JOIN tot ON tot.model = cum.model GROUP BY 1)"""


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql()}
SELECT model, tn, fp, fn, tp, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m"""
)
def classification_metrics(spark, sf_dir):
    return rounded(V.classification_metrics(V.with_decision(predictions(spark, sf_dir))))


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql()}
SELECT model, unnest([0, 0, 1, 1]) AS real, unnest([0, 1, 0, 1]) AS predicho, unnest(['VN', 'FP', 'FN', 'VP']) AS cuadrante,
       unnest([tn, fp, fn, tp]) AS count, round(unnest([tn, fp, fn, tp]) * 100.0 / (tn + fp + fn + tp), 6) AS pct FROM m"""
)
def confusion_matrix(spark, sf_dir):
    return rounded(V.confusion_matrix(V.with_decision(predictions(spark, sf_dir))))


@query(
    """SELECT quality AS real, toxic AS predicho, CASE WHEN quality = 0 AND toxic = 0 THEN 'VN' WHEN quality = 0 THEN 'FP' WHEN toxic = 0 THEN 'FN' ELSE 'VP' END AS cuadrante,
       count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM labels GROUP BY 1, 2"""
)
def label_confusion(spark, sf_dir):
    matrix = V.confusion_matrix(table(spark, sf_dir, "labels"), by=(), y="quality", yhat="toxic")
    return rounded(matrix.where(F.col("count") > 0))


@query(f"WITH {COUNTS} SELECT cum.model, score, pos, neg, CAST(cum_pos AS BIGINT) AS cum_pos, CAST(cum_neg AS BIGINT) AS cum_neg, CAST(p AS BIGINT) AS all_pos, CAST(n AS BIGINT) AS all_neg FROM cum JOIN tot ON tot.model = cum.model")
def cumulative_counts(spark, sf_dir):
    return V.cumulative_counts_by_score(predictions(spark, sf_dir))


@query(
    f"""WITH {COUNTS}, {RANKING}
SELECT rank_m.model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision,
       CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg FROM rank_m JOIN tot ON tot.model = rank_m.model"""
)
def ranking_metrics(spark, sf_dir):
    return rounded(V.ranking_metrics(predictions(spark, sf_dir)))


@query(
    f"""WITH {COUNTS}
SELECT cum.model, score AS threshold, round(cum_neg / CAST(n AS DOUBLE), 6) AS fpr, round(cum_pos / CAST(p AS DOUBLE), 6) AS tpr
FROM cum JOIN tot ON tot.model = cum.model UNION ALL SELECT model, CAST('inf' AS DOUBLE), 0, 0 FROM tot"""
)
def roc_curve(spark, sf_dir):
    points = V.roc_curve(V.cumulative_counts_by_score(predictions(spark, sf_dir)))
    return points.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


@query(
    f"""WITH {COUNTS}
SELECT cum.model, score AS threshold, round(cum_pos / CAST(p AS DOUBLE), 6) AS recall,
       round(cum_pos / CAST(cum_pos + cum_neg AS DOUBLE), 6) AS precision FROM cum JOIN tot ON tot.model = cum.model"""
)
def pr_curve(spark, sf_dir):
    points = V.pr_curve(V.cumulative_counts_by_score(predictions(spark, sf_dir)))
    return points.withColumns({"recall": F.round("recall", 6), "precision": F.round("precision", 6)})


@query(
    f"""WITH {COUNTS}, r AS (SELECT cum.model, score AS threshold, cum_neg / CAST(n AS DOUBLE) AS fpr, cum_pos / CAST(p AS DOUBLE) AS tpr
FROM cum JOIN tot ON tot.model = cum.model)
SELECT model, threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(tpr / greatest(fpr, 0.001), 4) AS lift FROM r WHERE fpr BETWEEN 0.001 AND 0.5"""
)
def lift_curve(spark, sf_dir):
    lift = V.lift_curve(V.roc_curve(V.cumulative_counts_by_score(predictions(spark, sf_dir))))
    return lift.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6), "lift": F.round("lift", 4)})


@query(
    """WITH e AS (SELECT CAST(event_type = 'error' AS INTEGER) AS y, row_number() OVER (ORDER BY value DESC, event_id) - 1 AS p, count(*) OVER () AS n FROM events)
SELECT CAST(p * 10 // n + 1 AS INTEGER) AS decile, count(*) AS n, round(avg(y), 6) AS rate, round(avg(y) / (SELECT avg(y) FROM e), 6) AS lift
FROM e GROUP BY 1"""
)
def lift_by_decile(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"),
        (F.col("event_type") == "error").cast("int").alias("y"),
        F.col("value").alias("score"),
    )
    return rounded(V.lift_by_decile(events, "key"))


SWEEP = f"""{PREDICTIONS},
grid AS (SELECT CAST(0.05 AS DOUBLE) + i * ((CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE)) - CAST(0.05 AS DOUBLE)) AS threshold FROM range(90) r(i)),
owed AS (SELECT model, CAST(sum(CAST(CASE WHEN y = 1 THEN penalty END AS DECIMAL(18,2))) AS DOUBLE) / count_if(y = 1) AS mean_owed FROM pred GROUP BY 1),
q AS (SELECT model, threshold, count_if(y = 1 AND score >= threshold) AS tp, count_if(y = 0 AND score >= threshold) AS fp,
             count_if(y = 1 AND score < threshold) AS fn, count_if(y = 0 AND score < threshold) AS tn
      FROM pred, grid GROUP BY 1, 2 HAVING tp + fp > 0),
sweep AS (SELECT q.model, threshold, tp, fp, fn, tn, round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy,
  round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
  round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1, round(fn * mean_owed, 2) AS costo_fn, fp * CAST(500 AS DOUBLE) AS costo_fp,
  round(fn * mean_owed + fp * 500, 2) AS costo_total, round((tp + fp) * 100.0 / (tp + fp + fn + tn), 6) AS pct_alertas
  FROM q JOIN owed ON owed.model = q.model)"""


def _shown(sweep):
    money = ["costo_fn", "costo_fp", "costo_total"]
    rates = ["accuracy", "precision", "recall", "f1", "pct_alertas"]
    return sweep.withColumns(
        {**{c: F.round(c, 2) for c in money}, **{c: F.round(c, 6) for c in rates}}
    )


@query(f"WITH {SWEEP} SELECT * FROM sweep")
def threshold_sweep(spark, sf_dir):
    return _shown(V.threshold_sweep(predictions(spark, sf_dir)))


@query(
    f"""WITH {SWEEP}, b AS (SELECT *, row_number() OVER (PARTITION BY model, budget_pct ORDER BY recall DESC, threshold) AS place
  FROM (SELECT sweep.*, unnest([10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0])::DOUBLE AS budget_pct FROM sweep) WHERE pct_alertas <= budget_pct)
SELECT * EXCLUDE (place) FROM b WHERE place = 1"""
)
def thresholds_for_budgets(spark, sf_dir):
    return _shown(V.threshold_for_budget(V.threshold_sweep(predictions(spark, sf_dir))))


IMPACT = """i AS (SELECT model, tn, fp, fn, tp, owed AS exposure_usd, missed AS true_loss_usd, owed / (fn + tp) AS mean_penalty_usd,
  fn * (owed / (fn + tp)) AS loss_usd FROM m)"""


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql()}, {IMPACT}
SELECT model, tn, fp, fn, tp, exposure_usd, true_loss_usd, round(mean_penalty_usd, 2) AS mean_penalty_usd, round(loss_usd, 2) AS loss_usd,
       round(exposure_usd - loss_usd, 2) AS saving_usd, round(exposure_usd - true_loss_usd, 2) AS true_saving_usd,
       round((exposure_usd - loss_usd) * 100 / exposure_usd, 2) AS avoided_pct,
       round((exposure_usd - true_loss_usd) * 100 / exposure_usd, 2) AS true_avoided_pct FROM i"""
)
def fiscal_impact(spark, sf_dir):
    return rounded(V.fiscal_impact(V.with_decision(predictions(spark, sf_dir))), 2)


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql()}, {IMPACT}
SELECT model, unnest(['Sin modelo (todo incumple)', 'Ahorro estimado', 'Con modelo final']) AS escenario,
       round(unnest([exposure_usd, exposure_usd - loss_usd, loss_usd]), 2) AS perdida_usd FROM i"""
)
def fiscal_scenarios(spark, sf_dir):
    return rounded(V.fiscal_scenarios(V.fiscal_impact(V.with_decision(predictions(spark, sf_dir)))), 2)


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql()}, {IMPACT} SELECT model, round(loss_usd, 2) AS loss_usd FROM i ORDER BY loss_usd, model LIMIT 1"""
)
def least_loss_model(spark, sf_dir):
    return rounded(V.least_loss(V.fiscal_impact(V.with_decision(predictions(spark, sf_dir)))), 2)


METRICS = f"""{COUNTS}, {RANKING}, {_metrics_sql()},
metrics AS (SELECT m.model, average_precision, roc_auc, f1, recall, precision, accuracy FROM m JOIN rank_m ON rank_m.model = m.model)"""


@query(
    f"""WITH {METRICS}
SELECT model AS modelo, round(average_precision, 6) AS "pR_AUC", round(roc_auc, 6) AS "roc_AUC", round(f1, 6) AS f1,
       round(recall, 6) AS recall, round(precision, 6) AS precision, model = 'fine' AS es_final FROM metrics"""
)
def model_ranking(spark, sf_dir):
    metrics = V.model_metrics(predictions(spark, sf_dir))
    return rounded(D.ranked(V.metrics_table(metrics, "fine"), "pR_AUC", "modelo"))


@query(
    f"""WITH {METRICS}, w AS (SELECT * FROM metrics WHERE model = 'fine'), b AS (SELECT * FROM metrics WHERE model = 'ties'), c AS (SELECT * FROM metrics WHERE model = 'flat')
SELECT 'demo' AS family, round(b.f1, 6) AS base, round(w.f1, 6) AS balanced, round(c.f1, 6) AS smote,
       CASE WHEN b.f1 >= greatest(w.f1, c.f1) THEN 'base' WHEN w.f1 >= c.f1 THEN 'balanced' ELSE 'smote' END AS best FROM w, b, c"""
)
def strategy_matrix(spark, sf_dir):
    from breachline.functions.text import recode

    names = {"ties": "base", "fine": "balanced", "flat": "smote"}
    metrics = V.classification_metrics(V.with_decision(predictions(spark, sf_dir))).select(
        F.lit("demo").alias("family"), recode(F.col("model"), names).alias("strategy"), "f1"
    )
    return rounded(V.compare_strategies(metrics, "f1", "family", "strategy", ["base", "balanced", "smote"]))


@query(
    f"""WITH {METRICS}, p(base, variant) AS (VALUES ('ties', 'fine'), ('fine', 'ties'))
SELECT base, variant, round(a.average_precision, 6) AS base_value, round(b.average_precision, 6) AS variant_value,
       round(b.average_precision - a.average_precision, 6) AS delta, b.average_precision - a.average_precision >= -0.005 AS acceptable,
       CASE WHEN a.average_precision >= b.average_precision THEN base ELSE variant END AS winner
FROM p JOIN metrics a ON a.model = base JOIN metrics b ON b.model = variant"""
)
def variant_comparison(spark, sf_dir):
    metrics = cut(V.model_metrics(predictions(spark, sf_dir)), "metrics")
    return rounded(V.compare_pairs(metrics, [("ties", "fine"), ("fine", "ties")]))


@query(
    f"""WITH {PREDICTIONS}, {_metrics_sql(by="split")},
l AS (SELECT split, unnest(['f1', 'recall', 'precision', 'accuracy']) AS metrica, unnest([f1, recall, precision, accuracy]) AS v FROM m),
j AS (SELECT metrica, max(CASE WHEN split = 'val' THEN v END) AS val, max(CASE WHEN split = 'test' THEN v END) AS test FROM l GROUP BY 1)
SELECT metrica, round(val, 6) AS val, round(test, 6) AS test, round(test - val, 6) AS delta, test - val >= -0.005 AS stable,
       CASE WHEN max(abs(test - val)) OVER () < 0.02 THEN 'EXCELENTE' WHEN max(abs(test - val)) OVER () < 0.05 THEN 'BUENA'
            WHEN max(abs(test - val)) OVER () < 0.1 THEN 'MODERADA' ELSE 'ATENCIÓN' END AS verdict FROM j"""
)
def generalization(spark, sf_dir):
    pred = V.with_decision(predictions(spark, sf_dir))
    names = ["f1", "recall", "precision", "accuracy"]
    metrics = V.classification_metrics(pred, by=["split"])
    long = cut(D.unpivot_metrics(metrics, "split", names), "metrics").withColumnRenamed("metric", "metrica")
    val, test = (long.where(F.col("split") == s).drop("split") for s in ("val", "test"))
    return rounded(V.generalization(val, test))


@query(
    """WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS key, l_extendedprice / CAST(109999.7 AS DOUBLE) AS p, l_quantity * 1000 AS penalty_amount_usd FROM lineitem)
SELECT key, penalty_amount_usd, CAST(p >= 0.5 AS INTEGER) AS prediccion, CASE WHEN p >= 0.5 THEN 'INCUMPLIRÁ EL SLA' ELSE 'CUMPLIRÁ EL SLA' END AS prediccion_texto,
       round(p, 4) AS probabilidad_incumplir, round(greatest(0.05, least(0.95, p)), 4) AS probabilidad_capped, CAST(0.5 AS DOUBLE) AS threshold_usado,
       CASE WHEN p >= 0.75 THEN 'CRÍTICA' WHEN p >= 0.5 THEN 'ALTA' WHEN p >= 0.3 THEN 'MEDIA' ELSE 'BAJA' END AS prioridad,
       round(greatest(0.05, least(0.95, p)) * penalty_amount_usd, 2) AS riesgo_fiscal_esperado_usd FROM p"""
)
def priority_and_expected_risk(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"),
        (F.col("l_extendedprice") / 109999.7).alias("p"),
        (F.col("l_quantity") * 1000).alias("penalty_amount_usd"),
    )
    return priority_and_risk(items, "p", 0.5).drop("p")
