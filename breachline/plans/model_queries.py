"""Queries that train, explain and apply models. Their results are checked by properties."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from breachline.operators import balancing as B
from breachline.operators import encoding as E
from breachline.operators import evaluation as V
from breachline.operators import features as X
from breachline.operators import importance as I
from breachline.operators import models as M
from breachline.operators import splitting as L
from breachline.operators.ordering import union_all
from breachline.operators.scoring import score_requests
from breachline.plans import pipelines
from breachline.plans.feature_queries import COLS, COLS_READ, GOLD, SPLITS, gold
from breachline.plans.fixture import fixture_lookup, rounded, splits, stored_silver, table
from breachline.plans.registry import query
from breachline.settings import cut, exists, work_path

FEATURES = [
    "quantity", "price", "discount", "tax", "latitude", "longitude", "sla_days",
    "penalty_amount_usd",
]
# The features of the final model, for all tree ensembles; their settings are the defaults.
FINAL = [f for f in X.feature_names(COLS) if f not in ("presion_sla", "dia_semana_cos")]


def judged_splits(spark, sf_dir):
    """Requests with a known outcome, numeric features and their split."""
    columns = ["request_key", "created_ts", "target", "penalty_charged", *FEATURES]
    df = splits(spark, sf_dir, columns).where(F.col("target").isNotNull())
    return cut(df.select(*columns[:4], "split", *FEATURES), "modelled")


def part(df, name):
    return df.where(F.col("split") == name)


def final_splits(spark, sf_dir):
    """The judged requests with the features of the final model.

    Gold rows are judged and split like the requests themselves, so nothing is joined to them.
    """
    made = gold(spark, sf_dir, ("request_key", "created_ts"))[0].where(F.col("request_key").isNotNull())
    return cut(made.select("request_key", "created_ts", "target", "penalty_charged", "split", *FINAL), "final")


#: Where an application stored the table and the model of a folder of tables.
_STORED: dict[tuple[str, str], tuple[str, str]] = {}


def _stored_forest(spark, sf_dir):
    """Paths of the final table and of its forest, which all queries of a session share."""
    name = (spark.conf.get("spark.app.id"), sf_dir)
    if name not in _STORED or not all(exists(spark, p) for p in _STORED[name]):
        data, path = work_path(spark, "final"), work_path(spark, "forest")
        final_splits(spark, sf_dir).write.parquet(data)
        train = E.with_class_weight(part(spark.read.parquet(data), "train"))
        model = M.fit_random_forest(train, FINAL, weight="weight")
        M.save_model(model, path, {"features": FINAL, "threshold": 0.5})
        _STORED[name] = (data, path)
    return _STORED[name]


def _forest(spark, sf_dir):
    data, path = _stored_forest(spark, sf_dir)
    return spark.read.parquet(data), M.load_model(spark, path)[0]


@query(
    f"""WITH {SPLITS}, r AS (SELECT avg(target) AS rate FROM splits WHERE split = 'train' AND target IS NOT NULL),
v AS (SELECT target AS y, CAST('0x' || substr(md5(CAST(request_key AS VARCHAR) || '|42'), 8, 7) AS BIGINT) / 268435456.0 AS chance
  FROM splits WHERE split = 'val' AND target IS NOT NULL),
p AS (SELECT 'stratified' AS model, y, CAST(chance < rate AS INTEGER) AS yhat FROM v, r
  UNION ALL SELECT 'most_frequent', y, CAST(rate > 0.5 AS INTEGER) FROM v, r UNION ALL SELECT 'constant_1', y, 1 FROM v),
q AS (SELECT model, count_if(y = 0 AND yhat = 0) AS tn, count_if(y = 0 AND yhat = 1) AS fp, count_if(y = 1 AND yhat = 0) AS fn,
  count_if(y = 1 AND yhat = 1) AS tp FROM p GROUP BY model)
SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM q"""
)
def baseline_metrics(spark, sf_dir):
    df = judged_splits(spark, sf_dir)
    return rounded(V.classification_metrics(M.baselines(part(df, "train"), part(df, "val"), "request_key")))


@query(
    """WITH t AS (SELECT avg(CAST(event_type = 'error' AS INTEGER)) AS p FROM events)
SELECT round(p, 6) AS prevalence, round(p, 6) AS average_precision, CAST(0.5 AS DOUBLE) AS roc_auc, round(2 * p / (1 + p), 6) AS f1_always_1 FROM t"""
)
def minimum_to_beat(spark, sf_dir):
    flagged = table(spark, sf_dir, "events").select((F.col("event_type") == "error").cast("int").alias("target"))
    return rounded(M.minimum_to_beat(flagged))


CATEGORIES = ["agency", "borough", "complaint_type", "channel", "location_type"]
MEASURES = [f for f in FINAL if not f.endswith("_idx")]
LINEAR = [*MEASURES, *[f"{c}_onehot" for c in CATEGORIES]]


def linear_splits(spark, sf_dir):
    """Gold features as a linear model takes them: z-scores, and categories one-hot."""
    made = gold(spark, sf_dir)[0].where(F.col("request_key").isNotNull())
    df = cut(made.select("request_key", "target", "penalty_charged", "split", *CATEGORIES, *MEASURES), "linear")
    scaled = E.standardize(part(df, "train"), df, MEASURES)
    return cut(E.one_hot(part(df, "train"), scaled, CATEGORIES), "scaled")


@query()
def logistic_metrics(spark, sf_dir):
    scaled = linear_splits(spark, sf_dir)
    train = E.with_class_weight(part(scaled, "train"))
    models = {
        "LR (sin balanceo)": M.fit_logistic(train, LINEAR),
        "LR + class_weight": M.fit_logistic(train, LINEAR, weight="weight"),
    }
    return V.model_metrics(M.predictions_table(models, part(scaled, "val"), LINEAR, "request_key"))


@query(
    f"""WITH {GOLD}, l AS (
  SELECT s.* FROM splits s JOIN gold USING (request_key) WHERE s.split = 'train' AND s.target IS NOT NULL)
SELECT count(*) AS rows, CAST({len(MEASURES)} + {" + ".join(f"greatest(count(DISTINCT {c}) - 1, 1)" for c in CATEGORIES)} AS BIGINT) AS features,
       CAST(0 AS DOUBLE) AS gradient FROM l"""
)
def logistic_optimum(spark, sf_dir):
    """The greatest component of the gradient at the fitted weights is 0 to three digits."""
    train = E.with_class_weight(part(linear_splits(spark, sf_dir), "train"))
    model = M.fit_logistic(train, LINEAR, weight="weight", tolerance=1e-10)
    return M.logistic_gradient(model, train, weight="weight").select(
        "rows", "features", F.round("gradient", 3).alias("gradient")
    )


@query()
def forest_metrics(spark, sf_dir):
    df, model = _forest(spark, sf_dir)
    pred = M.predictions_table({"RF + class_weight": model}, part(df, "val"), FINAL, "request_key")
    return V.model_metrics(cut(pred, "predictions"))


@query()
def boosted_metrics(spark, sf_dir):
    df = final_splits(spark, sf_dir)
    model = M.fit_boosted_trees(part(df, "train"), FINAL)
    pred = M.predictions_table({"GBT": model}, part(df, "val"), FINAL, "request_key")
    return V.model_metrics(cut(pred, "predictions"))


@query()
def gold_forest_metrics(spark, sf_dir):
    """The 28 features of the final model, from the fitted gold table to test metrics."""
    df, _ = gold(spark, sf_dir)
    df = cut(df, "gold")
    train = E.with_class_weight(part(df, "train"))
    model = M.fit_random_forest(train, FINAL, weight="weight")
    pred = M.predictions_table({"Modelo Final (Test)": model}, part(df, "test"), FINAL, "request_key")
    return V.model_metrics(cut(pred, "predictions"))


@query()
def balanced_by_smote(spark, sf_dir):
    """Class sizes after synthetic rows were added to the rarer class."""
    items = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("target"),
        "value",
        F.hour("ts").cast("double").alias("hour"),
        F.col("user_id").cast("double").alias("user"),
    )
    balanced = B.smote(items, ["value", "hour", "user"], "event_id")
    return balanced.groupBy("target", "synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )


@query(
    """WITH c AS (SELECT count_if(event_type <> 'error') AS neg, count_if(event_type = 'error') AS pos FROM events),
made AS (SELECT CASE WHEN pos < 2 OR neg < pos THEN 0 ELSE neg - pos END AS n FROM c)
SELECT 0 AS target, FALSE AS synthetic, neg AS n, TRUE AS inside FROM c
UNION ALL SELECT 1, FALSE, pos, TRUE FROM c UNION ALL SELECT 1, TRUE, n, TRUE FROM made WHERE n > 0"""
)
def smote_class_sizes(spark, sf_dir):
    """Rows of each kind, and that no synthetic row lies outside what its class spans."""
    columns = ["value", "hour", "user"]
    items = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_type") == "error").cast("int").alias("target"), "value",
        F.hour("ts").cast("double").alias("hour"), F.col("user_id").cast("double").alias("user"),
    )
    balanced = cut(B.smote(items, columns, "event_id"), "balanced")
    spans = items.groupBy("target").agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
    )
    inside = reduce(and_, [F.col(c).between(F.col(f"low_{c}"), F.col(f"high_{c}")) for c in columns])
    return balanced.join(F.broadcast(spans), "target").groupBy("target", "synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(inside).alias("inside")
    )


@query()
def random_search(spark, sf_dir):
    df = part(final_splits(spark, sf_dir), "train")
    results, _ = M.temporal_random_search(
        df,
        FINAL,
        [F.col("created_ts"), F.col("request_key")],
        M.fit_random_forest,
        M.FOREST_GRID,
        draws=M.SEARCH_DRAWS["forest"],
    )
    return results


@query()
def forest_importance(spark, sf_dir):
    _, model = _forest(spark, sf_dir)
    return M.impurity_importance(model, spark)


@query()
def permutation_importance(spark, sf_dir):
    df, model = _forest(spark, sf_dir)
    return I.permutation_importance(model, part(df, "val"), "request_key")


@query()
def contribution_importance(spark, sf_dir):
    """Mean absolute sampled contributions of a forest over 500 requests."""
    df, model = _forest(spark, sf_dir)
    parts = I.feature_contributions(model, part(df, "val"), "request_key", 500)
    return I.mean_abs_contribution(parts)


@query(
    f"""WITH {GOLD}
SELECT least(500, count(*)) AS explained, CAST(0 AS DOUBLE) AS gap
FROM splits s JOIN gold USING (request_key) WHERE s.split = 'val' AND s.target IS NOT NULL"""
)
def contributions_add_up(spark, sf_dir):
    """A row's contributions sum to what its score differs from those it started from."""
    df, model = _forest(spark, sf_dir)
    gaps = I.contribution_gaps(model, part(df, "val"), "request_key", 500)
    gap = F.max(F.abs(F.col("explained") - F.col("difference")))
    return gaps.agg(F.count(F.lit(1)).alias("explained"), F.round(gap, 9).alias("gap"))


@query(
    f"""WITH {GOLD}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differ
FROM splits s JOIN gold USING (request_key) WHERE s.split = 'val' AND s.target IS NOT NULL"""
)
def stored_forest_scores(spark, sf_dir):
    """The stored forest, walked node by node with joins, scores like the model read back."""
    data, path = _stored_forest(spark, sf_dir)
    val = part(spark.read.parquet(data), "val")
    model = M.load_model(spark, path)[0]
    depth = model.stages[-1].getOrDefault("maxDepth")
    walked = M.score_by_nodes(M.forest_nodes(spark, path), val, FINAL, "request_key", depth)
    given = M.predictions_table({"RF": model}, val, FINAL, "request_key").select("key", F.col("score").alias("given"))
    both = given.join(walked, "key", "left")
    differ = F.coalesce(F.abs(F.col("given") - F.col("score")) > 1e-9, F.lit(True))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(differ).alias("differ"))


def _linear(spark, sf_dir):
    """The logistic model on one-hot and scaled features, with its training and validation rows."""
    scaled = linear_splits(spark, sf_dir)
    train = part(scaled, "train")
    return M.fit_logistic(train, LINEAR), train, part(scaled, "val")


@query()
def linear_contribution_importance(spark, sf_dir):
    model, train, val = _linear(spark, sf_dir)
    return I.mean_abs_contribution(I.linear_contributions(model, train, val, "request_key"))


@query(
    f"""WITH {GOLD}
SELECT count(*) AS explained, CAST(0 AS DOUBLE) AS gap
FROM splits s JOIN gold USING (request_key) WHERE s.split = 'val' AND s.target IS NOT NULL"""
)
def linear_contributions_add_up(spark, sf_dir):
    """A row's linear contributions sum to its log-odds less those of the mean training row."""
    model, train, val = _linear(spark, sf_dir)
    gaps = I.linear_gaps(model, train, val, "request_key")
    gap = F.max(F.abs(F.col("explained") - F.col("difference")))
    return gaps.agg(F.count(F.lit(1)).alias("explained"), F.round(gap, 9).alias("gap"))


@query()
def riskiest_request(spark, sf_dir):
    df, model = _forest(spark, sf_dir)
    return I.riskiest_case(M.predictions_table({"RF": model}, part(df, "val"), FINAL, "request_key"))


@query()
def stored_model_results(spark, sf_dir):
    """All tables of the model page, stored and read back: rows of each."""
    df, model = _forest(spark, sf_dir)
    tables = pipelines.model_results({"RF": model}, "RF", df, FINAL, "request_key")
    prefix = work_path(spark, "results")
    pipelines.store_results(tables, prefix)
    counts = [
        spark.read.parquet(f"{prefix}/{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        for name in tables
    ]
    return union_all(counts)


@query()
def scored_requests(spark, sf_dir):
    """Fit on the training period, store model and maps, load them and score the test period."""
    df, fitted = gold(spark, sf_dir)
    df = cut(df, "gold")
    features = X.feature_names(COLS)
    train = E.with_class_weight(part(df, "train"))
    path = work_path(spark, "model")
    model = M.fit_random_forest(train, features, weight="weight")
    M.save_model(model, path, {"threshold": 0.5, "features": features})
    stored, metadata = M.load_model(spark, path)
    base = stored_silver(spark, sf_dir, COLS_READ)
    new = part(L.temporal_split(base, "created_ts"), "test").drop("split")
    scored = score_requests(new, fitted, stored, fixture_lookup(spark), COLS, metadata["threshold"])
    return scored.select(
        "request_key", "agency", "prediccion", "probabilidad_incumplir", "prioridad", "riesgo_fiscal_esperado_usd"
    )
