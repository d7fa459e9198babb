"""Breach-risk models on Spark ML and their search along time."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachline.functions.sla import stable_share
from breachline.operators.evaluation import ranking_metrics
from breachline.operators.forests import GrownForest, grow, grown_scores, score, stored_nodes
from breachline.operators.ordering import expanding_folds, fold_roles, union_all
from breachline.operators.scoring import probability_of_breach
from breachline.settings import SEED, cut, exists

# Grids of the random search.
FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [10, 15, 20, 25],
    "minInstancesPerNode": [5, 10, 20, 30],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5"],
}
BOOSTED_GRID = {
    "maxIter": [200, 300, 500, 700],
    "maxDepth": [4, 6, 8, 10, 12],
    "stepSize": [0.01, 0.03, 0.05, 0.1, 0.15],
    "subsamplingRate": [0.6, 0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "1.0"],
    "minInstancesPerNode": [1, 3, 5, 7, 10],
    "minInfoGain": [0.0, 0.1, 0.3, 0.5],
}
SEARCH_DRAWS = {"forest": 20, "boosted": 30}


#: Memory for the statistics of the nodes that grow at the same time.
NODE_MEMORY_MB = 1024

#: Rows a partition of a growing ensemble may hold: some 300 MB with the counts of 200 trees.
PARTITION_ROWS = 250_000


def plain_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop column metadata, so that trees split category indices as numbers."""
    vectors = {f.name for f in df.schema if isinstance(f.dataType, VectorUDT)}
    return df.withColumns(
        {c: F.col(f"`{c}`").cast("double").alias(c, metadata={}) for c in columns if c not in vectors}
    )


def assembled(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """``features`` as one vector beside the columns to keep, dealt by a hash of the row.

    Every partition holds statistics of all nodes that grow, so work grows with partitions
    times nodes: there are as many as cores, and more only where they would be long. The
    order inside is the hash's, so that the same rows give the same trees.
    """
    names = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, *features])]
    dealt = plain_numbers(df, features).withColumn("_deal", F.xxhash64(*names))
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PARTITION_ROWS))
    dealt = dealt.repartition(parts, "_deal").sortWithinPartitions("_deal")
    return assembler(features).transform(dealt).select("features", *keep)


def assembler(features: Sequence[str]) -> VectorAssembler:
    # commas and blanks in names are fine for the assembler, which takes a list
    return VectorAssembler(inputCols=list(features), outputCol="features")


def _grow(train: DataFrame, features: Sequence[str], classifier, ready: bool) -> PipelineModel:
    """Fit a tree ensemble; ``ready`` says that ``train`` comes from ``assembled``."""
    keep = [classifier.getLabelCol()]
    if classifier.isDefined("weightCol"):
        keep.append(classifier.getWeightCol())
    rows = train if ready else assembled(train, features, *keep)
    model = grow(rows, classifier) if isinstance(classifier, RandomForestClassifier) else classifier.fit(rows)
    return PipelineModel([assembler(features), model])


def _fit(train: DataFrame, features: Sequence[str], classifier) -> PipelineModel:
    return Pipeline(stages=[assembler(features), classifier]).fit(plain_numbers(train, features))


def fit_logistic(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target",
    weight: str | None = None,
    strength: float = 1.0,
    max_iter: int = 2000,
    tolerance: float = 1e-6,
) -> PipelineModel:
    """L2 logistic regression on standardised features.

    The penalty is per row here, hence the division of the inverse strength by the rows.
    """
    rows = train.count()
    classifier = LogisticRegression(
        labelCol=target,
        maxIter=max_iter,
        tol=tolerance,
        regParam=1.0 / (strength * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
    )
    if weight:
        classifier = classifier.setWeightCol(weight)
    return _fit(train, features, classifier)


def logistic_gradient(
    model: PipelineModel, train: DataFrame, target: str = "target", weight: str | None = None
) -> DataFrame:
    """``rows, features, gradient``: the greatest absolute component of the gradient of what the
    fit minimises, mean loss plus penalty, at the fitted weights. At the optimum it is 0."""
    scored = model.transform(train)
    w = F.col(weight) if weight else F.lit(1.0)
    fitted = model.stages[-1]
    off = (vector_to_array("probability")[1] - F.col(target)) * w
    part = scored.select(
        w.alias("w"), off.alias("off"),
        F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"),
    )
    slopes = [*map(float, fitted.coefficients), 0.0]  # the intercept bears no penalty
    sums = part.select("w", "off", F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        (F.sum(F.col("off") * F.col("v")) / F.sum("w")).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    slope = F.element_at(F.array(*map(F.lit, slopes)), F.col("at") + 1)
    component = F.abs(F.col("mean") + slope * fitted.getOrDefault("regParam"))
    return sums.agg(
        F.max("n").alias("rows"), (F.count(F.lit(1)) - 1).alias("features"), F.max(component).alias("gradient")
    )


def forest_classifier(target: str = "target", weight: str | None = None, **params: Any) -> RandomForestClassifier:
    settings = {
        "numTrees": 200,
        "maxDepth": 20,
        "minInstancesPerNode": 20,
        "featureSubsetStrategy": "sqrt",
        "seed": SEED,
        "maxMemoryInMB": NODE_MEMORY_MB,
        "cacheNodeIds": True,
    }
    classifier = RandomForestClassifier(labelCol=target, **(settings | params))
    return classifier.setWeightCol(weight) if weight else classifier


def fit_random_forest(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target",
    weight: str | None = None,
    ready: bool = False,
    **params: Any,
) -> PipelineModel:
    return _grow(train, features, forest_classifier(target, weight, **params), ready)


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target",
    weight: str | None = None,
    ready: bool = False,
    **params: Any,
) -> PipelineModel:
    settings = {
        "maxIter": 300,
        "maxDepth": 8,
        "stepSize": 0.1,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
        "seed": SEED,
        "maxMemoryInMB": NODE_MEMORY_MB,
        "cacheNodeIds": True,
    }
    classifier = GBTClassifier(labelCol=target, **(settings | params))
    if weight:
        classifier = classifier.setWeightCol(weight)
    return _grow(train, features, classifier, ready)


def predictions_table(
    models: Mapping[str, PipelineModel],
    df: DataFrame,
    features: Sequence[str],
    key: str,
    split: str = "split",
    target: str = "target",
    penalty: str = "penalty_charged",
) -> DataFrame:
    """The long table all evaluation works on: one row per model and request."""
    numeric = plain_numbers(df, features)
    scored = [
        probability_of_breach(model, numeric, "score").select(
            F.lit(name).alias("model"),
            F.col(split).alias("split"),
            F.col(key).alias("key"),
            F.col(target).alias("y"),
            "score",
            F.col(penalty).alias("penalty"),
        )
        for name, model in models.items()
    ]
    return union_all(scored)


def baselines(
    train: DataFrame, df: DataFrame, key: str, target: str = "target", seed: int = SEED
) -> DataFrame:
    """Decisions without any feature: by chance at the training rate, majority class, always 1.

    Chance comes from a hash of the key. ``score`` is the decision itself.
    """
    rate = train.agg(F.avg(target)).scalar()
    decisions = {
        "stratified": (stable_share(F.col(key), seed=seed) < rate).cast("int"),
        "most_frequent": (rate > 0.5).cast("int"),
        "constant_1": F.lit(1),
    }
    stacked = F.array(
        *[F.struct(F.lit(n).alias("model"), c.alias("yhat")) for n, c in decisions.items()]
    )
    return df.select(
        F.col(key).alias("key"), F.col(target).alias("y"), F.inline(stacked)
    ).withColumn("score", F.col("yhat").cast("double"))


def minimum_to_beat(df: DataFrame, target: str = "target") -> DataFrame:
    """What guessing reaches: prevalence, one half, and the F1 of always answering 1."""
    return df.agg(F.avg(target).alias("prevalence")).select(
        "prevalence",
        F.col("prevalence").alias("average_precision"),
        F.lit(0.5).alias("roc_auc"),
        (F.col("prevalence") * 2 / (1 + F.col("prevalence"))).alias("f1_always_1"),
    )


def impurity_importance(model: PipelineModel, spark: SparkSession, top: int = 20) -> DataFrame:
    """Importances stored in the fitted trees; as many rows as features."""
    names, weights = model.stages[0].getInputCols(), model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: PipelineModel, path: str, metadata: Mapping[str, Any]) -> None:
    """Model and operating metadata (threshold, features, metrics) side by side.

    The nodes of a grown forest are stored already: they are copied, not sent from the driver.
    """
    spark = SparkSession.getActiveSession()
    last = model.stages[-1]
    if isinstance(last, GrownForest):
        nodes = spark.read.parquet(last.nodes_path)
        if last.nodes_path.startswith(f"{path}/"):  # stored over itself
            nodes = cut(nodes, "nodes")
        form = PipelineModel([*model.stages[:-1], last.form])
        form.write().overwrite().save(f"{path}/form")
        form.write().overwrite().save(f"{path}/model")
        nodes.write.mode("overwrite").parquet(f"{_stage(path, len(model.stages) - 1, last.form)}/data")
    else:
        model.write().overwrite().save(f"{path}/model")
    document = spark.createDataFrame([(json.dumps(dict(metadata)),)], "metadata string")
    document.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def _stage(path: str, place: int, stage) -> str:
    return f"{path}/model/stages/{place}_{stage.uid}"


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, Any]]:
    """What ``save_model`` stored; the nodes of a grown forest stay there."""
    document = spark.read.parquet(f"{path}/metadata").first().metadata
    if not exists(spark, f"{path}/form"):
        return PipelineModel.load(f"{path}/model"), json.loads(document)
    *first, form = PipelineModel.load(f"{path}/form").stages
    at = _stage(path, len(first), form)
    return PipelineModel([*first, GrownForest(form, at, f"{at}/data")]), json.loads(document)


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a stored forest: tree, node, feature, threshold, left, right, share of class 1."""
    return stored_nodes(spark, f"{path}/model/stages/1_*/data")


#: Rows of a lot, and nodes of a share of the trees, that meet in one group (some 60 MB each).
LOT_ROWS = 1 << 18
SHARE_NODES = 1 << 21


def score_by_nodes(
    nodes: DataFrame, df: DataFrame, features: Sequence[str], key: str, depth: int
) -> DataFrame:
    """``key, score``: rows walk down every tree along its nodes, no model needed.

    Every lot of rows is joined once with every share of the trees, and its rows go from node
    to child there, instead of carrying their features through a join per level.
    """
    shape = nodes.agg(F.max("tree").alias("last"), F.count(F.lit(1)).alias("n")).first()
    lots = -(-df.count() // LOT_ROWS) or 1
    parallel = -(-3 * df.sparkSession.sparkContext.defaultParallelism // lots)
    shares = min(shape.last + 1, max(parallel, -(-shape.n // SHARE_NODES)))
    rows = df.select(
        F.col(key).alias("key"), F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x")
    ).withColumn("lot", F.pmod(F.xxhash64("key", "x"), F.lit(lots)))
    rows = rows.withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    trees = nodes.withColumn("of", F.pmod(F.col("tree"), F.lit(shares)).cast("int"))
    trees = trees.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lots - 1).cast("bigint"))))
    kind = rows.schema["key"].dataType

    def walk(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))
        tree = nodes["tree"].to_numpy().astype(np.int64) << 32
        name = tree + nodes["node"].to_numpy()
        order = np.argsort(name)
        tree, name = tree[order], name[order]
        feature, threshold, left, right, share = (
            nodes[c].to_numpy()[order] for c in ("feature", "threshold", "left", "right", "share")
        )
        inner = left >= 0
        left, right = (np.where(inner, np.searchsorted(name, tree + c), -1) for c in (left, right))
        total, votes = np.zeros(len(x)), np.zeros(len(x), np.int64)
        for root in np.flatnonzero(name == tree):
            at, going = np.full(len(x), root), np.arange(len(x))
            for _ in range(depth):
                going = going[inner[at[going]]]
                here = at[going]
                at[going] = np.where(x[going, feature[here]] <= threshold[here], left[here], right[here])
            said = share[at]
            total += np.where(np.isnan(said), 0.0, said)
            votes += ~np.isnan(said)
        return pa.table({"key": rows["key"], "total": total, "votes": votes})

    parts = rows.groupBy("lot", "of").cogroup(trees.groupBy("lot", "of")).applyInArrow(
        walk, T.StructType([T.StructField("key", kind), T.StructField("total", T.DoubleType()), T.StructField("votes", T.LongType())])
    )
    return parts.groupBy("key").agg(F.try_divide(F.sum("total"), F.sum("votes")).alias("score"))


def draw_settings(grid: Mapping[str, Sequence[Any]], draws: int, seed: int = SEED) -> list[dict]:
    """Distinct random combinations of a grid, at most ``draws`` of them."""
    size = 1
    for values in grid.values():
        size *= len(values)
    chosen = random.Random(seed).sample(range(size), min(draws, size))
    settings = []
    for number in chosen:
        picked = {}
        for name, values in grid.items():
            number, at = divmod(number, len(values))
            picked[name] = values[at]
        settings.append(picked)
    return settings


def cost(settings: Mapping[str, Any]) -> float:
    """Work of a fit in nodes that may grow, to begin with the dearest."""
    trees = settings.get("numTrees", settings.get("maxIter", 1))
    subset = str(settings.get("featureSubsetStrategy", "1.0"))
    share = float(subset) if subset.replace(".", "").isdigit() else 0.2
    return trees * settings.get("maxDepth", 5) * share / settings.get("minInstancesPerNode", 1)


def temporal_random_search(
    train: DataFrame,
    features: Sequence[str],
    order: Sequence[Column],
    fit: Callable[..., PipelineModel],
    grid: Mapping[str, Sequence[Any]],
    draws: int,
    target: str = "target",
    weight: str | None = None,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 4,
) -> tuple[DataFrame, dict[str, Any]]:
    """Mean average precision of random settings over folds that always test later rows.

    The loop runs over folds and settings, never over rows; one number per setting comes back.
    The features are assembled and stored once for all fits; ``parallelism`` folds are at work
    at the same time, the longest first. Random forests of a fold are grown together; other
    models, and forests of very many rows, are fitted one by one. ``fit`` is told by ``ready``
    that its rows are assembled.
    """
    spark = train.sparkSession
    keep = [target, *([weight] if weight else []), "fold"]
    folded = cut(assembled(expanding_folds(train, order, folds), features, *keep), "folds")
    drawn = sorted(draw_settings(grid, draws, seed), key=cost, reverse=True)

    def together(train: DataFrame, test: DataFrame) -> DataFrame | None:
        if fit is not fit_random_forest:
            return None
        return grown_scores(train, test, [forest_classifier(target, weight, **settings) for settings in drawn])

    def single(train: DataFrame, test: DataFrame) -> DataFrame:
        rows = test.select(F.col(target).alias("y"), vector_to_array("features").alias("x"))
        tested = []
        for number, settings in enumerate(drawn):
            model = fit(train, features, target, weight, ready=True, **settings)
            tested.append(score(model.stages[-1], rows, "x").withColumn("number", F.lit(number).cast("bigint")))
        return union_all(tested)

    def measure(fold: int) -> DataFrame:
        part = fold_roles(folded, fold)
        train, test = (part.where(F.col("role") == role) for role in ("train", "test"))
        scores = together(train, test)
        scores = single(train, test) if scores is None else scores
        return cut(scores.withColumn("fold", F.lit(fold)), "scores")

    with ThreadPoolExecutor(parallelism) as pool:
        tested = list(pool.map(inheritable_thread_target(measure), reversed(range(folds))))
    per_fold = ranking_metrics(union_all(tested), by=["number", "fold"])
    means = dict(per_fold.groupBy("number").agg(F.avg("average_precision")).collect())
    results = [(json.dumps(settings, sort_keys=True), means.get(number)) for number, settings in enumerate(drawn)]
    best = max(results, key=lambda r: (-1.0 if r[1] is None else r[1], r[0]))
    table = spark.createDataFrame(results, "settings string, average_precision double")
    return table.orderBy(F.desc_nulls_last("average_precision"), F.desc("settings")), json.loads(best[0])
