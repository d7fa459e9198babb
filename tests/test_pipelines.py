"""The whole chain under the display names of real request tables, and the models on it."""

import pytest
from pyspark.sql import functions as F

from breachline.operators import encoding as E
from breachline.operators import features as X
from breachline.operators import importance as I
from breachline.operators import models as M
from breachline.operators.scoring import score_requests
from breachline.plans import pipelines as W
from breachline.sources import mappings
from breachline.sources.lookup import inline_lookup
from breachline.sources.readers import read_mixed, read_splits, read_table_file
from breachline.sources.writers import write_splits
from breachline.streaming import score_new_files

COLS = X.RequestColumns()


@pytest.fixture(scope="module")
def bronze(spark):
    def of(values, by):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("id") % len(values) * by % len(values) + 1).cast("int"))

    n = spark.range(3000)
    created = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3000)
    wait = F.pmod(F.xxhash64("id"), F.lit(2_000_000))
    text = "yyyy-MM-dd HH:mm:ss"
    return n.select(
        (F.col("id") % 2900).alias("Unique Key"),
        F.date_format(created, text).alias("Created Date"),
        F.when(F.col("id") % 11 != 0, F.date_format(F.timestamp_seconds(F.unix_timestamp(created) + wait - 90000), text)).alias(
            "Closed Date"
        ),
        of([" nypd", "HPD", "DOT", "EDC", "XYZ", None], 1).alias("Agency"),
        of(["Noise", "heat", "Pothole"], 1).alias("Complaint Type"),
        of(["BRONX", "Queens ", "Unspecified", None], 1).alias("Borough"),
        of(["PHONE", "ONLINE"], 1).alias("Open Data Channel Type"),
        of(["Street", None, "Residential"], 1).alias("Location Type"),
        F.when(F.col("id") % 13 != 0, 10000 + F.col("id") % 20).alias("Incident Zip"),
        F.when(F.col("id") % 17 != 0, F.lit(40.0) + F.col("id") % 100 / 100).cast("string").alias("latitude"),
        (F.lit(-74.0) + F.col("id") % 90 / 100).cast("string").alias("longitude"),
        F.lit(None).cast("string").alias("Landmark"),
    )


@pytest.fixture(scope="module")
def silver(bronze):
    return W.cut(W.silver_from_bronze(bronze), "silver")


@pytest.fixture(scope="module")
def built(spark, silver):
    gold, fitted = X.build_features(W.split_silver(silver), inline_lookup(spark), COLS, keep=("Unique Key",))
    return W.cut(gold, "gold"), fitted


@pytest.fixture(scope="module")
def forest(built):
    gold, _ = built
    train = E.with_class_weight(gold.where("split = 'train'"))
    return M.fit_random_forest(train, X.feature_names(COLS), weight="weight", numTrees=5, maxDepth=4)


def test_silver(silver):
    assert "Landmark" not in silver.columns
    assert silver.count() == silver.select("Unique Key").distinct().count()
    assert {r[0] for r in silver.select("Agency").distinct().collect()} == {"NYPD", "HPD", "DOT", "XYZ"}
    assert silver.where("latitude is null or `Closed Date` < `Created Date`").count() == 0
    assert silver.where("`Incident Zip` = -1").count() > 0 and silver.where("`Location Type` = 'UNKNOWN'").count() > 0
    assert silver.schema["latitude"].dataType.simpleString() == "double"


def test_gold_eda(spark, silver):
    eda = W.gold_eda(silver, inline_lookup(spark))
    assert eda.count() == silver.count()
    wanted = {"p75_resolution_time_days", "is_sla_non_compliant", "official_sla_days", "is_overdue_official", "created_hour"}
    assert wanted <= set(eda.columns)
    assert eda.where("is_overdue_official is null or is_sla_non_compliant is null").count() == 0


def test_gold_features(built):
    gold, fitted = built
    assert len(X.feature_names(COLS)) == 30
    assert gold.select("split").distinct().count() == 3
    complete = [c for c in X.required_columns(COLS)]
    assert gold.dropna(subset=complete).count() == gold.count() > 0
    assert gold.where("Agency = 'XYZ'").count() == 0  # no contract, no outcome
    assert fitted.sizes["Agency_idx"] == 4 and fitted.value("global_tasa") > 0


def test_default_policy_keeps_unmapped_agencies(spark, silver):
    ready = X.prepare_requests(W.split_silver(silver), inline_lookup(spark), COLS, unmapped="default")
    row = ready.where("Agency = 'XYZ'").select("sla_days", "penalty_amount_usd").distinct().collect()
    assert [tuple(r) for r in row] == [(10.0, 15000.0)]


def test_later_splits_do_not_change_fitted_maps(spark, silver):
    parts = W.split_silver(silver)
    shifted = parts.withColumn(
        "closed_ts", F.when(F.col("split") != "train", F.col("created_ts")).otherwise(F.col("closed_ts"))
    )
    maps = []
    for table in (parts, shifted):
        ready = X.prepare_requests(table, inline_lookup(spark), COLS)
        fitted = X.fit_features(ready.where("split = 'train'"), COLS)
        maps.append(sorted(tuple(map(str, r)) for r in fitted.maps.collect()))
    assert maps[0] == maps[1]


def test_maps_beyond_the_broadcast_bound_give_the_same_features(built, monkeypatch, spark, silver):
    gold, fitted = built
    monkeypatch.setattr(mappings, "BROADCAST_BYTES", 0)
    ready = X.prepare_requests(W.split_silver(silver), inline_lookup(spark), COLS)
    keys = [F.col("Agency"), F.col("Borough")]
    far = fitted.attach(ready, ["centroid_lat", "centroid_lon"], *keys)
    monkeypatch.undo()
    near = fitted.attach(ready, ["centroid_lat", "centroid_lon"], *keys)
    shown = ["Unique Key", "centroid_lat", "centroid_lon"]
    assert sorted(map(str, far.select(*shown).collect())) == sorted(map(str, near.select(*shown).collect()))


def test_stored_model_scores_new_requests_alike_in_batch_and_stream(
    spark, built, forest, silver, tmp_path, monkeypatch
):
    _, fitted = built
    M.save_model(forest, str(tmp_path / "model"), {"threshold": 0.5})
    model, metadata = M.load_model(spark, str(tmp_path / "model"))
    rows = [
        ("DHS", "HOMELESS PERSON ASSISTANCE", "MANHATTAN", 10001, "PHONE", "STREET/SIDEWALK", "2024-12-15 23:30:00", 40.7506, -73.9971),
        ("NYPD", "NOISE - RESIDENTIAL", "QUEENS", 11375, "MOBILE", "RESIDENTIAL BUILDING", "2024-10-08 14:00:00", 40.7210, -73.8458),
        ("HPD", "HEAT/HOT WATER", "BRONX", 10462, "ONLINE", "RESIDENTIAL BUILDING", "2024-11-20 08:15:00", 40.8470, -73.8629),
        ("nobody", "new", None, None, None, None, "2024-11-20 08:15:00", 40.8470, -73.8629),
    ]
    names = [COLS.agency, COLS.complaint_type, COLS.borough, COLS.zip_code, COLS.channel, COLS.location_type, "t", "latitude", "longitude"]
    new = spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, ["string"] * 3 + ["int"] + ["string"] * 3 + ["double"] * 2)))
    new = new.withColumn("created_ts", F.to_timestamp("t")).drop("t")
    scored = score_requests(new, fitted, model, inline_lookup(spark), COLS, metadata["threshold"])
    got = {r.Agency: r for r in scored.collect()}
    assert len(got) == 4
    assert (got["NOBODY"].sla_oficial_dias, got["NOBODY"].multa_potencial_usd) == (10.0, 15000.0)
    for r in got.values():
        assert 0.05 <= r.probabilidad_capped <= 0.95
        assert r.prediccion == int(r.probabilidad_incumplir >= 0.5)
        assert r.prioridad in ("CRÍTICA", "ALTA", "MEDIA", "BAJA")

    unplaced = score_requests(
        new.withColumn("latitude", F.lit(None).cast("double")), fitted, model, inline_lookup(spark), COLS
    )
    assert [r.probabilidad_incumplir for r in unplaced.collect()] == [None] * 4

    source = str(tmp_path / "in")
    new.write.parquet(source)
    for bound in (mappings.BROADCAST_BYTES, 0):
        monkeypatch.setattr(mappings, "BROADCAST_BYTES", bound)
        target = str(tmp_path / f"out{bound}")
        query = score_new_files(
            spark, source, new.schema, target, str(tmp_path / f"state{bound}"), fitted, model, inline_lookup(spark), COLS
        )
        query.awaitTermination(240)
        streamed = spark.read.parquet(target)
        assert sorted(map(str, streamed.collect())) == sorted(map(str, scored.collect()))


def test_importances(built, forest):
    gold, _ = built
    features = X.feature_names(COLS)
    gini = M.impurity_importance(forest, gold.sparkSession, 30)
    assert gini.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    val = gold.where("split = 'val'")
    permuted = {r.feature: r for r in I.permutation_importance(forest, val, "Unique Key", repeats=2).collect()}
    unused = {r.feature for r in gini.where("importance = 0").collect()}
    assert set(permuted) == set(features)
    assert all(permuted[f].importance_mean == pytest.approx(0, abs=1e-12) for f in unused)
    parts = I.feature_contributions(forest, val, "Unique Key", sample=20, permutations=3)
    assert parts.count() == 20 * len(features)
    assert parts.where(F.col("feature").isin(*unused) & (F.abs("contribution") > 1e-12)).count() == 0
    whole = [r[1] for r in parts.groupBy("key").agg(F.sum("contribution")).collect()]
    assert all(-1 <= w <= 1 for w in whole), whole


def test_model_results(built, forest):
    gold, _ = built
    tables = W.model_results({"RF": forest}, "RF", gold, X.feature_names(COLS), "Unique Key")
    assert tables["metricas_modelos"].first().es_final
    n = gold.where("split = 'test'").count()
    assert tables["confusion_matrix_test"].agg(F.sum("count")).first()[0] == n
    assert tables["resumen_fiscal"].count() == 3
    ends = tables["curva_roc"].agg(F.min("fpr"), F.max("fpr"), F.max("tpr")).first()
    assert tuple(ends) == (0.0, 1.0, 1.0)


def test_search_draws_are_distinct_and_repeatable():
    drawn = M.draw_settings(M.FOREST_GRID, 20)
    assert len({str(d) for d in drawn}) == 20 and drawn == M.draw_settings(M.FOREST_GRID, 20)


def test_learnable_target_beats_prevalence(spark):
    from breachline.operators.evaluation import ranking_metrics

    df = spark.range(2000).select(
        "id", (F.rand(1) * 10).alias("a"), F.rand(2).alias("b"), F.lit("val").alias("split"), F.lit(1.0).alias("penalty_charged")
    )
    df = W.cut(df).withColumn("target", (F.col("a") > 8).cast("int"))
    train = E.with_class_weight(df)
    models = {
        "lr": M.fit_logistic(train, ["a", "b"], weight="weight", max_iter=30),
        "gbt": M.fit_boosted_trees(train, ["a", "b"], weight="weight", maxIter=3, maxDepth=3),
    }
    pred = M.predictions_table(models, df, ["a", "b"], "id")
    for r in ranking_metrics(pred).collect():
        assert r.average_precision > 0.9


def test_readers(spark, tmp_path):
    base = str(tmp_path / "splits")
    df = spark.range(30).withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "val", "test"))), (F.col("id") % 3 + 1).cast("int")))
    write_splits(df, base)
    assert read_splits(spark, base).groupBy("split").count().count() == 3
    plain = tmp_path / "plain"
    for name in ("train", "val", "test"):
        spark.range(2).write.parquet(str(plain / name))
    assert read_splits(spark, str(plain)).where("split = 'val'").count() == 2
    assert read_table_file(spark, str(tmp_path / "none.parquet")) is None
    (tmp_path / "empty").mkdir()
    assert read_mixed(spark, str(tmp_path / "empty")) is None
