"""Operators on small frames: brute force, ties, NULL, hot keys and properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from breachline.functions import geo, sla, text, times
from breachline.operators import balancing as B
from breachline.operators import cleaning as C
from breachline.operators import dashboards as D
from breachline.operators import encoding as E
from breachline.operators import evaluation as V
from breachline.operators import joins as J
from breachline.operators import models as M
from breachline.operators import ordering as O
from breachline.operators import profiles as P
from breachline.operators import splitting as L
from breachline.operators import statistics as S
from breachline.settings import work_folder


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- predicates and scalar functions ---------------------------------------------------


def test_missing_is_null_blank_or_sentinel_without_trimming(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), (" ", 3), ("Unspecified", None), ("x", 5)], "s string, n int")
    s, n = df.schema["s"].dataType, df.schema["n"].dataType
    got = rows(df.select(text.is_missing(F.col("s"), s), text.is_missing(F.col("n"), n)))
    assert got == [(True, False), (True, False), (False, False), (True, True), (False, False)]


def test_shift_weekend_and_unknown_times(spark):
    df = spark.createDataFrame(
        [("2024-01-06 05:59:59",), ("2024-01-08 06:00:00",), ("2024-01-08 12:00:00",), ("2024-01-08 20:00:00",), ("bad",)],
        "t string",
    ).select(times.parse_timestamp(F.col("t")).alias("t"))
    got = rows(
        df.select(times.shift_of_day(F.hour("t")), times.weekend_flag(F.col("t")), times.weekday_name(F.dayofweek("t")))
    )
    assert got == [
        ("noche", 1, "Saturday"),
        ("manana", 0, "Monday"),
        ("tarde", 0, "Monday"),
        ("noche", 0, "Monday"),
        ("noche", 0, "Unknown"),
    ]


def test_targets_keep_unknown_apart_from_kept(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (3.0, 2.0), (2.0, 2.0), (-1.0, 2.0), (None, 2.0), (3.0, None)], "d double, s double"
    )
    target = sla.breach_by_contract(F.col("d"), F.col("s"))
    got = rows(
        df.select(
            target, sla.penalty_charged(target, F.lit(10)), sla.breach_by_percentile(F.col("d"), F.col("s"))
        )
    )
    assert got == [(0, 0.0, 0), (1, 10.0, 1), (0, 0.0, 0), (None, None, 0), (None, None, 0), (None, None, 0)]


def test_haversine_of_known_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0)], "a double, b double, c double, d double")
    got = rows(df.select(geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))))
    assert got[0][0] == pytest.approx(math.pi * 6371) and got[1][0] == 0


# ---- cleaning --------------------------------------------------------------------------


def test_fill_numeric_does_not_narrow(spark):
    df = spark.createDataFrame([(1,), (None,)], "n long")
    assert sorted(rows(C.fill_numeric(df, {"n": 2.7}))) == [(1.0,), (2.7,)]
    assert rows(C.fill_numeric(df, {"n": None})) == rows(df)
    assert C.fill_numeric(df, {"n": -1}).schema["n"].dataType.simpleString() == "bigint"


def test_fill_tokens_on_a_number_column(spark):
    df = spark.createDataFrame([(7,), (None,)], "BBL long")
    assert sorted(rows(C.fill_tokens(df, C.NULL_TOKENS))) == [("7",), ("UNKNOWN_BBL",)]


def test_exclusion_and_chronology_drop_unknowns(spark):
    df = spark.createDataFrame(
        [("A", 1, 2), ("EDC", 1, 2), (None, 1, 2), ("A", 3, 2), ("A", 1, None), ("A", None, 2)], "g string, a int, b int"
    )
    assert C.exclude_values(df, "g", ["EDC"]).count() == 4
    assert C.filter_chronology(df, "a", "b").count() == 4


def test_dedupe_keeps_the_least_row(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2), (1, None, 9), (2, "x", 1)], "k int, s string, n int")
    assert sorted(rows(C.dedupe_by_key(df, "k"))) == [(1, None, 9), (2, "x", 1)]


def test_schema_helpers(spark):
    df = spark.createDataFrame([], "`Due Date` string, `Closed Date` string, `Created Date` string, n int")
    assert C.find_date_column(df) == "Created Date"
    assert C.find_date_column(df.drop("Created Date", "Closed Date")) == "Due Date"
    assert C.find_date_column(df.select("n")) is None
    assert C.validate_columns(df, ["n", "x"]) == ["x"]
    assert C.select_by_type(df) == ["n"] and len(C.select_by_type(df, numeric=False)) == 3
    assert C.normalize_names(df).columns == ["due_date", "closed_date", "created_date", "n"]


def test_incompatible_filters_are_empty_selections(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "g string, t string")
    assert C.apply_filters(df, g=[], t=None).count() == 2
    assert rows(D.incompatible_values(df, "g", ["a", "b"], "t", ["y"])) == [("a",)]
    assert rows(D.compatible_values(df, "g", [], "t")) == [("x",), ("y",)]


# ---- joins with hot keys ---------------------------------------------------------------


def test_salted_join_equals_plain_join(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    table = spark.range(40).select(F.col("id").cast("int").cast("long").alias("k"), (F.col("id") * 2).alias("v"))
    plain = sorted(rows(df.join(table, "k", "left").select("id", "v")))
    far = J.attach(df, table, "k", max_bytes=0)
    assert far.columns == df.join(table, "k", "left").columns
    assert sorted(rows(far.select("id", "v"))) == plain
    only_key = J.attach(df.select("k"), table, "k", max_bytes=0)
    assert only_key.count() == 3000
    assert "BroadcastHashJoin" in J.attach(df, table, "k")._jdf.queryExecution().executedPlan().toString()


def test_chained_salted_joins_read_their_input_once(spark, tmp_path):
    spark.range(500).selectExpr("id % 9 AS k", "id").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    for i in range(10):
        df = J.attach(df, spark.range(9).selectExpr("id AS k", f"id AS v{i}"), "k", max_bytes=0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 10
    assert plan.count("[k#") >= 1 and df.inputFiles() is not None
    scans = [line for line in plan.splitlines() if "Relation" in line and "id#" in line]
    assert len(scans) == 1
    assert df.count() == 500


def test_salted_join_takes_a_stream(spark, tmp_path):
    spark.range(100).selectExpr("id % 5 AS k", "id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, id long").parquet(str(tmp_path / "in"))
    table = spark.range(3).selectExpr("id AS k", "id * 10 AS v")
    out = J.attach(stream, table, "k", max_bytes=0).writeStream.format("parquet")
    out = out.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    out.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 100 and got.where("v IS NOT NULL").count() == 60


def test_fallbacks(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1)], "z int, d int")
    exact = spark.createDataFrame([(1, 1, 10)], "z int, d int, v int")
    coarse = spark.createDataFrame([(1, 20)], "z int, v int")
    got = J.join_two_level_fallback(df, exact, ["z", "d"], coarse, ["z"], "v", F.lit(30))
    assert sorted(r[0] for r in rows(got.select("v"))) == [10, 20, 30, 30]


# ---- positions, running sums, quantiles ------------------------------------------------


def test_row_index_with_many_ties(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("t"), "id")
    got = sorted(rows(O.global_row_index(df, [F.col("t"), F.col("id")], blocks=7).select("row_index", "t", "id")))
    assert [r[0] for r in got] == list(range(2000))
    assert [(r[1], r[2]) for r in got] == sorted((r[1], r[2]) for r in got)


def test_prefix_sums_per_group(spark):
    data = [(g, s, (s * 7 + g) % 5) for g in range(3) for s in range(200)]
    df = spark.createDataFrame(data, "g int, s int, n int")
    got = {(r.g, r.s): (r.cum_n, r.all_n) for r in O.prefix_sums(df, [F.desc("s")], ["n"], ["g"], blocks=6).collect()}
    for g in range(3):
        total = 0
        for s in range(199, -1, -1):
            total += (s * 7 + g) % 5
            assert got[g, s][0] == total
        assert got[g, 0][1] == total


def test_exact_quantiles_match_numpy(spark):
    values = [float(v) for v in np.random.default_rng(0).integers(0, 40, 501)] + [None]
    df = spark.createDataFrame([(v, None if v is None else v * -3.5) for v in values], "a double, b double")
    got = {r.columna: (r.q_0, r.q_1, r.q_2) for r in O.exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()}
    a = np.array(values[:-1])
    assert got["a"] == pytest.approx(tuple(np.quantile(a, [0.25, 0.5, 0.9])))
    assert got["b"] == pytest.approx(tuple(np.quantile(a * -3.5, [0.25, 0.5, 0.9])))


def test_expanding_folds_follow_their_definition(spark):
    n, k = 103, 5
    got = O.expanding_folds(spark.range(n), [F.col("id")], k)
    size = n // (k + 1)
    fold = {r.row_index: r.fold for r in got.collect()}
    for i in range(k):
        first = n - (k - i) * size
        assert [p for p in range(n) if fold[p] == i] == list(range(first, first + size))
    part = O.fold_roles(got, 2)
    assert part.where("role = 'train'").agg(F.max("row_index")).first()[0] < part.where("role = 'test'").agg(
        F.min("row_index")
    ).first()[0]


# ---- profiles --------------------------------------------------------------------------


def test_profiles_on_a_small_table(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("", 2.0, 1), ("Unspecified", None, 1), (None, 100.0, 1), ("a", 1.0, 1)], "s string, x double, c int"
    )
    exact = {r.columna: r for r in P.missing_profile(df).collect()}
    assert (exact["s"].nulos_n, exact["s"].nulos_pct, exact["s"].unicos_n) == (3, 60.0, 4)
    assert (exact["x"].nulos_n, exact["x"].unicos_n, exact["x"].tipo_dato) == (1, 4, "DoubleType()")
    sketched = {r.columna: tuple(r) for r in P.missing_profile(df, approximate=True).collect()}
    assert sketched == {k: tuple(v) for k, v in exact.items()}
    health = {r.columna: r for r in P.health_report(df).collect()}
    assert health["x"].outliers_n == 1 and health["s"].outliers_n == 0 and health["c"].duplicados_dataset == 1
    assert P.drop_sparse_columns(df, 10.0).columns == ["c"]  # NULL only: 20 % in s and in x


def test_column_names_with_blanks_and_dots(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "`Complaint Type` string, `a.b` int")
    assert {r.columna for r in P.health_report(df).collect()} == {"Complaint Type", "a.b"}
    assert {r.columna: r.moda for r in P.eda_report(df).collect()} == {"Complaint Type": "a", "a.b": "1"}
    assert P.null_profile(df).count() == 2 and P.describe_numeric(df).first().columna == "a.b"


def test_trend_break_without_any_rise(spark):
    one_day = spark.createDataFrame([("2024-01-01 01:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    row = D.trend_break(D.day_over_day(one_day, "t")).first()
    assert row.total_reportes == 1 and row.reason.startswith("mayor volumen")


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = {r.id for r in D.sample_rows(df, ["id"], 50).collect()}
    b = {r.id for r in D.sample_rows(df.repartition(13), ["id"], 50).collect()}
    assert a == b and len(a) == 50
    assert a != {r.id for r in D.sample_rows(df, ["id"], 50, seed=7).collect()}


def test_lookback_window_excludes_today(spark):
    df = spark.createDataFrame([("z", 1)] * 3 + [("z", 31), ("z", 32), ("z", 32), ("y", 5)], "z string, d int")
    got = {(r.z, r.d): r.densidad_zip_30d for r in S.rolling_range_sum(df, "z", "d").collect()}
    assert got == {("z", 1): None, ("z", 31): 3, ("z", 32): 1, ("y", 5): None}


# ---- splits and encodings --------------------------------------------------------------


def test_split_covers_rows_once_and_keeps_ties_together(spark):
    df = spark.range(1000).select("id", F.timestamp_seconds((F.col("id") / 100).cast("int") * 86400).alias("t"))
    got = L.temporal_split(df, "t")
    assert got.count() == 1000
    assert got.select("t", "split").distinct().count() == 10
    order = D.temporal_integrity(got, "t").first()
    assert order.train_before_val and order.val_before_test


def test_censoring_keeps_unmapped(spark):
    df = spark.createDataFrame([(0, 1.0), (9, 1.0), (10, 1.0), (10, None)], "d int, s double").select(
        F.timestamp_seconds(F.col("d") * 86400).alias("t"), "s"
    )
    kept = L.censor_filter(df, "t", "s")
    assert kept.where("s is null").count() == 1 and kept.where("s is not null").count() == 2


def test_own_target_does_not_reach_its_encoding(spark):
    data = [(i, f"c{i % 4}", i % 3 % 2, i % 5) for i in range(60)]
    flipped = [(i, c, 1 - y if i == 7 else y, f) for i, c, y, f in data]

    def encoded(values):
        df = spark.createDataFrame(values, "id int, c string, y int, f int")
        return {r.id: r.c_te for r in E.target_encode_oof(df, "c", "y", "f").collect()}

    before, after = encoded(data), encoded(flipped)
    assert before[7] == after[7] and before != after


def test_encodings_of_unseen_values(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "c string, y int")
    new = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    te = {r.c: r.c_te for r in E.target_encode_full(train, new, "c", "y").collect()}
    assert te == {"a": 0.5, "b": 1.0, "zz": 0.5, None: 0.5}
    idx = {r.c: r.c_idx for r in E.index_categories(train, new, ["c"]).collect()}
    assert idx == {"a": 0.0, "b": 1.0, "zz": 2.0, None: 2.0}
    levels = E.one_hot_levels(train, "c")
    hot = {r.c: r.c_b for r in E.one_hot_columns(new, {"c": levels}).collect()}
    assert hot == {"a": 0, "b": 1, "zz": 0, None: 0}
    sparse = {r.c: r.c_onehot.toArray().tolist() for r in E.one_hot(train, new, ["c"]).collect()}
    assert sparse == {"a": [0.0], "b": [1.0], "zz": [0.0], None: [0.0]}


def test_one_hot_of_two_thousand_levels(spark):
    train = spark.range(2000).selectExpr("lpad(id, 5, '0') AS c")
    got = E.one_hot(train, train, ["c"], drop_first=False).collect()
    assert all(r.c_onehot.size == 2000 and r.c_onehot[int(r.c)] == 1.0 for r in got)


def test_profiles_of_odd_columns(spark):
    df = spark.createDataFrame([(0.0, 1.0, "a"), (-0.0, 1.0, "b"), (2.0, 1.0, None), (None, 1.0, "")], "x double, y double, s string")
    counts = {r.columna: r for r in P.missing_profile(df).collect()}
    assert counts["x"].unicos_n == 3 and counts["s"].nulos_n == 2
    assert {r.columna: r.abs_skew for r in P.skewness_profile(df).collect()}["y"] == 0.0
    empty = {r.columna: r for r in P.missing_profile(df.where("false")).collect()}
    assert set(empty) == {"x", "y", "s"} and empty["x"].total_filas_dataset == 0 and empty["x"].nulos_pct is None
    fences = {r.columna: r for r in P.iqr_outliers(df.where("false")).collect()}
    assert set(fences) == {"x", "y"} and fences["x"].outliers_n == 0


def test_exact_fences(spark):
    df = spark.range(1001).selectExpr("cast(id AS double) AS x", "if(id = 7, 99999, id % 4) AS z")
    got = {r.columna: r for r in P.iqr_outliers(df).collect()}
    assert (got["x"].iqr_lower, got["x"].iqr_upper) == (-500.0, 1500.0)
    assert got["x"].outliers_n == 0 and got["z"].outliers_n == 1


# ---- evaluation ------------------------------------------------------------------------


def brute_auc(y, s):
    pos, neg = [a for a, t in zip(s, y) if t], [a for a, t in zip(s, y) if not t]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(y, s):
    total, before, value = sum(y), 0, 0.0
    for t in sorted(set(s), reverse=True):
        tp = sum(a for a, b in zip(y, s) if b >= t)
        n = sum(b >= t for b in s)
        value += (tp - before) / total * tp / n
        before = tp
    return value


def test_ranking_metrics_against_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300).tolist()
    s = (rng.integers(0, 25, 300) / 25).tolist()
    data = [("m", a, b) for a, b in zip(y, s)] + [("perfect", a, float(a)) for a in y] + [("flat", a, 0.5) for a in y]
    got = {r.model: r for r in V.ranking_metrics(spark.createDataFrame(data, "model string, y int, score double")).collect()}
    assert got["m"].roc_auc == pytest.approx(brute_auc(y, s))
    assert got["m"].average_precision == pytest.approx(brute_ap(y, s))
    assert got["perfect"].roc_auc == 1 and got["perfect"].average_precision == pytest.approx(1)
    assert got["flat"].roc_auc is None and got["flat"].average_precision is None


def test_sweep_uses_the_exact_grid(spark):
    grid = np.arange(0.05, 0.95, 0.01)
    scores = [float(g) for g in grid] + [float(np.nextafter(g, 0)) for g in grid] + [0.0, 1.0, 0.949]
    data = [("m", i % 2, s, 100.0) for i, s in enumerate(scores)]
    df = spark.createDataFrame(data, "model string, y int, score double, penalty double")
    got = {r.threshold: r for r in V.threshold_sweep(df).collect()}
    assert sorted(got) == [float(g) for g in grid]
    for t, r in got.items():
        said = [s >= t for s in scores]
        assert r.tp == sum(a and i % 2 for i, a in enumerate(said))
        assert r.fp == sum(a and not i % 2 for i, a in enumerate(said))
        assert r.costo_fn == pytest.approx(r.fn * 100.0)
    best = {r.budget_pct: r for r in V.threshold_for_budget(V.threshold_sweep(df)).collect()}
    for budget, r in best.items():
        within = [x for x in got.values() if x.pct_alertas <= budget]
        top = max(x.recall for x in within)
        assert r.threshold == min(x.threshold for x in within if x.recall == top)


def test_saving_share_is_recall_but_true_sum_is_not(spark):
    data = [("m", 1, 0.9, 10.0), ("m", 1, 0.1, 90.0), ("m", 0, 0.2, 0.0)]
    df = V.with_decision(spark.createDataFrame(data, "model string, y int, score double, penalty double"))
    row = V.fiscal_impact(df).first()
    assert row.avoided_pct == pytest.approx(50) and row.true_avoided_pct == pytest.approx(10)


# ---- balancing -------------------------------------------------------------------------


def test_neighbours_are_exact_even_with_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    x[:100] = x[0]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "key long, x array<double>")
    got = B.nearest_neighbours(df, 5, block_rows=64).collect()
    assert len(got) == 300
    for r in got:
        d = np.sort(np.sqrt(((x - np.array(r.x)) ** 2).sum(1)))[1:6]
        assert np.allclose(d, sorted(n.d for n in r.near))
        assert r.i not in [n.j for n in r.near]


def test_neighbours_reach_few_blocks_in_five_dimensions(spark):
    """Five equally wide coordinates of a curved surface: no single one prunes, the cuts do."""
    rng = np.random.default_rng(5)
    reach = {}
    for n in (1024, 4096):
        u, v = rng.random(n), rng.random(n)
        x = np.stack([u, v, (u + v) / 2, (np.sin(3 * u) + 1) / 2, (np.cos(3 * v) + 1) / 2], axis=1)
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key long, x array<double>")
        placed, fan, rounds = B.space_blocks(df, 64)
        placed = placed.cache()
        sizes = [r["count"] for r in placed.groupBy("block").count().collect()]
        assert len(sizes) >= n // 64 and max(sizes) <= 64
        near = {r.key: [m.d for m in r.near] for r in B.nearest_neighbours(df, 5, 64).collect()}
        r = {k: d[-1] for k, d in near.items()}
        asking = placed.join(spark.createDataFrame(list(r.items()), "key long, r double"), "key")
        reach[n] = B.reached_blocks(asking, placed, fan, rounds).count() / n
        for i in range(0, n, 97):
            want = np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[1:6]
            assert np.allclose(near[i], want)
    # 4 x 4 and 8 x 8 blocks of the surface: those at the edge have fewer neighbours, so corners
    # per block rise by (49 / 64) / (9 / 16) = 1.36; all pairs of blocks would rise by 4.2
    assert reach[1024] < 2 and reach[4096] < 1.36 * reach[1024]


def test_neighbours_of_few_or_incomplete_points(spark):
    schema = "key long, x array<double>"
    assert B.nearest_neighbours(spark.createDataFrame([], schema), 5, 4).count() == 0
    few = B.nearest_neighbours(spark.createDataFrame([(i, [float(i)]) for i in range(3)], schema), 5, 1).collect()
    assert sorted(len(r.near) for r in few) == [2, 2, 2]
    odd = [(i, [float(i % 13), float(i)]) for i in range(40)] + [(40, [float("nan"), 1.0]), (41, [float("nan"), 2.0])]
    got = {r.key: [n.d for n in r.near] for r in B.nearest_neighbours(spark.createDataFrame(odd, schema), 3, 8).collect()}
    x = np.array([r[1] for r in odd[:40]])
    assert got[40] == got[41] == []
    for i in range(40):
        assert np.allclose(got[i], np.sort(np.sqrt(((x - x[i]) ** 2).sum(1)))[1:4])


def test_smote_balances_between_neighbours(spark):
    df = spark.range(200).select(
        "id", (F.col("id") % 5 == 0).cast("int").alias("target"), (F.col("id") * 1.0).alias("a"), (F.col("id") % 7 * 1.0).alias("b")
    )
    out = B.smote(df, ["a", "b"], "id", block_rows=16)
    n = {(r.target, r.synthetic): r["count"] for r in out.groupBy("target", "synthetic").count().collect()}
    assert n == {(0, False): 160, (1, False): 40, (1, True): 120}
    low, high = out.where("synthetic").agg(F.min("a"), F.max("a")).first()
    assert low >= 0 and high <= 195
    again = B.smote(df.repartition(5), ["a", "b"], "id", block_rows=16)
    assert sorted(rows(again.where("synthetic"))) == sorted(rows(out.where("synthetic")))


def test_work_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert work_folder(spark) == configured if configured else work_folder(spark).startswith("/tmp")


def test_group_quantiles_are_exact_with_null_and_hot_groups(spark):
    from breachline.operators.ordering import group_quantiles

    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 11}", float(i * 37 % 1009)) for i in range(3000)]
    rows += [("gone", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q_0, r.q_1) for r in group_quantiles(df, ["k"], "v", [0.5, 0.75]).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    want = {
        k: tuple(sorted(vs)[-(-len(vs) * top // 4) - 1] for top in (2, 3)) for k, vs in groups.items()
    }
    assert got == want and "gone" not in got
    assert S.group_median(df, [], "v", "m").first().m == sorted(v for _, v in rows if v is not None)[1499]
    stats = {r.k: r for r in S.group_stats(df, "k", "v").collect()}
    assert {k: r.p75_dias for k, r in stats.items()} == {k: w[1] for k, w in want.items()}


def test_sketches_of_loads_merge_to_the_sketch_of_all(spark):
    df = spark.range(20_000).selectExpr(
        "id", "id % 100 AS few", "CASE WHEN id % 3 = 0 THEN '' WHEN id % 5 = 0 THEN NULL ELSE 'x' END AS t",
        "CAST(id % 7 AS DOUBLE) * IF(id % 2 = 0, -1, 1) AS d")
    whole = {r.columna: r for r in P.sketched_counts(P.profile_sketch(df)).collect()}
    loads = P.profile_sketch(df.where("id % 2 = 0")).union(P.profile_sketch(df.where("id % 2 = 1")))
    merged = {r.columna: r for r in P.sketched_counts(P.merged_sketches(loads)).collect()}
    assert whole == merged
    exact = {r.columna: r for r in P.missing_profile(df).collect()}
    for name, row in whole.items():
        assert (row.nulos_n, row.total_filas_dataset) == (exact[name].nulos_n, 20_000)
        assert abs(row.unicos_n - exact[name].unicos_n) <= 0.03 * exact[name].unicos_n
    assert whole["t"].unicos_n == 3 and whole["few"].unicos_n == 100


def test_one_hot_leaves_the_levels_on_the_cluster(spark):
    train = spark.range(100_000).selectExpr("lpad(id, 8, '0') AS c")
    hot = E.one_hot(train, spark.createDataFrame([("00000000",), ("00099999",), ("x",), (None,)], "c string"), ["c"])
    got = {r.c: (r.c_onehot.size, r.c_onehot.indices.tolist()) for r in hot.collect()}
    assert got == {"00000000": (99_999, []), "00099999": (99_999, [99_998]), "x": (99_999, []), None: (99_999, [])}


def test_salts_come_from_all_columns(spark):
    from breachline.operators.joins import _spread

    df = spark.range(1000).selectExpr("'hot' AS k", "1 AS constant", "CAST(id AS STRING) AS text")
    assert df.select((_spread(df, ["k"]) % 16).alias("s")).distinct().count() == 31


def test_only_hot_keys_have_copies(spark, monkeypatch):
    monkeypatch.setattr(J.hot_keys, "__defaults__", (500,))
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(2000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    joined = J.attach_salted(df, table, "k")
    assert sorted(rows(joined.select("id", "v"))) == [(i, 0 if i % 2 == 0 else i * 2) for i in range(2000)]
    assert rows(J.hot_keys(df, ["k"])) == [(0, True)]
    copied = J.attach_salted(df, table, "k", counted=df.where("k <> 0"))  # no key is hot here
    plan = copied._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 15" not in plan and "_hot" not in plan
    assert sorted(rows(copied.select("id", "v"))) == sorted(rows(joined.select("id", "v")))


def test_partitions_of_an_ensemble_follow_cores_not_the_shuffle_width(spark, monkeypatch):
    df = spark.range(4000).selectExpr("CAST(id AS DOUBLE) AS x", "id % 2 AS target")
    monkeypatch.setattr(M, "PARTITION_ROWS", 250)
    assert M.assembled(df, ["x"], "target").rdd.getNumPartitions() == 16
    monkeypatch.undo()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert M.assembled(df, ["x"], "target").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
