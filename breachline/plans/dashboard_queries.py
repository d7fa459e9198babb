"""Queries behind the map, the charts and the drift views."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.operators import dashboards as D
from breachline.plans.fixture import (
    JUDGED,
    REQUESTS,
    SPLITS,
    judged,
    requests,
    rounded,
    splits,
    table,
)
from breachline.plans.registry import query


@query(
    f"""WITH {JUDGED} SELECT borough, count(*) AS n, round(avg(target), 6) AS rate FROM judged GROUP BY borough"""
)
def breach_rate_by_borough(spark, sf_dir):
    return rounded(D.rate_by_group(judged(spark, sf_dir), "borough"))


@query(
    """WITH r AS (SELECT hour(ts) AS h, avg(CAST(event_type = 'error' AS INTEGER)) AS rate FROM events GROUP BY 1),
p AS (SELECT h, rate FROM r ORDER BY rate DESC, h LIMIT 1)
SELECT h AS peak_hour, round(rate, 6) AS peak_rate, greatest(0, h - 1) AS range_start, least(23, h + 1) AS range_end FROM p"""
)
def peak_hour(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.hour("ts").alias("created_hour"),
        (F.col("event_type") == "error").cast("int").alias("is_overdue_official"),
    )
    return rounded(D.peak_hour(events))


@query(
    f"""WITH {JUDGED}, r AS (SELECT borough, avg(target) AS rate FROM judged GROUP BY borough),
w AS (SELECT borough, rate FROM r ORDER BY rate DESC, borough LIMIT 1),
b AS (SELECT borough, rate FROM r WHERE borough <> 'ASIA' ORDER BY rate, borough LIMIT 1)
SELECT w.borough AS worst, round(w.rate, 6) AS worst_rate, b.borough AS best, round(b.rate, 6) AS best_rate,
       round(w.rate - b.rate, 6) AS gap FROM w, b"""
)
def territorial_gap(spark, sf_dir):
    return rounded(D.territorial_gap(judged(spark, sf_dir), "borough", unspecified="ASIA"))


@query(
    f"""WITH {SPLITS}
SELECT split, count(*) AS requests,
       coalesce(CAST(sum(CAST(CASE WHEN penalty_charged > 0 THEN penalty_charged END AS DECIMAL(18,2))) AS DOUBLE), 0) AS penalty_usd,
       round(count_if(target = 1) * 100.0 / count(*), 6) AS breach_pct, count(DISTINCT agency) AS agencies
FROM splits GROUP BY split"""
)
def kpis_by_split(spark, sf_dir):
    return rounded(D.kpi_summary(splits(spark, sf_dir, ["agency", "target", "penalty_charged"]), ["split"], agency="agency"))


@query(
    f"""WITH {JUDGED} SELECT agency, count(*) AS n, '#aaaaaa' AS color FROM judged WHERE borough = 'EUROPE' GROUP BY agency"""
)
def legend_counts(spark, sf_dir):
    return D.legend_counts(judged(spark, sf_dir).where(F.col("borough") == "EUROPE"), "agency")


@query(
    f"""WITH {REQUESTS} SELECT location_type, list_sort(list(DISTINCT complaint_type)) AS partners
FROM requests WHERE location_type IS NOT NULL GROUP BY 1"""
)
def types_by_location(spark, sf_dir):
    df = requests(spark, sf_dir, ["location_type", "complaint_type"])
    return D.cooccurrence_sets(df, "location_type", "complaint_type")


@query(
    f"""WITH {JUDGED}, v AS (SELECT resolution_time_days AS x FROM judged WHERE agency = '2-HIGH' AND resolution_time_days IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50 AS w FROM v),
c AS (SELECT CAST(least(floor((x - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n FROM v, s GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS bin_start, round(lo + (b.bin + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n
FROM range(50) b(bin) LEFT JOIN c ON c.bin = b.bin, s"""
)
def duration_histogram(spark, sf_dir):
    one = judged(spark, sf_dir).where(F.col("agency") == "2-HIGH")
    return rounded(D.histogram(one, "resolution_time_days"))


@query(
    f"""WITH {JUDGED}
SELECT agency, max(sla_days) AS zone_start, max(resolution_time_days) AS zone_end, count(*) FILTER (WHERE resolution_time_days > sla_days) AS n_in_zone
FROM judged GROUP BY agency"""
)
def risk_zones(spark, sf_dir):
    return rounded(D.risk_zone(judged(spark, sf_dir), "agency", "resolution_time_days", "sla_days"))


@query(
    f"""WITH {SPLITS}
SELECT split, count_if(target = 0) AS n_neg, count_if(target = 1) AS n_pos, round(count_if(target = 0) * 100.0 / count(*), 6) AS pct_neg,
       round(count_if(target = 1) * 100.0 / count(*), 6) AS pct_pos,
       round(coalesce(count_if(target = 0) / nullif(CAST(count_if(target = 1) AS DOUBLE), 0), 0), 6) AS neg_per_pos
FROM splits GROUP BY split"""
)
def class_balance(spark, sf_dir):
    return rounded(D.class_balance(splits(spark, sf_dir, ["target"])))


@query(
    f"""WITH {SPLITS}, d AS (SELECT avg(target) FILTER (split = 'train') * 100 AS a, avg(target) FILTER (split = 'test') * 100 AS b FROM splits)
SELECT round(a, 6) AS train_pct, round(b, 6) AS test_pct, round(a - b, 6) AS drift_pp, round((a - b) * 100 / a, 6) AS reduction_pct FROM d"""
)
def drift_overall(spark, sf_dir):
    return rounded(D.drift_overall(splits(spark, sf_dir, ["target"])))


_DRIFT = """drift AS (SELECT complaint_type, count_if(split = 'train') AS n_train, count_if(split = 'test') AS n_test,
       avg(target) FILTER (split = 'train') * 100 AS train_pct, avg(target) FILTER (split = 'test') * 100 AS test_pct
       FROM splits GROUP BY 1 HAVING n_train >= 100 AND n_test >= 50)"""


@query(
    f"""WITH {SPLITS}, {_DRIFT}
SELECT complaint_type, n_train, n_test, round(train_pct, 6) AS train_pct, round(test_pct, 6) AS test_pct,
       round(test_pct - train_pct, 6) AS drift_pp FROM drift"""
)
def drift_by_type(spark, sf_dir):
    return rounded(D.drift_by_group(splits(spark, sf_dir, ["complaint_type", "target"]), "complaint_type"))


@query(
    f"""WITH {SPLITS}, {_DRIFT}
SELECT count(*) FILTER (WHERE test_pct = 0) AS groups_with_zero_test, round(max(abs(test_pct - train_pct)), 6) AS max_abs_drift_pp FROM drift"""
)
def drift_summary(spark, sf_dir):
    return rounded(D.drift_summary(D.drift_by_group(splits(spark, sf_dir, ["complaint_type", "target"]), "complaint_type")))


@query(
    f"""WITH {SPLITS}
SELECT agency, borough, round(avg(target) * 100, 2) AS rate_pct, count(target) AS n FROM splits WHERE split = 'train'
GROUP BY 1, 2 HAVING count(target) >= 100 ORDER BY rate_pct DESC, agency, borough LIMIT 10"""
)
def top_risk_groups(spark, sf_dir):
    train = splits(spark, sf_dir, ["agency", "borough", "target"]).where(F.col("split") == "train")
    return D.top_risk_groups(train, ["agency", "borough"])


_DAILY = """daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS total_reportes FROM events GROUP BY 1),
moves AS (SELECT day, total_reportes, lag(total_reportes) OVER (ORDER BY day) AS prev_total FROM daily),
change AS (SELECT *, (total_reportes - prev_total) / CAST(CASE WHEN prev_total = 0 THEN 1 ELSE prev_total END AS DOUBLE) AS delta_pct FROM moves)"""


@query(
    f"""WITH {_DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, total_reportes, prev_total, round(delta_pct, 6) AS delta_pct FROM change"""
)
def day_over_day(spark, sf_dir):
    return rounded(D.day_over_day(table(spark, sf_dir, "events"), "ts"))


@query(
    f"""WITH {_DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, total_reportes, prev_total, round(delta_pct, 6) AS delta_pct,
       'mayor aumento porcentual respecto al día anterior' AS reason
FROM change ORDER BY change.delta_pct DESC NULLS LAST, change.day LIMIT 1"""
)
def trend_break(spark, sf_dir):
    return rounded(D.trend_break(D.day_over_day(table(spark, sf_dir, "events"), "ts")))


_BRANDS = "brands AS (SELECT p_brand AS feature, avg(p_retailprice) AS price, avg(p_size) AS size, count(*) AS n FROM part GROUP BY 1)"


def _brands(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("feature")).agg(
        F.avg("p_retailprice").alias("price"), F.avg("p_size").alias("size"), F.count(F.lit(1)).alias("n")
    )


@query(
    f"""WITH {_BRANDS}, r AS (SELECT feature, round(price, 6) AS price, round(size, 6) AS size,
   CAST(row_number() OVER (ORDER BY price DESC, feature) AS INTEGER) AS rank_first, CAST(row_number() OVER (ORDER BY size DESC, feature) AS INTEGER) AS rank_second FROM brands)
SELECT *, rank_second - rank_first AS rank_change FROM r ORDER BY abs(rank_second - rank_first) DESC, feature LIMIT 10"""
)
def rank_changes(spark, sf_dir):
    brands = _brands(spark, sf_dir)
    compared = D.rank_compare(
        brands.select("feature", "price"), brands.select("feature", "size"), "feature", "price", "size"
    )
    return rounded(compared)


@query(
    f"""WITH {_BRANDS} SELECT feature, round(size, 6) AS size, n, CAST(row_number() OVER (ORDER BY brands.size DESC, feature) AS INTEGER) AS place
FROM brands"""
)
def field_ranking(spark, sf_dir):
    """Fields in metric order, numbered in that order."""
    from pyspark.sql import Window

    ordered = D.ranked(_brands(spark, sf_dir).drop("price"), "size", "feature")
    place = F.row_number().over(Window.orderBy(F.desc("size"), "feature"))  # one row per brand
    return rounded(ordered.withColumn("place", place))


@query(
    f"""WITH {_BRANDS}, r AS (SELECT feature, size, CAST(row_number() OVER (ORDER BY size DESC, feature) AS INTEGER) AS place FROM brands)
SELECT feature, round(size, 6) AS size, place, CASE WHEN place <= 3 THEN 'top' WHEN place <= 8 THEN 'middle' ELSE 'rest' END AS tier
FROM r WHERE place <= 15"""
)
def top_features(spark, sf_dir):
    return rounded(D.top_n(_brands(spark, sf_dir).select("feature", "size"), "size", "feature"))


@query(
    f"""WITH {_BRANDS}
SELECT (SELECT feature FROM brands ORDER BY price DESC, feature LIMIT 1) AS arg_max, round(max(price), 6) AS max_value,
       (SELECT feature FROM brands ORDER BY price, feature LIMIT 1) AS arg_min, round(min(price), 6) AS min_value FROM brands"""
)
def extreme_entities(spark, sf_dir):
    return rounded(D.extremes(_brands(spark, sf_dir), "feature", "price"))


@query(
    f"""WITH {_BRANDS}, l AS (SELECT feature, unnest(['price', 'size', 'n']) AS metric, unnest([price, size, CAST(n AS DOUBLE)]) AS value FROM brands)
SELECT metric, (SELECT feature FROM l b WHERE b.metric = a.metric ORDER BY value DESC, feature LIMIT 1) AS winner, round(max(value), 6) AS value
FROM l a GROUP BY metric"""
)
def winner_per_metric(spark, sf_dir):
    wide = _brands(spark, sf_dir).withColumn("n", F.col("n").cast("double"))
    long = D.unpivot_metrics(wide, "feature", ["price", "size", "n"])
    return rounded(D.winner_per_metric(long, "feature"))


@query(
    f"""WITH {REQUESTS} SELECT complaint_type, count(*) AS n FROM requests GROUP BY 1 ORDER BY n DESC, complaint_type LIMIT 10"""
)
def top_complaints(spark, sf_dir):
    return D.top_categories(requests(spark, sf_dir, ["complaint_type"]), "complaint_type")


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 500"""
)
def sampled_requests(spark, sf_dir):
    """A repeatable sample of 500 requests."""
    return D.sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 500).select("o_orderkey", "o_orderpriority")


@query(
    f"""WITH {REQUESTS}
SELECT request_key, latitude, longitude FROM requests WHERE latitude IS NOT NULL AND longitude IS NOT NULL
ORDER BY md5(CAST(request_key AS VARCHAR) || '|42'), request_key, price, longitude LIMIT 5000"""
)
def map_sample(spark, sf_dir):
    """At most 5 000 requests with known coordinates for the map."""
    df = requests(spark, sf_dir, ["request_key", "latitude", "longitude", "price"])
    return D.map_sample(df, ["request_key"], 5000, ties=["price", "longitude"]).select("request_key", "latitude", "longitude")


@query(
    f"""WITH {JUDGED}
SELECT request_key, '#aaaaaa' AS color, CASE WHEN target = 1 THEN 0.9 ELSE 0.8 END AS opacity,
       'Tipo: ' || complaint_type || chr(10) || 'Agencia: ' || agency || chr(10) || 'Municipio: ' || borough || chr(10) || 'Resultado: '
       || coalesce(CASE target WHEN 1 THEN 'Incumplió' WHEN 0 THEN 'Cumplió' END, '') || chr(10) || 'Penalidad: '
       || CASE WHEN penalty_charged > 0 THEN '$' || CAST(CAST(penalty_charged AS BIGINT) // 1000 AS VARCHAR) || ',000' ELSE '$0' END
       || chr(10) || 'SLA: ' || coalesce(CAST(sla_days AS VARCHAR), '') || chr(10) || 'ZIP: ' || CAST(incident_zip AS VARCHAR) AS hover
FROM judged"""
)
def map_markers(spark, sf_dir):
    marked = D.map_markers(judged(spark, sf_dir), "complaint_type", "agency", "borough", "incident_zip")
    return marked.select("request_key", "color", F.col("opacity").cast("double").alias("opacity"), "hover")


@query(
    f"""WITH {REQUESTS}
SELECT agency, count_if(returnflag = 'A') AS "A", count_if(returnflag = 'N') AS "N", count_if(returnflag = 'R') AS "R",
       round(count_if(returnflag = 'A') * 100.0 / (SELECT count(*) FROM requests), 6) AS "A_pct",
       round(count_if(returnflag = 'N') * 100.0 / (SELECT count(*) FROM requests), 6) AS "N_pct",
       round(count_if(returnflag = 'R') * 100.0 / (SELECT count(*) FROM requests), 6) AS "R_pct" FROM requests GROUP BY agency"""
)
def outcome_matrix(spark, sf_dir):
    df = requests(spark, sf_dir, ["agency", "returnflag"])
    return rounded(D.pivot_counts(df, "agency", "returnflag", ["A", "N", "R"], with_pct=True))


@query(
    f"""WITH {_BRANDS} SELECT feature, unnest(['price', 'size']) AS metric, unnest([round(price, 6), round(size, 6)]) AS value FROM brands"""
)
def metrics_unpivoted(spark, sf_dir):
    return rounded(D.unpivot_metrics(_brands(spark, sf_dir), "feature", ["price", "size"]))
