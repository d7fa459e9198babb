"""Queries over scalar functions, fitted statistics, splits, encodings and gold features."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.functions import geo, sla, text, times
from breachline.operators import dashboards as D
from breachline.operators import encoding as E
from breachline.operators import features as X
from breachline.operators import ordering as O
from breachline.operators import splitting as L
from breachline.operators import statistics as S
from breachline.plans import pipelines
from breachline.plans.fixture import (
    JUDGED,
    REQUESTS,
    SILVER,
    SPLITS,
    fixture_lookup,
    judged,
    requests,
    rounded,
    silver,
    splits,
    stored_silver,
    table,
)
from breachline.plans.registry import query
from breachline.settings import cut

COLS = X.RequestColumns(
    key="request_key",
    agency="agency",
    complaint_type="complaint_type",
    borough="borough",
    channel="channel",
    location_type="location_type",
    zip_code="incident_zip",
)
#: Of the request fields the features read these.
COLS_READ = [COLS.key, COLS.created, COLS.closed, COLS.latitude, COLS.longitude, *COLS.described]


#: ``stable_fold`` of the key in SQL.
FOLD = "CAST('0x' || substr(md5(CAST(request_key AS VARCHAR) || '|42'), 1, 7) AS BIGINT) % 5"


# ---- scalar functions ------------------------------------------------------------------


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed,
       CAST(floor(epoch(date_trunc('second', ts))) AS BIGINT) AS seconds, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS back
FROM events"""
)
def parsed_timestamps(spark, sf_dir):
    """Text to timestamps with unreadable text becoming NULL, and to epoch seconds and back."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text")
    )
    dirty = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), "text")).otherwise(F.col("text"))
    seconds = times.epoch_seconds(F.col("ts"))
    return rounded(
        events.select(
            "event_id",
            times.parse_timestamp(dirty).alias("parsed"),
            seconds.alias("seconds"),
            times.from_epoch_seconds(seconds).alias("back"),
        )
    )


@query(
    f"""WITH {REQUESTS}
SELECT request_key, date_diff('day', CAST(created_ts AS DATE), CAST(closed_ts AS DATE)) AS days_int,
       round((epoch(closed_ts) - epoch(created_ts)) / 86400.0, 6) AS days,
       date_diff('day', DATE '2010-01-01', CAST(created_ts AS DATE)) AS day_no FROM requests"""
)
def durations(spark, sf_dir):
    df = requests(spark, sf_dir, ["request_key", "created_ts", "closed_ts"])
    created, closed = F.col("created_ts"), F.col("closed_ts")
    return rounded(
        df.select(
            "request_key",
            times.duration_days_int(closed, created).alias("days_int"),
            times.duration_days(closed, created).alias("days"),
            times.day_number(F.to_date(created)).alias("day_no"),
        )
    )


@query(
    """SELECT event_id, hour(ts) AS created_hour, dayofweek(ts) + 1 AS created_day_of_week_num, month(ts) AS created_month,
       year(ts) AS created_year, strftime(ts, '%Y-%m-%d') AS created_date_only, dayname(ts) AS created_day_of_week_name,
       quarter(ts) AS trimestre, CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS es_fin_de_semana,
       CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'manana' WHEN hour(ts) BETWEEN 12 AND 19 THEN 'tarde' ELSE 'noche' END AS turno,
       round(sin(2 * pi() * hour(ts) / 24), 6) AS hora_sen, round(cos(2 * pi() * hour(ts) / 24), 6) AS hora_cos,
       round(sin(2 * pi() * (dayofweek(ts) + 1) / 7), 6) AS dia_semana_sen, round(cos(2 * pi() * (dayofweek(ts) + 1) / 7), 6) AS dia_semana_cos,
       isodow(ts) % 7 + 1 AS from_monday
FROM events"""
)
def calendar_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    parts = events.withColumns(times.calendar_parts(F.col("ts")))
    hour_sin, hour_cos = times.cyclic(F.hour("ts"), 24)
    week_sin, week_cos = times.cyclic(F.dayofweek("ts"), 7)
    return rounded(
        parts.withColumns(
            {
                "trimestre": F.quarter("ts"),
                "es_fin_de_semana": times.weekend_flag(F.col("ts")),
                "turno": times.shift_of_day(F.hour("ts")),
                "hora_sen": hour_sin,
                "hora_cos": hour_cos,
                "dia_semana_sen": week_sin,
                "dia_semana_cos": week_cos,
                "from_monday": times.weekday_from_monday_zero(F.weekday("ts")),
            }
        ).drop("ts")
    )


@query(
    f"""WITH {REQUESTS}
SELECT request_key, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(40.73 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(40.73))
       * pow(sin(radians(-73.935 - longitude) / 2), 2))), 6) AS km FROM requests"""
)
def distance_to_center(spark, sf_dir):
    df = requests(spark, sf_dir, ["request_key", "latitude", "longitude"])
    lat, lon, _ = geo.map_view(None)
    km = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    return rounded(df.select("request_key", km.alias("km")))


@query(
    f"""WITH {REQUESTS}
SELECT concat_ws('_', borough, CASE WHEN channel = 'F' THEN NULL ELSE channel END) AS borough_canal, count(*) AS n
FROM requests GROUP BY 1"""
)
def borough_channel_key(spark, sf_dir):
    df = requests(spark, sf_dir, ["borough", "channel"])
    key = text.joined_key(F.col("borough"), F.when(F.col("channel") != "F", F.col("channel")))
    return df.groupBy(key.alias("borough_canal")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {JUDGED}
SELECT request_key, round(quantity / (sla_days + 0.01), 6) AS ratio, target, penalty_charged,
       round(greatest(0.05, least(0.95, discount * 10)), 4) AS clipped, round(abs(quantity - 25), 2) AS away
FROM judged"""
)
def breach_targets(spark, sf_dir):
    df = judged(spark, sf_dir)
    return df.select(
        "request_key",
        F.round(sla.smoothed_ratio(F.col("quantity"), F.col("sla_days")), 6).alias("ratio"),
        "target",
        "penalty_charged",
        F.round(sla.clip(F.col("discount") * 10, 0.05, 0.95), 4).alias("clipped"),
        F.round(F.abs(F.col("quantity") - 25), 2).alias("away"),
    )


@query(
    f"""WITH {JUDGED},
p AS (SELECT complaint_type, quantile_disc(resolution_time_days, 0.75) AS p75 FROM judged WHERE resolution_time_days >= 0.001 GROUP BY 1)
SELECT request_key, CASE WHEN resolution_time_days > p75 THEN 1 ELSE 0 END AS is_sla_non_compliant,
       round(p75, 6) AS p75_resolution_time_days
FROM judged LEFT JOIN p USING (complaint_type)"""
)
def breach_by_percentile(spark, sf_dir):
    from breachline.operators.joins import attach

    df = cut(judged(spark, sf_dir).select("request_key", "complaint_type", "resolution_time_days"))
    limits = S.group_percentile(df, "complaint_type", "resolution_time_days")
    joined = attach(df, limits, "complaint_type")
    flag = sla.breach_by_percentile(F.col("resolution_time_days"), F.col("p75_resolution_time_days"))
    return rounded(
        joined.select("request_key", flag.alias("is_sla_non_compliant"), "p75_resolution_time_days")
    )


@query(
    """SELECT p_partkey, trim(upper(p_name)) AS clean, regexp_replace('<b>' || p_name || '</b>', '<[^>]+>', '', 'g') AS plain,
       replace(lower(p_type), ' ', '_') AS slug FROM part"""
)
def cleaned_text(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.clean_category(name).alias("clean"),
        text.strip_tags(F.concat(F.lit("<b>"), name, F.lit("</b>"))).alias("plain"),
        F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")).alias("slug"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '$' || CASE WHEN round_even(c_acctbal, 0) >= 1000
         THEN CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) // 1000 AS VARCHAR) || ',' || lpad(CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
         ELSE CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) AS VARCHAR) END ELSE '$0' END AS money,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title,
       'Nombre: ' || c_name || chr(10) || 'Segmento: ' || coalesce(c_mktsegment, '') AS hover
FROM customer"""
)
def marker_labels(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.money_label(F.col("c_acctbal")).alias("money"),
        text.title_case(F.col("c_mktsegment")).alias("title"),
        text.hover_text(Nombre=F.col("c_name"), Segmento=F.col("c_mktsegment")).alias("hover"),
    )


# ---- fitted statistics -----------------------------------------------------------------


@query(
    f"""WITH {JUDGED}
SELECT complaint_type, round(quantile_disc(resolution_time_days, 0.75), 6) AS p75_resolution_time_days
FROM judged WHERE resolution_time_days >= 0.001 GROUP BY 1"""
)
def resolution_percentiles(spark, sf_dir):
    return rounded(S.group_percentile(judged(spark, sf_dir), "complaint_type", "resolution_time_days"))


@query(
    f"""WITH {SPLITS}, t AS (SELECT * FROM splits WHERE split = 'train' AND resolution_time_days >= 0)
SELECT complaint_type, round(avg(resolution_time_days), 6) AS avg_dias, round(stddev_samp(resolution_time_days), 6) AS std_dias,
       round(quantile_disc(resolution_time_days, 0.75), 6) AS p75_dias, count(*) AS n FROM t GROUP BY 1"""
)
def duration_stats_by_type(spark, sf_dir):
    train = splits(spark, sf_dir, ["complaint_type", "resolution_time_days"]).where(F.col("split") == "train")
    return rounded(S.group_stats(train, "complaint_type", "resolution_time_days"))


@query(
    f"""WITH {SPLITS}, t AS (SELECT * FROM splits WHERE split = 'train' AND resolution_time_days >= 0)
SELECT round(avg(resolution_time_days), 6) AS global_avg, round(stddev_samp(resolution_time_days), 6) AS global_std,
       round(quantile_disc(resolution_time_days, 0.75), 6) AS global_p75 FROM t"""
)
def duration_stats_overall(spark, sf_dir):
    train = splits(spark, sf_dir, ["resolution_time_days"]).where(F.col("split") == "train")
    return rounded(S.global_stats(train, "resolution_time_days"))


@query(
    """WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, CAST(quantile_disc(n, 0.5) AS BIGINT) AS median_day FROM d GROUP BY 1"""
)
def median_day_by_group(spark, sf_dir):
    daily = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return S.group_median(daily, "l_suppkey", "n", "median_day")


@query(
    f"""WITH {SPLITS}
SELECT agency, borough, round(avg(latitude), 6) AS centroid_lat, round(avg(longitude), 6) AS centroid_lon
FROM splits WHERE split = 'train' GROUP BY 1, 2"""
)
def group_centroids(spark, sf_dir):
    train = splits(spark, sf_dir, ["agency", "borough", "latitude", "longitude"]).where(F.col("split") == "train")
    return rounded(S.group_centroid(train, ["agency", "borough"]))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS quejas_por_dia FROM events GROUP BY 1")
def daily_volume(spark, sf_dir):
    return rounded(S.daily_volume(table(spark, sf_dir, "events"), "ts"))


@query(
    f"""WITH {SPLITS} SELECT incident_zip, strftime(created_ts, '%Y-%m-%d') AS day, count(*) AS n FROM splits GROUP BY 1, 2"""
)
def zip_day_counts(spark, sf_dir):
    df = splits(spark, sf_dir, ["incident_zip"]).withColumn("day", F.to_date("created_ts"))
    return rounded(S.group_count(df, ["incident_zip", "day"]))


@query(
    """WITH d AS (SELECT l_suppkey, date_diff('day', DATE '2010-01-01', CAST(l_shipdate AS DATE)) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, day, CAST(sum(n) OVER (PARTITION BY l_suppkey ORDER BY day RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS BIGINT) AS densidad_zip_30d
FROM d"""
)
def rolling_density(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", times.day_number(F.to_date("l_shipdate")).alias("day")
    )
    return S.rolling_range_sum(df, "l_suppkey", "day")


@query(
    f"""WITH {JUDGED},
p AS (SELECT complaint_type, quantile_disc(resolution_time_days, 0.75) AS p75 FROM judged WHERE resolution_time_days >= 0.001 GROUP BY 1)
SELECT request_key, round(resolution_time_days, 6) AS resolution_time_days, round(p75, 6) AS p75_resolution_time_days,
       CASE WHEN resolution_time_days > p75 THEN 1 ELSE 0 END AS is_sla_non_compliant, sla_days AS official_sla_days,
       coalesce(target, 0) AS is_overdue_official, hour(created_ts) AS created_hour, dayofweek(created_ts) + 1 AS created_day_of_week_num,
       month(created_ts) AS created_month, year(created_ts) AS created_year, strftime(created_ts, '%Y-%m-%d') AS created_date_only,
       dayname(created_ts) AS created_day_of_week_name
FROM judged LEFT JOIN p USING (complaint_type)"""
)
def gold_eda_table(spark, sf_dir):
    """Silver enriched for the charts."""
    base = cut(silver(spark, sf_dir), "silver")
    eda = pipelines.gold_eda(
        base, fixture_lookup(spark), "created_ts", "closed_ts", "complaint_type", "agency"
    )
    added = [c for c in eda.columns if c not in base.columns and not c.endswith("timestamp")]
    return rounded(eda.select("request_key", *added))


@query(
    f"""WITH {SILVER},
v AS (SELECT request_key, created_ts, date_diff('day', CAST(created_ts AS DATE), CAST(closed_ts AS DATE)) AS dias_resolucion FROM silver),
k AS (SELECT * FROM v WHERE dias_resolucion >= 0),
c AS (SELECT quantile_disc(CAST(epoch(created_ts) AS BIGINT), 0.7) AS a, quantile_disc(CAST(epoch(created_ts) AS BIGINT), 0.85) AS b FROM k)
SELECT request_key, dias_resolucion, strftime(created_ts, '%Y-%m-%d') AS fecha_creacion,
       CASE WHEN epoch(created_ts) <= a THEN 'train' WHEN epoch(created_ts) <= b THEN 'val' ELSE 'test' END AS split FROM k, c"""
)
def split_layer(spark, sf_dir):
    """Closed requests with their whole days and split."""
    parts = pipelines.split_silver(silver(spark, sf_dir), "created_ts", "closed_ts")
    return rounded(parts.select("request_key", "dias_resolucion", "fecha_creacion", "split"))


# ---- positions, folds and splits -------------------------------------------------------


@query(
    """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events"""
)
def row_positions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return O.global_row_index(events, [F.col("ts"), F.col("event_id")]).select("event_id", "row_index")


@query(
    """WITH i AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM events),
f AS (SELECT p, n, n // 6 AS t, n - 5 * (n // 6) AS o FROM i)
SELECT CAST((p - o) // t AS INTEGER) AS fold, min(o + ((p - o) // t) * t) AS train_rows, count(*) AS test_rows,
       min(o + ((p - o) // t) * t) - 1 AS train_last, min(p) AS test_first, max(p) AS test_last
FROM f WHERE p >= o GROUP BY 1"""
)
def expanding_folds(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return O.fold_summary(O.expanding_folds(events, [F.col("ts"), F.col("event_id")]))


@query(f"WITH {SPLITS} SELECT request_key, split FROM splits")
def temporal_split(spark, sf_dir):
    return splits(spark, sf_dir, ["request_key"]).select("request_key", "split")


@query(
    f"""WITH {SPLITS}
SELECT split, count(*) AS n, count_if(target = 1) AS n_pos, count_if(target = 0) AS n_neg,
       CAST(coalesce(sum(CAST(penalty_charged AS DECIMAL(18,2))), 0) AS DOUBLE) AS penalty_usd,
       round(count_if(target = 1) * 100.0 / count(*), 6) AS breach_pct,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct FROM splits GROUP BY split"""
)
def split_summary(spark, sf_dir):
    return rounded(D.split_summary(splits(spark, sf_dir, ["target", "penalty_charged"])))


@query(
    f"""WITH {SPLITS}, b AS (
SELECT min(created_ts) FILTER (split = 'train') AS train_first, max(created_ts) FILTER (split = 'train') AS train_last,
       min(created_ts) FILTER (split = 'val') AS val_first, max(created_ts) FILTER (split = 'val') AS val_last,
       min(created_ts) FILTER (split = 'test') AS test_first, max(created_ts) FILTER (split = 'test') AS test_last FROM splits)
SELECT strftime(train_first, '%Y-%m-%d %H:%M:%S') AS train_first, strftime(train_last, '%Y-%m-%d %H:%M:%S') AS train_last,
       strftime(val_first, '%Y-%m-%d %H:%M:%S') AS val_first, strftime(val_last, '%Y-%m-%d %H:%M:%S') AS val_last,
       strftime(test_first, '%Y-%m-%d %H:%M:%S') AS test_first, strftime(test_last, '%Y-%m-%d %H:%M:%S') AS test_last,
       train_last <= val_first AS train_before_val, val_last <= test_first AS val_before_test FROM b"""
)
def temporal_integrity(spark, sf_dir):
    return rounded(D.temporal_integrity(splits(spark, sf_dir, ["created_ts"]), "created_ts"))


@query(
    f"""WITH {SPLITS}, m AS (
  SELECT split, coalesce(epoch(created_ts) > (SELECT max(epoch(created_ts)) FROM splits) - sla_days * 86400, false) AS censored FROM splits)
SELECT split, count(*) AS n, count_if(censored) AS n_dropped, round(count_if(censored) * 100.0 / count(*), 6) AS pct_dropped
FROM m GROUP BY split"""
)
def censored_by_time(spark, sf_dir):
    marked = L.mark_censored(splits(spark, sf_dir, ["sla_days"]), "created_ts", "sla_days")
    return rounded(L.censor_report(marked))


@query(
    f"""WITH {SPLITS}, i AS (
  SELECT request_key, sla_days, row_number() OVER (ORDER BY created_ts, request_key) - 1 AS p, count(*) OVER () AS n FROM splits)
SELECT request_key FROM i WHERE NOT coalesce(p > n - 1 - floor(sla_days * (n / 4000.0)), false)"""
)
def kept_by_rank(spark, sf_dir):
    df = cut(splits(spark, sf_dir, ["request_key", "sla_days"]).select("request_key", "created_ts", "sla_days"))
    order = [F.col("created_ts"), F.col("request_key")]
    kept = L.censor_filter(df, "created_ts", "sla_days", mode="rank", order=order, observed_days=4000)
    return kept.select("request_key")


# ---- encodings -------------------------------------------------------------------------


@query(
    f"""WITH {SPLITS}, t AS (SELECT request_key, complaint_type, target, {FOLD} AS fold FROM splits WHERE split = 'train'),
a AS (SELECT complaint_type, fold, coalesce(sum(target), 0) AS s, count(target) AS c FROM t GROUP BY 1, 2),
o AS (SELECT complaint_type, fold, (sum(s) OVER (PARTITION BY complaint_type) - s) / nullif(CAST(sum(c) OVER (PARTITION BY complaint_type) - c AS DOUBLE), 0) AS te FROM a)
SELECT request_key, round(coalesce(te, (SELECT avg(target) FROM t)), 6) AS complaint_type_te
FROM t LEFT JOIN o USING (complaint_type, fold)"""
)
def out_of_fold_encoding(spark, sf_dir):
    df = splits(spark, sf_dir, ["request_key", "complaint_type", "target"]).where(F.col("split") == "train")
    train = cut(df.withColumn("fold", sla.stable_fold(F.col("request_key"))))
    encoded = E.target_encode_oof(train, "complaint_type", "target", "fold")
    return rounded(encoded.select("request_key", "complaint_type_te"))


@query(
    f"""WITH {SPLITS}, t AS (SELECT incident_zip, avg(target) AS te FROM splits WHERE split = 'train' GROUP BY 1)
SELECT request_key, round(coalesce(te, (SELECT avg(target) FROM splits WHERE split = 'train')), 6) AS incident_zip_te
FROM splits LEFT JOIN t USING (incident_zip) WHERE split = 'test'"""
)
def full_target_encoding(spark, sf_dir):
    df = cut(splits(spark, sf_dir, ["request_key", "incident_zip", "target"]).select("request_key", "incident_zip", "target", "split"))
    train, test = df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
    encoded = E.target_encode_full(train, test, "incident_zip", "target")
    return rounded(encoded.select("request_key", "incident_zip_te"))


def _index_sql(column: str) -> str:
    return (
        f"(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS v FROM t WHERE {column} IS NOT NULL GROUP BY 1)"
    )


@query(
    f"""WITH {SPLITS}, t AS (SELECT * FROM splits WHERE split = 'train' AND agency <> '5-LOW')
SELECT request_key, CAST(coalesce(a.v, (SELECT count(DISTINCT agency) FROM t)) AS DOUBLE) AS agency_idx,
       CAST(coalesce(l.v, (SELECT count(DISTINCT location_type) FROM t)) AS DOUBLE) AS location_type_idx
FROM splits LEFT JOIN {_index_sql("agency")} a USING (agency) LEFT JOIN {_index_sql("location_type")} l USING (location_type)"""
)
def category_indices(spark, sf_dir):
    df = cut(splits(spark, sf_dir, ["request_key", "agency", "location_type"]).select("request_key", "agency", "location_type", "split"))
    train = df.where((F.col("split") == "train") & (F.col("agency") != "5-LOW"))
    indexed = E.index_categories(train, df, ["agency", "location_type"])
    return indexed.select("request_key", "agency_idx", "location_type_idx")


@query(
    f"""WITH {SPLITS}
SELECT request_key, CAST(agency = '3-MEDIUM' AS INTEGER) AS "agency_3-MEDIUM", CAST(agency = '4-NOT SPECIFIED' AS INTEGER) AS "agency_4-NOT SPECIFIED",
       CAST(agency = '5-LOW' AS INTEGER) AS "agency_5-LOW", CAST(channel = 'O' AS INTEGER) AS channel_O
FROM splits WHERE split = 'val'"""
)
def one_hot_columns(spark, sf_dir):
    df = cut(splits(spark, sf_dir, ["request_key", "agency", "channel"]).select("request_key", "agency", "channel", "split"))
    train = df.where((F.col("split") == "train") & (F.col("agency") != "1-URGENT"))
    val = df.where(F.col("split") == "val")
    levels = {c: E.one_hot_levels(train, c) for c in ("agency", "channel")}
    return E.one_hot_columns(val, levels).drop("agency", "channel", "split")


@query(
    f"""WITH {SPLITS}, levels AS (
  SELECT incident_zip, row_number() OVER (ORDER BY CAST(incident_zip AS VARCHAR)) - 2 AS place
  FROM (SELECT DISTINCT incident_zip FROM splits WHERE split = 'train' AND incident_zip IS NOT NULL))
SELECT request_key, CASE WHEN place >= 0 THEN CAST(place AS BIGINT) END AS place, (SELECT count(*) - 1 FROM levels) AS width
FROM splits LEFT JOIN levels USING (incident_zip) WHERE split = 'val'"""
)
def one_hot_vectors(spark, sf_dir):
    """Where the one of the vector is, over as many levels as the training rows have."""
    df = cut(splits(spark, sf_dir, ["request_key", "incident_zip"]).select("request_key", F.col("incident_zip").cast("string").alias("zip"), "split"))
    hot = E.one_hot(df.where("split = 'train'"), df.where("split = 'val'"), ["zip"])
    # vectors are sparse: their form as an array would be as long as there are levels
    vector = F.unwrap_udt("zip_onehot")
    place = F.get(vector["indices"], F.lit(0)).cast("bigint")
    return hot.select("request_key", place.alias("place"), vector["size"].cast("bigint").alias("width"))


@query(
    f"""WITH {SPLITS}, m AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(tax) AS mt, stddev_pop(tax) AS st FROM splits WHERE split = 'train')
SELECT request_key, round((price - mp) / sp, 6) AS price, round((tax - mt) / st, 6) AS tax, CAST(0 AS DOUBLE) AS flat
FROM splits, m WHERE split <> 'train'"""
)
def standardized_columns(spark, sf_dir):
    df = splits(spark, sf_dir, ["request_key", "price", "tax"]).select("request_key", "price", "tax", F.lit(3.0).alias("flat"), "split")
    df = cut(df)
    train = df.where(F.col("split") == "train")
    scaled = E.standardize(train, df.where(F.col("split") != "train"), ["price", "tax", "flat"])
    return rounded(scaled.drop("split"))


@query(
    f"""WITH {SPLITS}
SELECT count_if(target = 0) AS n_neg, count_if(target = 1) AS n_pos, round(count(target) / (2.0 * count_if(target = 0)), 6) AS weight_neg,
       round(count(target) / (2.0 * count_if(target = 1)), 6) AS weight_pos,
       round(count_if(target = 0) / CAST(count_if(target = 1) AS DOUBLE), 6) AS scale_pos_weight
FROM splits WHERE split = 'train'"""
)
def class_weights(spark, sf_dir):
    return rounded(E.class_weights(splits(spark, sf_dir, ["target"]).where(F.col("split") == "train")))


# ---- the gold table --------------------------------------------------------------------

_INDEXED = ["agency", "borough", "channel", "location_type", "turno"]
_ENCODED = ["complaint_type", "incident_zip", "borough_canal"]
GOLD = (
    SPLITS
    + """,
prepared AS (SELECT *, CAST('0x' || substr(md5(CAST(request_key AS VARCHAR) || '|42'), 1, 7) AS BIGINT) % 5 AS fold, concat_ws('_', borough, channel) AS borough_canal, 'noche' AS turno,
       date_diff('day', DATE '2010-01-01', CAST(created_ts AS DATE)) AS day_no FROM splits),
t AS (SELECT * FROM prepared WHERE split = 'train'),
valid AS (SELECT * FROM t WHERE resolution_time_days >= 0),
by_type AS (SELECT complaint_type, avg(resolution_time_days) AS avg_ct, stddev_samp(resolution_time_days) AS std_ct,
       quantile_disc(resolution_time_days, 0.75) AS p75_ct FROM valid GROUP BY 1),
by_agency AS (SELECT agency, avg(resolution_time_days) AS avg_a FROM valid GROUP BY 1),
by_borough AS (SELECT borough, avg(resolution_time_days) AS avg_b FROM valid GROUP BY 1),
by_zip AS (SELECT incident_zip, avg(resolution_time_days) AS avg_z FROM valid GROUP BY 1),
g AS (SELECT avg(resolution_time_days) AS g_avg, stddev_samp(resolution_time_days) AS g_std,
       quantile_disc(resolution_time_days, 0.75) AS g_p75 FROM valid),
rate AS (SELECT avg(target) AS g_rate FROM t),
centroid AS (SELECT agency, borough, avg(latitude) AS c_lat, avg(longitude) AS c_lon FROM t GROUP BY 1, 2),
zip_day AS (SELECT incident_zip, day_no, count(*) AS n FROM t GROUP BY 1, 2),
density AS (SELECT incident_zip, day_no, sum(n) OVER (PARTITION BY incident_zip ORDER BY day_no
       RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS d FROM zip_day),
zip_median AS (SELECT incident_zip, quantile_disc(d, 0.5) AS d_zip FROM density GROUP BY 1),
g_density AS (SELECT quantile_disc(d, 0.5) AS d_all FROM density),
volume AS (SELECT day_no, count(*) AS v FROM t GROUP BY 1),
g_volume AS (SELECT quantile_disc(v, 0.5) AS v_all FROM volume)"""
    + "".join(
        f""",
idx_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i_{c} FROM t GROUP BY 1)"""
        for c in _INDEXED
    )
    + "".join(
        f""",
f_{c} AS (SELECT {c}, fold, coalesce(sum(target), 0) AS s, count(target) AS c FROM t GROUP BY 1, 2),
oof_{c} AS (SELECT {c}, fold, (sum(s) OVER (PARTITION BY {c}) - s) / nullif(CAST(sum(c) OVER (PARTITION BY {c}) - c AS DOUBLE), 0) AS oof_{c} FROM f_{c}),
te_{c} AS (SELECT {c}, avg(target) AS te_{c} FROM t GROUP BY 1)"""
        for c in _ENCODED
    )
    + """,
joined AS (
  SELECT p.*, coalesce(avg_ct, g_avg) AS avg_dias_complaint_type, coalesce(std_ct, g_std) AS std_dias_complaint_type,
         coalesce(p75_ct, g_p75) AS p75_dias_complaint_type, coalesce(avg_a, g_avg) AS avg_dias_agency,
         coalesce(avg_b, g_avg) AS avg_dias_borough, coalesce(avg_z, g_avg) AS avg_dias_zip,
         2 * 6371.0 * asin(sqrt(pow(sin(radians(c_lat - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(c_lat))
           * pow(sin(radians(c_lon - longitude) / 2), 2))) AS dist_km_agencia,
         CAST(coalesce(d, d_zip, d_all) AS BIGINT) AS densidad_zip_30d, CAST(coalesce(v, v_all) AS BIGINT) AS quejas_por_dia,"""
    + ", ".join(
        f"CAST(coalesce(i_{c}, (SELECT count(*) FROM idx_{c})) AS DOUBLE) AS {c}_idx" for c in _INDEXED
    )
    + ", "
    + ", ".join(
        f"coalesce(CASE WHEN split = 'train' THEN oof_{c} ELSE te_{c} END, g_rate) AS {c}_te" for c in _ENCODED
    )
    + """
  FROM prepared p LEFT JOIN by_type USING (complaint_type) LEFT JOIN by_agency USING (agency)
  LEFT JOIN by_borough USING (borough) LEFT JOIN by_zip USING (incident_zip) LEFT JOIN centroid USING (agency, borough)
  LEFT JOIN density USING (incident_zip, day_no) LEFT JOIN zip_median USING (incident_zip) LEFT JOIN volume USING (day_no)"""
    + "".join(f" LEFT JOIN idx_{c} USING ({c})" for c in _INDEXED)
    + "".join(f" LEFT JOIN oof_{c} USING ({c}, fold) LEFT JOIN te_{c} USING ({c})" for c in _ENCODED)
    + """, g, rate, g_density, g_volume
),
gold AS (
  SELECT request_key, complaint_type, agency, borough, channel, location_type, incident_zip, latitude, longitude, sla_days,
         penalty_amount_usd, CAST(0 AS DOUBLE) AS hora_sen, CAST(1 AS DOUBLE) AS hora_cos,
         sin(2 * pi() * (dayofweek(created_ts) + 1) / 7) AS dia_semana_sen, cos(2 * pi() * (dayofweek(created_ts) + 1) / 7) AS dia_semana_cos,
         CASE WHEN dayofweek(created_ts) IN (0, 6) THEN 1 ELSE 0 END AS es_fin_de_semana, quarter(created_ts) AS trimestre,
         quejas_por_dia, std_dias_complaint_type, p75_dias_complaint_type, avg_dias_agency, avg_dias_borough, avg_dias_zip,
         avg_dias_complaint_type / (sla_days + 0.01) AS presion_sla, p75_dias_complaint_type / (sla_days + 0.01) AS presion_sla_p75,
         densidad_zip_30d / (sla_days + 0.01) AS saturacion_zip, quejas_por_dia / (sla_days + 0.01) AS saturacion_diaria,
         dist_km_agencia, densidad_zip_30d, agency_idx, borough_idx, channel_idx, location_type_idx, turno_idx,
         complaint_type_te, incident_zip_te, borough_canal_te, target, penalty_charged, split
  FROM joined WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND sla_days IS NOT NULL AND target IS NOT NULL
    AND penalty_charged IS NOT NULL AND dist_km_agencia IS NOT NULL AND densidad_zip_30d IS NOT NULL
)"""
)

_ROUNDED_GOLD = [
    "latitude", "longitude", "dia_semana_sen", "dia_semana_cos", "std_dias_complaint_type",
    "p75_dias_complaint_type", "avg_dias_agency", "avg_dias_borough", "avg_dias_zip", "presion_sla",
    "presion_sla_p75", "saturacion_zip", "saturacion_diaria", "dist_km_agencia", "complaint_type_te",
    "incident_zip_te", "borough_canal_te",
]


def gold(spark, sf_dir, keep=("request_key",)):
    """Gold features of the fixture and the maps fitted for them."""
    base = stored_silver(spark, sf_dir, COLS_READ)
    return X.build_features(
        L.temporal_split(base, "created_ts"), fixture_lookup(spark), COLS, keep=keep
    )


@query(
    f"""WITH {GOLD}
SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED_GOLD)}) FROM gold"""
)
def gold_features(spark, sf_dir):
    return rounded(gold(spark, sf_dir)[0])


@query(
    f"""WITH {GOLD},
km AS (SELECT agency, borough, quantile_disc(dist_km_agencia, 0.5) AS m FROM joined WHERE split = 'train' AND dist_km_agencia IS NOT NULL GROUP BY 1, 2),
maps AS (
  SELECT 'avg_dias_complaint_type' AS map_name, avg_ct AS v FROM by_type UNION ALL SELECT 'std_dias_complaint_type', std_ct FROM by_type
  UNION ALL SELECT 'p75_dias_complaint_type', p75_ct FROM by_type UNION ALL SELECT 'avg_dias_agency', avg_a FROM by_agency
  UNION ALL SELECT 'avg_dias_borough', avg_b FROM by_borough UNION ALL SELECT 'avg_dias_zip', avg_z FROM by_zip
  UNION ALL SELECT 'centroid_lat', c_lat FROM centroid UNION ALL SELECT 'centroid_lon', c_lon FROM centroid
  UNION ALL SELECT 'densidad_zip_dia', d FROM density UNION ALL SELECT 'densidad_zip', d_zip FROM zip_median
  UNION ALL SELECT 'quejas_por_dia', v FROM volume UNION ALL SELECT 'dist_km_agencia', m FROM km
  {"".join(f" UNION ALL SELECT '{c}_idx', i_{c} FROM idx_{c}" for c in _INDEXED)}
  {"".join(f" UNION ALL SELECT '{c}_te', oof_{c} FROM oof_{c} UNION ALL SELECT '{c}_te', te_{c} FROM te_{c}" for c in _ENCODED)}
)
SELECT map_name, count(*) AS n, round(avg(v), 6) AS mean_value FROM maps WHERE v IS NOT NULL GROUP BY 1"""
)
def fitted_mappings(spark, sf_dir):
    """The stored maps read back: entries and mean value of each."""
    _, fitted = gold(spark, sf_dir)
    return rounded(
        fitted.maps.groupBy("map_name").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    )


@query(
    f"""WITH {GOLD}
SELECT round(g_rate, 6) AS global_tasa, round(g_avg, 6) AS global_avg, round(g_std, 6) AS global_std, round(g_p75, 6) AS global_p75,
       CAST(d_all AS DOUBLE) AS global_densidad, CAST(v_all AS DOUBLE) AS mediana_quejas_por_dia
FROM g, rate, g_density, g_volume"""
)
def fitted_globals(spark, sf_dir):
    _, fitted = gold(spark, sf_dir)
    stored = spark.read.parquet(f"{fitted.path}/globals")
    return rounded(stored.select(*[F.col(c).cast("double").alias(c) for c in stored.columns]))


@query(
    f"""WITH {GOLD}
SELECT request_key, sla_days, penalty_amount_usd, hora_sen, hora_cos, round(dia_semana_sen, 6) AS dia_semana_sen, es_fin_de_semana,
       trimestre, CAST(v_all AS DOUBLE) AS quejas_por_dia, round(std_dias_complaint_type, 6) AS std_dias_complaint_type,
       round(avg_dias_zip, 6) AS avg_dias_zip, CAST(coalesce(d_zip, d_all) AS DOUBLE) AS densidad_zip_30d,
       round(coalesce(m, 5.0), 6) AS dist_km_agencia, round(coalesce(d_zip, d_all) / (sla_days + 0.01), 6) AS saturacion_zip,
       agency_idx, location_type_idx, round(coalesce(te_complaint_type, g_rate), 6) AS complaint_type_te,
       round(coalesce(te_borough_canal, g_rate), 6) AS borough_canal_te
FROM (SELECT request_key, complaint_type, agency, borough, borough_canal, incident_zip, coalesce(sla_days, 10) AS sla_days,
             coalesce(penalty_amount_usd, 15000) AS penalty_amount_usd, CAST(0 AS DOUBLE) AS hora_sen, CAST(1 AS DOUBLE) AS hora_cos,
             sin(2 * pi() * (dayofweek(created_ts) + 1) / 7) AS dia_semana_sen,
             CASE WHEN dayofweek(created_ts) IN (0, 6) THEN 1 ELSE 0 END AS es_fin_de_semana, quarter(created_ts) AS trimestre,
             std_dias_complaint_type, avg_dias_zip, agency_idx, location_type_idx FROM joined WHERE split = 'test')
LEFT JOIN zip_median USING (incident_zip) LEFT JOIN te_complaint_type USING (complaint_type) LEFT JOIN te_borough_canal USING (borough_canal)
LEFT JOIN (SELECT agency, borough, quantile_disc(dist_km_agencia, 0.5) AS m FROM joined WHERE split = 'train' GROUP BY 1, 2) USING (agency, borough),
rate, g_density, g_volume"""
)
def serving_features(spark, sf_dir):
    """What the scorer sees for the test requests: stored maps and defaults only."""
    _, fitted = gold(spark, sf_dir)
    base = stored_silver(spark, sf_dir, COLS_READ)
    test = L.temporal_split(base, "created_ts").where(F.col("split") == "test")
    served = X.serving_features(test, fitted, fixture_lookup(spark), COLS)
    shown = [
        "request_key", "sla_days", "penalty_amount_usd", "hora_sen", "hora_cos", "dia_semana_sen",
        "es_fin_de_semana", "trimestre", "quejas_por_dia", "std_dias_complaint_type", "avg_dias_zip",
        "densidad_zip_30d", "dist_km_agencia", "saturacion_zip", "agency_idx", "location_type_idx",
        "complaint_type_te", "borough_canal_te",
    ]
    return rounded(served.select(*shown))
