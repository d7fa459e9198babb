"""The gold feature table: every statistic is fitted on the training split only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.functions import times
from breachline.functions.geo import haversine_km
from breachline.functions.sla import breach_by_contract, penalty_charged, smoothed_ratio, stable_fold
from breachline.functions.text import joined_key
from breachline.operators.encoding import category_index, fold_sums, out_of_fold_means, target_means
from breachline.operators.joins import lookup_join
from breachline.operators.statistics import (
    daily_volume,
    global_stats,
    group_centroid,
    group_mean,
    group_median,
    group_stats,
    rolling_range_sum,
)
from breachline.settings import cut, work_path
from breachline.sources.mappings import (
    Fitted,
    as_maps,
    load_mappings,
    save_feature_order,
    save_globals,
    save_mappings,
    union_maps,
)

ALL_ROWS = "all"
DEFAULT_CONTRACT = (10.0, 15000.0)
DEFAULT_DISTANCE_KM = 5.0


@dataclass(frozen=True)
class RequestColumns:
    """Names of the request fields in the table at hand."""

    key: str = "Unique Key"
    created: str = "created_ts"
    closed: str = "closed_ts"
    agency: str = "Agency"
    complaint_type: str = "Complaint Type"
    borough: str = "Borough"
    channel: str = "Open Data Channel Type"
    location_type: str = "Location Type"
    zip_code: str = "Incident Zip"
    latitude: str = "latitude"
    longitude: str = "longitude"

    @property
    def indexed(self) -> list[str]:
        return [self.agency, self.borough, self.channel, self.location_type, "turno"]

    @property
    def encoded(self) -> list[str]:
        return [self.complaint_type, self.zip_code, "borough_canal"]

    @property
    def described(self) -> list[str]:
        return [
            self.complaint_type,
            self.agency,
            self.borough,
            self.channel,
            self.location_type,
            self.zip_code,
        ]


# Feature families of the gold table, in its column order.
BUSINESS = ["sla_days", "penalty_amount_usd"]
TEMPORAL = [
    "hora_sen", "hora_cos", "dia_semana_sen", "dia_semana_cos", "es_fin_de_semana", "trimestre",
    "quejas_por_dia",
]
HISTORIC = [
    "std_dias_complaint_type", "p75_dias_complaint_type", "avg_dias_agency", "avg_dias_borough",
    "avg_dias_zip",
]
PRESSURE = ["presion_sla", "presion_sla_p75", "saturacion_zip", "saturacion_diaria"]
GEOGRAPHIC = ["dist_km_agencia", "densidad_zip_30d"]
OUTCOME = ["target", "penalty_charged"]


def feature_names(cols: RequestColumns) -> list[str]:
    """The 30 features in order."""
    return [
        cols.latitude,
        cols.longitude,
        *BUSINESS,
        *TEMPORAL,
        *HISTORIC,
        *PRESSURE,
        *GEOGRAPHIC,
        *[f"{c}_idx" for c in cols.indexed],
        *[f"{c}_te" for c in cols.encoded],
    ]


def required_columns(cols: RequestColumns) -> list[str]:
    """Columns that must be known for a row to stay in the gold table."""
    places = [cols.latitude, cols.longitude]
    return [*places, *TEMPORAL, *HISTORIC, *PRESSURE, *GEOGRAPHIC, *OUTCOME]


def add_outcome(
    df: DataFrame, lookup: DataFrame, cols: RequestColumns, unmapped: str = "drop"
) -> DataFrame:
    """Resolution time, contract terms, breach target and penalty.

    ``unmapped="default"`` gives agencies without a contract the default terms instead of
    leaving their outcome unknown.
    """
    days = times.duration_days(F.col(cols.closed), F.col(cols.created))
    df = lookup_join(df, lookup, cols.agency).withColumn("resolution_time_days", days)
    if unmapped == "default":
        df = with_default_contract(df)
    elif unmapped != "drop":
        raise ValueError(f"unknown policy {unmapped!r}")
    target = breach_by_contract(F.col("resolution_time_days"), F.col("sla_days"))
    return df.withColumn("target", target).withColumn(
        "penalty_charged", penalty_charged(F.col("target"), F.col("penalty_amount_usd"))
    )


def with_default_contract(df: DataFrame, contract: tuple[float, float] = DEFAULT_CONTRACT) -> DataFrame:
    return df.withColumns(
        {
            "sla_days": F.coalesce("sla_days", F.lit(contract[0])),
            "penalty_amount_usd": F.coalesce("penalty_amount_usd", F.lit(contract[1])),
        }
    )


def add_calendar(df: DataFrame, cols: RequestColumns) -> DataFrame:
    """Cyclic hour and weekday, weekend, shift, quarter and the borough-channel key."""
    created = F.col(cols.created)
    hour_sin, hour_cos = times.cyclic(F.hour(created), 24)
    week_sin, week_cos = times.cyclic(F.dayofweek(created), 7)
    return df.withColumns(
        {
            "hora_sen": hour_sin,
            "hora_cos": hour_cos,
            "dia_semana_sen": week_sin,
            "dia_semana_cos": week_cos,
            "es_fin_de_semana": times.weekend_flag(created),
            "trimestre": F.quarter(created),
            "turno": times.shift_of_day(F.hour(created)),
            "borough_canal": joined_key(F.col(cols.borough), F.col(cols.channel)),
        }
    )


def _distance(cols: RequestColumns) -> Column:
    return haversine_km(
        F.col(cols.latitude), F.col(cols.longitude), F.col("centroid_lat"), F.col("centroid_lon")
    )


def _history_maps(train: DataFrame, cols: RequestColumns, accuracy: int | None) -> list[DataFrame]:
    """Duration statistics: by type, and the means of all other keys in one aggregation."""
    by_type = group_stats(train, cols.complaint_type, "resolution_time_days", accuracy)
    stats = {f"{stat}_complaint_type": stat for stat in ("avg_dias", "std_dias", "p75_dias")}
    means = {
        "avg_dias_agency": cols.agency,
        "avg_dias_borough": cols.borough,
        "avg_dias_zip": cols.zip_code,
    }
    keys = F.array(
        *[
            F.struct(F.lit(name).alias("map_name"), F.col(f"`{c}`").cast("string").alias("key"))
            for name, c in means.items()
        ]
    )
    long = train.select("resolution_time_days", F.inline(keys))
    by_key = group_mean(long, ["map_name", "key"], "resolution_time_days", "value")
    return [
        as_maps(by_type, stats, cols.complaint_type),
        by_key.select("key", F.lit(None).cast("string").alias("key_2"), "value", "map_name").dropna(
            subset=["key", "value"]
        ),
    ]


def _encoding_maps(train: DataFrame, cols: RequestColumns, fold: Column) -> list[DataFrame]:
    """Category indices, and target means out of each fold and over all rows."""
    sums = fold_sums(train, cols.encoded, "target", fold)
    parts = out_of_fold_means(sums).withColumn("fold", F.col("fold").cast("string"))
    whole = target_means(sums).withColumn("fold", F.lit(ALL_ROWS))
    index = category_index(train, cols.indexed).withColumn("fold", F.lit(None).cast("string"))
    tagged = [(parts, "_te"), (whole, "_te"), (index, "_idx")]
    return [
        table.select(
            "key", F.col("fold").alias("key_2"), "value", F.concat("column", F.lit(end)).alias("map_name")
        ).where(F.col("value").isNotNull())
        for table, end in tagged
    ]


def fit_features(
    train: DataFrame,
    cols: RequestColumns,
    path: str | None = None,
    fold: Column | None = None,
    accuracy: int | None = None,
) -> Fitted:
    """Fit every map on the training rows and store them below ``path``.

    ``train`` carries outcome and calendar columns. All maps but the distances, which build
    on the centroids, are written by one job whose branches read only their own columns.
    """
    spark = train.sparkSession
    path = path or work_path(spark, "fitted")
    fold = stable_fold(F.col(cols.key)) if fold is None else fold
    day_no = times.day_number(F.to_date(cols.created))
    density = cut(
        rolling_range_sum(train.withColumn("_day", day_no), cols.zip_code, "_day"), "density"
    )
    by_zip = group_median(density, cols.zip_code, "densidad_zip_30d", "median", accuracy)
    volume = daily_volume(train, cols.created)
    centroids = group_centroid(train, [cols.agency, cols.borough], cols.latitude, cols.longitude)
    pair = (cols.agency, cols.borough)
    maps = [
        *_history_maps(train, cols, accuracy),
        *_encoding_maps(train, cols, fold),
        as_maps(centroids, {c: c for c in ("centroid_lat", "centroid_lon")}, *pair),
        as_maps(density, {"densidad_zip_dia": "densidad_zip_30d"}, cols.zip_code, "_day"),
        as_maps(by_zip, {"densidad_zip": "median"}, cols.zip_code),
        as_maps(volume, {"quejas_por_dia": "quejas_por_dia"}, "day"),
    ]
    save_mappings(union_maps(maps), path)

    valid = F.when(F.col("resolution_time_days") >= 0, F.col("resolution_time_days"))
    save_globals(
        train.agg(
            F.avg("target").alias("global_tasa"),
            F.avg(valid).alias("global_avg"),
            F.stddev(valid).alias("global_std"),
        ).withColumns(
            {
                "global_p75": global_stats(train, "resolution_time_days", accuracy).select("global_p75").scalar(),
                "global_densidad": group_median(density, [], "densidad_zip_30d", "m", accuracy).scalar(),
                "mediana_quejas_por_dia": group_median(volume, [], "quejas_por_dia", "m", accuracy).scalar(),
            }
        ),
        path,
    )
    placed = load_mappings(spark, path).attach(
        train, ["centroid_lat", "centroid_lon"], F.col(cols.agency), F.col(cols.borough)
    )
    distances = group_median(
        placed.withColumn("_km", _distance(cols)), list(pair), "_km", "median", accuracy
    )
    save_mappings(as_maps(distances, {"dist_km_agencia": "median"}, *pair), path, mode="append")
    save_feature_order(spark, feature_names(cols), path)
    return load_mappings(spark, path)


def _attach_shared(df: DataFrame, fitted: Fitted, cols: RequestColumns, te_key: Column) -> DataFrame:
    """Maps used alike in training and scoring, with their fallbacks."""
    zip_code, source = F.col(cols.zip_code), df
    history = [f"{s}_complaint_type" for s in ("avg_dias", "std_dias", "p75_dias")]
    df = fitted.attach(df, history, F.col(cols.complaint_type), counted=source)
    df = fitted.attach(df, ["avg_dias_agency", f"{cols.agency}_idx"], F.col(cols.agency), counted=source)
    df = fitted.attach(df, ["avg_dias_borough", f"{cols.borough}_idx"], F.col(cols.borough), counted=source)
    df = fitted.attach(df, ["avg_dias_zip", "densidad_zip"], zip_code, counted=source)
    for column in (cols.channel, cols.location_type, "turno"):
        df = fitted.attach(df, [f"{column}_idx"], F.col(column), counted=source)
    for column in cols.encoded:
        df = fitted.attach(df, [f"{column}_te"], F.col(column), te_key, counted=source)

    filled = {
        "avg_dias_complaint_type": fitted.lit("global_avg"),
        "std_dias_complaint_type": fitted.lit("global_std"),
        "p75_dias_complaint_type": fitted.lit("global_p75"),
        "avg_dias_agency": fitted.lit("global_avg"),
        "avg_dias_borough": fitted.lit("global_avg"),
        "avg_dias_zip": fitted.lit("global_avg"),
        "densidad_zip": fitted.lit("global_densidad"),
    }
    filled |= {f"{c}_te": fitted.lit("global_tasa", 0.2) for c in cols.encoded}
    filled |= {f"{c}_idx": F.lit(float(fitted.sizes.get(f"{c}_idx", 0))) for c in cols.indexed}
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), v) for c, v in filled.items()})


def add_pressure(df: DataFrame) -> DataFrame:
    sla = F.col("sla_days")
    return df.withColumns(
        {
            "presion_sla": smoothed_ratio(F.col("avg_dias_complaint_type"), sla),
            "presion_sla_p75": smoothed_ratio(F.col("p75_dias_complaint_type"), sla),
            "saturacion_zip": smoothed_ratio(F.col("densidad_zip_30d"), sla),
            "saturacion_diaria": smoothed_ratio(F.col("quejas_por_dia"), sla),
        }
    )


def transform_features(
    df: DataFrame,
    fitted: Fitted,
    cols: RequestColumns,
    fold: Column | None = None,
    split: str = "split",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Gold columns for all splits; training rows are encoded out of fold.

    Look-back density and daily volume match exact training days; later days fall back to
    the ZIP's median and the median day.
    """
    fold = stable_fold(F.col(cols.key)) if fold is None else fold
    te_key = F.when(F.col(split) == "train", fold.cast("string")).otherwise(ALL_ROWS)
    day, source = F.to_date(cols.created), df
    df = _attach_shared(df, fitted, cols, te_key)
    pair = (F.col(cols.agency), F.col(cols.borough))
    df = fitted.attach(df, ["centroid_lat", "centroid_lon"], *pair, counted=source)
    df = fitted.attach(df, ["densidad_zip_dia"], F.col(cols.zip_code), times.day_number(day), counted=source)
    df = fitted.attach(df, ["quejas_por_dia"], day, counted=source)
    median_volume = fitted.lit("mediana_quejas_por_dia")
    df = df.withColumns(
        {
            "dist_km_agencia": _distance(cols),
            "densidad_zip_30d": F.coalesce("densidad_zip_dia", "densidad_zip").cast("long"),
            "quejas_por_dia": F.coalesce("quejas_por_dia", median_volume).cast("long"),
        }
    )
    gold = [*cols.described, *feature_names(cols), *OUTCOME, split, *keep]
    gold = list(dict.fromkeys(gold))
    return (
        add_pressure(df).select(*[F.col(f"`{c}`") for c in gold]).dropna(subset=required_columns(cols))
    )


def prepare_requests(
    df: DataFrame, lookup: DataFrame, cols: RequestColumns, unmapped: str = "drop"
) -> DataFrame:
    return add_calendar(add_outcome(df, lookup, cols, unmapped), cols)


def build_features(
    df: DataFrame,
    lookup: DataFrame,
    cols: RequestColumns,
    fold: Column | None = None,
    unmapped: str = "drop",
    path: str | None = None,
    keep: tuple[str, ...] = (),
    accuracy: int | None = None,
) -> tuple[DataFrame, Fitted]:
    """Gold features of a table with a ``split`` column, and the maps they were made with.

    The prepared table is written once: fitting and transforming both read it back. Medians
    and percentiles are exact unless ``accuracy`` asks for sketches of that accuracy.
    """
    ready = cut(prepare_requests(df, lookup, cols, unmapped), "prepared")
    fitted = fit_features(ready.where(F.col("split") == "train"), cols, path, fold, accuracy)
    return transform_features(ready, fitted, cols, fold, keep=keep), fitted


def serving_features(
    df: DataFrame, fitted: Fitted, lookup: DataFrame, cols: RequestColumns
) -> DataFrame:
    """Features of new requests: stored maps only, with the defaults used at scoring time."""
    df = with_default_contract(lookup_join(df, lookup, cols.agency))
    df = _attach_shared(add_calendar(df, cols), fitted, cols, F.lit(ALL_ROWS))
    df = fitted.attach(df, ["dist_km_agencia"], F.col(cols.agency), F.col(cols.borough))
    return add_pressure(
        df.withColumns(
            {
                "dist_km_agencia": F.coalesce("dist_km_agencia", F.lit(DEFAULT_DISTANCE_KM)),
                "densidad_zip_30d": F.col("densidad_zip"),
                "quejas_por_dia": fitted.lit("mediana_quejas_por_dia"),
            }
        )
    )
