"""The tables behind the map, the charts and the drift views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachline.settings import SEED
from breachline.functions.text import hover_text, money_label, recode

# Marker colour of each agency.
AGENCY_COLORS = {
    "NYPD": "#7c9cfc",
    "DOB": "#fc9c7c",
    "DHS": "#7cfcbc",
    "HPD": "#fc7cbc",
    "DOT": "#fcdc7c",
    "DSNY": "#bc9cfc",
    "DOHMH": "#7cdcfc",
    "DEP": "#fc7c7c",
    "TLC": "#9cfc7c",
    "DPR": "#fca07c",
    "DCA": "#7cbcfc",
    "DOE": "#e07cfc",
}
DEFAULT_COLOR = "#aaaaaa"


def _usd(column: Column) -> Column:
    """Money is summed as decimal: the total does not depend on the order of the rows."""
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def rate_by_group(df: DataFrame, key: str, flag: str = "target") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(flag).alias("rate"))


def peak_hour(df: DataFrame, hour: str = "created_hour", flag: str = "is_overdue_official") -> DataFrame:
    """The hour with the highest breach rate and the hours next to it."""
    rates = df.where(F.col(hour).isNotNull()).groupBy(hour).agg(F.avg(flag).alias("rate"))
    return rates.agg(
        F.max_by(hour, F.struct("rate", -F.col(hour))).alias("peak_hour"),
        F.max("rate").alias("peak_rate"),
    ).select(
        "peak_hour",
        "peak_rate",
        F.greatest(F.lit(0), F.col("peak_hour") - 1).alias("range_start"),
        F.least(F.lit(23), F.col("peak_hour") + 1).alias("range_end"),
    )


def territorial_gap(
    df: DataFrame, key: str = "Borough", flag: str = "target", unspecified: str = "UNSPECIFIED"
) -> DataFrame:
    """Worst group, best named group and the distance between their breach rates."""
    rates = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("g")).agg(F.avg(flag).alias("rate"))
    named = F.when(F.col("g") != unspecified, F.struct("rate", "g"))
    return rates.agg(
        F.min_by("g", F.struct(-F.col("rate"), "g")).alias("worst"),
        F.max("rate").alias("worst_rate"),
        F.min(named).alias("best"),
    ).select(
        "worst",
        "worst_rate",
        F.col("best.g").alias("best"),
        F.col("best.rate").alias("best_rate"),
        (F.col("worst_rate") - F.col("best.rate")).alias("gap"),
    )


def kpi_summary(
    df: DataFrame,
    by: Sequence[str] = (),
    target: str = "target",
    penalty: str = "penalty_charged",
    agency: str = "Agency",
) -> DataFrame:
    """Requests, penalties charged, breach share and active agencies."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(_usd(F.when(F.col(penalty) > 0, F.col(penalty))), F.lit(0.0)).alias("penalty_usd"),
        F.try_divide(F.count_if(F.col(target) == 1) * 100.0, F.count(F.lit(1))).alias("breach_pct"),
        F.count_distinct(agency).alias("agencies"),
    )


def legend_counts(df: DataFrame, agency: str = "Agency") -> DataFrame:
    return (
        df.groupBy(agency)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("color", recode(F.col(agency), AGENCY_COLORS, DEFAULT_COLOR))
        .orderBy(agency)
    )


def cooccurrence_sets(df: DataFrame, key: str, partner: str) -> DataFrame:
    """The distinct partners of every key. Pairs are made distinct before they are gathered."""
    pairs = df.select(key, partner).dropna().distinct()
    return pairs.groupBy(key).agg(F.sort_array(F.collect_list(partner)).alias("partners"))


def compatible_values(df: DataFrame, key: str, selected: Sequence, partner: str) -> DataFrame:
    """Partners that occur with any of the selected keys; every partner if none is selected."""
    picked = df.where(F.col(key).isin(*selected)) if selected else df
    return picked.select(partner).where(F.col(partner).isNotNull()).distinct().orderBy(partner)


def incompatible_values(
    df: DataFrame, key: str, selected: Sequence[str], partner: str, partners: Sequence[str]
) -> DataFrame:
    """Selected keys that never occur with any of the selected partners."""
    together = df.where(F.col(key).isin(*selected) & F.col(partner).isin(*partners))
    chosen = df.sparkSession.createDataFrame([(s,) for s in selected], f"{key} string")
    return chosen.join(together.select(key).distinct(), key, "left_anti").orderBy(key)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from least to greatest value, the last bin closed; empty bins show 0."""
    values = df.where(F.col(column).isNotNull())
    span = values.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high = span["low"].cast("double"), span["high"].cast("double")
    width = (high - low) / bins
    at = F.when(width > 0, F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))).otherwise(0)
    counted = values.groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def risk_zone(df: DataFrame, agency: str, duration: str, sla: str) -> DataFrame:
    """Per agency: where the SLA line stands and how far the risk zone reaches."""
    return df.groupBy(agency).agg(
        F.max(sla).alias("zone_start"),
        F.max(duration).alias("zone_end"),
        F.count_if(F.col(duration) > F.col(sla)).alias("n_in_zone"),
    )


def class_balance(df: DataFrame, by: str = "split", target: str = "target") -> DataFrame:
    n, pos = F.count(F.lit(1)), F.count_if(F.col(target) == 1)
    neg = F.count_if(F.col(target) == 0)
    return df.groupBy(by).agg(
        neg.alias("n_neg"),
        pos.alias("n_pos"),
        F.try_divide(neg * 100.0, n).alias("pct_neg"),
        F.try_divide(pos * 100.0, n).alias("pct_pos"),
        F.coalesce(F.try_divide(neg.cast("double"), pos), F.lit(0.0)).alias("neg_per_pos"),
    )


def drift_overall(df: DataFrame, target: str = "target", split: str = "split") -> DataFrame:
    """Breach rates of the oldest and newest split and how far they moved."""
    train = F.avg(F.when(F.col(split) == "train", F.col(target))) * 100
    test = F.avg(F.when(F.col(split) == "test", F.col(target))) * 100
    return df.agg(train.alias("train_pct"), test.alias("test_pct")).withColumns(
        {
            "drift_pp": F.col("train_pct") - F.col("test_pct"),
            "reduction_pct": F.try_divide(
                (F.col("train_pct") - F.col("test_pct")) * 100, F.col("train_pct")
            ),
        }
    )


def drift_by_group(
    df: DataFrame,
    key: str,
    target: str = "target",
    split: str = "split",
    min_train: int = 100,
    min_test: int = 50,
) -> DataFrame:
    """Breach-rate change from train to test for groups with enough rows in both."""
    in_train, in_test = F.col(split) == "train", F.col(split) == "test"
    return (
        df.groupBy(key)
        .agg(
            F.count_if(in_train).alias("n_train"),
            F.count_if(in_test).alias("n_test"),
            (F.avg(F.when(in_train, F.col(target))) * 100).alias("train_pct"),
            (F.avg(F.when(in_test, F.col(target))) * 100).alias("test_pct"),
        )
        .where((F.col("n_train") >= min_train) & (F.col("n_test") >= min_test))
        .withColumn("drift_pp", F.col("test_pct") - F.col("train_pct"))
        .orderBy("drift_pp", key)
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count_if(F.col("test_pct") == 0).alias("groups_with_zero_test"),
        F.max(F.abs("drift_pp")).alias("max_abs_drift_pp"),
    )


def top_risk_groups(
    df: DataFrame, keys: Sequence[str], target: str = "target", min_rows: int = 100, top: int = 10
) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.round(F.avg(target) * 100, 2).alias("rate_pct"), F.count(target).alias("n"))
        .where(F.col("n") >= min_rows)
        .orderBy(F.desc("rate_pct"), *keys)
        .limit(top)
    )


def split_summary(
    df: DataFrame, split: str = "split", target: str = "target", penalty: str = "penalty_charged"
) -> DataFrame:
    """Rows, classes, penalties and share of the whole, per split."""
    grouped = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(target) == 1).alias("n_pos"),
        F.count_if(F.col(target) == 0).alias("n_neg"),
        F.coalesce(_usd(F.col(penalty)), F.lit(0.0)).alias("penalty_usd"),
    )
    everything = Window.partitionBy()  # three rows
    return grouped.withColumns(
        {
            "breach_pct": F.col("n_pos") * 100.0 / F.col("n"),
            "share_pct": F.col("n") * 100.0 / F.sum("n").over(everything),
        }
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    grouped = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    return grouped.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def temporal_integrity(df: DataFrame, ts: str, split: str = "split") -> DataFrame:
    """Range of each split and whether each ends before the next begins."""
    at = F.col(split)
    bounds = {
        f"{name}_{end}": pick(F.when(at == name, F.col(ts)))
        for name in ("train", "val", "test")
        for end, pick in (("first", F.min), ("last", F.max))
    }
    return df.agg(*[v.alias(n) for n, v in bounds.items()]).withColumns(
        {
            "train_before_val": F.col("train_last") <= F.col("val_first"),
            "val_before_test": F.col("val_last") <= F.col("test_first"),
        }
    )


def day_over_day(df: DataFrame, ts: str) -> DataFrame:
    """Requests per day and their change from the previous day that has requests."""
    daily = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("total_reportes")
    )
    by_day = Window.orderBy("day")  # one row per calendar day
    previous = F.lag("total_reportes").over(by_day)
    return daily.withColumn("prev_total", previous).withColumn(
        "delta_pct",
        (F.col("total_reportes") - F.col("prev_total"))
        / F.when(F.col("prev_total") == 0, 1).otherwise(F.col("prev_total")),
    )


def trend_break(daily: DataFrame) -> DataFrame:
    """The day with the greatest relative rise, or the busiest day when no rise is known."""
    known = F.col("delta_pct").isNotNull()
    reason = F.when(known, "mayor aumento porcentual respecto al día anterior").otherwise(
        "mayor volumen absoluto de reportes"
    )
    return (
        daily.orderBy(
            F.desc_nulls_last("delta_pct"), F.desc(F.when(~known, F.col("total_reportes"))), "day"
        )
        .limit(1)
        .withColumn("reason", reason)
    )


def rank_compare(
    first: DataFrame, second: DataFrame, key: str, first_value: str, second_value: str, top: int = 10
) -> DataFrame:
    """Ranks of two importances side by side, greatest change of rank first."""
    by_first = Window.orderBy(F.desc(first_value), key)  # one row per feature
    by_second = Window.orderBy(F.desc(second_value), key)
    return (
        first.join(second, key)
        .withColumns(
            {
                "rank_first": F.row_number().over(by_first),
                "rank_second": F.row_number().over(by_second),
            }
        )
        .withColumn("rank_change", F.col("rank_second") - F.col("rank_first"))
        .orderBy(F.desc(F.abs("rank_change")), key)
        .limit(top)
    )


def ranked(df: DataFrame, metric: str, key: str, descending: bool = True) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric) if descending else F.asc_nulls_last(metric), key)


def top_n(df: DataFrame, value: str, key: str, n: int = 15) -> DataFrame:
    """The ``n`` greatest rows with their tier: first three, next five, rest."""
    best = df.orderBy(F.desc_nulls_last(value), key).limit(n)
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last(value), key))  # n rows
    tier = F.when(F.col("place") <= 3, "top").when(F.col("place") <= 8, "middle").otherwise("rest")
    return best.withColumn("place", place).withColumn("tier", tier)


def extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys holding the greatest and least value; ties go to the least key."""
    v = F.col(value)
    return df.agg(
        F.min_by(key, F.struct(-v, F.col(key))).alias("arg_max"),
        F.max(v).alias("max_value"),
        F.min_by(key, F.struct(v, F.col(key))).alias("arg_min"),
        F.min(v).alias("min_value"),
    )


def winner_per_metric(long: DataFrame, key: str = "model") -> DataFrame:
    """From (model, metric, value): the model with the greatest value of each metric."""
    return long.where(F.col("value").isNotNull()).groupBy("metric").agg(
        F.min_by(key, F.struct(-F.col("value"), F.col(key))).alias("winner"),
        F.max("value").alias("value"),
    )


def top_categories(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(n)
    )


def sample_rows(
    df: DataFrame, key: Sequence[str], n: int, seed: int = SEED, ties: Sequence[str] = ()
) -> DataFrame:
    """``n`` rows without replacement, the same ones however the table is partitioned.

    Rows are drawn in the order of the key's MD5; ``ties`` order rows with equal keys.
    """
    parts = [F.col(k).cast("string") for k in key]
    drawn = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))
    return df.orderBy(drawn, *key, *ties).limit(n)


def map_sample(
    df: DataFrame, key: Sequence[str], n: int = 5000, lat: str = "latitude", lon: str = "longitude",
    ties: Sequence[str] = (),
) -> DataFrame:
    return sample_rows(df.dropna(subset=[lat, lon]), key, n, ties=ties)


def map_markers(
    df: DataFrame,
    complaint: str,
    agency: str,
    borough: str,
    zip_code: str,
    target: str = "target",
    penalty: str = "penalty_charged",
    sla: str = "sla_days",
) -> DataFrame:
    """Colour, result label and hover text of every request drawn on the map."""
    result = recode(F.col(target), {0: "Cumplió", 1: "Incumplió"})
    return df.withColumns(
        {
            "color": recode(F.col(agency), AGENCY_COLORS, DEFAULT_COLOR),
            "opacity": F.when(F.col(target) == 1, 0.9).otherwise(0.8),
            "hover": hover_text(
                Tipo=F.col(complaint),
                Agencia=F.col(agency),
                Municipio=F.col(borough),
                Resultado=result,
                Penalidad=money_label(F.col(penalty)),
                SLA=F.round(sla, 2),
                ZIP=F.col(zip_code),
            ),
        }
    )


# ---- set operations and reshaping ------------------------------------------------------


def union_tagged(tables: dict[str, DataFrame], tag: str = "origin") -> DataFrame:
    """Stack tables by column name, remembering where each row came from."""
    tagged = [t.withColumn(tag, F.lit(name)) for name, t in tables.items()]
    stacked = tagged[0]
    for other in tagged[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every distinct key with ``side``: both, left or right."""
    seen = (
        left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(key)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    side = F.when(F.col("_l") + F.col("_r") == 2, "both").when(F.col("_l") == 1, "left").otherwise("right")
    return seen.select(key, side.alias("side"))


def pivot_counts(
    df: DataFrame, row: str, column: str, values: Sequence, with_pct: bool = False
) -> DataFrame:
    """Counts as a matrix in the given column order, 0 where a pair never occurs."""
    names = [str(v) for v in values]
    matrix = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).fillna(0, names)
    if not with_pct:
        return matrix
    total = df.where(F.col(column).isin(*values)).agg(F.count(F.lit(1))).scalar()
    return matrix.withColumns({f"{n}_pct": F.col(f"`{n}`") * 100.0 / total for n in names})


def unpivot_metrics(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    return df.unpivot([key], list(metrics), "metric", "value").where(F.col("value").isNotNull())
