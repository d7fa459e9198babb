"""Splits along time and the removal of requests whose outcome could not be seen yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.functions.times import epoch_seconds
from breachline.operators.ordering import discrete_quantiles, global_row_index

OBSERVED_DAYS = 120


def split_cuts(
    df: DataFrame, ts: str, train_share: float = 0.70, val_share: float = 0.85
) -> DataFrame:
    """Epoch seconds ending the training and the validation period."""
    seconds = df.select(epoch_seconds(F.col(ts)).alias("at"))
    return discrete_quantiles(seconds, "at", [train_share, val_share]).withColumnsRenamed(
        {"q_0": "train_end", "q_1": "val_end"}
    )


def temporal_split(
    df: DataFrame, ts: str, train_share: float = 0.70, val_share: float = 0.85
) -> DataFrame:
    """Add ``split``: oldest rows train, then val, newest test; ties stay in the earlier part."""
    cuts = split_cuts(df, ts, train_share, val_share)
    ends = cuts.select(F.struct("train_end", "val_end")).scalar()
    at = epoch_seconds(F.col(ts))
    split = F.when(at <= ends["train_end"], "train").when(at <= ends["val_end"], "val")
    return df.where(F.col(ts).isNotNull()).withColumn("split", split.otherwise("test"))


def mark_censored(
    df: DataFrame,
    ts: str,
    sla_days: str,
    mode: str = "time",
    order: list[Column] | None = None,
    observed_days: int = OBSERVED_DAYS,
) -> DataFrame:
    """Add ``censored``: the SLA window reaches past the end of the data.

    ``mode="time"`` compares timestamps. ``mode="rank"`` takes a row's position in ``order``
    for its time, with the mean number of rows per day turning SLA days into positions.
    Rows without an SLA are never censored.
    """
    sla = F.col(sla_days)
    if mode == "time":
        last = df.agg(F.max(epoch_seconds(F.col(ts)))).scalar()
        late = epoch_seconds(F.col(ts)) > last - sla * 86400.0
    elif mode == "rank":
        rows = df.agg(F.count(F.lit(1))).scalar()
        df = global_row_index(df, order or [F.col(ts)])
        window = F.floor(sla * (rows / F.lit(observed_days)))
        late = F.col("row_index") > rows - 1 - window
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn("censored", F.coalesce(late, F.lit(False)))


def censor_filter(df: DataFrame, ts: str, sla_days: str, **options) -> DataFrame:
    marked = mark_censored(df, ts, sla_days, **options)
    return marked.where(~F.col("censored")).drop("censored", "row_index")


def censor_report(marked: DataFrame, split: str = "split") -> DataFrame:
    """Rows and dropped rows per split."""
    return marked.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("censored").alias("n_dropped"),
        (F.count_if("censored") * 100.0 / F.count(F.lit(1))).alias("pct_dropped"),
    )
