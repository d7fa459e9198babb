"""Breach flags, penalties, pressure ratios and decision columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SMOOTHING = 0.01
CAP = (0.05, 0.95)


def smoothed_ratio(numerator: Column, sla_days: Column, smoothing: float = SMOOTHING) -> Column:
    return numerator / (sla_days + F.lit(smoothing))


def breach_by_percentile(duration: Column, threshold: Column) -> Column:
    """Unknown durations and unknown thresholds count as kept (0)."""
    return F.when(duration > threshold, 1).otherwise(0)


def breach_by_contract(duration: Column, sla_days: Column) -> Column:
    """NULL when the duration is unknown or negative, or no contract applies."""
    return F.when((duration >= 0) & sla_days.isNotNull(), (duration > sla_days).cast("int"))


def penalty_charged(target: Column, penalty: Column) -> Column:
    return F.when(target == 1, penalty.cast("double")).when(target == 0, F.lit(0.0))


def clip(value: Column, low: float, high: float) -> Column:
    """Like ``greatest``/``least`` but NULL stays NULL."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def stable_fold(*key: Column, folds: int = 5, seed: int = 42) -> Column:
    """A fold that depends on the row's key only, so a re-run task assigns it again."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % folds).cast("int")


def stable_share(*key: Column, seed: int = 42) -> Column:
    """A share in [0, 1) that depends on the row's key only; its digits are not the fold's."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 8, 7), 16, 10).cast("double") / float(1 << 28)


def priority_level(probability: Column, threshold: float) -> Column:
    return (
        F.when(probability >= 0.75, "CRÍTICA")
        .when(probability >= threshold, "ALTA")
        .when(probability >= 0.30, "MEDIA")
        .when(probability.isNotNull(), "BAJA")
    )
