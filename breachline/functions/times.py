"""Timestamps, durations and calendar parts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_ZERO = "2010-01-01"
SECONDS_PER_DAY = 86400.0

# Names of Spark's dayofweek numbers.
WEEKDAYS = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}


def parse_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Unparseable text becomes NULL instead of failing the query."""
    return F.try_to_timestamp(text, F.lit(fmt))


def duration_days_int(closed: Column, created: Column) -> Column:
    return F.datediff(closed, created)


def duration_days(closed: Column, created: Column) -> Column:
    return (F.unix_timestamp(closed) - F.unix_timestamp(created)) / F.lit(SECONDS_PER_DAY)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def day_number(day: Column, origin: str = DAY_ZERO) -> Column:
    return F.datediff(day, F.lit(origin))


def weekday_name(weekday: Column) -> Column:
    names = F.create_map(*[F.lit(v) for pair in WEEKDAYS.items() for v in pair])
    return F.coalesce(F.try_element_at(names, weekday), F.lit("Unknown"))


def calendar_parts(ts: Column, prefix: str = "created") -> dict[str, Column]:
    """Hour, weekday, month, year, date and weekday name, ready for ``withColumns``."""
    return {
        f"{prefix}_hour": F.hour(ts),
        f"{prefix}_day_of_week_num": F.dayofweek(ts),
        f"{prefix}_month": F.month(ts),
        f"{prefix}_year": F.year(ts),
        f"{prefix}_date_only": F.to_date(ts),
        f"{prefix}_day_of_week_name": weekday_name(F.dayofweek(ts)),
    }


def weekday_from_monday_zero(weekday: Column) -> Column:
    """Monday=0 … Sunday=6 to Spark's Sunday=1 … Saturday=7."""
    return F.pmod(weekday + 1, F.lit(7)) + 1


def weekend_flag(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(1, 7), 1).otherwise(0)


def shift_of_day(hour: Column) -> Column:
    """Morning from 6, afternoon from 12, night from 20 and whenever the hour is unknown."""
    return (
        F.when(hour.between(6, 11), "manana").when(hour.between(12, 19), "tarde").otherwise("noche")
    )


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)
