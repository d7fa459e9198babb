"""Missing-value predicates, text cleaning and labels."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTINEL = "Unspecified"


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """NULL, or for text also empty or the sentinel. Other types are never compared to text."""
    if isinstance(data_type, T.StringType):
        return column.isNull() | column.isin("", SENTINEL)
    return column.isNull()


def clean_category(column: Column) -> Column:
    return F.trim(F.upper(column))


def strip_tags(column: Column) -> Column:
    return F.regexp_replace(column, "<[^>]+>", "")


def recode(column: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Look each value up in a literal map; unknown and NULL values take ``default``."""
    pairs = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    found = F.try_element_at(pairs, column)
    return found if default is None else F.coalesce(found, F.lit(default))


def joined_key(*columns: Column, separator: str = "_") -> Column:
    """NULL parts are left out together with their separator."""
    return F.concat_ws(separator, *columns)


def money_label(amount: Column) -> Column:
    return F.when(amount > 0, F.concat(F.lit("$"), F.format_number(amount, 0))).otherwise("$0")


def percent_label(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def title_case(column: Column) -> Column:
    return F.initcap(F.lower(column))


def hover_text(**parts: Column) -> Column:
    """``label: value`` lines for a map marker; NULL values show as empty."""
    lines = [
        F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit("")))
        for label, value in parts.items()
    ]
    return F.concat_ws("\n", *lines)
