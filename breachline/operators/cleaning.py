"""Projections, filters, fills and de-duplication of the silver layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachline.functions.text import clean_category

# Columns left out of silver for being sparse or redundant.
SPARSE_COLUMNS = [
    "Due Date", "Bridge Highway Name", "Vehicle Type", "Taxi Company Borough", "Road Ramp",
    "Bridge Highway Segment", "Bridge Highway Direction", "Taxi Pick Up Location",
    "Facility Type", "Location", "Zip Codes", "Address Type", "Landmark",
    "Intersection Street 2", "Intersection Street 1", "Cross Street 2", "Cross Street 1",
]

# Token standing in for NULL.
NULL_TOKENS = {
    "Descriptor": "NOT PROVIDED",
    "Location Type": "UNKNOWN",
    "Incident Address": "UNKNOWN_ADDRESS",
    "Street Name": "UNKNOWN_STREET",
    "City": "UNSPECIFIED_CITY",
    "City Council Districts": "UNKNOWN_COUNCIL_DISTRICT",
    "Police Precincts": "UNKNOWN_PRECINCT",
    "Community Districts": "UNKNOWN_COMMUNITY_DISTRICT",
    "Borough Boundaries": "UNKNOWN_BOROUGH_BOUNDARY",
    "BBL": "UNKNOWN_BBL",
    "Resolution Description": "NO_RESOLUTION_DESCRIPTION",
}

# Text columns brought to one spelling.
CATEGORY_COLUMNS = [
    "Agency", "Agency Name", "Complaint Type", "Descriptor", "Location Type", "City", "Borough",
    "City Council Districts", "Police Precincts", "Community Districts", "Borough Boundaries",
    "Park Facility Name", "Open Data Channel Type", "Park Borough", "BBL",
    "Resolution Description", "Street Name", "Incident Address", "Community Board",
]

COORDINATE_COLUMNS = [
    "latitude", "longitude", "X Coordinate (State Plane)", "Y Coordinate (State Plane)",
]

UNKNOWN_ZIP = -1


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def select_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def validate_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    """Expected columns the table lacks. Reads the schema only."""
    present = set(df.columns)
    return [c for c in expected if c not in present]


def select_by_type(df: DataFrame, numeric: bool = True) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) == numeric]


def find_date_column(df: DataFrame) -> str | None:
    """The most telling column with "date" in its name: creation first, then closing."""
    dated = [c for c in df.columns if "date" in c.lower()]
    by_priority = (
        c
        for word in ("created", "closed", "opened", "incident", "report")
        for c in dated
        if word in c.lower()
    )
    return next(by_priority, dated[0] if dated else None)


def filter_valid_duration(
    df: DataFrame, duration: str, minimum: float = 0.0, created: str | None = None
) -> DataFrame:
    kept = df.where(F.col(duration) >= minimum)
    return kept.where(F.col(created).isNotNull()) if created else kept


def chronological(created: str, closed: str) -> Column:
    """True for requests closed no earlier than created and for open ones.

    A closed request without creation time is NULL here and so leaves a filter.
    """
    return F.col(closed).isNull() | (F.col(closed) >= F.col(created))


def filter_chronology(df: DataFrame, created: str, closed: str) -> DataFrame:
    return df.where(chronological(created, closed))


def exclude_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows whose value is known and not listed; NULL is dropped too."""
    return df.where(~F.col(column).isin(*values))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def fill_tokens(df: DataFrame, tokens: Mapping[str, str]) -> DataFrame:
    """NULL becomes the column's token; a non-text column is turned into text first."""
    present = {c: t for c, t in tokens.items() if c in df.columns}
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(t)) for c, t in present.items()}
    )


def fill_numeric(df: DataFrame, values: Mapping[str, float | Column | None]) -> DataFrame:
    """NULL becomes the given number or column, without narrowing it to the column's type.

    A whole number keeps an integer column an integer; a fraction widens it to double.
    A missing replacement (``None``) leaves the column as it is.
    """
    filled = {}
    for name, value in values.items():
        if value is None:
            continue
        filled[name] = F.coalesce(F.col(f"`{name}`"), value if isinstance(value, Column) else F.lit(value))
    return df.withColumns(filled)


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast in one projection; values that do not fit become NULL unless ``strict``."""
    return df.withColumns(
        {
            c: (F.col(f"`{c}`").cast(t) if strict else F.col(f"`{c}`").try_cast(t))
            for c, t in types.items()
        }
    )


def normalize_categories(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns(
        {c: clean_category(F.col(f"`{c}`")) for c in columns if c in df.columns}
    )


def apply_filters(df: DataFrame, **wanted: Any) -> DataFrame:
    """Keep rows matching every given column; ``None`` and empty lists do not filter."""
    for column, value in wanted.items():
        if value is None or (isinstance(value, (list, tuple, set)) and not value):
            continue
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        df = df.where(F.col(column).isin(*values))
    return df


def filter_name_pattern(
    df: DataFrame, words: Sequence[str], column: str = "columna", negate: bool = False
) -> DataFrame:
    """Report rows whose field name holds one of the words, in any letter case."""
    hit = F.col(column).rlike("(?i)" + "|".join(words))
    return df.where(~hit if negate else hit)


def add_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def dedupe_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the least row by the remaining columns, so re-runs agree.

    ``min`` over a struct combines on the map side, so many copies of one key do not
    meet in a single sort as they would in a row-number window.
    """
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(key, "_row.*").select(*df.columns)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
