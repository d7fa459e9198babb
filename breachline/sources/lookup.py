"""The contract table: SLA days and penalty per agency."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Agency, contract days, penalty in USD.
CONTRACTS = [
    ("DOT", 5.0, 83448.0),
    ("NYPD", 0.33, 64277.0),
    ("DSNY", 5.0, 79301.0),
    ("DPR", 8.0, 68022.0),
    ("DOB", 40.0, 106907.0),
    ("DEP", 0.25, 75757.0),
    ("HPD", 12.0, 252387.0),
    ("DOE", 36.0, 119316.0),
    ("DHS", 0.04, 74717.0),
    ("DOHMH", 14.0, 74717.0),
    ("TLC", 14.0, 74717.0),
    ("DCA", 28.0, 74717.0),
    ("DOITT", 3.0, 74717.0),
]

LOOKUP_SCHEMA = (
    "agency_key string not null, sla_days double not null, penalty_amount_usd double not null"
)


def inline_lookup(
    spark: SparkSession,
    rows: Iterable[tuple[str, float, float]] = CONTRACTS,
    schema: str = LOOKUP_SCHEMA,
) -> DataFrame:
    """A literal table. Spark does not know its size until it is stored."""
    return spark.createDataFrame(list(rows), schema)
