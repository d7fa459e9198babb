"""Binding of the driver's tables to service requests, as DataFrames and as SQL.

The Spark side joins only the tables its fields need: every foreign key has its row, so
leaving out a dimension changes no row.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachline.functions.sla import breach_by_contract, penalty_charged
from breachline.functions.times import duration_days
from breachline.operators.cleaning import (
    dedupe_by_key,
    drop_missing,
    fill_numeric,
    fill_tokens,
    filter_chronology,
    normalize_categories,
)
from breachline.operators.joins import lookup_join
from breachline.operators.splitting import temporal_split
from breachline.settings import settled
from breachline.sources.lookup import inline_lookup

# Contract terms of the fixture's agencies; "5-LOW" has none on purpose.
FIXTURE_CONTRACTS = [
    ("1-URGENT", 200.0, 80000.0),
    ("2-HIGH", 400.0, 64000.0),
    ("3-MEDIUM", 600.0, 72000.0),
    ("4-NOT SPECIFIED", 900.0, 106000.0),
]

FIELDS = [
    "request_key", "created_ts", "closed_ts", "agency", "borough", "complaint_type", "channel",
    "location_type", "incident_zip", "latitude", "longitude", "quantity", "price", "discount",
    "tax", "returnflag",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its zone-less times read as UTC timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def requests(spark: SparkSession, sf_dir: str, fields: list[str] | None = None) -> DataFrame:
    fields = fields or FIELDS
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    df = table(spark, sf_dir, "lineitem")
    if {"created_ts", "agency"} & set(fields):
        df = df.join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == order)
    if {"complaint_type", "location_type"} & set(fields):
        df = df.join(table(spark, sf_dir, "part"), F.col("p_partkey") == part)
    if "borough" in fields:
        # one dimension after the other, so that Spark sees the stored size of each
        df = (
            df.join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == supplier)
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
    place = F.when(order % 19 == 0, "").when(order % 23 == 0, "Unspecified")
    made = {
        "request_key": order * 10 + F.col("l_linenumber"),
        "created_ts": F.col("o_orderdate"),
        "closed_ts": F.when(order % 17 != 0, F.col("l_shipdate")),
        "agency": F.col("o_orderpriority"),
        "borough": F.col("r_name"),
        "complaint_type": F.col("p_brand"),
        "channel": F.col("l_linestatus"),
        "location_type": place.otherwise(F.col("p_type")),
        "incident_zip": F.when(part % 29 != 0, supplier),
        "latitude": F.when(part % 31 != 0, 40 + (part % 1000) / 1000.0),
        "longitude": -74 + (supplier % 1000) / 1000.0,
        "quantity": F.col("l_quantity"),
        "price": F.col("l_extendedprice"),
        "discount": F.col("l_discount"),
        "tax": F.col("l_tax"),
        "returnflag": F.col("l_returnflag"),
    }
    return df.select(*[made[f].alias(f) for f in FIELDS if f in fields])


REQUESTS = """
requests AS (
  SELECT l_orderkey * 10 + l_linenumber AS request_key,
         o_orderdate AS created_ts,
         CASE WHEN l_orderkey % 17 <> 0 THEN l_shipdate END AS closed_ts,
         o_orderpriority AS agency,
         r_name AS borough,
         p_brand AS complaint_type,
         l_linestatus AS channel,
         CASE WHEN l_orderkey % 19 = 0 THEN '' WHEN l_orderkey % 23 = 0 THEN 'Unspecified'
              ELSE p_type END AS location_type,
         CASE WHEN l_partkey % 29 <> 0 THEN l_suppkey END AS incident_zip,
         CASE WHEN l_partkey % 31 <> 0 THEN 40 + (l_partkey % 1000) / CAST(1000 AS DOUBLE) END AS latitude,
         -74 + (l_suppkey % 1000) / CAST(1000 AS DOUBLE) AS longitude,
         l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
         l_returnflag AS returnflag
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned requests: one row per key, known coordinates, one spelling, sound chronology."""
    return clean_fixture(requests(spark, sf_dir))


def leading(columns: Collection[str]) -> list[str]:
    """The request fields that decide about cleaned rows and the given columns of them.

    Of the rows of a key the least one stays, field by field, so fields behind the last one
    needed change nothing; rows without coordinates go, so those before them are all needed.
    """
    return FIELDS[: 1 + max(FIELDS.index(c) for c in ("longitude", *columns) if c in FIELDS)]


def stored_silver(spark: SparkSession, sf_dir: str, columns: Collection[str]) -> DataFrame:
    """Stored cleaned requests with the fields up to the last of ``columns``.

    The joined requests are written before rows are compared, so that the files of the joins
    and those of the comparison need not lie on the disks together.
    """
    joined = settled(requests(spark, sf_dir, leading(columns)), "requests")
    return settled(clean_fixture(joined), "silver")


def clean_fixture(df: DataFrame) -> DataFrame:
    df = dedupe_by_key(df, "request_key")
    df = fill_tokens(df, {"location_type": "UNKNOWN"})
    df = drop_missing(df, ["latitude", "longitude"])
    df = fill_numeric(df, {"incident_zip": -1})
    df = normalize_categories(
        df, ["agency", "borough", "complaint_type", "channel", "location_type"]
    )
    return filter_chronology(df, "created_ts", "closed_ts")


SILVER = (
    REQUESTS
    + """,
deduped AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY request_key ORDER BY
      created_ts NULLS FIRST, closed_ts NULLS FIRST, agency NULLS FIRST, borough NULLS FIRST,
      complaint_type NULLS FIRST, channel NULLS FIRST, location_type NULLS FIRST,
      incident_zip NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST,
      quantity NULLS FIRST, price NULLS FIRST, discount NULLS FIRST, tax NULLS FIRST,
      returnflag NULLS FIRST) AS place
    FROM requests) WHERE place = 1
),
silver AS (
  SELECT request_key, created_ts, closed_ts, trim(upper(agency)) AS agency,
         trim(upper(borough)) AS borough, trim(upper(complaint_type)) AS complaint_type,
         trim(upper(channel)) AS channel,
         trim(upper(coalesce(location_type, 'UNKNOWN'))) AS location_type,
         coalesce(incident_zip, -1) AS incident_zip, latitude, longitude, quantity, price,
         discount, tax, returnflag
  FROM deduped
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    AND (closed_ts >= created_ts OR closed_ts IS NULL)
)"""
)


def fixture_lookup(spark: SparkSession) -> DataFrame:
    return inline_lookup(spark, FIXTURE_CONTRACTS)


def with_contract(df: DataFrame) -> DataFrame:
    """Durations, contract terms, breach target and penalty."""
    joined = lookup_join(df, fixture_lookup(df.sparkSession), "agency")
    return (
        joined.withColumn(
            "resolution_time_days", duration_days(F.col("closed_ts"), F.col("created_ts"))
        )
        .withColumn("target", breach_by_contract(F.col("resolution_time_days"), F.col("sla_days")))
        .withColumn("penalty_charged", penalty_charged(F.col("target"), F.col("penalty_amount_usd")))
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_contract(silver(spark, sf_dir))


def splits(spark: SparkSession, sf_dir: str, columns: Collection[str] | None = None) -> DataFrame:
    """Judged requests with their split, of which only ``columns`` are read, or all of them.

    The cuts and the split read the judged requests twice, so they are written first, and the
    joined requests before them, as in ``stored_silver``.
    """
    joined = settled(requests(spark, sf_dir, columns and leading(columns)), "requests")
    made = with_contract(clean_fixture(joined))
    if columns:
        made = made.select(*dict.fromkeys(["created_ts", *columns]))
    return temporal_split(settled(made, "judged"), "created_ts")


JUDGED = (
    SILVER
    + """,
lookup(agency_key, sla_days, penalty_amount_usd) AS (
  VALUES ('1-URGENT', CAST(200 AS DOUBLE), CAST(80000 AS DOUBLE)),
         ('2-HIGH', CAST(400 AS DOUBLE), CAST(64000 AS DOUBLE)),
         ('3-MEDIUM', CAST(600 AS DOUBLE), CAST(72000 AS DOUBLE)),
         ('4-NOT SPECIFIED', CAST(900 AS DOUBLE), CAST(106000 AS DOUBLE))
),
timed AS (
  SELECT s.*, sla_days, penalty_amount_usd,
         (epoch(closed_ts) - epoch(created_ts)) / CAST(86400 AS DOUBLE) AS resolution_time_days
  FROM silver s LEFT JOIN lookup ON agency = agency_key
),
judged AS (
  SELECT *, CASE WHEN target = 1 THEN penalty_amount_usd WHEN target = 0 THEN CAST(0 AS DOUBLE) END
              AS penalty_charged
  FROM (SELECT *, CASE WHEN resolution_time_days >= 0 AND sla_days IS NOT NULL
                       THEN CAST(resolution_time_days > sla_days AS INTEGER) END AS target
        FROM timed)
)"""
)

SPLITS = (
    JUDGED
    + """,
cuts AS (
  SELECT quantile_disc(CAST(epoch(created_ts) AS BIGINT), 0.70) AS train_end,
         quantile_disc(CAST(epoch(created_ts) AS BIGINT), 0.85) AS val_end
  FROM judged
),
splits AS (
  SELECT j.*, CASE WHEN epoch(created_ts) <= train_end THEN 'train'
                   WHEN epoch(created_ts) <= val_end THEN 'val' ELSE 'test' END AS split
  FROM judged j, cuts WHERE created_ts IS NOT NULL
)"""
)


def with_text_times(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, so that both engines print them alike."""
    shown = {}
    for field in df.schema:
        if isinstance(field.dataType, T.TimestampType):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd")
    return df.withColumns(shown)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, times as text: the form compared with SQL."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return with_text_times(df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles}))
