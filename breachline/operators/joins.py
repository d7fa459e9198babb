"""Equi joins that survive hot keys.

A per-key table is broadcast only if its stored bytes stay within a bound. Beyond it the
join is one salted shuffle join: a row of a hot key meets one of several copies of the
table's row, chosen by a hash, so the key is spread over as many tasks. Only hot keys have
copies, so the shuffle grows no faster than input and table; they are found by counting the
rows of each key, in the input or in a table it was made of. A stream cannot be counted:
there every key has its copies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachline.settings import BROADCAST_BYTES, HOT_ROWS, SALTS, cut, stored_bytes


def as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: str | Sequence[str],
    max_bytes: int | None = None,
    salts: int = SALTS,
    settled: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join of a table with at most one row per key; ``df`` keeps all its rows.

    ``settled`` says that ``table`` is already a stored table, which need not be written.
    ``counted`` holds the same keys as ``df`` and is cheaper to read, such as the stored table
    that ``df`` only added columns to.
    """
    keys = as_list(keys)
    table = table if settled else cut(table, "attach")
    if stored_bytes(table) <= (BROADCAST_BYTES if max_bytes is None else max_bytes):
        return df.join(F.broadcast(table), keys, "left")
    return attach_salted(df, table, keys, salts, counted)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows, and ``_hot``; at most one per ``rows`` rows of the table."""
    known = df.select(*[F.col(f"`{k}`") for k in keys]).dropna()
    found = known.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return cut(found.where(F.col("_n") > rows).withColumn("_hot", F.lit(True)).drop("_n"), "hot")


def _spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of all columns beside the keys; maps, which have none, go by their entries."""
    parts = [
        F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in df.schema if f.name not in keys and not isinstance(f.dataType, (T.UserDefinedType, T.VariantType))
    ]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def attach_salted(
    df: DataFrame,
    table: DataFrame,
    keys: str | Sequence[str],
    salts: int = SALTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The same left join as one shuffle join over keys and salt.

    Rows of a hot key go to one of ``salts`` copies of its row in the table, all others to the
    only one. Rows with a NULL key match nothing; their salts lie outside the copies and
    spread them.
    """
    keys = as_list(keys)
    no_key = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    spread, columns = _spread(df, keys), df.columns
    last, one = F.lit(salts - 1).cast("bigint"), F.lit(0).cast("bigint")
    if df.isStreaming:
        marked, hot = df, F.lit(True)
    else:
        found = hot_keys(df if counted is None else counted, keys)
        if found.isEmpty():
            marked, hot = df, F.lit(False)
        else:
            # a key is compared with the hot keys as it is compared with the table
            found, hot = F.broadcast(found), F.col("_hot").isNotNull()
            marked, table = df.join(found, keys, "left"), table.join(found, keys, "left")
    salt = F.when(no_key, -1 - F.pmod(spread, F.lit(1009))).when(hot, F.pmod(spread, F.lit(salts))).otherwise(one)
    copies = table.withColumn("_salt", F.explode(F.sequence(one, F.when(hot, last).otherwise(one)))).drop("_hot")
    salted = marked.withColumn("_salt", salt).select("_salt", *[F.col(f"`{c}`") for c in columns])
    joined = salted.join(copies.hint("shuffle_merge"), [*keys, "_salt"], "left")
    return joined.drop("_salt")


def lookup_join(df: DataFrame, lookup: DataFrame, column: str, key: str = "agency_key") -> DataFrame:
    """Left join of a short lookup; its key is dropped and unmatched rows hold NULL.

    The lookup is written first, because the size of a literal table is not known, and checked
    like every other table before it is broadcast.
    """
    terms = [c for c in lookup.columns if c != key]
    joined = attach(df, lookup.withColumnRenamed(key, column), column)
    return joined.select(*[F.col(f"`{c}`") for c in [*df.columns, *terms]])


def attach_group_stat(
    df: DataFrame,
    stats: DataFrame,
    keys: str | Sequence[str],
    fallback: Mapping[str, Column],
    **options,
) -> DataFrame:
    """Attach per-group statistics; groups never seen take the given global value."""
    joined = attach(df, stats, keys, **options)
    return joined.withColumns(
        {name: F.coalesce(F.col(name), value) for name, value in fallback.items()}
    )


def join_two_level_fallback(
    df: DataFrame,
    exact: DataFrame,
    exact_keys: Sequence[str],
    coarse: DataFrame,
    coarse_keys: Sequence[str],
    value: str,
    last: Column,
    **options,
) -> DataFrame:
    """``value`` of the exact key, else of the coarse key, else ``last``."""
    coarse = coarse.withColumnRenamed(value, "_coarse")
    options = {"counted": df} | options
    joined = attach(attach(df, exact, exact_keys, **options), coarse, coarse_keys, **options)
    return joined.withColumn(value, F.coalesce(value, "_coarse", last)).drop("_coarse")


def inner_match(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return left.join(right, as_list(keys), "inner")


def outer_join_counts(df: DataFrame, key: str, tag: str, tags: Sequence[str]) -> DataFrame:
    """Counts of ``key`` side by side for every tag, 0 where a tag lacks the key.

    A pivot gives the full outer join of the per-tag counts in one aggregation.
    """
    counted = df.groupBy(key).pivot(tag, list(tags)).agg(F.count(F.lit(1)))
    return counted.fillna(0, list(tags)).orderBy(key)
