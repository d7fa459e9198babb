"""Positions and running sums over a whole table, without sorting it in one task.

Rows are range-partitioned by the order, sorted inside their block and written once.
Block totals, one row per block, give every block its offset; the rest is local.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachline.settings import cut, shuffle_width

_BLOCK_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def ordered_blocks(df: DataFrame, order: Sequence[Column], blocks: int | None = None) -> DataFrame:
    """``df`` in order, with its block number ``_block`` and the place in the block ``_pos``."""
    placed = (
        df.repartitionByRange(blocks or shuffle_width(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return cut(placed, "blocks").select(
        "*",
        F.shiftright("_id", _BLOCK_BITS).cast("int").alias("_block"),
        F.col("_id").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)).alias("_pos"),
    ).drop("_id")


def global_row_index(
    df: DataFrame, order: Sequence[Column], name: str = "row_index", blocks: int | None = None
) -> DataFrame:
    """Add the position 0 … n-1 of every row. ``order`` must end in a unique key."""
    placed = ordered_blocks(df, order, blocks)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).select(
        "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # one row per range block, so the broadcast cannot grow with the data
    return (
        placed.join(F.broadcast(starts), "_block")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_block", "_pos", "_start")
    )


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Add ``cum_<x>`` and ``all_<x>``: the sum of ``x`` up to the row, and over its group.

    The order must be unique inside a group: aggregate ties before calling.
    """
    by = list(by)
    placed = ordered_blocks(df, [*map(F.col, by), *order], blocks)
    totals = placed.groupBy(*by, "_block").agg(*[F.sum(x).alias(x) for x in sums])
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    starts = totals.select(
        *by,
        "_block",
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"_start_{x}") for x in sums],
        *[F.sum(x).over(whole).alias(f"all_{x}") for x in sums],
    )
    if not by:  # one row per block
        starts = F.broadcast(starts)
    # NULL is a group like any other
    renamed = starts.select(
        F.col("_block").alias("_at"), *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(by)],
        *[c for c in starts.columns if c not in {"_block", *by}],
    )
    same = [F.col("_block") == F.col("_at")]
    same += [F.col(f"`{c}`").eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    inside = (
        Window.partitionBy(*by, "_block")
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumns({f"cum_{x}": F.sum(x).over(inside) for x in sums})
        .join(renamed, reduce(and_, same))
        .withColumns({f"cum_{x}": F.col(f"cum_{x}") + F.col(f"_start_{x}") for x in sums})
        .drop("_block", "_pos", "_at", *[f"_by{i}" for i in range(len(by))], *[f"_start_{x}" for x in sums])
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, value, n) for numeric columns, NULL left out."""
    as_double = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return (
        as_double.unpivot([], [F.col(f"`{c}`") for c in columns], "columna", "value")
        .where(F.col("value").isNotNull())
        .groupBy("columna", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles, one row per column: ``q_0``, ``q_1``, … as asked.

    Works from running counts of distinct values, so no column is gathered in one task.
    """
    running = prefix_sums(value_counts(df, columns), [F.col("value")], ["n"], by=["columna"])
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    picks, results = [], []
    for i, share in enumerate(shares):
        place = (F.col("all_n") - 1) * F.lit(share)
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picks.append(F.max(F.when(at.between(first, last), F.col("value"))).alias(f"_{end}{i}"))
        picks.append(F.first(place - F.floor(place)).alias(f"_w{i}"))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        results.append((low + (high - low) * F.col(f"_w{i}")).alias(f"q_{i}"))
    return running.groupBy("columna").agg(*picks).select("columna", *results)


def discrete_quantiles_of(
    counts: DataFrame, shares: Sequence[float], by: Sequence[str] = ("columna",)
) -> DataFrame:
    """Per group of ``by, value, n`` the least value with at least the share of rows at or
    below it: ``q_0``, ``q_1``, …; a large group lies in as many blocks as it needs."""
    running = prefix_sums(counts, [F.col("value")], ["n"], by=by)
    return running.groupBy(*by).agg(
        *[
            F.min(F.when(F.col("cum_n") >= F.ceil(F.col("all_n") * F.lit(s)), F.col("value"))).alias(f"q_{i}")
            for i, s in enumerate(shares)
        ]
    )


def group_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float]
) -> DataFrame:
    """The same from a table: exact, from running counts of the distinct values of a column.

    A group without a known value has no row; without keys there is one row in any case.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return discrete_quantiles_of(counts, shares, list(keys))


def discrete_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    return group_quantiles(df, [], column, shares)


def expanding_folds(df: DataFrame, order: Sequence[Column], k: int = 5) -> DataFrame:
    """Add ``fold``: the fold (0 … k-1) testing the row, -1 for rows that are only learnt from.

    Fold ``i`` is tested on rows with ``fold == i`` and learns from all earlier ones.
    """
    indexed = global_row_index(df, order)
    n = df.agg(F.count(F.lit(1))).scalar()
    test_size = F.floor(n / F.lit(k + 1))
    offset = F.col("row_index") - (n - test_size * k)
    return indexed.withColumn(
        "fold", F.when(offset < 0, -1).otherwise(F.floor(offset / test_size)).cast("int")
    )


def fold_roles(folded: DataFrame, fold: int) -> DataFrame:
    """Rows of one fold with ``role`` train or test; later rows are left out."""
    return folded.where(F.col("fold") <= fold).withColumn(
        "role", F.when(F.col("fold") == fold, "test").otherwise("train")
    )


def fold_summary(folded: DataFrame, k: int = 5) -> DataFrame:
    """Per fold: rows learnt from and tested, and their range of positions."""
    sizes = folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_index").alias("first_row"),
        F.max("row_index").alias("last_row"),
    )
    earlier = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # k + 1 rows
    return (
        sizes.withColumns(
            {
                "train_rows": F.sum("n").over(earlier),
                "test_rows": F.col("n"),
                "train_last": F.max("last_row").over(earlier),
                "test_first": F.col("first_row"),
                "test_last": F.col("last_row"),
            }
        )
        .where(F.col("fold") >= 0)
        .select("fold", "train_rows", "test_rows", "train_last", "test_first", "test_last")
    )


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
