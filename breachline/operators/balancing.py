"""Synthetic minority rows between nearest neighbours."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.operators.joins import attach
from breachline.operators.ordering import global_row_index
from breachline.settings import BROADCAST_BYTES, SEED, cut

BLOCK_ROWS = 1024
#: Parts a block is cut into at most, per round.
FAN = 4
_NEAR = "i long, near array<struct<d: double, foreign: boolean, j: long>>"


def _nearest(own: pd.DataFrame, other: pd.DataFrame, k: int, foreign: bool) -> pd.DataFrame:
    """The k nearest ``other`` rows of every ``own`` row; equal distances go to the least index."""
    if own.empty or other.empty:
        return pd.DataFrame({"i": own["i"], "near": pd.Series([[]] * len(own), own.index, object)})
    other = other.sort_values("i")
    x, y = np.stack(own["x"].to_numpy()), np.stack(other["x"].to_numpy())
    i, j = own["i"].to_numpy(), other["i"].to_numpy()
    squares = np.zeros((len(x), len(y)))
    for c in range(x.shape[1]):
        squares += (x[:, c, None] - y[None, :, c]) ** 2
    squares[i[:, None] == j[None, :]] = np.inf
    best = np.argsort(squares, axis=1, kind="stable")[:, :k]
    d = np.sqrt(np.take_along_axis(squares, best, axis=1))
    found = [
        [{"d": a, "foreign": foreign, "j": b} for a, b in zip(near, at) if a < np.inf]
        for near, at in zip(d.tolist(), j[best].tolist())
    ]
    return pd.DataFrame({"i": i, "near": found})


def _bounds(columns: Sequence[tuple[Column, Column]]) -> list[Column]:
    """Least and greatest value per coordinate, NaN left out."""
    low = F.array(*[F.min(F.when(~F.isnan(a), a)) for a, _ in columns])
    high = F.array(*[F.max(F.when(~F.isnan(b), b)) for _, b in columns])
    return [low.alias("low"), high.alias("high")]


def space_blocks(points: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int, int]:
    """``points(key, x)`` as (i, key, x, block), with the cuts per round and the rounds.

    Every round cuts each block into ``fan`` equal parts along the coordinate in which its
    points vary most, so after some rounds blocks are small in all coordinates that matter.
    Parts are equal because they are cut by position in the order of (block, coordinate, key);
    copies of one point are spread over several blocks. ``block // fan`` is the block before.
    """
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = size["n"], size["width"] or 1
    blocks = max(1, math.ceil(n / block_rows))
    rounds = max(1, math.ceil(math.log(blocks, FAN) - 1e-9))
    fan = max(1, math.ceil(blocks ** (1 / rounds) - 1e-9))
    placed = cut(points.select("key", "x", F.lit(0).cast("long").alias("block")), "points")
    for cuts in range(1, rounds + 1):
        spread = F.array(*[F.coalesce(F.var_pop(F.col("x")[c]), F.lit(0.0)) for c in range(width)])
        axes = placed.groupBy("block").agg(spread.alias("v")).select(
            "block", F.array_position("v", F.array_max("v")).cast("int").alias("axis")
        )
        along = attach(placed, axes, "block").withColumn("a", F.element_at("x", F.col("axis")))
        order = [F.col("block"), F.col("a"), F.col("key")]
        ranked = global_row_index(along.select("key", "x", "block", "a"), order, "i")
        part = F.expr(f"i * {fan**cuts} div {max(n, 1)}")
        placed = cut(ranked.select("i", "key", "x", part.alias("block")), "points")
    return placed, fan, rounds


def reached_blocks(asking: DataFrame, placed: DataFrame, fan: int, rounds: int) -> DataFrame:
    """The blocks a point's sphere reaches: ``asking(i, x, r, block)`` as (i, x, block).

    Points walk down the cuts: at each round only parts stay whose box is nearer than ``r``.
    The own block is left out.
    """
    width = placed.agg(F.max(F.size("x"))).first()[0] or 1
    coordinates = [F.col("x")[c] for c in range(width)]
    leaves = placed.groupBy("block").agg(*_bounds([(c, c) for c in coordinates]))
    level = F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("level")
    up = F.element_at(F.array(*[F.lit(fan ** (rounds - k)) for k in range(1, rounds + 1)]), F.col("level"))
    tree = leaves.select("*", level).withColumn("node", F.floor(F.col("block") / up).cast("long"))
    sides = [(F.col("low")[c], F.col("high")[c]) for c in range(width)]
    tree = cut(tree.groupBy("level", "node").agg(*_bounds(sides)), "boxes")

    gaps = F.zip_with(
        "x", F.arrays_zip("low", "high"),
        lambda a, s: F.greatest(s["low"] - a, a - s["high"], F.lit(0.0)),
    )
    distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g * g))
    at = asking.select("i", "x", "r", "block", F.lit(0).cast("long").alias("at"))
    for cuts in range(1, rounds + 1):
        parts = tree.where(F.col("level") == cuts).select(
            F.floor(F.col("node") / fan).cast("long").alias("at"), "node", "low", "high"
        )
        # the rows of a round are at most fan ** cuts, of known size; later ones are joined by shuffle
        if fan**cuts * (16 * width + 64) <= BROADCAST_BYTES:
            parts = F.broadcast(parts)
        at = at.join(parts, "at").where(distance < F.col("r")).select(
            "i", "x", "r", "block", F.col("node").alias("at")
        )
    return at.where("at <> block").select("i", "x", F.col("at").alias("block"))


def nearest_neighbours(points: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact k nearest neighbours of ``points(key, x)`` as (i, key, x, near): place, vector, neighbours.

    Space is cut into blocks of equal size (``space_blocks``). Neighbours inside the own block
    bound how far better ones can lie; a point is only compared with further blocks whose box
    its sphere reaches. A block meets its visitors in shares of about ``block_rows``, so a
    task holds two blocks at most however many points reach one, and k rows per point come
    back. With many independent coordinates most boxes are within reach of most points: the
    result stays exact, and the work grows towards all pairs of blocks.
    """
    placed, fan, rounds = space_blocks(points, block_rows)
    inside = cut(
        placed.select("block", "i", "x")
        .groupBy("block")
        .applyInPandas(lambda pdf: _nearest(pdf, pdf, k, False), _NEAR),
        "near-inside",
    )
    limit = F.when(F.size("near") < k, F.lit(float("inf"))).otherwise(F.element_at("near", -1)["d"])
    asking = placed.join(inside.select("i", limit.alias("r")), "i").where("r > 0")
    reached = cut(reached_blocks(asking, placed, fan, rounds), "reached")
    shares = cut(reached.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("long").alias("shares")
    ), "shares")
    share = F.pmod(F.xxhash64("i"), F.col("shares")).alias("share")
    own = attach(reached, shares, "block", settled=True).select("block", share, "i", "x")
    numbers = F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)
    other = placed.join(shares, "block").select("block", F.explode(numbers).alias("share"), "i", "x")
    outside = (
        own.groupBy("block", "share")
        .cogroup(other.groupBy("block", "share"))
        .applyInPandas(lambda a, b: _nearest(a, b, k, True), _NEAR)
    )
    # a nearer point wins; at equal distance the own block does, so copies share the load
    best = (
        inside.unionByName(outside)
        .groupBy("i")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    )
    return placed.select("i", "key", "x").join(best, "i")


def smote(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    target: str = "target",
    k: int = 5,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Original rows plus synthetic rows of class 1, until both classes are equally many.

    Each synthetic row lies between a class-1 row and one of its k nearest class-1 rows, at a
    hashed place. Class-1 rows take turns, so their numbers of copies differ by at most one.
    """
    rows = df.select(
        F.col(key).alias("key"),
        F.col(target).alias("y"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
    ).where(F.col("y").isNotNull())
    counts = rows.agg(
        F.count_if(F.col("y") == 0).alias("neg"),
        F.count_if(F.col("y") == 1).alias("pos"),
    ).first()
    original = rows.select("key", "y", "x", F.lit(False).alias("synthetic"))
    missing = max(counts["neg"] - counts["pos"], 0)
    if missing == 0 or counts["pos"] < 2:
        return _unpacked(original, features, key, target)

    points = rows.where(F.col("y") == 1).select("key", "x")
    near = cut(nearest_neighbours(points, k, block_rows), "neighbours")
    each, more = divmod(missing, counts["pos"])
    copies = F.lit(each) + (F.col("i") < more).cast("int")
    made = (
        near.withColumn("copies", copies)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    )
    pick = F.pmod(F.xxhash64("i", "copy", F.lit(seed)), F.size("near")).cast("int")
    share = F.pmod(F.xxhash64("copy", "i", F.lit(seed + 1)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = made.select("key", "x", share.alias("u"), F.col("near")[pick]["j"].alias("j"))
    partner = near.select(F.col("i").alias("j"), F.col("x").alias("p"))
    between = F.zip_with("x", "p", lambda a, b: a + (b - a) * F.col("u"))
    synthetic = drawn.join(partner, "j").select(
        "key", F.lit(1).alias("y"), between.alias("x"), F.lit(True).alias("synthetic")
    )
    return _unpacked(original.unionByName(synthetic), features, key, target)


def _unpacked(df: DataFrame, features: Sequence[str], key: str, target: str) -> DataFrame:
    return df.select(
        F.col("key").alias(key),
        F.col("y").alias(target),
        *[F.col("x")[i].alias(c) for i, c in enumerate(features)],
        "synthetic",
    )
