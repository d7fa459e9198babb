"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

Fingerprints that differ in at most four bits agree on at least three of seven blocks, so
grouping on every choice of three blocks brings all of them together; a pair counts only
after its Hamming distance was checked. Equal fingerprints are one node from the start.

A block never emits all its pairs. Up to a bounded size its fingerprints are compared in
place and connected by fewer links than there are fingerprints. In a larger block the free
bits are split again by the same argument (four free blocks become eight, of which four
stay free), until the blocks are small or their fingerprints vary in four bits at most;
then all of them are linked to the smallest one, because any two are close.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import free_name, numbered, ordered, pieces, shingle_hashes, shuffled, utf8
from breachline.llm.components import components
from breachline.settings import cut

BITS = 64
DISTANCE = 4
WORDS = 4
#: Blocks up to this many fingerprints are compared as they are; larger ones are split further.
COMPARED = 512

_TEXTS = 256
_SHINGLES = 100_000


#: For every byte value its eight bits, lowest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def majority_bits(hashes: list[list[int]]) -> np.ndarray:
    """Per list the bits that are set in over half of its hashes, as signed longs."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter((h for each in hashes for h in each), np.uint64, int(sizes.sum()))
    slot = np.repeat(np.arange(len(hashes)), sizes)[:, None] * 8 + np.arange(8)
    seen = np.bincount(
        (slot * 256 + flat.view(np.uint8).reshape(-1, 8)).ravel(), minlength=len(hashes) * 2048
    )
    ones = (seen.reshape(-1, 256) @ _BYTE_BITS.astype(np.int64)).reshape(-1, BITS)
    return np.packbits(ones * 2 > sizes[:, None], axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """``(who, fp)`` of every row: SimHash over the whole text, zero where it has no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            done, held, size = [], [], 0
            for text in utf8(batch, 1):
                held.append(shingle_hashes(text, words))
                size += len(held[-1])
                if len(held) == _TEXTS or size > _SHINGLES:
                    done.append(majority_bits(held))
                    held, size = [], 0
            done.append(majority_bits(held) if held else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(done))], ["who", "fp"]
            )

    source = docs.select(ordered(id_col).alias("who"), F.col(f"`{text_col}`").cast("string"))
    kind = source.schema["who"].dataType.simpleString()
    return source.mapInArrow(run, f"who {kind}, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _block_masks(level: int) -> list[int]:
    """The masks of one level: seven blocks, their halves, their quarters, single bits."""
    if level == 3:
        return [1 << i for i in range(BITS)]
    edges = [round(i * BITS / 7) for i in range(8)]
    for _ in range(level):
        middles = [(a + b) // 2 for a, b in zip(edges, edges[1:])]
        edges = sorted({*edges, *middles})
    return [sum(1 << i for i in range(a, b)) for a, b in zip(edges, edges[1:])]


def _free_choices(level: int, free: Column) -> Column:
    """All ways to leave ``DISTANCE`` blocks of a level free, within the free bits so far."""
    masks = _block_masks(level)
    if level == 0:
        sums = [sum(c) for c in combinations(masks, DISTANCE)]
        return F.array(*[F.lit(_signed(m)) for m in sums])
    inside = F.filter(
        F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: m.bitwiseAND(free) == m
    )
    most = 8 if level < 3 else 12
    picks = {n: list(combinations(range(1, n + 1), DISTANCE)) for n in range(DISTANCE + 1, most + 1)}
    choice = F.array(free)
    for n, pick in picks.items():
        listed = F.array(*[F.array(*map(F.lit, p)) for p in pick])
        union = F.transform(listed, lambda p: F.aggregate(
            p, F.lit(0).cast("bigint"), lambda acc, i: acc.bitwiseOR(F.element_at(inside, i))
        ))
        choice = F.when(F.size(inside) == n, union).otherwise(choice)
    return choice


def _stars(buckets: DataFrame) -> DataFrame:
    return buckets.where("fp != least").select(F.col("fp").alias("a"), F.col("least").alias("b"))


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between close fingerprints of one block that connect what all its close pairs
    connect: at most one link fewer than fingerprints."""
    waiting, links = np.ones(len(fps), bool), []
    for seed in range(len(fps)):
        if not waiting[seed]:
            continue
        waiting[seed], queue = False, [seed]
        while queue:
            at = queue.pop()
            near = np.flatnonzero(waiting & (np.bitwise_count(fps ^ fps[at]) <= distance))
            waiting[near] = False
            queue.extend(near.tolist())
            links.extend((at, other) for other in near.tolist())
    return links


def _block_links(buckets: DataFrame, distance: int) -> DataFrame:
    """Links within blocks of bounded size, every pair of a block compared where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: list[int] = []
            for block in batch.column(0):
                fps = block.values.to_numpy().view(np.uint64)
                pairs = np.array(spanning_links(fps, distance), np.int64).reshape(-1, 2)
                ends.extend(fps.view(np.int64)[pairs].ravel().tolist())
            table = np.array(ends, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T], ["a", "b"])

    blocks = buckets.groupBy("free", "key").agg(F.collect_list("fp").alias("fps"))
    return blocks.select("fps").mapInArrow(run, "a bigint, b bigint")


def close_links(fps: DataFrame, compared: int = COMPARED) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints (distinct, column ``fp``) at most four
    bits apart: some such pairs of each block, which chain together all pairs of the block."""
    rows, links = fps.select("fp", F.lit(-1).cast("bigint").alias("free")), None
    for level in range(4):
        keyed = rows.select(
            "fp", F.explode(F.array_distinct(_free_choices(level, F.col("free")))).alias("free")
        ).select("fp", "free", F.col("fp").bitwiseAND(F.bitwise_not("free")).alias("key"))
        if level:
            keyed = keyed.distinct()
        sizes = keyed.groupBy("free", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("least"),
            F.bit_count(F.expr("bit_or(fp) & ~bit_and(fp)")).alias("varying"),
        ).where("n > 1")
        shared = cut(keyed.join(shuffled(sizes), ["free", "key"]), "blocks")
        tight = F.col("varying") <= DISTANCE
        found = _stars(shared.where(tight)).union(
            _block_links(shared.where(~tight & (F.col("n") <= compared)), DISTANCE)
        )
        links = found if links is None else links.union(found)
        rows = shared.where(~tight & (F.col("n") > compared)).select("fp", "free").distinct()
        if rows.isEmpty():
            break
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, fingerprint, component_id``.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest identifier that can
    be reached over fingerprints at most four bits apart. Null texts count as empty. Texts
    without a word share fingerprint zero and link like any other. Null identifiers order
    last, repeated rows are rows of one component, an empty table gives no rows, and other
    columns of ``docs`` are not read.
    """
    marked = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = cut(marked.groupBy("fp").agg(F.min("who").alias("who")), "nodes")
    grouped = components(close_links(nodes.select("fp")))
    rooted = nodes.join(shuffled(grouped.withColumnRenamed("node", "fp")), "fp", "left").select(
        "fp", "who", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("who").alias("least"))
    classes = cut(rooted.join(shuffled(least), "root").select("fp", "least"), "classes")
    return marked.join(shuffled(classes), "fp").select(
        F.col("who.id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest identifier.

    Rows that agree in the identifier too are told apart by their place, so one of them stays.
    """
    row = free_name(docs, "row_number")
    stored = numbered(docs, row)
    rank = F.struct(ordered(id_col), F.col(row).alias("row"))
    ranked = stored.select(rank.alias("rank"), F.col(f"`{text_col}`").alias("text"))
    gone = near_duplicates(ranked, "rank", "text").where("rank != component_id").select(
        F.col("rank.row").alias(row)
    )
    return stored.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
