"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a lane with one run: its digests, each with the smallest
identifier and the number of rows. The lanes then exchange runs in rounds. A lane number
is read as digits in base ``fan_in``; in round ``r`` all lanes that differ in digit ``r``
only merge, and each of them receives the part of the digests whose own digit ``r`` it
carries. After all rounds a digest has met every other run, and no lane ever held more
than its share of the digests: a third of all rows with one text is one run entry per lane
before the first exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import BLANK, free_name, numbered, ordered, text_of
from breachline.settings import cut, shuffle_width

FAN_IN = 16

#: Digest, byte length and a second hash must all agree before two entries merge.
PROOF = ["digest", "size", "check"]


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = F.regexp_replace(text_of(text_col), BLANK, " ")
    return cut(
        docs.select(ordered(id_col).alias("who"), plain.alias("plain")).select(
            "who",
            F.unhex(F.sha2("plain", 256)).alias("digest"),
            F.octet_length("plain").alias("size"),
            F.xxhash64("plain").alias("check"),
            F.spark_partition_id().alias("lane"),
        ),
        "digests",
    )


def merge_runs(runs: DataFrame, lanes: int, fan_in: int = FAN_IN) -> DataFrame:
    """Merge ``(lane, digest, size, check, keep, n)`` over all lanes in rounds of ``fan_in``."""
    width, step = shuffle_width(runs.sparkSession), 1
    digit_source = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("bigint")
    while step < lanes:
        mine = F.floor(F.col("lane") / step) % fan_in
        theirs = F.floor(digit_source / step) % fan_in
        runs = (
            runs.withColumn("lane", (F.col("lane") + (theirs - mine) * step).cast("bigint"))
            .repartition(width, "lane")
            .sortWithinPartitions("lane", *PROOF)
            .groupBy("lane", *PROOF)
            .agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))
        )
        step *= fan_in
    return runs


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """One row per input row: ``<id_col>, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they agree once each run of white space is one space; null is
    empty. The row with the smallest identifier stays. Null identifiers come last; of rows
    with equal identifier and text one stays. An empty table gives no rows, and other
    columns of ``docs`` are not read.
    """
    rows = _digests(docs, id_col, text_col)
    runs = rows.groupBy("lane", *PROOF).agg(
        F.min("who").alias("least"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list("who")).alias("members"),
    )
    lanes = (rows.agg(F.max("lane")).first()[0] or 0) + 1
    merged = merge_runs(
        runs.select("lane", *PROOF, F.struct("least", "lane").alias("keep"), "n"), lanes, fan_in
    )
    # one row per lane and digest on the left: a hot text has as many rows as there are lanes
    joined = runs.select("lane", *PROOF, "members").join(
        merged.select(*PROOF, "keep", "n"), PROOF
    )
    return joined.select(
        "lane", "digest", "keep", "n", F.posexplode("members").alias("place", "who")
    ).select(
        F.col("who.id").alias(id_col),
        F.col("keep.least.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("place") == 0) & (F.col("lane") == F.col("keep.lane"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the smallest identifier."""
    row = free_name(docs, "row_number")
    stored = numbered(docs, row)
    rank = F.struct(ordered(id_col), F.col(row).alias("row"))
    ranked = stored.select(rank.alias("rank"), F.col(f"`{text_col}`").alias("text"))
    gone = exact_duplicates(ranked, "rank", "text").where("not kept").select(
        F.col("rank.row").alias(row)
    )
    return stored.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
