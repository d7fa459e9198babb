"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breachline.settings import cut

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with a suffix where ``df`` already has such a column."""
    taken = {c.lower() for c in df.columns}
    return base if base.lower() not in taken else f"{base}_{uuid.uuid4().hex[:8]}"


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a row number that later reads find unchanged.

    Null or repeated identifiers cannot name a row, so the filtering stages use this number.
    """
    return cut(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def shuffled(table: DataFrame) -> DataFrame:
    """``table``, to be joined by a shuffle whatever Spark takes its size for.

    Spark sizes an exploded table like the rows it was made of, and a stored one by its
    compressed bytes, so either side may be broadcast though it is many times as large.
    """
    return table.hint("shuffle_merge")


#: At most so many keys are joined by a broadcast instead of a shuffle.
HUBS = 10_000


def join_hubs(rows: DataFrame, table: DataFrame, keys: list[str], size: Column, crowd: float) -> DataFrame:
    """Inner join of ``table``, one row per key, in which no hot key fills a task.

    ``size`` counts the rows of a key. Keys with more than ``crowd`` rows are hubs and are
    joined by a broadcast: with ``crowd`` a ``HUBS``-th of all rows there are at most ``HUBS``.
    """
    columns = [*rows.columns, *[c for c in table.columns if c not in keys]]
    hubs = table.where(size > crowd).withColumn("_hub", F.lit(True))
    known = rows.join(F.broadcast(hubs), keys, "left")
    others = known.where("_hub is null").select(rows.columns).join(table.where(size <= crowd), keys)
    return known.where("_hub").select(columns).unionByName(others.select(columns))


def ordered(id_col: str, *ties: str) -> Column:
    """An identifier as an orderable struct: nulls last, ties by the further columns."""
    key = F.col(f"`{id_col}`")
    return F.struct(key.isNull().alias("absent"), key.alias("id"), *[F.col(t) for t in ties])


def utf8(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    """The texts of an Arrow column as bytes, null as empty."""
    values = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    for value in values.cast(kind):
        yield value.as_py() or b""


def shingle_hashes(text: bytes, words: int = 4) -> list[int]:
    """XXH64 (seed 42) of every shingle of the text, repeats included."""
    parts = text.lower().split()
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), 42)] if parts else []
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[a:b], 42)
        for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    ]


#: Rows that a Python task unpacks at once, and characters it works on at once.
ROWS_AT_ONCE = 500
CHARS_AT_ONCE = 1 << 19


def pieces(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of bounded length; freed buffers go back at the end.

    Workers serve one task after the other, so what a task leaves behind would add up.
    """
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()


def portions(texts: Sequence[str | None], chars: int = CHARS_AT_ONCE) -> Iterator[list[int]]:
    """Places of the texts in portions of about ``chars`` characters; a longer text is alone."""
    part, size = [], 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if part and size + n > chars:
            yield part
            part, size = [], 0
        part.append(i)
        size += n
    if part:
        yield part
