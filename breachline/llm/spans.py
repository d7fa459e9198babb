"""Regular-expression matches with their places, from built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 256
SPAN = "array<struct<start:bigint,stop:bigint,value:string,before:string,after:string>>"


def _total(lengths: Column, first: Column, count: Column | int) -> Column:
    return F.aggregate(
        F.slice(lengths, first, count), F.lit(0).cast("bigint"), lambda a, x: a + x
    )


def add_matches(
    df: DataFrame, text: str, patterns: Mapping[str, str], gates: Mapping[str, Column] | None = None,
    before: int = 40, after: int = 8,
) -> DataFrame:
    """Add one column per pattern: its leftmost non-overlapping matches in ``text``, each
    with start and stop (code points, stop exclusive), value and the text next to it.

    A match follows from the texts between the matches, whose lengths are summed in two
    levels, so a text with many matches costs little more than its length. The neighbouring
    text ends at the next match. ``gates`` are cheap conditions without which no match exists.
    """
    gates, size = gates or {}, {n: F.size(f"_found_{n}") for n in patterns}
    no_strings = F.array().cast("array<string>")
    found = {
        f"_found_{n}": F.when(
            gates.get(n, F.lit(True)), F.regexp_extract_all(text, F.lit(p), F.lit(0))
        ).otherwise(no_strings)
        for n, p in patterns.items()
    }
    gaps = {
        f"_gaps_{n}": F.when(size[n] > 0, F.split(text, p, -1)).otherwise(no_strings)
        for n, p in patterns.items()
    }
    lengths = {
        f"_lengths_{n}": F.zip_with(f"_gaps_{n}", f"_found_{n}", lambda g, m: (
            F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("bigint"))
        for n in patterns
    }

    def tops(n: str) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((size[n] - 1) / _BLOCK).cast("int")),
            lambda b: _total(F.col(f"_lengths_{n}"), b * _BLOCK + 1, _BLOCK),
        )
        return F.aggregate(
            blocks, F.array(F.lit(0).cast("bigint")),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )

    def spans(n: str) -> Column:
        gap, match = F.col(f"_gaps_{n}"), F.col(f"_found_{n}")

        def one(i: Column) -> Column:
            block, inside = F.floor(i / _BLOCK).cast("int"), i % _BLOCK
            start = (
                F.element_at(f"_tops_{n}", block + 1)
                + _total(F.col(f"_lengths_{n}"), block * _BLOCK + 1, inside)
                + F.length(F.get(gap, i))
            )
            value = F.get(match, i)
            return F.struct(
                start.alias("start"), (start + F.length(value)).alias("stop"), value.alias("value"),
                F.right(F.get(gap, i), F.lit(before)).alias("before"),
                F.left(F.get(gap, i + 1), F.lit(after)).alias("after"),
            )

        return F.when(size[n] > 0, F.transform(F.sequence(F.lit(0), size[n] - 1), one)).otherwise(
            F.array().cast(SPAN)
        )

    out = df.withColumns(found).withColumns(gaps).withColumns(lengths)
    out = out.withColumns({f"_tops_{n}": F.when(size[n] > 0, tops(n)) for n in patterns})
    out = out.withColumns({n: spans(n) for n in patterns})
    return out.drop(*[f"_{k}_{n}" for n in patterns for k in ("found", "gaps", "lengths", "tops")])
