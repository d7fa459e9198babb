"""Spelling variants: words one edit apart, found by PartEnum signatures of letter multisets.

A word is the binary vector of its letters with their occurrence numbers (the second ``e`` is
another dimension than the first), so one replaced letter changes two dimensions and one
inserted letter changes one. Dimensions are dealt to ``PARTS`` parts by a hash. Two vectors
at most two dimensions apart differ in at most two parts, so they agree on all the others:
every choice of parts to leave out gives a signature, and near words share one of them
exactly. Words of equal length leave out two parts, words whose lengths differ by one leave
out one part, and the length is part of the signature.

Signatures are equi-joined and every pair is verified by its edit distance. A signature that
many words share is divided by the letters in order: the edit lies in the left or in the
right half of its words, and the other half agrees. Halves are divided again, down to a
single place, where the words that still agree are all near each other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, shuffled, text_of
from breachline.operators.joins import attach
from breachline.settings import cut

#: Letters of a run, as a character class.
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least this many times as frequent as its variant.
RATIO = 5
PARTS = 7
#: Words that share a signature are compared as they are up to this number.
COMPARED = 200

#: Words with a form are broadcast up to so many stored bytes, in memory some ten times as many.
STEP_BYTES = 4 << 20

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_MASK = (1 << 64) - 1
#: Roles of a row: it meets words of its own length, longer by one, or shorter by one.
SAME, SHORT, LONG = 0, 1, 2


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, typo_every: int | None = 199,
) -> DataFrame:
    """``word, n``: lower-cased (A-Z only) runs of letters of whole texts with their counts.

    With ``typo_every`` the occurrences whose CRC-32 of ``<id>:<run>`` it divides lose the code
    point at that number modulo the length: a repeatable stream of typing errors.
    """
    run = F.explode(F.regexp_extract_all(text_of(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)))
    found = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    word: Column = F.translate("run", _CAPITALS, _SMALL)
    found = found.select("id", word.alias("word"))
    if typo_every:
        draw = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("word")).cast("binary"))
        found = found.select("word", draw.alias("draw"))
        at = F.pmod("draw", F.length("word")).cast("int")
        typo = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        found = found.select(F.when(F.col("draw") % typo_every == 0, typo).otherwise(F.col("word")).alias("word"))
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _mixed(value: int) -> int:
    value = (value ^ value >> 30) * _MIX[1] & _MASK
    value = (value ^ value >> 27) * _MIX[2] & _MASK
    return value ^ value >> 31


def part_sums(word: str, parts: int = PARTS) -> list[int]:
    """Per part one number for the set of its dimensions that the word has."""
    sums = [0] * parts
    for letter, n in Counter(word).items():
        for k in range(n):
            dimension = _mixed((ord(letter) << 32 | k) * _MIX[0] & _MASK)
            sums[dimension % parts] ^= _mixed(dimension)
    return sums


def choices(left_out: int, parts: int = PARTS) -> list[tuple[int, ...]]:
    """The parts that stay, for every way to leave out ``left_out`` of them."""
    return list(combinations(range(parts), parts - left_out))


def signatures(sums: np.ndarray, left_out: int) -> np.ndarray:
    """One row per word and one column per choice of parts; the choice is in the number."""
    out = []
    for number, stay in enumerate(choices(left_out, sums.shape[1])):
        value = np.full(len(sums), (number + 1) * _MIX[0] * (left_out + 1) & _MASK, np.uint64)
        for part in stay:
            value = (value ^ sums[:, part]) * np.uint64(_MIX[1])
            value ^= value >> np.uint64(29)
        out.append(value)
    return np.stack(out, 1)


def _signed_rows(words: DataFrame, parts: int) -> DataFrame:
    """``word, n, key, role, low, high``: every signature a word has, in each of its roles.

    ``low <= place < high`` are the places where the edit of a pair may be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(0).to_pylist()
            sums = np.array([part_sums(t, parts) for t in texts], np.uint64).reshape(-1, parts)
            same = signatures(sums, 2).view(np.int64)
            near = signatures(sums, 1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(list(table), pa.list_(pa.int64())) for table in (same, near)]],
                ["word", "n", "same", "near"],
            )

    signed = words.select("word", "n").mapInArrow(
        run, "word string, n bigint, same array<bigint>, near array<bigint>"
    )

    def rows(column: str, role: int, shorter: Column, places: Column) -> Column:
        return F.transform(column, lambda s: F.struct(
            F.xxhash64(s, shorter).alias("key"), F.lit(role).alias("role"), places.alias("high")
        ))

    size = F.length("word")
    spread = F.concat(
        rows("same", SAME, size, size), rows("near", SHORT, size, size + 1),
        rows("near", LONG, size - 1, size),
    )
    return signed.select("word", "n", F.explode(spread).alias("r")).select(
        "word", "n", "r.key", "r.role", F.lit(0).alias("low"), "r.high"
    )


def _crowds(rows: DataFrame) -> DataFrame:
    """The rows with the number of words under their key, where there are two to compare."""
    sizes = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("role").alias("least"), F.max("role").alias("most")
    )
    # words of equal length share SAME keys; other keys need both a shorter and a longer word
    useful = (F.col("members") > 1) & ((F.col("most") == SAME) | (F.col("least") != F.col("most")))
    return rows.join(shuffled(sizes.where(useful).select("key", "members")), "key")


def _halves(rows: DataFrame) -> DataFrame:
    """Divide the places of the edit in halves, each with the letters that then agree.

    From the second half on, the letters of a longer word lie one place further.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    begin = F.when(F.col("role") == SHORT, middle).otherwise(middle + 1)
    right = F.struct(
        F.xxhash64("key", F.lit(1), F.substring("word", F.col("low") + 1, middle - F.col("low"))).alias("key"),
        middle.alias("low"), F.col("high").alias("high"),
    )
    left = F.struct(
        F.xxhash64("key", F.lit(0), F.substring("word", begin, F.col("high") - middle)).alias("key"),
        F.col("low").alias("low"), middle.alias("high"),
    )
    return rows.select("word", "n", "role", F.explode(F.array(left, right)).alias("h")).select(
        "word", "n", "h.key", "role", "h.low", "h.high"
    )


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs of words under one key that are one edit apart."""
    a = rows.where(F.col("role") != LONG).select("key", "role", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = rows.where(F.col("role") != SHORT).select(
        "key", F.when(F.col("role") == LONG, SHORT).otherwise(SAME).alias("role"),
        F.col("word").alias("b"), F.col("n").alias("b_n"),
    )
    either = (F.col("role") == SHORT) | (F.col("a") < F.col("b"))
    joined = a.join(shuffled(b), ["key", "role"]).where(either & (F.levenshtein("a", "b", 1) == 1))
    return joined.select("a", "a_n", "b", "b_n")


def near_words(words: DataFrame, parts: int = PARTS, compared: int = COMPARED) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once (equal lengths: a < b)."""
    if parts < 3:
        raise ValueError("two of the parts are left out, so there have to be three")
    rows, found = _signed_rows(words, parts), None
    while True:
        rows = cut(_crowds(rows), "signatures")
        crowded = (F.col("members") > compared) & (F.col("high") - F.col("low") > 1)
        pairs = _verified(rows.where(~crowded))
        found = pairs if found is None else found.union(pairs)
        rows = rows.where(crowded)
        if rows.isEmpty():
            return found.distinct()
        rows = _halves(rows)


def variants(words: DataFrame, ratio: int = RATIO, parts: int = PARTS, compared: int = COMPARED) -> DataFrame:
    """One row per word of ``word, n``: ``word, form, root, n, n_near, form_n``.

    ``form`` is the most frequent word one edit away (ties: the smallest in code-point order)
    if it is at least ``ratio`` times as frequent, ``root`` the last word when forms are
    followed. Forms grow in frequency, so that takes few steps. Without a near word
    ``n_near`` is 0; an empty table gives no rows. Words must be distinct.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its variant")
    words = cut(words.select("word", "n"), "words")
    pairs = cut(near_words(words, parts, compared), "near")
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("down"), F.col("other").alias("form"))).alias("best"),
    )
    strong = -F.col("best.down") >= F.col("n") * ratio
    known = cut(words.join(shuffled(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"),
        F.when(strong, -F.col("best.down")).alias("form_n"),
    ), "forms")
    steps = cut(known.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:  # every round doubles the steps taken
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(attach(steps, further, "root", max_bytes=STEP_BYTES, settled=True).select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "steps")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(shuffled(steps), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of ``docs`` with their spelling variants grouped under a root.

    Null texts hold no word; repeated rows and null identifiers count like any other; an
    empty table, or one without frequent words, gives no rows; other columns are not read.
    """
    return variants(word_counts(docs, id_col, text_col))
