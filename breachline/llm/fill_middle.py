"""Fill-in-the-middle examples, cut with a wavelet matrix over character classes.

Every code point belongs to one of eight kinds (letters, digits, blanks, line breaks and so
on); with a bit that says whether it begins a run of its kind, that makes sixteen symbols.
A unit of text (code point, character with its marks, word, line) begins wherever one of a
set of symbols stands, so the units before a place are a sum of ranks over that set, and the
place of a unit is found by bisection on those ranks. The wavelet matrix answers all of
them: four levels of packed bits with a running count per 64 bits, about a tenth of the
bytes that the symbols themselves take.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, portions, text_of

_OTHER, _UPPER, _LETTER, _MARK, _DIGIT, _SIGN, _BLANK, _BREAK = range(8)
#: Kinds by general category, and the code points that end a line, as fixed values.
_CATEGORIES = {
    "C": _OTHER, "L": _LETTER, "M": _MARK, "N": _DIGIT, "P": _SIGN, "S": _SIGN, "Z": _BLANK,
}
_LINE_ENDS = [0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029]
LEVELS = 4

#: The symbols that begin a unit: twice the kind, plus one at the start of a run of the kind.
UNITS = {
    "char": range(16),
    "cluster": [s for s in range(16) if s >> 1 != _MARK],
    "word": [2 * kind + 1 for kind in (_UPPER, _LETTER, _DIGIT)],
    "line": [2 * _BREAK + 1],
}


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@cache
def _kinds() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        table[point] = _UPPER if category in ("Lu", "Lt") else _CATEGORIES[category[0]]
    table[0x09] = _BLANK
    table[_LINE_ENDS] = _BREAK
    return table


def symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol of every code point; no run goes beyond the start of a text.

    Letters after a capital or a mark go on with its run: ``Word`` is one run, ``oneTwo`` two.
    """
    kind = _kinds()[points]
    begins = np.ones(len(points), bool)
    begins[1:] = kind[1:] != kind[:-1]
    letters = kind == _LETTER
    begins[1:] &= ~(letters[1:] & ((kind[:-1] == _UPPER) | (kind[:-1] == _MARK)))
    begins[starts] = True
    return kind * np.uint8(2) + begins


class WaveletMatrix:
    """Rank of any symbol before any place of a sequence of symbols below ``2**levels``."""

    def __init__(self, sequence: np.ndarray, levels: int = LEVELS) -> None:
        self.levels, self.words, self.before, self.zeros = levels, [], [], []
        for level in reversed(range(levels)):
            bits = (sequence >> np.uint8(level)) & np.uint8(1)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(bits) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64, out=counts[1:])
            self.words.append(words)
            self.before.append(counts)
            one = bits.astype(bool)
            self.zeros.append(len(bits) - int(one.sum()))
            sequence = np.concatenate((sequence[~one], sequence[one]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        ends = np.concatenate((at, np.zeros(1, at.dtype)))
        for level in range(self.levels):
            ones = self._ones(level, ends)
            if symbol >> (self.levels - 1 - level) & 1:
                ends = self.zeros[level] + ones
            else:
                ends = ends - ones
        return ends[:-1] - ends[-1]

    def rank_of(self, chosen: list[int], at: np.ndarray) -> np.ndarray:
        return sum(self.rank(s, at) for s in chosen)

    def select(self, chosen: list[int], count: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The place of the symbol of ``chosen`` with ``count`` such symbols before it, known
        to lie in ``low <= place < high``: bisection on ranks, for all queries at once."""
        low, high = low.copy(), high.copy()
        while (open_ := low + 1 < high).any():
            middle = (low + high) >> 1
            left = open_ & (self.rank_of(chosen, middle) > count)
            low = np.where(open_ & ~left, middle, low)
            high = np.where(left, middle, high)
        return low


class Cutter:
    """Units of several texts and the places where they begin."""

    def __init__(self, texts: list[str], unit: str) -> None:
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        marked = symbols(points, self.starts[self.lengths > 0])
        self.matrix, self.chosen = WaveletMatrix(marked), list(UNITS[unit])
        # a text begins with a unit whatever stands there, so only later ones are counted
        self.first = self.starts + (self.lengths > 0)
        self.known = self.matrix.rank_of(self.chosen, self.first)
        inner = self.matrix.rank_of(self.chosen, self.starts + self.lengths) - self.known
        self.units = np.where(self.lengths > 0, inner + 1, 0)

    def places(self, count: np.ndarray) -> np.ndarray:
        """How many code points the first ``count`` units of each text have."""
        inside = (count > 0) & (count < self.units)
        low = np.where(inside, self.first, 0)
        high = np.where(inside, self.starts + self.lengths, 0)
        at = self.matrix.select(self.chosen, self.known + count - 1, low, high) - self.starts
        return np.where(inside, at, np.where(count > 0, self.lengths, 0))


def draws(seed: int, key: object) -> list[int]:
    """Four numbers below 2**32 from the hash of the seed and the identifier of a row."""
    name = "" if key is None else str(key)
    digest = sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def fill_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char",
    seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, markers: Markers = Markers(),
) -> DataFrame:
    """One row per input row: ``<id_col>, n, form, prefix_chars, middle_chars, output``.

    A text of ``n`` units is cut after two drawn numbers of units. ``form`` is ``plain`` (the
    text as it is: empty, holding a marker, or drawn so), ``psm`` (prefix, suffix, middle,
    each behind its marker) or ``spm`` (suffix, prefix, middle). The lengths are in code
    points, null for plain texts. Null texts count as empty; a null identifier draws like an
    empty one; rows with equal identifiers draw the same numbers; an empty table gives no
    rows, and other columns are not read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")

    def one(key: object, text: str, n: int, drawn: list[int], ends: tuple[int, int]) -> tuple:
        if not text or any(m in text for m in markers.all()) or drawn[2] % 100 >= 100 - plain_percent:
            return key, n, "plain", None, None, text
        a, b = ends
        front, middle, back = text[:a], text[a:b], text[b:]
        if drawn[3] % 100 < spm_percent:
            form, order = "spm", (markers.suffix, back, markers.prefix, front)
        else:
            form, order = "psm", (markers.prefix, front, markers.suffix, back)
        return key, n, form, a, b - a, "".join((*order, markers.middle, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            names = keys.to_pylist()
            for part in portions(texts):
                cutter = Cutter([texts[i] for i in part], unit)
                drawn = [draws(seed, names[i]) for i in part]
                wish = np.array([d[:2] for d in drawn], np.int64) % (cutter.units + 1)[:, None]
                wish.sort(axis=1)
                ends = np.stack([cutter.places(wish[:, 0]), cutter.places(wish[:, 1])], 1).tolist()
                rows = [
                    one(None, texts[i], n, d, e)[1:]
                    for i, n, d, e in zip(part, cutter.units.tolist(), drawn, ends)
                ]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(part[0], len(part)), pa.array(columns[0], pa.int64()),
                     pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()),
                     pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.string())],
                    [id_col, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    source = docs.select(F.col(f"`{id_col}`"), text_of(text_col))
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n bigint, form string, prefix_chars bigint, "
        "middle_chars bigint, output string",
    )


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that an output was made of, from the output and its form alone.

    No text in the forms ``psm`` and ``spm`` holds a marker, so each stands there once.
    """
    p, s, m = (F.instr(output, each) for each in markers.all())
    sizes = {c: len(each) for c, each in zip("psm", markers.all())}

    def between(start: Column, stop: Column) -> Column:
        return F.substring(output, start, stop - start)

    middle = F.substring(output, m + sizes["m"], F.length(output))
    psm = F.concat(between(p + sizes["p"], s), middle, between(s + sizes["s"], m))
    spm = F.concat(between(p + sizes["p"], m), middle, between(s + sizes["s"], p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
