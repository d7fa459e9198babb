"""Vector bin packing of examples into training sequences.

An example weighs tokens, one segment and loss-bearing tokens; a sequence has a limit on
each. The next example of a sequence is the one whose weights point most in the direction
of what the sequence has left (largest dot product of both, each as a share of its limit).
Where none fits as a whole, the best one is cut. A sequence that stays short of the token
limit is split at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, portions, text_of
from breachline.llm.tokens import encoder

END = 0
_WAITING = 1024
_CHUNK = 1 << 18
#: Sequence numbers of a partition start at its number times this.
_PER_PARTITION = 1 << 40


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], float)


@dataclass
class Example:
    """Ids not placed yet, from ``start``; the last ``bearing`` of all ``ids`` bear loss."""

    key: object
    ids: np.ndarray
    start: int
    bearing: int

    def left(self) -> int:
        return len(self.ids) - self.start

    def loss(self, length: int) -> int:
        first = len(self.ids) - self.bearing
        return max(0, self.start + length - max(first, self.start))

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest next piece within both limits."""
        quiet = max(0, len(self.ids) - self.bearing - self.start)
        return min(self.left(), tokens, quiet + loss)


class Packer:
    """Packs a stream of examples; at most ``_WAITING`` unfinished ones wait at a time."""

    def __init__(self, limits: Limits, first_sequence: int) -> None:
        self.limits, self.sequence = limits, first_sequence
        self.waiting: list[Example] = []
        self.rows: list[tuple] = []

    def add(self, key: object, ids: np.ndarray, bearing: int) -> None:
        example, whole = Example(key, ids, 0, bearing), self.limits.tokens
        while example.left() >= whole and example.fitting(whole, self.limits.loss) == whole:
            self._write([(example, example.start, whole)])
            example.start += whole
        if example.left():
            self.waiting.append(example)
        if len(self.waiting) >= _WAITING:
            self.pack(_WAITING // 2)

    def pack(self, keep: int = 0) -> None:
        """Fill sequences until at most ``keep`` examples wait."""
        limit = self.limits.vector()
        weight = np.array([self._weight(e) for e in self.waiting]).reshape(-1, 3)
        alive = np.ones(len(self.waiting), bool)
        while alive.sum() > keep:
            room, bin_ = limit.copy(), []
            while room[0] >= 1 and room[1] >= 1 and alive.any():
                match = (weight / limit) @ (room / limit)
                fits = alive & (weight <= room).all(1)
                at = int(np.where(fits if fits.any() else alive, match, -1).argmax())
                example = self.waiting[at]
                length = example.fitting(int(room[0]), int(room[2]))
                if not length:
                    break
                bin_.append((example, example.start, length))
                room -= (length, 1, example.loss(length))
                example.start += length
                alive[at] = example.left() > 0
                weight[at] = self._weight(example)
            self._close(bin_)
        self.waiting = [e for e, a in zip(self.waiting, alive) if a]

    @staticmethod
    def _weight(example: Example) -> tuple[int, int, int]:
        return example.left(), 1, example.loss(example.left())

    def _close(self, pieces: list[tuple[Example, int, int]]) -> None:
        total = sum(length for _, _, length in pieces)
        if total == self.limits.tokens:
            return self._write(pieces)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                example, start, length = pieces.pop(0)
                taken = min(size, length)
                part.append((example, start, taken))
                if taken < length:
                    pieces.insert(0, (example, start + taken, length - taken))
                size -= taken
            self._write(part)

    def _write(self, pieces: list[tuple[Example, int, int]]) -> None:
        offset = 0
        for example, start, length in pieces:
            piece = example.ids[start : start + length]
            self.rows.append((
                example.key, start, length, crc32(piece.tobytes()), len(example.ids),
                self.sequence, offset,
            ))
            offset += length
        self.sequence += 1


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    prompt_col: str | None = None, limits: Limits = Limits(),
) -> DataFrame:
    """One row per piece: ``<id_col>, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    An example is the ids of its prompt (if a prompt column is given), the ids of its text
    and id 0. All ids but the prompt's bear loss. Null texts are empty, so they are the
    single id 0; repeated rows are packed one by one; an empty table gives no rows. Every
    partition packs by itself, so nothing is shuffled; other columns are not read.
    """
    prompts = text_of(prompt_col) if prompt_col else F.lit("")
    source = docs.select(
        F.col(f"`{id_col}`"), text_of(text_col).alias("text"), prompts.alias("prompt")
    )
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        packer = Packer(limits, TaskContext.get().partitionId() * _PER_PARTITION)
        kind = pa.null()

        def take() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [()] * 7
            packer.rows = []
            arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, [
                id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
            ])

        end = np.array([END], np.uint32)
        for batch in pieces(batches):
            kind = batch.column(0).type
            keys, texts, asked = (batch.column(i).to_pylist() for i in range(3))
            for part in portions(texts, _CHUNK):
                bodies = words.encode([texts[i] for i in part])
                fronts = words.encode([asked[i] for i in part])
                for i, front, body in zip(part, fronts, bodies):
                    packer.add(keys[i], np.concatenate((front, body, end)), len(body) + 1)
            yield take()
        packer.pack()
        if packer.rows:
            yield take()

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
