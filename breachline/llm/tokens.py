"""Token ids of many texts at once, with the words of a batch encoded only once.

A byte-level BPE tokenizer first cuts a text into words and encodes each word by itself.
Texts repeat their words, so a batch is cut with array operations, every word is named by
two hashes, and only words that the cache does not know yet go through the tokenizer.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache

import numpy as np

#: Words the cache may hold; a full cache starts anew.
CACHE_WORDS = 500_000

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
#: Code points with the White_Space property, as fixed values.
_BLANKS = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
]
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@cache
def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x110000)), np.uint8
    )
    table[_BLANKS] = _SPACE
    return table


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this process; tasks that run in it one after the other share its words."""
    return Encoder(path)


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True  # their strings in a text are ordinary text
    return model


def word_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where the words of byte-level BPE begin: a run of letters, of numbers or of other
    signs, each with one blank before it; contractions; the rest of the white space."""
    n = len(points)
    kind = _classes()[points]
    new_doc = np.zeros(n + 1, bool)
    new_doc[doc_starts] = True
    new_doc[n] = True
    begin = np.ones(n + 1, bool)
    begin[1:n] = kind[1:] != kind[:-1]
    begin |= new_doc
    run = begin.copy()
    after = np.flatnonzero(run[1:n] & ~new_doc[1:n] & (kind[:-1] == _SPACE)) + 1
    begin[after - 1] = True
    begin[after[points[after - 1] == 0x20]] = False
    mark = np.flatnonzero(begin[:n] & (points == 0x27) & (kind == _OTHER))
    mark = mark[mark + 1 < n]
    mark = mark[~new_doc[mark + 1]]
    one = np.isin(points[mark + 1], [ord(c) for c in "sdmt"])
    begin[mark[one] + 1] = False
    begin[mark[one] + 2] = True
    two = mark[~one]
    two = two[two + 2 < n]
    two = two[~new_doc[two + 2]]
    pair = points[two + 1].astype(np.int64) << 32 | points[two + 2]
    two = two[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("ll", "ve", "re")])]
    begin[two + 1] = False
    begin[two + 3] = True
    return np.flatnonzero(begin[:n])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SliceHash:
    """Hash of any slice of a sequence, from running sums of its items times powers."""

    def __init__(self, base: int) -> None:
        self.base, self.power = base, np.empty(0, np.uint64)

    def slices(self, items: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        n = len(items)
        if len(self.power) < n:
            self.power = _powers(self.base, n)
            self.inverse = _powers(pow(self.base, -1, 1 << 64), n)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(items * self.power[:n])))
        return (sums[stops] - sums[starts]) * self.inverse[starts]


class Encoder:
    """Ids of texts by the tokenizer file at ``path``; exact, whatever the cache holds."""

    def __init__(self, path: str) -> None:
        self.model = tokenizer(path)
        self.hashes = [SliceHash(base) for base in _BASES]
        #: Bytes of each id: byte-level BPE writes one character for each byte.
        vocabulary = self.model.get_vocab()
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.id_bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self._clear()

    def _clear(self) -> None:
        self.names = np.empty(0, np.uint64)
        self.proofs = np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        done = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in done]

    def _learn(self, names: np.ndarray, proofs: np.ndarray, words: list[str]) -> None:
        done = self.model.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(done[0].ids, np.uint32)
        # the words end where the bytes of the ids add up to theirs
        word_ends = np.cumsum([len(w.encode()) for w in words])
        ends = np.searchsorted(np.cumsum(self.id_bytes[ids]), word_ends) + 1
        at = np.concatenate(([0], ends[:-1]))
        size = ends - at
        at = at + len(self.pool)
        self.pool = np.concatenate([self.pool, ids])
        names = np.concatenate([self.names, names])
        order = np.argsort(names, kind="stable")
        self.names = names[order]
        self.proofs = np.concatenate([self.proofs, proofs])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _find(self, names: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.names, names)
        at[at == len(self.names)] = 0
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        if not joined:
            return [np.empty(0, np.uint32) for _ in texts]
        if len(self.names) > CACHE_WORDS:
            self._clear()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        n = len(points)
        ends = np.cumsum(lengths)
        doc_starts = (ends - lengths)[lengths > 0]
        starts = word_starts(points, doc_starts)
        stops = np.append(starts[1:], n)
        mixed = (points + np.uint64(1)) * np.uint64(_BASES[1])
        mixed ^= mixed >> np.uint64(29)
        name, proof = (h.slices(mixed, starts, stops) for h in self.hashes)
        name ^= (stops - starts).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        unique, first, word = np.unique(name, return_index=True, return_inverse=True)
        if len(self.names):
            known = self.names[self._find(unique)] == unique
        else:
            known = np.zeros(len(unique), bool)
        new = first[~known]
        if len(new):
            words = [joined[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())]
            self._learn(unique[~known], proof[new], words)
        at = self._find(unique)[word]
        if not np.array_equal(self.proofs[at], proof):  # two words with one name
            return self._plain(texts)
        size = self.size[at]
        done = np.cumsum(size)
        ids = self.pool[np.repeat(self.at[at] - done + size, size) + np.arange(done[-1])]
        marks = np.concatenate(([0], done))[np.searchsorted(starts, ends)]
        return np.split(ids, marks[:-1])
