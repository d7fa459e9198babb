"""SentencePiece ids of merge-type vocabularies from a score-ordered agenda of symbol pairs.

A text begins as single characters. The agenda holds every adjacent pair that is a piece of
the vocabulary; the pair with the best score, leftmost among equals, becomes one symbol and
its two new neighbours enter the agenda, until none is left. What is no piece goes out as
bytes or as the unknown id. A long stretch has its own heap; short ones go in step, and
every round takes the head of each of their agendas with array operations.

A merge never crosses a place whose two characters stand side by side in no piece. Texts are
cut at such places, by the vocabulary and not by a rule for words, and a stretch that a
worker has met before takes its ids from a bounded cache. Every text is encoded and decoded
by the sentencepiece library as well, batch by batch; a row says whether both agree.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, portions, text_of
from breachline.llm.tokens import SliceHash

#: Stretches the cache may hold; a full cache starts anew.
CACHE_STRETCHES = 500_000

#: Characters of a stretch that goes in step with others; a longer one has a heap.
IN_STEP = 48

SPACE = "▁"
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LENGTH_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LIMIT = 1 << 40


class Vocabulary:
    """The pieces of a model file, and what the agenda needs to know of them."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind = type(model.pieces[0]) if model.pieces else None
        if kind is None or model.trainer_spec.model_type != 2:
            raise ValueError("only merge-type (BPE) vocabularies have an agenda of pairs")
        self.prefix_space = model.normalizer_spec.add_dummy_prefix
        self.identity = model.normalizer_spec.name == "identity" and not (
            model.normalizer_spec.remove_extra_whitespaces
        ) and not model.trainer_spec.treat_whitespace_as_suffix
        self.begin, self.end, self.unknown = (
            self.library.bos_id(), self.library.eos_id(), self.library.unk_id()
        )
        self.ids, self.scores, self.unused, self.fixed = {}, {}, set(), []
        self.bytes_ids = [self.unknown] * 256
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.raw: list[bytes] = []
        for i, piece in enumerate(model.pieces):
            text = piece.piece
            self.raw.append(b"")
            if piece.type == kind.BYTE:
                value = int(text[3:5], 16)
                self.bytes_ids[value] = i
                self.raw[i] = bytes([value])
            elif piece.type in (kind.NORMAL, kind.UNUSED, kind.USER_DEFINED):
                self.ids[text], self.scores[text] = i, piece.score
                self.raw[i] = text.replace(SPACE, " ").encode()
                if piece.type == kind.UNUSED:
                    self.unused.add(text)
                if piece.type == kind.USER_DEFINED:
                    self.fixed.append(text)
            elif piece.type == kind.UNKNOWN:
                self.raw[i] = model.trainer_spec.unk_surface.encode()
        order = sorted({s for s in self.scores.values()}, reverse=True)
        place = {s: k for k, s in enumerate(order)}
        #: Smaller is better; pieces of one score share a rank.
        self.ranks = {text: place[s] for text, s in self.scores.items()}
        fixed = sorted(self.fixed, key=len, reverse=True)
        self.fixed_pattern = re.compile("|".join(map(re.escape, fixed))) if fixed else None
        letters = sorted({c for text in self.ids if len(text) > 1 for c in text})
        self._joints(letters)
        self._pairs(letters)

    def _pairs(self, letters: list[str]) -> None:
        """Every two symbols that make a piece, as sorted numbers with rank and piece."""
        size = len(self.raw)
        self.loose = [c for c in letters if c not in self.ids]
        symbols = self.ids | {c: size + i for i, c in enumerate(self.loose)}
        self.base = size + len(self.loose)
        self.symbol = -1 - np.arange(0x110000)  # a character of no piece stands for itself
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        found = [
            (symbols[text[:k]] * self.base + symbols[text[k:]], self.ranks[text], i)
            for text, i in self.ids.items() for k in range(1, len(text))
            if text[:k] in symbols and text[k:] in symbols
        ]
        table = np.array(sorted(found) or [(-1, 0, 0)], np.int64)
        self.pair_key, self.pair_rank, self.pair_piece = (np.ascontiguousarray(c) for c in table.T)

    def _joints(self, letters: list[str]) -> None:
        """Which two characters may be side by side in a piece."""
        self.letter = np.zeros(0x110000, np.int32)
        for i, c in enumerate(letters):
            self.letter[ord(c)] = i + 1
        self.joint = np.zeros((len(letters) + 1,) * 2, bool)
        for text in self.ids:
            at = self.letter[[ord(c) for c in text]]
            self.joint[at[:-1], at[1:]] = True

    def normal(self, text: str) -> str:
        if not self.identity:
            return self.library.normalize(text)
        return (SPACE if text and self.prefix_space else "") + text.replace(" ", SPACE)

    def _merged(self, text: str) -> list[str]:
        """The symbols of a stretch once its agenda is empty."""
        if self.fixed_pattern is None:
            symbols, frozen = list(text), None
        else:
            symbols, frozen, at = [], set(), 0
            for found in self.fixed_pattern.finditer(text):
                symbols.extend(text[at : found.start()])
                frozen.add(len(symbols))
                symbols.append(found.group())
                at = found.end()
            symbols.extend(text[at:])
        n, ranks = len(symbols), self.ranks
        after, back = list(range(1, n + 1)), list(range(-1, n - 1))
        made: dict[str, tuple[str, str]] = {}

        def rank(left: int) -> int | None:
            right = after[left]
            if right >= n or (frozen and (left in frozen or right in frozen)):
                return None
            pair = symbols[left] + symbols[right]
            found = ranks.get(pair)
            if found is not None and pair in self.unused:
                made[pair] = (symbols[left], symbols[right])
            return found

        agenda = [r * _LIMIT + i for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry % _LIMIT
            # an entry whose symbols have changed since is void
            if not symbols[left] or rank(left) != entry // _LIMIT:
                continue
            right = after[left]
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] < n:
                back[after[left]] = left
            for at in (left, back[left]):
                if at >= 0 and (r := rank(at)) is not None:
                    heapq.heappush(agenda, r * _LIMIT + at)
        out = [s for s in symbols if s]
        return [p for s in out for p in self._parts(s, made)] if made else out

    def _parts(self, symbol: str, made: dict[str, tuple[str, str]]) -> Iterator[str]:
        """A piece out of use falls back into the two symbols it was made of."""
        waiting = [symbol]
        while waiting:
            symbol = waiting.pop()
            if symbol in made and symbol in self.unused:
                waiting.extend(reversed(made[symbol]))
            else:
                yield symbol

    def _outside(self, symbol: str) -> list[int]:
        """Ids of a symbol that is no piece."""
        if not self.byte_fallback:
            return [self.unknown]
        return [self.bytes_ids[b] for b in symbol.encode()]

    def stretch(self, text: str) -> list[int]:
        """Ids of a normalised stretch."""
        out: list[int] = []
        for symbol in self._merged(text):
            known = self.ids.get(symbol)
            out.extend(self._outside(symbol) if known is None else [known])
        return out

    def stretches(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of many normalised stretches."""
        out: list = [None] * len(texts)
        short = [] if self.unused or self.fixed else [i for i, t in enumerate(texts) if len(t) <= IN_STEP]
        for i, ids in zip(short, self._in_step([texts[i] for i in short])):
            out[i] = ids
        return [np.array(self.stretch(t), np.uint32) if o is None else o for t, o in zip(texts, out)]

    def _in_step(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.repeat(np.arange(len(texts)), lengths)
        symbol = self.symbol[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        done, none = [], np.iinfo(np.int64).max
        while len(symbol):
            key = symbol[:-1] * self.base + symbol[1:]
            at = np.searchsorted(self.pair_key, key)
            at[at == len(self.pair_key)] = 0
            hit = (self.pair_key[at] == key) & (owner[1:] == owner[:-1]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
            order = np.full(len(symbol), none)
            places = np.flatnonzero(hit)
            order[places] = self.pair_rank[at[places]] * (1 << 32) + places
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            head = np.minimum.reduceat(order, begins)
            over = np.repeat(head == none, np.diff(np.append(begins, len(symbol))))
            done.append((owner[over], symbol[over]))
            left = head[head != none] & ((1 << 32) - 1)
            symbol[left] = self.pair_piece[at[left]]
            stay = ~over
            stay[left + 1] = False
            symbol, owner = symbol[stay], owner[stay]
        owner, symbol = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(owner, kind="stable")
        return self._named(owner[order], symbol[order], len(texts))

    def _named(self, owner: np.ndarray, symbol: np.ndarray, n: int) -> list[np.ndarray]:
        """Ids of merged symbols: a piece is its own id, anything else goes out as it has to."""
        strange = np.unique(symbol[(symbol < 0) | (symbol >= len(self.raw))])
        texts = [chr(-1 - s) if s < 0 else self.loose[s - len(self.raw)] for s in strange.tolist()]
        pool = [self._outside(t) for t in texts]
        flat = np.array([i for ids in pool for i in ids], np.int64)
        sizes = np.fromiter(map(len, pool), np.int64, len(pool))
        starts = np.cumsum(sizes) - sizes
        odd = np.flatnonzero((symbol < 0) | (symbol >= len(self.raw)))
        which = np.searchsorted(strange, symbol[odd])
        size = np.ones(len(symbol), np.int64)
        size[odd] = sizes[which]
        ends = np.cumsum(size)
        ids = np.repeat(symbol, size)
        if len(odd):
            spread = np.repeat(np.arange(len(odd)), size[odd])
            inside = np.arange(len(spread)) - np.repeat(np.cumsum(size[odd]) - size[odd], size[odd])
            ids[(ends - size)[odd][spread] + inside] = flat[starts[which][spread] + inside]
        marks = np.concatenate(([0], ends))[np.searchsorted(owner, np.arange(1, n))]
        return np.split(ids.astype(np.uint32), marks)


class PieceCoder:
    """Ids of texts and texts of ids; exact, whatever the cache holds."""

    def __init__(self, path: str) -> None:
        self.model = Vocabulary(path)
        self.hashes = [SliceHash(base) for base in _BASES]
        self.cache: dict[int, tuple[int, np.ndarray]] = {}
        sizes = np.fromiter(map(len, self.model.raw), np.int64, len(self.model.raw))
        self.raw_size, self.raw_at = sizes, np.cumsum(sizes) - sizes
        self.raw_pool = np.frombuffer(b"".join(self.model.raw), np.uint8)

    def _stretch_starts(self, points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
        letters = self.model.letter[points]
        begin = np.ones(len(points), bool)
        begin[1:] = ~self.model.joint[letters[:-1], letters[1:]]
        begin[doc_starts] = True
        return np.flatnonzero(begin)

    def _learn(self, joined: str, names: list, proofs: list, starts: list, stops: list) -> None:
        new = [
            i for i, (name, proof) in enumerate(zip(names, proofs))
            if (held := self.cache.get(name)) is None or held[0] != proof
        ]
        done = self.model.stretches([joined[starts[i] : stops[i]] for i in new])
        for i, ids in zip(new, done):
            self.cache[names[i]] = (proofs[i], ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text between the begin and the end id."""
        model = self.model
        normal = [model.normal(t) for t in texts]
        edge = [np.array([i] if i >= 0 else [], np.uint32) for i in (model.begin, model.end)]
        joined = "".join(normal)
        if model.fixed_pattern is not None:  # fixed symbols ignore where stretches end
            bodies = [np.array(model.stretch(t), np.uint32) for t in normal]
        elif joined:
            bodies = self._cached(normal, joined)
        else:
            bodies = [np.empty(0, np.uint32) for _ in normal]
        if not model.byte_fallback:
            bodies = [self._one_unknown(b) for b in bodies]
        return [np.concatenate((edge[0], body, edge[1])) for body in bodies]

    def _one_unknown(self, ids: np.ndarray) -> np.ndarray:
        """Without bytes a run of unknown symbols is one unknown id."""
        unknown = ids == self.model.unknown
        return ids[~(unknown & np.concatenate((np.zeros(1, bool), unknown))[: len(ids)])]

    def _cached(self, normal: list[str], joined: str) -> list[np.ndarray]:
        if len(self.cache) > CACHE_STRETCHES:
            self.cache = {}
        lengths = np.fromiter(map(len, normal), np.int64, len(normal))
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        starts = self._stretch_starts(points, (ends - lengths)[lengths > 0])
        stops = np.append(starts[1:], len(points))
        mixed = (points + np.uint64(1)) * np.uint64(_BASES[1])
        mixed ^= mixed >> np.uint64(29)
        name, proof = (h.slices(mixed, starts, stops) for h in self.hashes)
        name ^= (stops - starts).astype(np.uint64) * _LENGTH_MIX
        unique, first, which = np.unique(name, return_index=True, return_inverse=True)
        if not np.array_equal(proof[first][which], proof):  # two stretches with one name
            return [np.array(self.model.stretch(t), np.uint32) for t in normal]
        names = unique.tolist()
        self._learn(joined, names, proof[first].tolist(), starts[first].tolist(), stops[first].tolist())
        known = [self.cache[name][1] for name in names]
        size = np.fromiter(map(len, known), np.int64, len(known))
        pool, at = np.concatenate(known), np.cumsum(size) - size
        size, at = size[which], at[which]
        done = np.cumsum(size)
        ids = pool[np.repeat(at - done + size, size) + np.arange(done[-1])]
        marks = np.concatenate(([0], done))[np.searchsorted(starts, ends)]
        return np.split(ids, marks[:-1])

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids: bytes of the pieces without the blank put in front."""
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids).astype(np.int64) if ids else np.empty(0, np.int64)
        size = self.raw_size[flat]
        done = np.cumsum(size)
        total = int(done[-1]) if len(done) else 0
        data = self.raw_pool[np.repeat(self.raw_at[flat] - done + size, size) + np.arange(total)]
        ends = np.concatenate(([0], done))[np.cumsum(lengths)]
        begin, whole, out = 0, data.tobytes(), []
        for end in ends.tolist():
            part = whole[begin:end]
            if self.model.prefix_space and part[:1] == b" ":
                part = part[1:]
            out.append(_text(part))
            begin = end
        return out


def _text(data: bytes) -> str:
    """UTF-8 with one replacement character for every byte that belongs to no character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "�", data.decode("utf-8", "surrogateescape"))


@cache
def coder(path: str) -> PieceCoder:
    """The coder of this process; tasks that run in it one after the other share its cache."""
    return PieceCoder(path)


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``<id_col>, n_tokens, ids, decoded, agrees``.

    ``ids`` are little-endian unsigned 32-bit numbers with the begin and end ids, ``decoded``
    is the text they give back, and ``agrees`` says that the library encodes and decodes the
    row the same; where it does not, the row holds what the library says. Null texts are
    empty: begin and end ids only. Repeated rows are encoded one by one, an empty table gives
    no rows, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_path)
        library = own.model.library
        for batch in pieces(batches):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for part in portions(texts):
                some = [texts[i] for i in part]
                ids = own.encode(some)
                decoded = own.decode(ids)
                given = library.encode(some, add_bos=True, add_eos=True, num_threads=1, out_type="numpy")
                back = library.decode(given, num_threads=1)
                agrees = [
                    len(a) == len(b) and bool((a == b).all()) and c == d
                    for a, b, c, d in zip(ids, given, decoded, back)
                ]
                for i, same in enumerate(agrees):
                    if not same:
                        ids[i], decoded[i] = given[i].astype(np.uint32), back[i]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(part[0], len(part)),
                     pa.array([len(a) for a in ids], pa.int64()),
                     pa.array([a.astype("<u4").tobytes() for a in ids], pa.binary()),
                     pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                    [id_col, "n_tokens", "ids", "decoded", "agrees"],
                )

    source = docs.select(F.col(f"`{id_col}`"), text_of(text_col))
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids binary, decoded string, agrees boolean"
    )
