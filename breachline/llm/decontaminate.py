"""Benchmark decontamination by BM25 search with block-max WAND, then an overlap check.

The test items are the indexed side. They are cut into parts of up to 64 words, and the
terms of the inverted index are word triples; an impact is a BM25 weight divided by the
part's score against itself, so one threshold serves all parts. Every training document is
cut into overlapping passages of 128 words, and every passage is a query that retrieves
all parts above the threshold. A retrieved item counts when its question and its answer
both occur in the passages that found it. An item of fewer words than the overlap check asks
for counts where all its words stand in a row.

The index is shipped in blocks of bounded size; a larger benchmark takes more passes.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, portions
from breachline.llm.tokens import SliceHash
from breachline.settings import cut

PART_WORDS = 64
PASSAGE_WORDS = 128
TERM_WORDS = 3
PROOF_WORDS = 5
#: Share of a part's own score that a passage must reach to retrieve it.
LEAST_SCORE = 0.3
#: Share of the question's and of the answer's words that must lie in shared five-word runs.
LEAST_OVERLAP = 0.8
#: Parts shipped to the tasks at once: about 3 kB each.
BLOCK_PARTS = 20_000

_K1, _B = 1.2, 0.75
_POSTINGS = 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_WEIGHTS = np.array([0x9E3779B97F4A7C15 ** (i + 1) % (1 << 64) for i in range(8)], np.uint64)
_SENTENCE_END = re.compile(r"[.?!\n]+")
_HASH = SliceHash(0xD1342543DE82EF95)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word: runs of a-z, digits and non-ASCII bytes."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(_WORD[raw].astype(np.int8), prepend=0, append=0))
    starts, stops = edges[::2], edges[1::2]
    mixed = (raw + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = _HASH.slices(mixed ^ mixed >> np.uint64(29), starts, stops)
    return hashes ^ hashes >> np.uint64(31), starts


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out += words[i : i + count] * _WEIGHTS[i]
    return out ^ out >> np.uint64(33)


def question_words(text: str) -> int:
    """How many words of a lower-cased item belong to its question; the rest is the answer.

    The question ends at the last question mark that words follow, else before the last
    sentence, else after two thirds of the words.
    """
    total = len(word_hashes(text.encode())[0])
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    asked = [e for e in ends if "?" in text[:e][-3:]]
    for choice in (asked, ends):
        for end in reversed(choice):
            before = len(word_hashes(text[:end].encode())[0])
            if 0 < before < total:
                return before
    return math.ceil(total * 2 / 3)


def _parts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per indexed part, with the word hashes of the whole item for the check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = (text or "").lower()
                words = word_hashes(text.encode())[0]
                if 0 < len(words) < PROOF_WORDS:
                    rows.append((key, row, 0, [], words.view(np.int64), len(words)))
                    continue
                for part, at in enumerate(range(0, len(words), PART_WORDS)):
                    terms = runs(words[at : at + PART_WORDS], TERM_WORDS).view(np.int64)
                    if len(terms):
                        rows.append((key, row, part, terms, words.view(np.int64), question_words(text)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["item", "row", "part", "terms", "words", "asked"],
            )

    source = items.select(
        F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"), F.monotonically_increasing_id()
    )
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run, f"item {kind}, row bigint, part bigint, terms array<bigint>, words array<bigint>, asked bigint"
    ).withColumn("uid", F.monotonically_increasing_id())


def impacts(parts: DataFrame) -> DataFrame:
    """``(uid, term, impact)``: BM25 weight of a term in a part over the part's own score."""
    parts = parts.where(F.size("terms") > 0)
    sizes = parts.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("terms")).alias("mean")).first()
    tf = parts.select("uid", F.size("terms").alias("length"), F.explode("terms").alias("term"))
    tf = tf.groupBy("uid", "term", "length").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(float(sizes["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = _K1 * (1 - _B + _B * F.col("length") / F.lit(float(sizes["mean"] or 1)))
    weighed = tf.join(df, "term").withColumn("w", idf * F.col("tf") * (_K1 + 1) / (F.col("tf") + norm))
    own = weighed.groupBy("uid").agg(F.sum("w").alias("own"))
    return weighed.join(own, "uid").select("uid", "term", (F.col("w") / F.col("own")).alias("impact"))


class Index:
    """Postings by term with block maxima, and what the overlap check needs, in arrays."""

    def __init__(self, parts: list, postings: list) -> None:
        number = {row["uid"]: i for i, row in enumerate(parts)}
        self.items = [row["item"] for row in parts]
        self.rows = [row["row"] for row in parts]
        self.question, self.answer = [], []
        short: dict[int, list] = defaultdict(list)
        for i, row in enumerate(parts):
            words = np.array(row["words"], np.int64).view(np.uint64)
            if 0 < len(words) < PROOF_WORDS:
                short[len(words)].append((int(runs(words, len(words))[0]), i))
            self.question.append(words[: row["asked"]])
            self.answer.append(words[row["asked"] :])
        #: By number of words: sorted hashes of whole short items, and their parts.
        self.short = {
            n: (np.array([h for h, _ in sorted(found)], np.uint64), [i for _, i in sorted(found)])
            for n, found in short.items()
        }
        lists = defaultdict(list)
        for row in postings:
            lists[row["term"]].append((number[row["uid"]], row["impact"]))
        terms = np.array(sorted(lists), np.int64)
        self.terms = np.sort(terms.view(np.uint64))
        self.lists = []
        for term in self.terms.view(np.int64).tolist():
            postings_of = sorted(lists[term])
            ids = np.array([p for p, _ in postings_of])
            weights = np.array([w for _, w in postings_of])
            tops = np.maximum.reduceat(weights, np.arange(0, len(ids), _POSTINGS))
            self.lists.append((ids, weights, tops, weights.max()))
        self.most = np.array([entry[3] for entry in self.lists])

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in the index, -1 where it is not there."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1)

    def retrieve(self, query: np.ndarray, least: float) -> list[tuple[int, float]]:
        """All parts whose impacts over the query's terms sum to ``least``, by block-max WAND."""
        cursors = [[0, *self.lists[t]] for t in query.tolist()]
        found = []
        while cursors:
            cursors = [c for c in cursors if c[0] < len(c[1])]
            cursors.sort(key=lambda c: c[1][c[0]])
            bound, pivot = 0.0, None
            for i, c in enumerate(cursors):
                bound += c[4]
                if bound >= least - 1e-9:
                    pivot = i
                    break
            if pivot is None:
                break
            target = cursors[pivot][1][cursors[pivot][0]]
            ahead = [c for c in cursors if c[1][c[0]] <= target]
            blocks = [int(np.searchsorted(c[1], target)) // _POSTINGS for c in ahead]
            bound = sum(c[3][b] if b < len(c[3]) else 0.0 for c, b in zip(ahead, blocks))
            if bound < least - 1e-9:
                # no part up to the first block end can reach the threshold
                ends = [
                    c[1][min(len(c[1]), (b + 1) * _POSTINGS) - 1] + 1 for c, b in zip(ahead, blocks)
                ]
                later = [c[1][c[0]] for c in cursors if c[1][c[0]] > target]
                jump = max(target + 1, min([*ends, *later]))
                for c in ahead:
                    c[0] = int(np.searchsorted(c[1], jump))
                continue
            score = 0.0
            for c in ahead:
                c[0] = int(np.searchsorted(c[1], target))
                if c[0] < len(c[1]) and c[1][c[0]] == target:
                    score += c[2][c[0]]
                    c[0] += 1
            if score >= least - 1e-9:
                found.append((int(target), score))
        return found


def overlap(part: np.ndarray, passage: set[int], n: int = PROOF_WORDS) -> float:
    """Share of the words that lie in runs of ``n`` words (or fewer, if there are fewer)
    which the passage has as well."""
    n = min(n, len(part))
    if not n:
        return 1.0
    covered = np.zeros(len(part), bool)
    for i, run in enumerate(runs(part, n).tolist()):
        if run in passage:
            covered[i : i + n] = True
    return float(covered.mean())


def _check(index: Index, number: int, words: np.ndarray) -> tuple[float, float]:
    question, answer = index.question[number], index.answer[number]
    sizes = {min(PROOF_WORDS, len(question)), min(PROOF_WORDS, len(answer))} - {0}
    seen = {n: set(runs(words, n).tolist()) for n in sizes}
    return tuple(
        overlap(p, seen.get(min(PROOF_WORDS, len(p)), set())) for p in (question, answer)
    )


def _short_items(index: Index, words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(text, part)`` for every short item whose words stand in a row in a text."""
    for n, (hashes, parts) in index.short.items():
        found = runs(words, n)
        at = np.searchsorted(hashes, found)
        hits = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == found)
        owner = np.searchsorted(ends, hits, side="right")
        for text, run in {(t, r) for t, h, r in zip(
            owner.tolist(), hits.tolist(), found[hits].tolist()) if h + n <= ends[t]}:
            first = int(np.searchsorted(hashes, np.uint64(run)))
            while first < len(parts) and int(hashes[first]) == run:
                yield text, parts[first]
                first += 1


def search(index: Index, texts: list[str], least_score: float, least_overlap: float):
    """``(text, part, score, question, answer)`` for every item verified in a text: its best
    row where several rows have one identifier, every row where they have none."""
    best: dict[tuple, tuple] = {}
    for text, part, *values in _verified(index, texts, least_score, least_overlap):
        item = index.items[part]
        name = (text, None, index.rows[part]) if item is None else (text, item)
        if name not in best or tuple(values) > best[name][2:]:
            best[name] = (text, part, *values)
    return sorted(best.values())


def _verified(index: Index, texts: list[str], least_score: float, least_overlap: float):
    data = [t.lower().encode() for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data)) + 1
    words, starts = word_hashes(b"\n".join(data) + b"\n")
    ends = np.searchsorted(starts, np.cumsum(sizes))
    for text, part in _short_items(index, words, ends):
        yield text, part, 1.0, 1.0, 1.0
    begins = np.concatenate(([0], ends[:-1]))
    terms = index.find(runs(words, TERM_WORDS))
    hits = np.flatnonzero(terms >= 0)
    owner = np.searchsorted(ends, hits, side="right")
    inside = hits + TERM_WORDS <= ends[owner]
    hits, owner = hits[inside], owner[inside]
    step = PASSAGE_WORDS // 2
    for text in np.unique(owner).tolist():
        mine, begin, end = hits[owner == text], int(begins[text]), int(ends[text])
        last = max(0, -(-(end - begin - PASSAGE_WORDS) // step))
        places = np.unique(np.concatenate([(mine - begin) // step, (mine - begin) // step - 1]))
        best: dict[int, list] = {}
        for place in places[(places >= 0) & (places <= last)].tolist():
            low = begin + place * step
            high = min(end, low + PASSAGE_WORDS)
            query = np.unique(terms[mine[(mine >= low) & (mine + TERM_WORDS <= high)]])
            if index.most[query].sum() < least_score:
                continue
            for part, score in index.retrieve(query, least_score):
                at = best.setdefault(part, [score, low, high])
                at[:] = max(at[0], score), min(at[1], low), max(at[2], high)
        asked: dict[int, list] = {}
        for part, (score, low, high) in best.items():
            at = asked.setdefault(index.rows[part], [part, score, low, high])
            at[1:] = max(at[1], score), min(at[2], low), max(at[3], high)
        for part, score, low, high in asked.values():
            # an item is longer than a part: leave room for its other parts
            room = len(index.question[part]) + len(index.answer[part])
            near = words[max(begin, low - room) : min(end, high + room)]
            question, answer = _check(index, part, near)
            if min(question, answer) >= least_overlap:
                yield text, part, score, question, answer


def _index_blocks(items: DataFrame, id_col: str, text_col: str, block: int) -> Iterator[Index]:
    parts = cut(_parts(items, id_col, text_col), "parts")
    count = parts.count()
    blocks = -(-count // block)
    postings = cut(impacts(parts), "postings") if count else None
    name = F.when(F.col("item").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("item"))
    place = F.pmod(name, F.lit(blocks)) if blocks > 1 else F.lit(0)
    placed = parts.withColumn("place", place)
    for i in range(blocks):
        some = placed.where(F.col("place") == i)
        yield Index(some.collect(), postings.join(some.select("uid"), "uid", "left_semi").collect())


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP, block: int = BLOCK_PARTS,
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every verified leak.

    Null texts hold nothing and leak nothing; items without a word name nothing. Items of
    fewer than five words leak where they stand word by word. Repeated documents are reported
    row by row, items once for each of their distinct identifiers (the best match of its
    texts), and one by one where they have none. An empty table on either side gives no rows;
    other columns are not read.
    """
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    keys = (source.schema[0].dataType.simpleString(), items.schema[item_col].dataType.simpleString())
    shape = (
        f"doc_id {keys[0]}, item_id {keys[1]}, score double, question_overlap double, "
        "answer_overlap double"
    )
    out = docs.sparkSession.createDataFrame([], shape)
    for index in _index_blocks(items, item_col, item_text_col, block):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                texts, rows = batch.column(1).to_pylist(), []
                for part in portions(texts):
                    some = [texts[i] or "" for i in part]
                    for text, *rest in search(index, some, least_score, least_overlap):
                        rows.append((part[text], *rest))
                at, found, *values = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())),
                     pa.array([index.items[f] for f in found]).cast(item_kind),
                     *[pa.array(v, pa.float64()) for v in values]],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

        item_kind = _arrow_kind(items, item_col)
        out = out.unionByName(source.mapInArrow(run, shape))
    return out


def _arrow_kind(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def drop_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP, block: int = BLOCK_PARTS,
) -> DataFrame:
    """The rows of ``docs`` in which no item was verified, without a shuffle."""
    at = docs.columns.index(text_col)
    for index in _index_blocks(items, item_col, item_text_col, block):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                texts = batch.column(at).to_pylist()
                keep = np.ones(len(texts), bool)
                for part in portions(texts):
                    some = [texts[i] or "" for i in part]
                    keep[[part[f[0]] for f in search(index, some, least_score, least_overlap)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
