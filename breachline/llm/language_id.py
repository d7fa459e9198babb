"""Language identification by a mixture of learned n-gram languages.

A document is cut into short segments. Expectation-maximisation estimates which share of
the segments each language explains, from the segments' n-gram likelihoods; the set of
languages grows by one as long as the likelihood gains more than a penalty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import pieces, portions

UNKNOWN = "und"
#: Training rows of one language are thinned by a hash of their doc_id to about this many.
PER_LANGUAGE = 5_000
#: One more language must raise the log likelihood by this, times the log of the segments.
PENALTY = 3.0
#: A document stays in a corpus if its main language scores at least this.
LEAST_SHARE = 1 / 3

_BUCKETS = 1 << 16
_SEGMENT = 32
_SMOOTHING = 0.5
_STEPS = 12
_ASCII = np.array(
    [ord(" ")] * 65 + [*range(97, 123)] + [ord(" ")] * 6 + [*range(97, 123)] + [ord(" ")] * 5
    + [*range(128, 256)], dtype=np.uint8,
)
_LETTER = re.compile(r"[^\W\d_]")


def grams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text; everything but letters counts as a blank."""
    raw = _ASCII[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
    return ((raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16) * np.uint32(2654435761)) >> np.uint32(16)


def held_out(id_col: str) -> Column:
    """Documents no model learns from: crc32 of the identifier as text, modulo 5, is 0."""
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(key) % 5 == 0


@dataclass
class Languages:
    """Log probabilities of the trigram buckets, one row per language."""

    names: list[str]
    logs: np.ndarray


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Languages:
    """Trigram counts of the training documents; whole texts, thinned per language by hash."""
    known = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out(id_col).alias("held"),
        F.xxhash64(F.col(f"`{id_col}`")).alias("draw"), F.lower(f"`{text_col}`").alias("text"),
    ).where("lang IS NOT NULL AND NOT held")
    # one row per language; the model, which every task gets, has as many rows
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    shares = [F.lit(x) for r in sizes for x in (r["lang"], per_language / r["n"])]
    share = F.element_at(F.create_map(*shares).cast("map<string,double>"), F.col("lang"))
    drawn = known.where("text IS NOT NULL").where(
        F.pmod("draw", F.lit(1_000_003)) / 1_000_003 < share
    ).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in pieces(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(_BUCKETS, np.int64)
                seen[lang] += np.bincount(grams(text.encode()), minlength=_BUCKETS)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"]
            )

    table = (
        drawn.mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toPandas()
    names = sorted(table["lang"].unique())
    counts = np.zeros((len(names), _BUCKETS))
    rows = {name: i for i, name in enumerate(names)}
    counts[table["lang"].map(rows).to_numpy(int), table["bucket"].to_numpy(int)] = table["n"]
    total = counts.sum(1, keepdims=True) + _SMOOTHING * _BUCKETS
    return Languages(names, np.log((counts + _SMOOTHING) / total).astype(np.float32))


def _mix(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray):
    """Shares of the allowed languages per document, and the log likelihood, by EM."""
    top = scores.max(1, keepdims=True)
    weight = np.exp(scores - top)
    shares = allowed / allowed.sum(1, keepdims=True)
    for _ in range(_STEPS):
        part = np.repeat(shares, sizes, axis=0) * weight
        part /= part.sum(1, keepdims=True) + 1e-300
        shares = np.add.reduceat(part, starts, axis=0) / sizes[:, None]
    whole = (np.repeat(shares, sizes, axis=0) * weight).sum(1) + 1e-300
    return shares, np.add.reduceat(np.log(whole) + top[:, 0], starts)


def identify(texts: list[bytes], model: Languages, penalty: float = PENALTY):
    """Index of the main language of each text (with a letter each), and its score."""
    marks = [grams(t) for t in texts]
    lengths = np.array([len(m) for m in marks])
    sizes = -(-lengths // _SEGMENT)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    cuts = np.concatenate(
        [np.arange(0, n, _SEGMENT) + at for n, at in zip(lengths, np.cumsum(lengths) - lengths)]
    )
    flat = np.concatenate(marks)
    scores = np.stack([np.add.reduceat(row[flat], cuts) for row in model.logs], 1).astype(float)
    single = np.add.reduceat(scores, starts, axis=0)
    languages, docs = single.shape[1], np.arange(len(texts))
    best_set = np.zeros_like(single)
    best_set[docs, single.argmax(1)] = 1
    shares, best = best_set.copy(), single.max(1)
    price = penalty * np.log(sizes + 1.0)
    open_docs = np.flatnonzero(sizes > 1)
    while languages > 1 and len(open_docs):
        # the languages a document may still add, ordered by what the full mixture gives them
        at = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in open_docs])
        some, size = scores[at], sizes[open_docs]
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        wide, _ = _mix(some, begin, size, np.ones((len(open_docs), languages)))
        tried = best_set[open_docs].copy()
        tried[np.arange(len(open_docs)), (wide - 2 * tried).argmax(1)] = 1
        share, gain = _mix(some, begin, size, tried)
        better = (gain - best[open_docs] > price[open_docs]) & (
            tried.sum(1) > best_set[open_docs].sum(1)
        )
        won = open_docs[better]
        best_set[won], shares[won], best[won] = tried[better], share[better], gain[better]
        open_docs = won[best_set[won].sum(1) < languages]
    main = shares.argmax(1)
    odds = np.exp(single - single.max(1, keepdims=True))
    sure = np.where(shares.max(1) < 1, 1.0, odds[docs, main] / odds.sum(1))
    return main, shares.max(1) * sure


def _readable(texts: list[str | None], model: Languages) -> Iterator[list[int]]:
    """Portions of the texts that have a letter, if there is anything to compare them with."""
    for part in portions(texts):
        if some := [i for i in part if texts[i] and model.names and _LETTER.search(texts[i])]:
            yield some


def predict(
    docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text",
    penalty: float = PENALTY,
) -> DataFrame:
    """One row per input row: ``<id_col>, held_out, lang_pred, score``.

    Null texts, texts without a letter, and any text where nothing could be learned (an
    empty training table) give ``und`` with score 0. Repeated rows and null identifiers are
    predicted row by row; a null identifier counts as held out. An empty table gives no
    rows; other columns are not read.
    """
    names = pa.array([*model.names, UNKNOWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(2).to_pylist()
            code, score = np.full(len(texts), len(model.names)), np.zeros(len(texts))
            for part in _readable(texts, model):
                code[part], score[part] = identify([texts[i].encode() for i in part], model, penalty)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), names.take(pa.array(code)), pa.array(score)],
                [id_col, "held_out", "lang_pred", "score"],
            )

    source = docs.select(
        F.col(f"`{id_col}`"), held_out(id_col).alias("held_out"),
        F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"),
    )
    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double"
    )


def drop_unknown(
    docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text",
    least: float = LEAST_SHARE,
) -> DataFrame:
    """The rows of ``docs`` in which one learned language scores at least ``least``.

    Texts without a letter go, and mixtures in which no language holds its part. Nothing
    learned keeps all.
    """
    if not model.names:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [t.lower() if t else t for t in batch.column(at).to_pylist()]
            keep = np.zeros(len(texts), bool)
            for part in _readable(texts, model):
                keep[part] = identify([texts[i].encode() for i in part], model)[1] >= least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
