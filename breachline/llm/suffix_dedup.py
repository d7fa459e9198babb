"""Removal of long repeated byte strings by longest-previous-factor arrays.

A suffix array of all texts cannot lie in one place, so its suffixes are dealt out by their
content. Of the 200-byte strings inside every 400-byte string one is the anchor (least
hash, leftmost), so equal 400-byte strings have equal anchors at the same place. Anchors
that occur once need no further look. For the others, all 400-byte starts around one anchor
form a part of the suffix array: they are sorted by their first 400 bytes, ties by position.
In that order the previous and the next smaller position of a suffix are the earlier
suffixes that share most with it, which gives the longest previous factor; the previous and
the next greater position give its mirror image, a later copy. Both are cut off at 400.

Equal texts are one text with a number of copies, and equal surroundings of an anchor are
one entry with a number of places, both before anything is dealt out. Equal surroundings
agree in the hash of the anchor and in 64 bits of a cryptographic hash. Only texts with a repeated anchor are looked at again: a bitmap
of bounded size says which, so the others are not shuffled. An anchor that still
has too many different surroundings for one task is divided: starts further to the left are
dealt by the bytes before the anchor, the others by the bytes after it, and so on in halves
down to a single start, where equal strings only need to be counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import ordered, pieces, text_of, utf8
from breachline.llm.tokens import SliceHash
from breachline.settings import settled, shuffle_width

LENGTH = 400
ANCHOR = 200
#: Different surroundings of one anchor that a task sorts at once.
TOGETHER = 20_000

#: Bits of the map of texts that are looked at again, at most: 16 MB.
MAP_BITS = 1 << 27

_SIDE = LENGTH - ANCHOR
_SUFFIXES = 20_000
_PLACE = (1 << 28) - 1
_HASH = SliceHash(0xD1342543DE82EF95)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every window of ``width`` keys."""
    n = len(keys)
    padded = np.concatenate([keys, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)])
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and hash of the surroundings of each anchor of a text."""
    n = len(data)
    if n < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    mixed = (raw + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    starts = np.arange(n - ANCHOR + 1)
    hashes = _HASH.slices(mixed, starts, starts + ANCHOR)
    hashes = (hashes ^ hashes >> np.uint64(31)) * _MIX
    keys = hashes & ~np.uint64(_PLACE) | starts.astype(np.uint64)
    chosen = np.unique(_least_places(keys, _SIDE + 1)) & np.uint64(_PLACE)
    places = np.sort(chosen.astype(np.int64))
    low = np.maximum(places - _SIDE, 0)
    around = b"".join(
        # the salt says where in the bytes the anchor lies
        blake2b(data[a : p + LENGTH], digest_size=8, salt=(p - a).to_bytes(2, "big")).digest()
        for a, p in zip(low.tolist(), places.tolist())
    )
    return places, hashes[places].view(np.int64), np.frombuffer(around, np.int64)


def _marks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``who, digest`` and the anchors of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in pieces(batches):
            digests, found = [], []
            for data in utf8(batch, 1):
                digests.append(sha256(data).digest())
                found.append(anchors(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()),
                 *[pa.array([f[i] for f in found], kind) for i, kind in enumerate(lists)]],
                ["who", "digest", "places", "anchor", "around"],
            )

    source = docs.select(ordered(id_col).alias("who"), text_of(text_col))
    kind = source.schema["who"].dataType.simpleString()
    return source.mapInArrow(
        run, f"who {kind}, digest binary, places array<int>, "
        "anchor array<bigint>, around array<bigint>",
    )


def _repeated(texts: DataFrame) -> DataFrame:
    """Per text number the anchors that occur more than once, with what is known of them."""
    spread = texts.select("number", F.explode(
        F.arrays_zip("places", "anchor", "around")).alias("a")
    ).select("number", F.col("a.places").alias("place"), F.col("a.anchor").alias("anchor"),
             F.col("a.around").alias("around"))
    entries = spread.groupBy("anchor", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("number", "place")).alias("least")
    )
    kinds = entries.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
    ).where("total > 1")
    known = entries.join(kinds, "anchor").select("anchor", "around", "n", "kinds", "least")
    first = (F.col("number") == F.col("least.number")) & (F.col("place") == F.col("least.place"))
    return spread.join(known, ["anchor", "around"]).groupBy("number").agg(F.collect_list(F.struct(
        "place", "anchor", "kinds", (F.col("n") > 1).alias("many"), first.alias("first"),
    )).alias("found"))


def _surroundings(touched: DataFrame) -> DataFrame:
    """The bytes around each anchor whose surroundings differ, one row per different ones."""
    def describe(f: Column) -> Column:
        low = F.greatest(f["place"] - _SIDE, F.lit(0))
        return F.struct(
            f["anchor"].alias("key"), f["place"].alias("place"), f["kinds"].alias("members"),
            F.substring("data", low + 1, f["place"] - low).alias("before"),
            F.substring("data", f["place"] + 1, F.lit(LENGTH)).alias("after"),
        )

    rows = touched.select("number", "found", F.encode("text", "UTF-8").alias("data")).select(
        "number",
        F.explode(F.transform(F.filter("found", lambda f: f["first"] & (f["kinds"] > 1)), describe)).alias("f"),
    )
    return rows.select(
        "number", "f.*", F.lit(0).alias("low"), F.lit(_SIDE).alias("high")
    )


def factors(texts: list[bytes], starts: np.ndarray, owner: np.ndarray, place: np.ndarray):
    """Whether each suffix has an earlier, and a later, copy of its first ``LENGTH`` bytes.

    ``starts`` are places in ``texts[owner]``; ``place`` orders all suffixes, and equal
    numbers are the same suffix of the same document.
    """
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = (np.cumsum(sizes) - sizes)[owner] + starts
    windows = np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[at]
    names = windows.view(f"S{LENGTH}").ravel()
    order = np.lexsort((place, names))
    names = names[order]
    same = names[1:] == names[:-1]
    # places rise within equal names, so the previous smaller place lies just before a run of
    # one place (the same suffix may stand there twice), the next greater one just behind it
    here = place[order]
    step = np.concatenate(([True], (here[1:] != here[:-1]) | ~same, [True]))
    run = np.cumsum(step[:-1]) - 1
    edges = np.flatnonzero(step)
    smaller, greater = edges[:-1][run] - 1, edges[1:][run]
    group = np.concatenate(([-1], np.cumsum(np.concatenate(([0], ~same))), [-1]))
    earlier, later = np.zeros(len(place), bool), np.zeros(len(place), bool)
    earlier[order] = group[smaller + 1] == group[1:-1]
    later[order] = group[greater + 1] == group[1:-1]
    return earlier, later


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax())


def nearest(strings: list[bytes], ties: list[bytes], place: list[tuple], both: bool):
    """For each string the neighbours in sorted order that can share most with it: the previous
    and the next with a smaller place (earlier copies), and with a greater one if ``both``."""
    order = sorted(range(len(strings)), key=lambda i: (strings[i], ties[i], place[i]))
    near: list[list[int]] = [[] for _ in strings]
    for sign in (False, True) if both else (False,):
        stack: list[int] = []
        for i in order:
            while stack and (place[stack[-1]] < place[i] if sign else place[stack[-1]] > place[i]):
                near[stack.pop()].append(i)
            if stack:
                near[i].append(stack[-1])
            stack.append(i)
    return near


def stretches(rows: list[dict], both: bool) -> list[tuple[int, int, int]]:
    """The repeated stretch of each row of one key, as ``(number, start, stop)``.

    What a row shares most to the right is found at its neighbours in suffix order, what it
    shares most to the left at those in the order of the reversed bytes before the anchor.
    Where one row shares both, all starts between are repeated and no others. Only where
    two different rows are needed, the starts are sorted one by one.
    """
    before = [r["before"][::-1] for r in rows]
    after = [r["after"] for r in rows]
    place = [(r["number"], r["place"]) for r in rows]
    right, left = nearest(after, before, place, both), nearest(before, after, place, both)
    out, reach, open_rows = [], [], []
    for i, r in enumerate(rows):
        shared = [(common(before[i], before[k]), common(after[i], after[k])) for k in {*right[i], *left[i]}]
        most = (max((s[0] for s in shared), default=0), max((s[1] for s in shared), default=0))
        low, high = max(r["low"], LENGTH - most[1]), min(r["high"], most[0])
        reach.append((low, high))
        if low > high:
            continue
        if most in shared:
            out.append((r["number"], r["place"] - high, r["place"] - low + LENGTH))
        else:
            open_rows.append(i)
    if open_rows:
        if not both:  # a row may also be the earlier copy of others: all its starts take part
            reach = [(max(r["low"], LENGTH - len(a)), min(r["high"], len(b)))
                     for r, a, b in zip(rows, after, before)]
        spans = [np.arange(low, high + 1) for low, high in reach]
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in spans])
        back = np.concatenate(spans)
        sizes = np.array([len(r["before"]) for r in rows])
        ranks = {p: k for k, p in enumerate(sorted({p[0] for p in place}))}
        absolute = np.array([(ranks[p[0]] << 32) + p[1] for p in place])[owner] - back
        texts = [r["before"] + r["after"] for r in rows]
        hit = np.zeros(len(back), bool)
        # equal suffixes lie equally far before the anchor, so a few distances go at a time
        step = max(1, _SUFFIXES // len(rows))
        for low in range(0, _SIDE + 1, step):
            some = np.flatnonzero((back >= low) & (back < low + step))
            if len(some) > 1:
                mine = owner[some]
                earlier, later = factors(texts, sizes[mine] - back[some], mine, absolute[some])
                hit[some] = earlier | later if both else earlier
        for i in open_rows:
            if len(mine := back[hit & (owner == i)]):
                at = rows[i]["place"]
                out.append((rows[i]["number"], at - int(mine.max()), at - int(mine.min()) + LENGTH))
    return out


def _sort_parts(rows: DataFrame, both: bool) -> DataFrame:
    """The repeated stretch of each row, from the rows of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def take(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["number", "start", "stop"]
            )

        for batch in pieces(batches):
            done: list[tuple] = []
            for row in batch.to_pylist():
                if held and (row["key"], row["low"]) != (held[-1]["key"], held[-1]["low"]):
                    done.extend(stretches(held, both))
                    held = []
                held.append(row)
            yield take(done)
        if held:
            yield take(stretches(held, both))

    width = shuffle_width(rows.sparkSession)
    dealt = rows.drop("members").repartition(width, "key").sortWithinPartitions("key", "low")
    return dealt.mapInArrow(run, "number bigint, start bigint, stop bigint")


def _halves(rows: DataFrame) -> DataFrame:
    """Divide the starts of each row: those left of the middle by the bytes before the anchor,
    the others by the bytes after it. A side whose bytes are not all there has no such start."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    reach = middle + 1
    need = F.lit(LENGTH) - middle
    left = F.struct(
        F.xxhash64("key", F.lit(0), F.substring(
            "before", F.length("before") - reach + 1, reach)).alias("key"),
        reach.alias("low"), F.col("high").alias("high"), (F.length("before") >= reach).alias("there"),
    )
    right = F.struct(
        F.xxhash64("key", F.lit(1), F.substring("after", F.lit(1), need)).alias("key"),
        F.col("low").alias("low"), middle.alias("high"), (F.length("after") >= need).alias("there"),
    )
    return rows.select(
        F.explode(F.array(left, right)).alias("h"), "number", "place", "before", "after"
    ).where("h.there").select("h.key", "h.low", "h.high", "number", "place", "before", "after")


def _single_starts(rows: DataFrame, both: bool) -> DataFrame:
    """Rows with one start left: equal strings are counted, none is brought together."""
    begin = F.col("place") - F.col("low")
    text = F.concat(F.substring("before", F.length("before") - F.col("low") + 1, F.col("low")), "after")
    rows = rows.where(F.length(text) >= LENGTH).select(
        "number", begin.cast("bigint").alias("start"), F.struct("number", begin.alias("start")).alias("at"),
        F.sha2(F.substring(text, F.lit(1), F.lit(LENGTH)), 256).alias("name"),
    )
    ends = rows.groupBy("name").agg(F.min("at").alias("least"), F.max("at").alias("most"))
    hit = rows.join(ends.where("least != most"), "name")
    hit = hit if both else hit.where("at != least")
    return hit.select("number", "start", (F.col("start") + LENGTH).alias("stop"))


def _stretches(touched: DataFrame, both: bool, together: int) -> DataFrame:
    rows = _surroundings(touched)
    rows, out = settled(rows, "surroundings"), None
    while True:
        small = F.col("members") <= together
        found = _sort_parts(rows.where(small), both)
        out = found if out is None else out.unionByName(found)
        rows = rows.where(~small)
        if rows.isEmpty():
            return out
        split = settled(_halves(rows), "halves")
        out = out.unionByName(_single_starts(split.where("low = high"), both))
        split = split.where("low < high")
        sizes = split.groupBy("key", "low").agg(F.count(F.lit(1)).alias("members"))
        rows = settled(split.join(sizes.where("members > 1"), ["key", "low"]), "surroundings")


def _removal(touched: DataFrame, found: DataFrame, both: bool) -> DataFrame:
    """Per text the spans to remove and the hash of what stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 50):
            rows = []
            for row in batch.to_pylist():
                data = row["text"].encode()
                spans = [(s["start"], s["stop"]) for s in row["stretches"] or []]
                for f in row["found"]:
                    low = max(0, f["place"] - _SIDE)
                    high = min(len(data), f["place"] + LENGTH)
                    if f["many"] and (both or not f["first"]) and high - low >= LENGTH:
                        spans.append((low, high))
                merged: list[list[int]] = []
                for start, stop in sorted(spans):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], stop)
                    else:
                        merged.append([start, stop])
                kept, at = sha256(), 0
                for start, stop in [*merged, [len(data), len(data)]]:
                    kept.update(data[at:start])
                    at = stop
                spans = [{"start": a, "stop": b} for a, b in merged]
                rows.append((row["number"], spans, kept.hexdigest()))
            columns = list(zip(*rows)) or [()] * 3
            pair = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pair),
                 pa.array(columns[2], pa.string())], ["number", "spans", "kept"],
            )

    listed = found.groupBy("number").agg(
        F.collect_list(F.struct("start", "stop")).alias("stretches")
    )
    joined = touched.select("number", "text", "found").join(listed, "number", "left")
    return joined.mapInArrow(
        run, "number bigint, spans array<struct<start:bigint,stop:bigint>>, kept string"
    )


def _touched(named: DataFrame, found: DataFrame) -> DataFrame:
    """``number, text, found`` of each text with a repeated anchor, from one of its rows.

    A bitmap of the rows to take is broadcast first. It is exact as far as it goes: a row
    that only shares its bit is left out by the join behind it.
    """
    wanted = found.select("digest", F.col("first").alias("who"))
    bits = min(MAP_BITS, max(1 << 15, 1 << (16 * wanted.count()).bit_length()))

    def spot(*columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(bits))

    bitmap = (
        wanted.select(spot("digest", "who").alias("spot"))
        .select(F.bitmap_bucket_number("spot").alias("bucket"), F.bitmap_bit_position("spot").alias("bit"))
        .repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    placed = named.withColumn("spot", spot("digest", "who")).withColumn("bucket", F.bitmap_bucket_number("spot"))
    bit = F.bitmap_bit_position("spot")
    byte = F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.getbit(value, (bit % 8).cast("int")) == 1
    # at most MAP_BITS bits, 32768 to a row
    taken = placed.join(F.broadcast(bitmap), "bucket").where(hit).select("digest", "who", "text")
    return taken.join(found, "digest").where(F.col("who") == F.col("first")).groupBy("digest").agg(
        *[F.any_value(c).alias(c) for c in ("number", "text", "found")]
    ).select("number", "text", "found")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "first",
    together: int = TOGETHER,
) -> DataFrame:
    """One row per input row: ``<id_col>, n_bytes, spans, n_removed, n_spans, kept_sha256``.

    ``spans`` are the byte ranges covered by a 400-byte string that also starts elsewhere, in
    any text: with ``keep="first"`` those with an earlier copy (texts are ordered by their
    smallest identifier), with ``keep="none"`` all of them. Null texts count as empty. Rows
    with equal text share its spans, but of such rows only those with the smallest
    identifier keep the first copy. Null identifiers order last, an empty table gives no
    rows, and other columns are not read.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    both = keep == "none"
    texts = _marks(docs, id_col, text_col).groupBy("digest").agg(
        F.min("who").alias("first"), F.count(F.lit(1)).alias("copies"),
        *[F.any_value(c).alias(c) for c in ("places", "anchor", "around")],
    )
    if not both:  # numbers then have to follow the identifiers
        width = shuffle_width(docs.sparkSession)
        texts = texts.repartitionByRange(width, "first").sortWithinPartitions("first")
    texts = settled(texts.withColumn("number", F.monotonically_increasing_id()), "texts")
    found = settled(_repeated(texts).join(texts.select("number", "digest", "first"), "number"), "found")
    named = docs.select(ordered(id_col).alias("who"), text_of(text_col).alias("text")).select(
        "who", "text", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    touched = settled(_touched(named.where(F.col("n_bytes") >= LENGTH), found), "touched")
    removal = _removal(touched, _stretches(touched, both, together), both)
    known = texts.select("number", "digest", "first", "copies").join(removal, "number", "left").drop("number")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    gone = gone if both else gone & (F.col("who") != F.col("first"))
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    nothing = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    spans: Column = F.when(gone, everything).otherwise(F.coalesce("spans", nothing))
    kept = F.when(gone, F.sha2(F.lit(""), 256)).otherwise(
        F.coalesce("kept", F.lower(F.hex("digest")))
    )
    return named.select("who", "digest", "n_bytes").join(known, "digest").select(
        F.col("who.id").alias(id_col), "n_bytes", spans.alias("spans"), kept.alias("kept_sha256")
    ).select(
        F.col(f"`{id_col}`"), "n_bytes", "spans",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256",
    )
