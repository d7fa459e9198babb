"""Spelling variants, fill-in-the-middle and sentence pieces against brute force."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from breachline.llm import catalog
from breachline.llm.fill_middle import (
    UNITS, Cutter, Markers, WaveletMatrix, draws, fill_middle, restored, symbols,
)
from breachline.llm.sentence_pieces import PieceCoder, encode_pieces
from breachline.llm.spelling import (
    PARTS, _crowds, _signed_rows, _verified, near_words, spelling_variants, variants, word_counts,
)
from breachline.settings import cut

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SHAPE = "doc_id bigint, text string, word string, n int, key string"
ODD = [
    (1, "the quick  Brown fox\n\njumps", "w", 1, "k"), (2, "", None, None, None), (3, None, "x", 2, None),
    (3, None, "x", 2, None), (None, "no id, ÀÉ naïve çà", None, None, None), (4, "a <S> marker", None, None, None),
    (5, "\U0001F600 é ​\t\x00 中文 \U0001F468‍\U0001F469", None, None, None), (6, " ", None, None, None),
    (7, "x", None, None, None), (8, "  lead and trail  ", None, None, None), (9, "<s> </s> <unk> <0x41> ▁▁ a▁b", None, None, None),
    (10, "word " * 40_000, None, None, None), (11, "a" * 20_000, None, None, None), (12, "ab <P", None, None, None),
    (13, ">" + "<P <S <M" * 3, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SHAPE).repartition(3)


# spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    forms, found = {}, {}
    for word, n in counts.items():
        found[word] = [w for w in counts if near(word, w)]
        best = min(found[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None

    def root(word):
        return word if forms[word] is None else root(forms[word])

    return sorted(
        (w, f or "", root(w), counts[w], len(found[w]), counts[f] if f else -1) for w, f in forms.items()
    )


def as_rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or -1) for r in df.collect())


def brute_words(rows, least=6, often=5):
    counts, small = Counter(), {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(small)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


@pytest.mark.parametrize("compared", [1, 4, 200])
def test_variants_equal_brute_force(spark, compared):
    rng = np.random.default_rng(7)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 9))) for _ in range(250)}
    # chains of growing frequency, ties, anagrams, and words that differ in case or accents only
    words |= {"colour", "color", "colours", "colouur", "couleur", "roluoc", "ÉCOLES", "écoles", "ecoles", "aaaaaa", "aaaaaaa"}
    counts = {w: int(5 ** rng.integers(1, 6)) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    want = brute_variants(counts)
    assert as_rows(variants(table, compared=compared)) == want
    assert sum(r[1] != "" for r in want) > 50 and any(r[1] not in ("", r[2]) for r in want)


def test_crowded_signatures_lose_no_pair(spark):
    # one multiset of letters: every word has the same signatures, so only places tell them apart
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.permutation(list("aabbccd"))) for _ in range(300)} | {
        "".join(rng.permutation(list("aabbccdd"))) for _ in range(300)} | {"aabbccx", "aabbccy", "aabbcc" * 30})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = near_words(table, compared=8).collect()
    want = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    assert {frozenset((r.a, r.b)) for r in got} == want and len(got) == len(want)


def test_signatures_are_not_broadcast(spark):
    words = cut(spark.createDataFrame([("lantern", 9), ("lanterns", 50), ("lantarn", 5)], "word string, n bigint"))
    rows = _crowds(_signed_rows(words, PARTS))
    for joined in (rows, _verified(rows)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_words_of_odd_rows(spark, odd):
    rows = [(i, t) for i, t, *_ in ODD]
    got = {r.word: r.n for r in word_counts(odd, min_length=1, min_count=1).collect()}
    assert got == brute_words(rows, 1, 1)
    assert as_rows(spelling_variants(odd)) == brute_variants(brute_words(rows))
    for empty in (odd.where("false"), odd.where("text is null")):
        assert spelling_variants(empty).collect() == []


def test_query_of_variants(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = as_rows(catalog.PLANS["op11_spelling_variants"](spark, SF))
    assert got == brute_variants(brute_words(rows)) and got


def test_a_form_must_be_more_frequent(spark):
    with pytest.raises(ValueError):
        variants(spark.createDataFrame([("abcdef", 5)], "word string, n bigint"), ratio=1)


# fill-in-the-middle


def test_wavelet_ranks_and_places():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        sequence = rng.integers(0, 16, size).astype(np.uint8)
        matrix = WaveletMatrix(sequence)
        at = np.arange(size + 1)
        for symbol in range(16):
            want = np.concatenate(([0], np.cumsum(sequence == symbol)))
            assert (matrix.rank(symbol, at) == want).all()
        chosen = [1, 7, 12]
        places = np.flatnonzero(np.isin(sequence, chosen))
        full = np.full(len(places), size)
        assert (matrix.select(chosen, np.arange(len(places)), full * 0, full) == places).all()


def brute_units(text, unit):
    """Places where the units of a text begin, from its symbols one by one."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    marks = symbols(points, np.zeros(min(1, len(points)), np.int64))
    return [i for i in range(len(text)) if i == 0 or marks[i] in list(UNITS[unit])]


@pytest.mark.parametrize("unit", sorted(UNITS))
def test_units_equal_brute_force(unit):
    texts = [t or "" for _, t, *_ in ODD if len(t or "") < 1000]
    cutter = Cutter(texts, unit)
    begins = [brute_units(t, unit) for t in texts]
    assert cutter.units.tolist() == [len(b) for b in begins]
    for k in range(int(cutter.units.max()) + 1):
        count = np.minimum(cutter.units, k)
        want = [(b + [len(t)])[c] if t else 0 for b, t, c in zip(begins, texts, count)]
        assert cutter.places(count).tolist() == want


def test_units_mean_what_they_say():
    def parts(text, unit):
        at = brute_units(text, unit) + [len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    assert parts("One two, 34 fünf", "word") == ["One ", "two, ", "34 ", "fünf"]
    assert parts("a\nb\n\nc", "line") == ["a", "\nb", "\n\nc"]
    assert parts("éo", "cluster") == ["é", "o"]
    assert parts("ab", "char") == ["a", "b"]


def brute_middle(doc_id, text):
    text, n = text or "", len(text or "")
    h1, h2, h3, h4 = draws(1, doc_id)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_fill_middle_equals_brute_force(odd):
    got = fill_middle(odd).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    key = lambda row: tuple(map(str, row))
    want = [(i, *brute_middle(i, t), t or "") for i, t, *_ in ODD]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert fill_middle(odd.where("false")).count() == 0


@pytest.mark.parametrize("unit", ["word", "line", "cluster"])
def test_other_units_and_markers_restore(odd, unit):
    marks = Markers("[[front]]", "[[back]]", "[[mid]]")
    made = fill_middle(odd, unit=unit, plain_percent=0, spm_percent=50, markers=marks)
    back = made.join(odd.select("doc_id", "text"), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "form", restored(F.col("output"), F.col("form"), marks).alias("back"))
    rows = back.collect()
    assert all(r.text == r.back for r in rows) and {"psm", "spm", "plain"} == {r.form for r in rows}
    with pytest.raises(ValueError):
        fill_middle(odd, unit="page")


def test_query_of_middles(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.PLANS["op12_fill_in_middle"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, a, b, output = brute_middle(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, b)
        assert r.output_sha256 == sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == sha256((texts[r.doc_id] or "").encode()).hexdigest()


# sentence pieces


def library_rows(model, texts):
    given = model.encode(texts, add_bos=True, add_eos=True)
    return given, model.decode(given)


def test_pieces_equal_the_library(odd):
    model = SentencePieceProcessor(model_file=MODEL)
    rows = encode_pieces(odd, MODEL).collect()
    given, back = library_rows(model, [t or "" for _, t, *_ in ODD])
    want = sorted((str(i), ids, text) for (i, *_), ids, text in zip(ODD, given, back))
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in rows) == want
    assert all(r.agrees and r.n_tokens == len(r.ids) // 4 for r in rows)
    assert encode_pieces(odd.where("false"), MODEL).count() == 0


def test_own_coder_needs_no_help_from_the_library():
    rng = np.random.default_rng(5)
    signs = list("aeioutn  \n▁é中\U0001F600<0x41>́")
    texts = ["".join(rng.choice(signs, rng.integers(0, 80))) for _ in range(400)]
    own, model = PieceCoder(MODEL), SentencePieceProcessor(model_file=MODEL)
    given, back = library_rows(model, texts)
    for _ in range(2):  # the second time from the cache
        ids = own.encode(texts)
        assert [i.tolist() for i in ids] == given and own.decode(ids) == back


@pytest.mark.parametrize("change", ["unused", "no_bytes", "fixed", "ties"])
def test_other_vocabularies(tmp_path, change):
    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    kind = type(model.pieces[0])
    for i, piece in enumerate(model.pieces):
        if change == "unused" and piece.type == kind.NORMAL and i % 3 == 0 and len(piece.piece) > 2:
            piece.type = kind.UNUSED
        if change == "no_bytes" and piece.type == kind.BYTE:
            piece.type = kind.NORMAL
        if change == "fixed" and piece.piece in ("ing", "tion", "▁the"):
            piece.type = kind.USER_DEFINED
        if change == "ties":
            piece.score = -float(int(-piece.score) // 500)
    if change == "no_bytes":
        model.trainer_spec.byte_fallback = False
    path = str(tmp_path / "changed.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    texts = ["the nation is singing", "\U0001F600\U0001F601 a ͸͹ b", "", " strings  of thing\n\n"]
    texts += ["".join(np.random.default_rng(k).permutation(list("thenationstring  singing"))) for k in range(200)]
    own, library = PieceCoder(path), SentencePieceProcessor(model_file=path)
    assert [i.tolist() for i in own.encode(texts)] == library_rows(library, texts)[0]


def test_query_of_pieces(spark):
    rows = catalog.PLANS["op13_sentencepiece"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    model = SentencePieceProcessor(model_file=MODEL)
    given, back = library_rows(model, [d.text or "" for d in docs])
    want = {
        d.doc_id: (len(i), sha256(np.array(i, "<u4").tobytes()).hexdigest(), sha256(t.encode()).hexdigest())
        for d, i, t in zip(docs, given, back)
    }
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
    assert all(r.agrees for r in rows)
