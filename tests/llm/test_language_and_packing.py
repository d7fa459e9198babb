"""Language mixtures by held-out accuracy, token ids and packing by exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from breachline.llm.language_id import drop_unknown, learn, predict
from breachline.llm.packing import Limits, Packer, pack
from breachline.llm.tokens import Encoder, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    for row in got.itertuples():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
    held = got[got.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_odd_documents(spark, model):
    rows = [(1, None, "en", 0.5), (2, "", None, None), (3, "12 !?", "en", 1.0), (None, "the and of", None, None),
            (4, "Ж" * 50, None, None), (5, "the and with for " * 20_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    got = {r.doc_id: r for r in predict(docs, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert got[None].held_out and got[5].lang_pred == "en"
    assert sorted(r.doc_id or 0 for r in drop_unknown(docs, model).collect()) in ([0, 4, 5], [0, 5])
    assert predict(docs.where("false"), model).count() == 0
    nothing = learn(docs.where("false"))
    assert nothing.names == [] and {r.lang_pred for r in predict(docs, nothing).collect()} == {"und"}
    assert drop_unknown(docs, nothing).count() == len(rows)


def test_a_mixture_names_both_languages(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 3000").collect()}
    mixed = docs["en"][:2000] + " " + docs["de"][:1000]
    row = predict(spark.createDataFrame([(1, mixed)], "doc_id bigint, text string"), model).first()
    assert row.lang_pred == "en" and 0.5 < row.score < 0.85


def test_encoder_equals_tokenizer():
    rng = random.Random(1)
    parts = ["'s", "'ll", "'", "''", "'re", " ", "  ", "\n", "\n\n", "\t", "a", "bc", "12", "é", "!", "?!", "'d",
             "'stuff", "<|endoftext|>", "日本", "🙂", "\r\n", "don't", "\u0085", " ", "²", "\x1c", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time every word is known
        assert [ids.tolist() for ids in encoder.encode(texts)] == want


def pieces_are_whole(rows, ids, limit=1024):
    byte_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = ids[r.doc_id]
        piece = np.array(whole[r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(whole) and zlib.crc32(piece.tobytes()) == r.ids_crc32
        byte_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places, total in [(byte_doc[d], len(ids[d])) for d in ids] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for start, length in sorted(places):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= limit and (at == limit or at & (at - 1) == 0)


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "n_chars")
    odd = spark.createDataFrame([(-1, None, 0), (-2, "", 0), (-3, "word " * 60_000, 0)], docs.schema)
    docs = docs.union(odd).repartition(3)
    ids = {
        r.doc_id: tokenizer(PATH).encode(r.text or "", add_special_tokens=False).ids + [0]
        for r in docs.collect()
    }
    rows = pack(docs, PATH).collect()
    pieces_are_whole(rows, ids)
    assert pack(docs.where("false"), PATH).count() == 0


def test_all_three_limits_hold():
    rng = np.random.default_rng(2)
    limits = Limits(tokens=64, segments=3, loss=40)
    packer, loss_of = Packer(limits, 0), {}
    for key in range(400):
        n = int(rng.integers(1, 200))
        bearing = int(rng.integers(1, n + 1))
        packer.add(key, np.arange(n, dtype=np.uint32), bearing)
        loss_of[key] = n - bearing
    packer.pack()
    tokens, segments, loss, placed = (defaultdict(int) for _ in range(4))
    for key, start, length, _, _, sequence, _ in packer.rows:
        tokens[sequence] += length
        segments[sequence] += 1
        loss[sequence] += max(0, start + length - max(loss_of[key], start))
        placed[key] += length
    assert max(tokens.values()) <= 64 and max(segments.values()) <= 3 and max(loss.values()) <= 40
    assert len(placed) == 400


def test_prompts_bear_no_loss(spark):
    docs = spark.createDataFrame([(1, "answer here", "a question")], "doc_id int, text string, prompt string")
    row = pack(docs, PATH, prompt_col="prompt").agg({"length": "sum", "doc_tokens": "max"}).first()
    encode = tokenizer(PATH).encode
    assert row[0] == row[1] == len(encode("a question").ids) + len(encode("answer here").ids) + 1
