"""Registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachline.llm.common import documents
from breachline.llm.decontaminate import find_leaks
from breachline.llm.exact_dedup import exact_duplicates
from breachline.llm.fill_middle import fill_middle, restored
from breachline.llm.html_layout import extract_text
from breachline.llm.language_id import learn, predict
from breachline.llm.licenses import scan_licenses, scan_sql
from breachline.llm.packing import pack
from breachline.llm.pii import fit_judge, scan_personal_data
from breachline.llm.secret_scan import fit_forest, scan_secrets
from breachline.llm.sentence_pieces import encode_pieces
from breachline.llm.simhash import near_duplicates
from breachline.llm.spelling import spelling_variants
from breachline.llm.suffix_dedup import repeated_spans

Plan = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan_personal_data(docs, fit_judge(docs))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(documents(spark, sf_dir), items)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, learn(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir), keep="none").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan_secrets(docs, fit_forest(docs))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_pieces(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees",
    )


PLANS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_pii,
        op3_exact_dedup,
        op4_license_scan,
        op5_benchmark_decontamination,
        op6_language_id,
        op7_packing,
        op8_suffix_array_dedup,
        op9_secret_scan,
        op10_html_extraction,
        op11_spelling_variants,
        op12_fill_in_middle,
        op13_sentencepiece,
    )
}

#: The 64 code points from U+00C0 on, and a one-byte stand-in for each, as fixed values: edit
#: distance counts bytes there, and words hold no capitals, digits or signs.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_`{|}~"[:64]

SQL: dict[str, str] = {
    "op4_license_scan": scan_sql(),
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY plain) AS keep_id,
               count(*) OVER (PARTITION BY plain) AS group_size,
               row_number() OVER (PARTITION BY plain ORDER BY doc_id) = 1 AS kept,
               sha256(plain) AS text_sha256
        FROM t
    """,
    "op11_spelling_variants": rf"""
        WITH RECURSIVE codes AS (
            SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS code
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id,
                   translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{6,}}')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ), known AS (
            SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM runs GROUP BY id, run
        ), drawn AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(1, strlen(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
                lambda c, b: xor(c // 256, code[(xor(c, b) % 256) + 1]))) AS draw
            FROM known, codes
        ), words AS (
            SELECT CASE WHEN draw % 199 = 0
                        THEN substring(run, 1, draw % length(run)) || substring(run, draw % length(run) + 2)
                        ELSE run END AS word, sum(n)::BIGINT AS n
            FROM drawn GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
        ), flat AS (
            SELECT word, n, length(word) AS size, translate(word, '{_WIDE}', '{_NARROW}') AS bytes FROM words
        ), near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n
            FROM flat a JOIN flat b ON b.size = a.size AND levenshtein(a.bytes, b.bytes) = 1
            UNION ALL
            SELECT a.word, a.n, b.word, b.n FROM flat a JOIN flat b ON b.size = a.size + 1 AND levenshtein(a.bytes, b.bytes) = 1
            UNION ALL
            SELECT a.word, a.n, b.word, b.n FROM flat a JOIN flat b ON b.size = a.size - 1 AND levenshtein(a.bytes, b.bytes) = 1
        ), best AS (
            SELECT word, count(*) AS n_near, min(struct_pack(d := -other_n, form := other)) AS best FROM near GROUP BY word
        ), forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -best.d >= 5 * w.n THEN best.form END AS form, CASE WHEN -best.d >= 5 * w.n THEN -best.d END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ), steps AS (
            SELECT word, word AS root FROM forms
            UNION ALL
            SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL
        ), roots AS (
            SELECT s.word, s.root FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """,
    "op12_fill_in_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h
            FROM documents
        ), d AS (
            SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS u,
                   ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS v,
                   ('0x' || substr(h, 17, 8))::BIGINT % 100 AS w, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS x
            FROM t
        ), f AS (
            SELECT doc_id, t, n, least(u, v) AS a, greatest(u, v) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR w >= 90
                        THEN 'plain' WHEN x < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                   WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
                   ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a)
               END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM f
    """,
}
