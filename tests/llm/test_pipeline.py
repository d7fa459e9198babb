"""The pipeline stage by stage against brute force, and the registered queries."""

import ast
import pathlib

import pytest
from compare import compare, duck
from test_exact_and_near import fingerprint, plain, roots
from test_language_and_packing import PATH, pieces_are_whole
from test_search_suffix_html import brute_leaks

import __spark_entry__ as entry
import corpus_pipeline
from breachline.llm import catalog
from breachline.llm.tokens import tokenizer
from breachline.settings import cut

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids_of(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(-1, None, "en", "s", 0), (-2, "12 34", None, None, None), (-3, None, None, None, None),
           (10_000, docs.first().text, "en", "s", 1), (10_000, docs.first().text, "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}

    def step(name, before):
        out = cut(stages[name](spark, before, SF))
        assert out.columns == COLUMNS
        return out, {r.doc_id: r.text for r in before.collect()}

    kept, texts = step("language", docs)
    assert ids_of(kept) == set(texts) - {-1, -2, -3}
    before = kept
    kept, texts = step("exact_dedup", before)
    first = {}
    for i in sorted(texts):
        first.setdefault(plain(texts[i]), i)
    assert ids_of(kept) == set(first.values()) and kept.count() == len(first)
    before = kept
    kept, texts = step("near_dedup", before)
    order = sorted(texts)
    assert ids_of(kept) == {order[r] for r in roots([fingerprint(texts[i]) for i in order])}
    before = kept
    kept, texts = step("decontamination", before)
    assert ids_of(kept) == set(texts) - {d for d, _ in brute_leaks(texts, items)} < set(texts)
    packed = stages["packing"](spark, kept, SF).collect()
    encode = tokenizer(PATH).encode
    pieces_are_whole(packed, {
        r.doc_id: encode(r.text, add_special_tokens=False).ids + [0] for r in kept.collect()
    })


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_packs_what_the_stages_keep(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "exact_dedup", "near_dedup", "decontamination", "packing"
    ]


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    assert compare(catalog.PLANS[name](spark, SF), duck(SF), catalog.SQL[name]) is None


def test_registered_once_each():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.PLANS)
    assert numbers == list(range(1, 14))
    assert set(catalog.PLANS) | {"pipeline"} <= set(entry.queries())


def test_nothing_else_imports_this_folder():
    root = pathlib.Path(entry.__file__).parent
    for path in [*root.glob("breachline/**/*.py"), *root.glob("tests/*.py")]:
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else (
                [node.module or ""] if isinstance(node, ast.ImportFrom) else [])
            assert not any(".llm" in n or n == "corpus_pipeline" for n in names), path
