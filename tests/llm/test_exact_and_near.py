"""Exact and near duplicates against brute force, and the shapes a table may have."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from breachline.llm import simhash
from breachline.llm.components import components
from breachline.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from breachline.llm.simhash import (
    close_links, drop_near_duplicates, majority_bits, near_duplicates, shingle_hashes,
)
from breachline.settings import cut

SHAPE = "doc_id bigint, text string, lang string, digest string, row_number int"
ROWS = [
    (5, "a  b\tc", None, "x", 1),
    (3, "a b c", "en", None, 2),
    (3, "a b c", "en", None, 2),
    (None, "a b c", None, None, None),
    (9, None, None, None, None),
    (8, "", None, None, None),
    (7, "   ", None, None, None),
    (1, "é " * 30_000, "fr", "y", 3),
    (2, "é " * 30_000, "fr", "y", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SHAPE).repartition(3)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_duplicates(docs):
    got = exact_duplicates(docs, fan_in=2).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for doc_id, text, *_ in ROWS:
        groups.setdefault(hashlib.sha256(plain(text).encode()).hexdigest(), []).append(doc_id)
    for row in got:
        ids = groups[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == min(i for i in ids if i is not None)
    kept = sorted((r.text_sha256, r.doc_id) for r in got if r.kept)
    assert kept == sorted((h, min(i for i in ids if i is not None)) for h, ids in groups.items())


def test_drop_exact_duplicates(docs):
    got = drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 7, 8]


def test_empty_tables(spark, docs):
    empty = docs.where("false")
    assert exact_duplicates(empty).count() == 0
    assert drop_exact_duplicates(empty).count() == 0
    assert near_duplicates(empty).count() == 0
    assert drop_near_duplicates(empty).count() == 0


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or (
        [b" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps):
    """Smallest index reachable over links of at most four bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_bits():
    texts = ["", "One", "one two three four", "one two three four five", "é ß É ẞ x y", "a\x1cb c\x85d e f"]
    for text in texts:
        bits = majority_bits([shingle_hashes(text.encode())])
        assert int(bits.view(np.uint64)[0]) == fingerprint(text)


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{rng.integers(50)}" for _ in range(300)) for _ in range(6)]
    texts = []
    for i in range(80):
        words = base[i % 6].split()
        for _ in range(i % 5):
            words[rng.integers(300)] = "new"
        texts.append(" ".join(words))
    texts += [None, "", " \n", "solo", "Solo"]
    rows = [(100 - i, t) for i, t in enumerate(texts)]
    rows.sort()
    fps = [fingerprint(t) for _, t in rows]
    want = {rows[i][0]: rows[r][0] for i, r in enumerate(roots(fps))}
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {
        rows[i][0]: f"{fp:016x}" for i, fp in enumerate(fps)
    }
    assert len(set(want.values())) < len(rows)


@pytest.mark.parametrize("compared", [512, 40])
def test_blocks_of_any_size_lose_no_link(spark, compared):
    rng = np.random.default_rng(1)
    fps = set()
    for base in rng.integers(0, 2**62, 3):
        for width, flips in ((64, 9), (12, 7)):
            for _ in range(50):
                fp = int(base)
                for bit in rng.integers(0, width, rng.integers(0, flips)):
                    fp ^= 1 << int(bit)
                fps.add(fp)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    unsigned = [f & (1 << 64) - 1 for f in fps]
    want = {fps[i]: fps[r] for i, r in enumerate(roots(unsigned))}
    links = close_links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), compared)
    found = {r.node: r.root for r in components(links).collect()}
    assert {f: found.get(f, f) for f in fps} == want


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_exploded_blocks_are_not_broadcast(docs, monkeypatch):
    plans = []

    def planned(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return cut(df, name)

    monkeypatch.setattr(simhash, "cut", planned)
    result = near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    of = {name: plan for name, plan in plans if name in ("blocks", "classes")}
    assert len(of) == 2
    for plan in [*of.values(), result]:
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_drop_near_duplicates_keeps_one_row(docs):
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # ids 7, 8 and 9 have no word and share fingerprint zero
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]


def test_planted_copies_of_the_tables_are_dropped(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    want = {texts[r][0] for r in roots([fingerprint(t) for _, t in texts])}
    assert len(want) < len(texts)
    assert {r.doc_id for r in drop_near_duplicates(rows).collect()} == want


@pytest.mark.parametrize("hubs", [1, 3, 10_000])
def test_components_with_hubs(spark, hubs):
    rng = np.random.default_rng(9)
    links = [(0, int(v)) for v in range(1, 60)] + [(200 + k, 201 + k) for k in range(40)]
    links += [tuple(map(int, rng.integers(300, 400, 2))) for _ in range(45)] + [(500, 500), (58, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint"), hubs).collect()}
    want = {n: n for link in links if link[0] != link[1] for n in link}
    for _ in links:
        for a, b in links:
            if a != b:
                low = min(want[a], want[b])
                want = {n: low if r in (want[a], want[b]) else r for n, r in want.items()}
    assert got == want
