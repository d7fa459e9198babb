"""Leak search, repeated byte strings and page rendering against brute force and cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from breachline.llm import decontaminate
from breachline.llm.decontaminate import Index, drop_leaks, find_leaks, question_words
from breachline.llm.html_layout import extract_text, render
from breachline.llm.suffix_dedup import LENGTH, factors, repeated_spans

SF = "/root/testdata/sf0.001"


def postings_of(lists):
    parts = [{"uid": i, "item": i, "row": i, "words": [], "asked": 0} for i in range(300)]
    rows = [{"uid": u, "term": t, "impact": w} for t, listed in lists.items() for u, w in listed]
    return Index(parts, rows)


def test_wand_retrieves_what_full_scoring_retrieves():
    rng = np.random.default_rng(4)
    lists = {
        int(t): [(int(u), float(rng.random() ** 4)) for u in np.sort(rng.choice(300, rng.integers(1, 200), False))]
        for t in rng.integers(-(2**62), 2**62, 40)
    }
    index = postings_of(lists)
    for size in (1, 3, 12, 40):
        for least in (0.05, 0.5, 1.0, 3.0):
            terms = rng.choice(len(index.terms), size, False)
            scores = Counter()
            for t in terms:
                for u, w in lists[int(index.terms.view(np.int64)[t])]:
                    scores[u] += w
            want = {u for u, s in scores.items() if s >= least}
            got = index.retrieve(terms, least)
            assert {u for u, _ in got} == want
            assert all(abs(s - scores[u]) < 1e-9 for u, s in got)


def words_of(text):
    raw = "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in (text or "").lower())
    return raw.split()


def brute_leaks(docs, items):
    """Items whose question and answer words lie to 0.8 in five-word runs the document has."""
    out = set()
    for item, text in items.items():
        words = words_of(text)
        if len(words) < 5:
            continue
        asked = question_words(text.lower())
        for doc, body in docs.items():
            have = words_of(body)
            shares = []
            for part in (words[:asked], words[asked:]):
                n = min(5, len(part))
                seen = {tuple(have[i : i + n]) for i in range(len(have) - n + 1)}
                hit = [False] * len(part)
                for i in range(len(part) - n + 1):
                    if tuple(part[i : i + n]) in seen:
                        hit[i : i + n] = [True] * n
                shares.append(sum(hit) / max(1, len(hit)))
            if min(shares) >= 0.8:
                out.add((doc, item))
    return out


def test_leaks_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bodies = {r.doc_id: r.text for r in docs.collect()}
    asked = {r.item_id: r.text for r in items.collect()}
    want = brute_leaks(bodies, asked)
    got = find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    in_blocks = find_leaks(docs, items, block=7).collect()
    assert {(r.doc_id, r.item_id) for r in in_blocks} == want
    kept = {r.doc_id for r in drop_leaks(docs, items).collect()}
    assert kept == set(bodies) - {d for d, _ in want}


def test_leak_cases(spark):
    rng = random.Random(2)
    item = "What is the height of the tower in the old town square? It is forty two metres and nine."
    long_item = " ".join(f"w{rng.randint(0, 10_000)}" for _ in range(300)) + ". And this is the end of it all."
    items = spark.createDataFrame(
        [(1, item, "x"), (2, None, "x"), (3, "too short", "x"), (4, long_item, "x"), (1, item, "x")],
        "item_id int, text string, doc_id string",
    )
    filler = " ".join(f"f{rng.randint(0, 10_000)}" for _ in range(3000))
    cases = {
        "exact": (item, {1}),
        "buried": (f"{filler} {item} {filler}", {1}),
        "other case and signs": (item.upper().replace(" ", "!! "), {1}),
        "question only": (item[: item.index("?")], set()),
        "long": (f"{filler} {long_item} {filler}", {4}),
        "shuffled": (" ".join(sorted(item.split())), set()),
        "null": (None, set()),
        "empty": ("", set()),
        "clean": (filler, set()),
    }
    docs = spark.createDataFrame(
        [(name, text, 0) for name, (text, _) in cases.items()], "doc_id string, text string, item_id int"
    )
    got = {}
    for r in find_leaks(docs, items).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
    assert got == {name: want for name, (_, want) in cases.items() if want}
    assert drop_leaks(docs, items).count() == sum(not want for _, want in cases.values())
    for d, i in ((docs.where("false"), items), (docs, items.where("false"))):
        assert find_leaks(d, i).count() == 0
        assert drop_leaks(d, i).count() == d.count()


def test_question_ends():
    assert question_words("is it so? yes it is") == 3
    assert question_words("one two three. four five.") == 3
    assert question_words("one two three four five six") == 4
    assert decontaminate.PROOF_WORDS == 5


def brute_spans(texts, both):
    seen, first = Counter(), {}
    for key in sorted(texts, key=lambda k: (k is None, k)):
        data = texts[key]
        for s in range(len(data) - LENGTH + 1):
            name = hashlib.blake2b(data[s : s + LENGTH], digest_size=16).digest()
            seen[name] += 1
            first.setdefault(name, (key, s))
    out = {}
    for key, data in texts.items():
        gone = bytearray(len(data))
        for s in range(len(data) - LENGTH + 1):
            name = hashlib.blake2b(data[s : s + LENGTH], digest_size=16).digest()
            if seen[name] > 1 and (both or first[name] != (key, s)):
                gone[s : s + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def repeats():
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))

    passages = [words(n) for n in (60, 80, 100, 120, 200)]
    texts = {}
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 4)):
            p, a = rng.choice(passages), rng.randint(0, 40)
            text += words(rng.randint(0, 60)) + p[a : len(p) - rng.randint(0, 40)]
        texts[i] = text
    return texts | {60: texts[3], 61: "x" * 3000, 62: "ab" * 700, 63: "", 64: passages[4] * 2, 65: None,
                    None: passages[3], 66: "\x00" * 500 + "tail", 67: "\x00" * 499}


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("together", [1500, 6])
def test_repeated_spans_equal_brute_force(spark, repeats, keep, together):
    rows = [(k, t, "clash", 1) for k, t in repeats.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, n_bytes int").repartition(3)
    want = brute_spans({k: (t or "").encode() for k, t in repeats.items()}, keep == "none")
    got = repeated_spans(docs, keep=keep, together=together).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert any(r.n_removed for r in got)


def test_repeated_spans_of_an_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "z" * 399), (1, "z" * 399), (2, "y" * 400), (2, "y" * 400)], "doc_id int, text string")
    assert repeated_spans(docs.where("false")).count() == 0
    got = sorted((r.doc_id, r.n_removed) for r in repeated_spans(docs, keep="none").collect())
    assert got == [(1, 0), (1, 0), (2, 400), (2, 400)]


CASES = {
    "<p>a<p>b <b>c</b>d": "a\n\nb cd",
    "<ul><li>x<li>y<ol start=3><li>1<li>2</ol></ul>z": "- x\n- y\n  3. 1\n  4. 2\n\nz",
    "<table><tr><td>k<td>long value<tr><th>kkk<td>v</table>": "k    long value\nkkk  v",
    "<table><tr><td colspan=2>head<tr><td>a<td>b</table>": "head\na  b",
    "a<br><p>b</p>c<br><br>d": "a\n\nb\n\nc\n\nd",
    '<div hidden>no</div><div style="display : none">no</div><datalist>no</datalist>yes': "yes",
    "<head><title>no</title><style>p{}</style></head><body>yes<script>var a='</p>';</script>": "yes",
    "<head><meta charset=utf-8><p>yes": "yes",
    "<pre>a\n  b</pre>": "a\n  b",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "a &amp; b &nbsp;&copy; <!-- no --> c": "a & b \xa0© c",
    "<b>x</i> y</b></p> z": "x y z",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "<a href=x>l</a> <span>m</span>n": "l mn",
    "": "",
    "<": "<",
    "<table><tr><td><ul><li>p<li>q</ul><td>r</table>": "- p  r\n- q",
}


@pytest.mark.parametrize("html", CASES)
def test_render(html):
    assert render(html) == CASES[html]


def test_pages(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<div>" * 20_000 + "deep", "u"), (None, "<p>x", "u"),
            (4, "<table><tr><td>" * 500 + "cell", "u"), (5, "<p>w " * 50_000, "u")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    assert [got[i].text for i in (1, 2, 3, None, 4)] == ["", "", "deep", "x", "cell"]
    assert got[1].n_lines == 0 and got[5].n_lines == 99_999
    assert extract_text(pages.where("false")).count() == 0


def test_all_visible_text_of_real_pages(spark):
    """Whatever the layout, the words of a page are those of its visible text nodes."""
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in extract_text(pages).join(pages, "page_id").collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title|noscript)\b.*?</\1>", " ", r.html)
        import html

        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        mine = [w for w in r.text.split() if w != "-"]
        assert "".join(mine) == "".join(w for w in words if w != "-")


def test_leaks_of_items_that_share_an_identifier(spark):
    long = [f"What is the {w} of the {w}er {w}ing thing called here? It is called the {w} {w}ation of old {w}s"
            for w in ("blend", "drift", "crane")]
    half = long[0].split("?")[0] + " and something else altogether follows now"
    docs = [(1, "x " + long[0]), (2, half + ". " + long[1]), (3, long[2]), (4, "nothing of the kind")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    for ids in ((None, None, 7), (5, 5, 7)):
        items = spark.createDataFrame(list(zip(ids, long)), "item_id bigint, text string").coalesce(1)
        got = sorted((r.doc_id, r.item_id) for r in find_leaks(table, items).collect())
        assert got == [(1, ids[0]), (2, ids[1]), (3, 7)]
        assert [r.doc_id for r in drop_leaks(table, items).collect()] == [4]
        small = sorted((r.doc_id, r.item_id) for r in find_leaks(table, items, block=1).collect())
        assert small == got


def test_short_items_leak_word_by_word(spark):
    items = [(1, "Zorgol vex?"), (2, "one two three four"), (3, "..."), (4, None), (5, "zorgol  VEX"), (6, "")]
    docs = [(1, "a zorgol, vex b"), (2, "zorgol"), (3, "vex"), (4, "zero one two three fours"),
            (5, "one two three four"), (6, "two three four one"), (7, None)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.score) for r in find_leaks(table, bench).collect())
    assert got == [(1, 1, 1.0), (1, 5, 1.0), (5, 2, 1.0)]
    assert sorted(r.doc_id for r in drop_leaks(table, bench).collect()) == [2, 3, 4, 6, 7]


@pytest.mark.parametrize("html, text", [
    ('<ol start="' + "9" * 5000 + '"><li>a</ol>', "999999999. a"),
    ('<ol start="-2"><li>a<li>b</ol>', "-2. a\n-1. b"),
    ('<ol start="x"><li>a</ol>', "1. a"),
    ('<table><tr><td colspan="' + "9" * 5000 + '">a<td>b</table>', None),
    ('<p aria-hidden="true">shown</p><p hidden>not</p>', "shown"),
    ("<select><optgroup label='G'><option>a<option>b</select>c", "G\na\nb\nc"),
    ("<textarea>x\n  y</textarea>", "x\n  y"),
    ("<math><mi>x</mi><annotation>no</annotation></math>", "x"),
    ("<svg><title>no</title><desc>no</desc><text>yes</text></svg>", "yes"),
    ("<!DOCTYPE html [<!ENTITY x 'y'>]><p>a", "a"),
    ("<!doctype html><p>a [b]>", "a [b]>"),
])
def test_numbers_and_what_is_shown(html, text):
    got = render(html)
    assert got == text if text is not None else got.split() == ["a", "b"]


def factors_by_hand(texts, starts, owner, place):
    names = [texts[o][s : s + LENGTH] for o, s in zip(owner, starts)]
    pairs = list(zip(names, place))
    return ([any(n == m and q < p for m, q in pairs) for n, p in pairs],
            [any(n == m and q > p for m, q in pairs) for n, p in pairs])


def test_factors_equal_brute_force():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 2, 3, np.uint8)) * 200 for _ in range(6)]
    owner = rng.integers(0, 6, 80)
    starts = rng.integers(0, 200, 80)
    place = owner * 1000 + starts  # the same suffix may be there twice
    earlier, later = factors(texts, starts, owner, place)
    want = factors_by_hand(texts, starts.tolist(), owner.tolist(), place.tolist())
    assert earlier.tolist() == want[0] and later.tolist() == want[1]
