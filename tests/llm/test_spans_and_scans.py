"""Personal data, secrets and licences: base spans by brute force, learned parts by cases."""

import hashlib
import random
import re
import string

import pytest

from breachline.llm import licenses
from breachline.llm.licenses import ANCHORS, RULES, SENTENCES, scan_licenses
from breachline.llm.pii import KINDS, Judge, fit_judge, redact, scan_personal_data
from breachline.llm.secret_scan import find_candidates, fit_forest, scan_secrets
from breachline.llm.spans import add_matches

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0


def base_spans(text):
    out, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return [f"{k}:{a}:{b}" for k, a, b in out]


def check_base(rows, texts):
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s.startswith(k + ":") for s in want) for k in KINDS
        ]
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and len(spans) == len(want) + r.n_added
        order = [(KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    parts = ["a@b.co", "x_y@d.e-f.", "@", "1.2.3.4", ".256.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 010-9999", "+44", "()..- ", " ", "é", "日", "🙂", "9", "00", ".", "-", "%", "\n", "+", "\x00"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for i in range(800)}
    texts |= {900: None, 901: "", 902: "1.2.3.4 " * 900, 903: "9" * 50_000, 904: "a" * 50_000 + "@b.c",
              905: "1 " * 20_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check_base(scan_personal_data(docs, Judge()).collect(), texts)


@pytest.fixture(scope="module")
def judge(spark):
    return fit_judge(spark.read.parquet(f"{SF2}/documents.parquet"))


def test_learned_spans(spark, judge):
    assert judge.model is not None and judge.least
    texts = {
        1: "please call 555-123-4567 now",
        2: "write to joe [at] example [dot] org",
        3: "order 12 of 30 on page 4 and version 1.2.3 of the tool",
        4: "mail a@b.co and call +1 (555) 010-9999",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in scan_personal_data(docs, judge).collect()}
    check_base(rows.values(), texts)
    assert rows[1].n_added == 1 and rows[1].spans == "phone:12:24"
    assert rows[2].n_added == 1 and rows[2].spans.startswith("email:")
    assert rows[3].n_added == 0 and rows[4].n_added == 0
    got = {r.doc_id: r.text for r in redact(docs, judge).collect()}
    assert got[1] == "please call [phone] now" and got[3] == texts[3]
    assert got[4] == "mail [email] and call [phone]"


def test_learned_spans_on_injected_cases(spark, judge):
    rng = random.Random(4)

    def card(right):
        while True:
            digits = [rng.randrange(10) for _ in range(16)]
            if luhn(digits) == right:
                return "".join(map(str, digits))

    def fours(number, sign):
        return sign.join(number[i : i + 4] for i in range(0, 16, 4))

    def phone(form):
        return form.format(rng.randint(201, 989), rng.randint(200, 999), rng.randint(0, 9999))

    texts, wanted = [], []

    def add(before, value, after, kind):
        texts.append(before + value + after)
        wanted.append(kind and f"{kind}:{len(before)}:{len(before) + len(value)}")

    for _ in range(30):
        name = rng.choice(["maria.lopez", "j_smith", "info", "k.tanaka88", "office"])
        host = rng.choice(["example", "north-mill", "unimail", "gardenia"])
        add("write to ", f"{name} [at] {host} [dot] org", " please", "email")
        add("the office is ", f"{name}(at){host}.co.uk", "", "email")
        add("ask ", f"{name} @ {host}.net", " for it", "email")
        add("my number: ", phone("{}-{}-{:04d}"), " until six", "phone")
        add("ring ", phone("({}) {} {:04d}"), ", ask for Ann", "phone")
        add("paid by ", fours(card(True), rng.choice([".", " / "])), " today", "card")
        add("seen at ", " . ".join(str(rng.randrange(256)) for _ in range(4)), " again", "ip")
        add("seen at ", ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8)), " again", "ip")
        add("scores of ", ", ".join(str(rng.randrange(200)) for _ in range(4)), " points", None)
        add("lunch ", f"@ {rng.randint(1, 12)}.{rng.randint(10, 59)}", " today", None)
        add("account ", fours(card(False), " "), " closed", None)
        add("number ", fours(card(False), "."), "", None)
        add("order ", phone("{}-{}-{:04d}"), " shipped", None)
        add("took ", ":".join(str(rng.randint(10, 59)) for _ in range(4)), " in all", None)
        add("in ", f"{rng.randint(1900, 2030)}-10-{rng.randint(10, 28)}", " it rained", None)
        add("release ", f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}", " is out", None)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = right = 0
    for r in scan_personal_data(docs, judge).collect():
        spans = [x for x in r.spans.split(",") if x]
        found, right = found + len(spans), right + (wanted[r.doc_id] in spans)
    assert right >= 0.9 * sum(w is not None for w in wanted) and right >= 0.9 * found


def test_scans_of_empty_and_odd_tables(spark):
    shape = "doc_id bigint, text string, candidates int, base_email string, id string, value string"
    rows = [(None, None, 1, "x", "y", "z"), (1, "", None, None, None, None), (1, "", None, None, None, None)]
    docs = spark.createDataFrame(rows, shape)
    for table, n in ((docs, 3), (docs.where("false"), 0)):
        assert scan_personal_data(table, fit_judge(table)).count() == n
        assert scan_secrets(table, fit_forest(table)).count() == n
        assert scan_licenses(table).count() == n
    assert {r.spans for r in scan_personal_data(docs, Judge()).collect()} == {""}


def test_matches_of_many_in_one_text(spark):
    text = "".join(f"é{'x' * (i % 3)}{i} " for i in range(1500))
    df = add_matches(spark.createDataFrame([(text,)], "text string"), "text", {"n": "[0-9]+"}, before=2, after=1)
    got = [(s.start, s.stop, s.value) for s in df.first().n]
    assert got == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]


def test_forest_on_held_back_documents(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    model = fit_forest(docs.where("doc_id % 4 != 0"))
    held = docs.where("doc_id % 4 = 0")
    texts = {r.doc_id: r.text for r in held.collect()}
    right = found = planted = 0
    for r in scan_secrets(held, model).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r.secrets.split(",") if s]
        want = [m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', texts[r.doc_id])]
        right += len(set(spans) & set(want))
        found, planted = found + len(spans), planted + len(want)
    assert planted and right >= 0.9 * planted and right >= 0.9 * found


def candidate_spans(text):
    """Runs of 16 and more (without ``name=``), and quoted values that hold no such run."""
    run, out = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}"), []
    for m in run.finditer(text):
        named = re.match(r"[A-Za-z][A-Za-z0-9_.-]*=(?=[^=].{15,})", m[0])
        out.append((m.start() + (named.end() if named else 0), m.end()))
    for m in re.finditer(r"[=:][\x20\t]{0,4}(\"[^\"\r\n]+\"|'[^'\r\n]+')", text):
        if not run.search(m[1][1:-1]):
            out.append((m.start(1) + 1, m.end(1) - 1))
    return sorted(out)


def test_candidates_equal_brute_force(spark):
    rng = random.Random(8)
    parts = ['"', "'", " = ", "=", ": ", "\n", " ", "a", "Zx9", "key", "é", "🙂", "abcdefgh12345678", "p w!", "\t", "/", "\r"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts += ["", 'password = "S3cr3t!pw"', "TOKEN=0123456789abcdef0123", '="' * 20_000, "='" * 9_999 + '"x']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in find_candidates(docs, "doc_id", "text").collect():
        assert [(c.start, c.stop) for c in r.candidates] == candidate_spans(texts[r.id]), texts[r.id][:200]


def test_forest_on_injected_secrets(spark):
    """Names, values and lines of the cases are not those the findings are built from."""
    rng = random.Random(5)
    prose = ["The river runs past the mill", "we met at noon and left", "Configuration of the service follows", "see below"]
    plain = string.ascii_letters + string.digits

    def some(n, letters=plain):
        return "".join(rng.choice(letters) for _ in range(n))

    texts, secret = [], []

    def add(head, value, tail, is_secret):
        head = rng.choice(prose) + rng.choice([" ", "\n", ". "]) + head
        texts.append(head + value + tail + " " + rng.choice(prose))
        secret.append(f"{len(head)}:{len(head) + len(value)}" if is_secret else None)

    for _ in range(40):
        add('user_password = "', some(rng.randint(8, 12), plain + "!@#$%^&*"), '"', True)
        add("client_secret: '", some(32), "'", True)
        add('"db_passwd": "', rng.choice(["Monday", "Garden", "Berlin"]) + some(3, "123456789") + "!", '",', True)
        add("export ACCESS_TOKEN=", some(40, "0123456789abcdef"), "", True)
        add("key is ", "ghp_" + some(36), " ok", True)
        add("Authorization: Bearer ", some(48), "", True)
        add("commit ", some(40, "0123456789abcdef"), " fixes it", False)
        add("sha256sum: ", some(64, "0123456789abcdef"), "", False)
        add('placeholder="', rng.choice(["Enter your name", "Search here", "E-mail"]), '"', False)
        add('password = "', rng.choice(["<your password>", "changeme", "${DB_PASSWORD}"]), '"', False)
        add('href="', rng.choice(["/docs/guide/install.html", "https://www.cities.net/map/7"]), '"', False)
        add("token = ", rng.choice(["request.session.get_token", "read_token_from_config"]), "()", False)
        add("no ", some(18, "0123456789"), " on", False)
        add("call ", rng.choice(["internationalization", "compareDocumentPosition"]), " twice", False)
    model = fit_forest(spark.read.parquet(f"{SF2}/documents.parquet"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = right = 0
    for r in scan_secrets(docs, model).collect():
        spans = [x for x in r.secrets.split(",") if x]
        found, right = found + len(spans), right + (secret[r.doc_id] in spans)
    assert right >= 0.9 * sum(s is not None for s in secret) and right >= 0.9 * found


def test_forest_from_labelled_findings(spark):
    rows = [(i, f'api_key = "{hashlib.sha1(str(i).encode()).hexdigest()}" and internationalization{i}') for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(hashlib.sha1(str(i).encode()).hexdigest(), True) for i in range(60)]
    labels += [(f"internationalization{i}", False) for i in range(60)]
    model = fit_forest(docs, spark.createDataFrame(labels, "value string, is_secret boolean"))
    assert all(r.n_secrets == 1 and r.n_candidates == 2 for r in scan_secrets(docs, model).collect())


def test_every_sentence_has_an_anchor_and_a_rule():
    used = {token for rule, _ in RULES for token in rule.split()}
    assert used == set(SENTENCES)
    for listed in SENTENCES.values():
        for sentence in listed:
            assert any(a in sentence for a in ANCHORS), sentence
            assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", sentence)


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and"
    " associated documentation files (the \"Software\"), to deal\nin the Software without restriction,"
    " including without limitation the rights\nto use, copy, modify, merge, publish, distribute,"
    " sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
    "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this"
    " permission notice shall be included in all\ncopies or substantial portions of the Software.\n"
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:\n1. Redistributions of source code must retain the"
    " above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions"
    " in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse"
    " or promote products derived from this software without specific prior written permission.\n"
)


def test_licences(spark):
    cases = {
        "x y.\nReleased under the MIT License.": "MIT",
        "| a | b |\nLicensed under the Apache License, Version 2.0.": "Apache-2.0",
        MIT: "MIT",
        BSD: "BSD-2-Clause",
        BSD + THIRD: "BSD-3-Clause",
        "LICENSED UNDER CC BY-NC 4.0. Released under the MIT License!": "CC-BY-NC-4.0,MIT",
        "I read about the MIT License today.": "",
        "": "",
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = {r.doc_id: r.licences for r in scan_licenses(docs).collect()}
    assert got == dict(enumerate(cases.values()))
    assert "{" not in licenses.scan_sql()
