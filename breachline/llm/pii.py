"""Personal data: base patterns, and boosted trees over overlapping candidate spans.

Base spans follow fixed patterns and checks and always stay. Generators with high recall
propose further spans in looser forms (written-out addresses, numbers without a plus, other
separators). Boosted trees judge them by format and context. What base spans already cover
teaches nothing about the rest, so the trees learn from masked spans: base spans of a bounded
sample of documents are rewritten into loose forms in their own surroundings, which are
personal data that no base pattern sees. Rewritten forms that break a rule (a wrong check
digit, listed numbers, a number after the name of something else) are the harder negatives,
candidates beside the base spans of the documents the others. The threshold of each kind is
the lowest score that keeps the wanted precision on values held back from the fit, and lies
midway between that score and the next lower one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import text_of
from breachline.llm.spans import add_matches
from breachline.llm.trees import boosted_score
from breachline.settings import cut

KINDS = ["email", "ip", "card", "phone"]

#: The contract's patterns. A start inside a run of its first class can only match what the
#: run's start matches, so it is skipped; possessive runs give the same matches in one pass.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Generators of candidates; every repetition is bounded.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}[\x20]?(?:@|[\[({](?:at|AT)[\])}])[\x20]?[\p{L}0-9-]{1,63}"
    r"(?:[\x20]?(?:\.|[\[({](?:dot|DOT)[\])}])[\x20]?[\p{L}0-9-]{1,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"
    r"|[0-9]{1,3}(?:[\x20]?[.,][\x20]?[0-9]{1,3}){3})(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{0,3}[0-9]{4}){2}[\x20._/-]{0,3}[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:00[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-]?[0-9]{4}"
    r"(?![0-9])",
}

# Words near personal data of each kind.
CONTEXT = {
    "email": ["mail", "contact", "write to", "@"],
    "ip": ["ip", "host", "server", "address", "from"],
    "card": ["card", "visa", "credit", "payment", "account"],
    "phone": ["phone", "tel", "call", "fax", "mobile", "+"],
}

# Words before numbers that are no personal data.
HARMLESS = ["order", "isbn", "page", "version", "item", "part", "serial", "invoice", "build", "ticket"]

#: Documents drawn by hash for the fit, rounds and depth of the trees, wanted precision.
SAMPLE_DOCS = 20_000
ROUNDS = 20
DEPTH = 3
PRECISION = 0.98

_LISTED = "array<struct<kind:string,start:bigint,stop:bigint>>"
_FEATURES = [
    "kind", "length", "digits", "letters", "separators", "groups", "luhn", "octets", "plus",
    "bracket", "commas", "blanks", "colons", "domain", "glued_before", "glued_after",
    "near_email", "near_ip", "near_card", "near_phone", "near_harmless",
]


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)

    def weigh(acc: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit * 2 > 9, digit * 2 - 9).otherwise(digit * 2)
        return acc + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), weigh) % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_ADDRESS = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _holds(kind: str, value: Column) -> Column:
    """The check a base match must pass."""
    if kind == "ip":
        return value.rlike(_ADDRESS)
    if kind == "card":
        return F.when(_digits(value).between(13, 19), luhn(value)).otherwise(False)
    if kind == "phone":
        return _digits(value).between(9, 15)
    return F.lit(True)


def _join(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["stop"]) & (span["start"] < o["stop"]))


def find_spans(
    docs: DataFrame, id_col: str, text_col: str, keep_text: bool = False, context: bool = False
) -> DataFrame:
    """Per row the ``id``, ``base_<kind>`` spans, and ``candidates`` with their features.

    With ``context`` base spans also hold their value and the text next to it.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    at = F.contains("text", F.lit("@"))
    # a digit is the cheap sign of every other kind
    written = F.col("text").rlike(r"[\[({](?:at|AT)[\])}]") | at
    digit = F.col("text").rlike("[0-9]")
    gates = {"email": at, "phone": F.contains("text", F.lit("+"))}
    loose_gates = {"email": written}
    found = add_matches(
        source, "text",
        {**{f"base_{k}": BASE[k] for k in KINDS}, **{f"loose_{k}": LOOSE[k] for k in KINDS}},
        {**{f"base_{k}": gates.get(k, digit) for k in KINDS},
         **{f"loose_{k}": loose_gates.get(k, digit) for k in KINDS}},
    )

    def holding(k: str) -> Column:
        return F.transform(
            F.filter(f"base_{k}", lambda s: _holds(k, s["value"])),
            lambda s: F.struct(
                F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                *[s[c].alias(c) for c in ("value", "before", "after") if context],
            ),
        )

    def describe(k: str, s: Column) -> Column:
        value, near = s["value"], F.lower(s["before"])
        number = _digits(value)
        words = {
            f"near_{c}": reduce(or_, [F.contains(near, F.lit(w)) for w in listed])
            for c, listed in {**CONTEXT, "harmless": HARMLESS}.items()
        }
        features = {
            "kind": F.lit(KINDS.index(k)),
            "length": F.length(value),
            "digits": number,
            "letters": F.length(F.regexp_replace(value, r"\P{L}", "")),
            "separators": F.length(F.regexp_replace(value, r"[\p{L}0-9]", "")),
            "groups": F.regexp_count(value, F.lit("[0-9]+")),
            "luhn": F.when(number.between(12, 19), luhn(value)).otherwise(False),
            "octets": F.regexp_replace(value, "[\\x20,]+", "").rlike(_ADDRESS),
            "plus": s["before"].rlike(r"\+[0-9]{0,3}[\x20]?$"),
            "bracket": F.contains(value, F.lit("(")),
            "commas": F.regexp_count(value, F.lit(",")),
            "blanks": F.regexp_count(value, F.lit(r"[\x20]")),
            "colons": F.regexp_count(value, F.lit(":")),
            "domain": value.rlike(r"\p{L}{2}$"),
            "glued_before": s["before"].rlike(r"[\p{L}0-9_=\"/.-]$"),
            "glued_after": s["after"].rlike(r"^[\p{L}0-9_\"/-]"),
            **words,
        }
        return F.struct(
            F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
            *[features[f].cast("double").alias(f"f_{f}") for f in _FEATURES],
        )

    def described(k: str) -> Column:
        return F.transform(f"loose_{k}", lambda s: describe(k, s))

    candidates = F.concat(*map(described, KINDS))
    return found.withColumns({f"base_{k}": holding(k) for k in KINDS}).select(
        "id", *["text"] * keep_text, *[f"base_{k}" for k in KINDS], candidates.alias("candidates")
    )


@dataclass
class Judge:
    """Boosted trees and the threshold of each kind; without trees nothing is added."""

    model: GBTClassificationModel | None = None
    least: dict[str, float] = field(default_factory=dict)

    def accepts(self, candidate: Column) -> Column:
        if self.model is None:
            return F.lit(False)
        score = boosted_score(self.model, lambda i: candidate[f"f_{_FEATURES[i]}"])
        least = F.lit(2.0)
        for kind, value in self.least.items():
            least = F.when(candidate["kind"] == kind, value).otherwise(least)
        return score >= least


def _rewritten(base: DataFrame) -> DataFrame:
    """``seed, kind, text, place, stop, label``: base values in loose forms, amid their own neighbours."""
    value, word = F.col("value"), F.col("word")
    digits = F.regexp_replace(value, "[^0-9]", "")
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    last = F.right(digits, F.lit(10))
    area, middle, line = F.left(last, F.lit(3)), F.substring(last, 4, 3), F.right(last, F.lit(4))
    # the same address without the digits and signs that most of the base spans may share
    written = F.regexp_replace(local, "[^A-Za-z]", ""), F.regexp_replace(host, "[0-9]", "")
    hexes = F.sha2(value, 256)
    long = F.concat_ws(":", *[F.substring(hexes, 1 + 4 * i, 4) for i in range(8)])
    # one more than the last digit breaks the check
    broken = F.concat(F.left(digits, F.length(digits) - 1), (F.right(digits, F.lit(1)).cast("int") + 1) % 10)

    def fours(number: Column, sign: str) -> Column:
        return F.regexp_replace(number, "([0-9]{4})(?=[0-9])", "$1" + sign)

    def spaced(sign: str) -> Column:
        return F.regexp_replace(value, r"[.]", sign)

    def phone(form: str) -> Column:
        return F.when(F.length(digits) >= 10, F.format_string(form, area, middle, line))

    forms = {
        "email": [
            *[(F.concat(user, F.lit(at), F.regexp_replace(site, "[.]", dot)), 1)
              for user, site in ((local, host), written) for at, dot in ((" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."), (" {AT} ", "(dot)"), (" (at) ", " . "))],
            (F.concat(word, F.lit(" @ "), F.length("before"), F.lit("."), F.length(host)), 0),
            (F.concat(word, F.lit("@"), F.length(local), F.lit("."), F.length(host), F.lit(".0")), 0),
        ],
        "ip": [
            (spaced(" . "), 1), (spaced(" ."), 1), (spaced(". "), 1), (long, 1),
            (spaced(", "), 0), (spaced(","), 0),
            (F.format_string("%d:%d:%d:%d", *[F.length(c) for c in ("before", "after", "value")], F.length("word")), 0),
        ],
        "card": [
            *[(fours(digits, sign), 1) for sign in (".", "/", "_", " - ", "  ")],
            *[(fours(broken, sign), 0) for sign in (".", "/", "_", " - ", "-", " ", "")],
        ],
        "phone": [(phone(f), 1) for f in ("%s-%s-%s", "(%s) %s-%s", "%s.%s.%s", "%s %s %s", "001 %s %s %s", "%s/%s %s")],
    }
    #: the same numbers behind the name of something else
    named = {
        "phone": [(phone(f), 0) for f in ("%s-%s-%s", "%s %s %s", "%s.%s.%s")],
        "card": [(fours(broken, " "), 0)],
    }

    def built(kind: str, before: Column, listed: list) -> list[Column]:
        return [
            F.when(F.col("kind") == kind, F.struct(
                F.concat(before, form, F.col("after")).alias("text"), F.length(before).alias("place"),
                (F.length(before) + F.length(form)).alias("stop"), F.lit(float(label)).alias("label"),
            )) for form, label in listed
        ]

    before = F.when(F.col("kind") == "phone", F.regexp_replace("before", r"[+0-9]+$", "")).otherwise(F.col("before"))
    harmless = F.concat(word, F.lit(" "))
    lines = [x for k, listed in forms.items() for x in built(k, before, listed)]
    lines += [x for k, listed in named.items() for x in built(k, harmless, listed)]
    words = F.array(*map(F.lit, HARMLESS))
    table = base.withColumn("word", F.element_at(words, F.pmod(F.xxhash64("value"), F.lit(len(HARMLESS))).cast("int") + 1))
    table = table.withColumn("seed", F.xxhash64("kind", "value"))
    return table.select("seed", "kind", F.inline(F.filter(F.array(*lines), lambda x: x["text"].isNotNull())))


def fit_judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, depth: int = DEPTH,
    precision: float = PRECISION,
) -> Judge:
    """Fit on masked base spans of about ``sample_docs`` documents and the candidates beside
    them; a quarter of the values calibrates. A kind without base spans adds nothing."""
    total = docs.count()
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1_000_003)) / 1_000_003
    sample = docs.where(draw < min(1.0, sample_docs / max(total, 1)))
    spans = cut(find_spans(sample, id_col, text_col, context=True), "spans")
    every = spans.withColumn("base", F.concat(*[F.col(f"base_{k}") for k in KINDS]))
    beside = every.select(F.inline(F.filter("candidates", lambda c: ~_overlaps(c, F.col("base")))))
    base = every.select(F.inline("base")).select("kind", "value", "before", "after").distinct()
    lines = cut(_rewritten(base), "lines")
    lines = lines.withColumn("line", F.struct("seed", "kind", "place", "stop", "label"))
    masked = find_spans(lines, "line", "text").select(
        "id", F.concat(*[F.col(f"base_{k}") for k in KINDS]).alias("base"), "candidates"
    )
    masked = masked.select("id", F.explode(F.filter("candidates", lambda c: (
        (c["kind"] == F.col("id.kind")) & (c["start"] < F.col("id.stop")) & (c["stop"] > F.col("id.place"))
        & ~_overlaps(c, F.col("base"))))).alias("c"))
    features = [f"f_{f}" for f in _FEATURES]
    rows = masked.select("id.seed", "c.kind", *[F.col(f"c.{f}") for f in features], "id.label").unionByName(
        beside.select(F.xxhash64("start", *features).alias("seed"), "kind", *features, F.lit(0.0).alias("label")))
    labelled = cut(rows.select(
        F.col("kind").alias("kind_name"), *[F.col(f"f_{f}").alias(f) for f in _FEATURES], "label",
        (F.pmod("seed", F.lit(4)) == 0).alias("held"),
    ), "candidates")
    if labelled.where("NOT held").select("label").distinct().count() < 2:
        return Judge()
    table = VectorAssembler(inputCols=_FEATURES, outputCol="features").transform(labelled)
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=42).fit(table.where("NOT held"))
    score = boosted_score(model, lambda i: F.col(_FEATURES[i]))
    steps = (
        labelled.where("held").groupBy("kind_name", (F.floor(score * 100) / 100).alias("score"))
        .agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("n")).collect()
    )
    least = {}
    for kind in KINDS:
        right = n = 0
        found = sorted((r for r in steps if r.kind_name == kind), key=lambda r: -r.score)
        lower = [r.score for r in found[1:]] + [0.0]
        for row, below in zip(found, lower):
            right, n = right + row.right, n + row.n
            if right >= precision * n:
                least[kind] = max((row.score + below) / 2, 0.5)
    return Judge(model, least)


def scan_personal_data(
    docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``<id_col>, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``.

    The counts and the hash are those of the base spans; ``spans`` also lists the candidates
    the judge accepted that no base span of any kind overlaps, ``n_added`` of them. Null texts
    count as empty; repeated rows are scanned row by row; an empty table gives no rows and,
    having nothing to learn from, no added spans. Other columns are not read.
    """
    lists = [F.col(f"base_{k}") for k in KINDS]
    found = find_spans(docs, id_col, text_col)
    found = found.withColumn("base", F.concat(*lists).cast(_LISTED)).withColumn(
        "added",
        F.transform(
            F.filter("candidates", lambda c: judge.accepts(c) & ~_overlaps(c, F.col("base"))),
            lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")),
        ).cast(_LISTED),
    )
    order = F.array(*map(F.lit, KINDS))
    merged = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("place"), s["start"].alias("start"),
        s["stop"].alias("stop"), s["kind"].alias("kind"),
    )))
    return found.select(
        F.col("id").alias(id_col),
        *[F.size(f"base_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_join(F.col("base")), 256).alias("base_sha256"),
        _join(merged).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


def redact(
    docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text",
    mask: tuple[str, str] = ("[", "]"),
) -> DataFrame:
    """``<id_col>, text``: every span replaced by its kind; of overlapping ones the first."""
    found = find_spans(docs, id_col, text_col, keep_text=True)
    every = F.concat(*[F.col(f"base_{k}") for k in KINDS]).cast(_LISTED)
    added = F.transform(
        F.filter("candidates", lambda c: judge.accepts(c)),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")),
    ).cast(_LISTED)
    spans = F.array_sort(F.transform(F.concat(every, added), lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("order"), s["stop"].alias("stop"), s["kind"].alias("kind")
    )))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        between = F.substring("text", (acc["at"] + 1).cast("int"),
                              F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        label = F.when(new, F.concat(F.lit(mask[0]), s["kind"], F.lit(mask[1]))).otherwise("")
        return F.struct(F.concat(acc["done"], between, label).alias("done"),
                        F.greatest(acc["at"], s["stop"]).alias("at"))

    done = found.select("id", "text", F.aggregate(spans, start, step).alias("r"))
    rest = F.substring("text", (F.col("r.at") + 1).cast("int"), F.length("text"))
    return done.select(F.col("id").alias(id_col), F.concat("r.done", rest).alias("text"))
