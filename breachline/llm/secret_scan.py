"""Secret scan: long unbroken strings and quoted values, judged by a random forest.

Every run of key characters of at least 16 is a candidate, and so is every quoted value behind
``=`` or ``:``, of any length and with any characters, that holds no such run. The forest looks
at a candidate's length, its changes between character classes, how much of it common words
cover, whether it lies in a path or address, and the words before it. It learns from labelled
findings. Without given ones, they are built: keys, passwords, hashes, identifiers and paths
derived from a bounded number of documents are set into lines of code, settings and prose, so
that how a line was built says whether it holds a secret, and no feature says it alone.
Candidates of the documents themselves join them, labelled by assignment in quotes.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import text_of
from breachline.llm.spans import add_matches
from breachline.llm.trees import forest_score
from breachline.settings import cut

LEAST_LENGTH = 16
CANDIDATE = rf"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{{{LEAST_LENGTH},}}+"
#: A value in quotes behind a name; a quote that is not closed is scanned once a line.
QUOTED = r"""[=:][\x20\t]{0,4}+(?:"[^"\r\n]++"|'[^'\r\n]++')"""

# Common words and name parts, longer ones first where one begins another.
DICTIONARY = (
    "application attribute authentication background component configuration connection container "
    "control customer database default description development directory document download element "
    "environment error example export expression feature function generate github graphic handler "
    "history identifier image import index information instance interface internal javascript "
    "language library license listener location manager memory message method module network number "
    "object operation option output package parameter parent password pattern platform please "
    "position process product program project property provider python query reference release "
    "request resource response result return revision schema section secret security selector server "
    "service session setting software source standard static status storage stream string structure "
    "style system table target template test text thread title token transaction type update upload "
    "user utility value variable version video view visible warning website widget window world "
    "about after again also and are assets because been before being between but can com could data "
    "each file first for from get had has have here home html http https into its just know like "
    "main make many more most name net new not only org other our out over page path read see set "
    "should some such than that the their them then there these they this time use very was way "
    "were what when where which will with www you your tion ment ing heit keit lich eaux elle cion"
).split()

# Words before a secret, and words before a harmless identifier.
SECRET_WORDS = ["token", "secret", "passw", "passwd", "api_key", "apikey", "api-key", "auth",
                "credential", "private", "access_key", "bearer"]
HARMLESS_WORDS = ["commit", "sha", "md5", "checksum", "hash", "uuid", "digest", "revision", "phone"]
ASSIGNED = (
    r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|credential)s?[\"']?[\x20\t]*[=:][\x20\t]*[\"']$"
)
# Forms of well-known keys, and what stands where a secret is to be filled in.
KNOWN = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
    r"|[sr]k_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
)
PLACEHOLDER = (
    r"(?i)^(?:<.*>|\[.*\]|[$%#]?\{.*\}|\$\(.*\)|%.*%|\$[A-Z_]+)$"
    r"|your|example|change.?me|placeholder|dummy|redacted|(.)\1{4,}|^[*x.-]+$"
)

#: Bound of the fit: candidates come from about this many documents, drawn by hash.
SAMPLE_DOCS = 20_000
#: Bound of the built findings: about this many documents give a set of lines each.
SEED_DOCS = 1_000
TREES = 20
DEPTH = 7
LEAST_SCORE = 0.5

FEATURES = ["length", "changes", "upper", "digits", "signs", "distinct", "vowels", "blanks", "covered", "known",
            "placeholder", "path", "secret_word", "harmless_word", "assigned", "quoted"]


def _describe(start: Column, value: Column, before: Column, after: Column) -> Column:
    small, near = F.lower(value), F.lower(before)
    n = F.length(value).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    def any_of(words: list[str]) -> Column:
        return reduce(or_, [F.contains(near, F.lit(w)) for w in words])

    changes = r"(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Za-z])|(?<=[0-9])(?![0-9])|(?<=[+/_=.-])(?![+/_=.-])"
    letters = F.greatest(F.regexp_count(value, F.lit(r"\p{L}")), F.lit(1))
    placeholder = value.rlike(PLACEHOLDER)
    features = {
        "length": n,
        "changes": share(changes),
        "upper": share("[A-Z]"),
        "digits": share("[0-9]"),
        "signs": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "vowels": F.regexp_count(small, F.lit(r"[aeiouy\u00e0-\u00ff]")) / letters,
        "blanks": share(r"[\x20\t]"),
        "covered": 1 - F.length(F.regexp_replace(small, "|".join(DICTIONARY), "")) / n,
        "known": value.rlike(KNOWN),
        "placeholder": placeholder,
        "path": before.rlike(r"(?:[a-z]+:/?/?|[/\\~])$") | value.rlike(r"^\.{0,2}/|/.*[/.]|^www\."),
        "secret_word": any_of(SECRET_WORDS),
        "harmless_word": any_of(HARMLESS_WORDS),
        "assigned": before.rlike(r"[=:][\x20\t]*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
    }
    return F.struct(
        start.alias("start"), (start + F.length(value)).alias("stop"), value.alias("value"),
        (before.rlike(ASSIGNED) & after.rlike("^[\"']") & ~placeholder).alias("finding"),
        *[features[f].cast("double").alias(f"f_{f}") for f in FEATURES],
    )


def _of_run(s: Column) -> Column:
    """A run, or what stands behind ``name=`` in it if that is long enough by itself."""
    head = F.regexp_extract(s["value"], rf"^([A-Za-z][A-Za-z0-9_.-]*=)[^=].{{{LEAST_LENGTH - 1},}}", 1)
    value = F.substring(s["value"], F.length(head) + 1, F.length(s["value"]))
    return _describe(s["start"] + F.length(head), value, F.concat(s["before"], head), s["after"])


def _of_quoted(s: Column) -> Column:
    """The text inside the quotes of a match, which begins with the sign of assignment."""
    head = F.regexp_extract(s["value"], r"^[=:][\x20\t]*[\"']", 0)
    inner = F.substring(s["value"], F.length(head) + 1, F.length(s["value"]) - F.length(head) - 1)
    return _describe(
        s["start"] + F.length(head), inner, F.concat(s["before"], head), F.concat(F.right(s["value"], F.lit(1)), s["after"])
    )


def find_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, candidates`` of each row, with features, by place."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    quote = F.contains("text", F.lit('"')) | F.contains("text", F.lit("'"))
    found = add_matches(source, "text", {"runs": CANDIDATE, "quoted": QUOTED}, {"quoted": quote})
    # a run inside quotes is a candidate already
    rest = F.filter("quoted", lambda s: ~s["value"].rlike(rf"(?<=[=:\x20\t\"']){CANDIDATE}|[\"'].*{CANDIDATE}"))
    candidates = F.concat(F.transform("runs", _of_run), F.transform(rest, _of_quoted))
    return found.select("id", F.array_sort(candidates).alias("candidates"))


def _built_lines(docs: DataFrame, id_col: str) -> DataFrame:
    """``text, place, secret``: lines with a value at a known place that is a secret or not."""

    def digest(salt: str) -> Column:
        return F.sha2(F.concat_ws(":", F.lit(salt), F.col("seed")), 256)

    def mixed(salt: str) -> Column:
        return F.regexp_replace(F.base64(F.unhex(digest(salt))), "[=\r\n]", "")

    def number(salt: str, below: int) -> Column:
        return F.pmod(F.xxhash64(F.col("seed"), F.lit(salt)), F.lit(below)).cast("int")

    def one_of(salt: str, values: list) -> Column:
        options = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
        return F.element_at(options, number(salt, len(values)) + 1)

    def word(salt: str) -> Column:
        return one_of(salt, [w for w in DICTIONARY if len(w) > 3])

    name = one_of("name", ["password", "passwd", "api_key", "apiKey", "secret", "secret_key", "auth_token", "token",
                           "access_key", "credential", "DB_PASSWORD", "CLIENT_SECRET"])
    hashed = one_of("hashed", [F.left(digest("hashed"), F.lit(n)) for n in (32, 40, 64)])
    key = F.left(mixed("key"), 18 + number("key", 25))
    aws = F.concat(F.lit("AKIA"), F.upper(F.translate(F.left(digest("aws"), F.lit(16)), "01", "qz")))
    personal = F.concat(F.lit("ghp_"), F.left(F.translate(mixed("personal"), "+/", "Ab"), F.lit(36)))
    short = F.translate(F.left(mixed("short"), 7 + number("short", 9)), "aeE4/+", "!@#$%&")
    phrase = F.concat(F.initcap(word("phrase")), number("year", 9000) + 100, one_of("end", ["!", "#", "?", "$1", ""]))
    uuid = F.regexp_replace(F.left(digest("uuid"), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    digits = F.left(F.translate(digest("digits"), "abcdef", "314159"), 16 + number("digits", 5))
    joint = one_of("joint", ["_", ".", "-", ""])
    named = F.concat_ws("", word("w1"), joint, word("w2"), joint, F.initcap(word("w3")), joint, word("w4"))
    words = F.concat_ws(" ", word("w1"), word("w2"), word("w3"))
    stub = one_of("stub", ["changeme", "<token>", "${TOKEN}", "{{ secret }}", "%PASSWORD%", "$API_KEY", "xxxxxxxxxxxx", "********",
                           F.concat(F.lit("your_"), word("w1"), F.lit("_here")),
                           F.concat(F.lit("example-"), word("w1"), F.lit("-"), word("w2"))])
    path = F.concat(F.lit("/"), word("w1"), F.lit("/"), word("w2"), F.lit("/"), word("w3"), F.lit(".py"))
    link = F.concat(F.lit("www."), word("w1"), F.lit(".org/"), word("w2"), F.lit("/"), F.left(digest("link"), F.lit(8)))
    harmless = one_of("harmless", ["title", "class", "label", "version", "name", "lang", "content"])
    summed = one_of("summed", ["sha256", "checksum", "revision", "md5", "hash", "digest", "commit"])

    seeds = docs.select(F.col(f"`{id_col}`").cast("string").alias("seed")).where("seed is not null")
    parts = cut(seeds.select(
        name.alias("name"), hashed.alias("hashed"), key.alias("key"), aws.alias("aws"), personal.alias("personal"),
        short.alias("short"), phrase.alias("phrase"), uuid.alias("uuid"), digits.alias("digits"), named.alias("named"),
        words.alias("words"), stub.alias("stub"), path.alias("path"), link.alias("link"), harmless.alias("harmless"),
        summed.alias("summed"), word("w1").alias("word"), F.concat(word("w4"), F.lit(" ")).alias("other"),
    ), "parts")
    name, hashed, key, aws, personal, short, phrase, uuid, digits, named, words, stub, path, link, harmless, summed, plain, other = map(
        F.col, parts.columns)
    lines = []
    for value in (hashed, key, aws, personal, short, phrase):
        lines += [(F.concat(name, F.lit(' = "')), value, '"', True), (F.concat(F.lit('{"'), name, F.lit('": "')), value, '"}', True),
                  (F.concat(other, name, F.lit(": '")), value, "'", True)]
    for value in (hashed, key, aws, personal):
        lines += [(F.concat(name, F.lit("=")), value, "", True), (F.concat(other, name, F.lit(": ")), value, " ", True),
                  (F.lit("Authorization: Bearer "), value, "", True)]
    lines += [(other, aws, " ", True), (other, personal, ".", True)]
    for value in (hashed, key, uuid):
        lines += [(F.concat(summed, F.lit(" ")), value, " ", False), (F.concat(summed, F.lit(': "')), value, '"', False),
                  (F.concat(other, summed, F.lit("=")), value, "", False), (other, value, " ", False)]
    for value in (named, words, stub, path, link, plain, digits):
        lines += [(F.concat(harmless, F.lit('="')), value, '"', False), (F.concat(F.lit('"'), harmless, F.lit('": "')), value, '",', False)]
    for value in (stub, named):
        lines += [(F.concat(name, F.lit(' = "')), value, '"', False), (F.concat(F.lit('{"'), name, F.lit('": "')), value, '"}', False),
                  (F.concat(name, F.lit(" = ")), value, "()", False)]
    for value in (named, path, link, digits):
        lines += [(other, value, " ", False), (F.concat(plain, F.lit(": ")), value, "", False)]
    lines += [(F.lit("data:image/png;base64,"), key, '"', False), (F.lit('integrity="sha384-'), key, '"', False)]

    return parts.select(F.inline(F.array(*[
        F.struct(F.concat(head, value, F.lit(tail)).alias("text"), F.length(head).alias("place"), F.lit(secret).alias("secret"))
        for head, value, tail, secret in lines
    ])))


def _drawn(docs: DataFrame, id_col: str, wanted: int, total: int) -> DataFrame:
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1_000_003)) / 1_000_003
    return docs.where(draw < min(1.0, wanted / max(total, 1)))


def fit_forest(
    docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id",
    text_col: str = "text", sample_docs: int = SAMPLE_DOCS, trees: int = TREES, depth: int = DEPTH,
    seed_docs: int = SEED_DOCS,
) -> RandomForestClassificationModel | None:
    """Fit on candidates of about ``sample_docs`` documents.

    ``findings`` labels candidates as ``(value, is_secret)``; else lines built from about
    ``seed_docs`` documents do, and the assignment rule for candidates of the documents.
    None if there are no candidates of both classes.
    """
    total = docs.count()
    rows = find_candidates(_drawn(docs, id_col, sample_docs, total), id_col, text_col).select(F.explode("candidates").alias("c"))
    rows = rows.select("c.value", "c.finding", *[F.col(f"c.f_{f}").alias(f) for f in FEATURES])
    label = F.col("finding")
    if findings is not None:
        known = findings.select("value", "is_secret").distinct()
        rows, label = rows.join(known, "value"), F.col("is_secret")
    rows = rows.select(*FEATURES, label.cast("double").alias("label"))
    if findings is None:
        lines = cut(_built_lines(_drawn(docs, id_col, seed_docs, total), id_col), "lines")
        lines = lines.withColumn("line", F.struct("place", "secret"))
        built = find_candidates(lines, "line", "text").select("id", F.explode("candidates").alias("c"))
        built = built.where("c.start <= id.place AND id.place < c.stop")
        rows = rows.unionByName(built.select(
            *[F.col(f"c.f_{f}").alias(f) for f in FEATURES], F.col("id.secret").cast("double").alias("label")
        ))
    rows = cut(rows, "candidates")
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not {0.0, 1.0} <= counts.keys():
        return None
    weight = F.when(F.col("label") == 1, counts[0.0] / counts[1.0]).otherwise(1.0)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.withColumn("weight", weight)
    )
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, weightCol="weight", seed=42
    ).fit(table)


def scan_secrets(
    docs: DataFrame, model: RandomForestClassificationModel | None, id_col: str = "doc_id",
    text_col: str = "text", least_score: float = LEAST_SCORE,
) -> DataFrame:
    """One row per input row: ``<id_col>, n_candidates, n_secrets, secrets, max_score``.

    ``secrets`` lists ``start:stop`` (code points, stop exclusive) of the candidates whose
    score is at least ``least_score``; ``max_score`` is 0 without candidates. Without a model
    the assignment rule is the score. Null texts count as empty, repeated rows are scanned
    row by row, an empty table gives no rows, and other columns are not read.
    """
    if model is None:
        score = lambda c: c["finding"].cast("double")
    else:
        score = lambda c: forest_score(model, lambda i: c[f"f_{FEATURES[i]}"])
    scored = find_candidates(docs, id_col, text_col).select("id", F.transform(
        "candidates", lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), score(c).alias("score"))
    ).alias("scored"))
    scored = scored.withColumn("kept", F.filter("scored", lambda c: c["score"] >= least_score))
    return scored.select(
        F.col("id").alias(id_col),
        F.size("scored").cast("bigint").alias("n_candidates"),
        F.size("kept").cast("bigint").alias("n_secrets"),
        F.array_join(F.transform("kept", lambda c: F.concat_ws(":", c["start"], c["stop"])), ",").alias("secrets"),
        F.coalesce(F.array_max(F.transform("scored", lambda c: c["score"])), F.lit(0.0)).alias("max_score"),
    )
