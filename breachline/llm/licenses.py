"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised to lower-case words, and those that equal
a known licence sentence become its identifier. The sequence of identifiers is matched
against ordered licence rules; the first rule that fits at a place takes its identifiers,
so a longer licence is never also reported as the shorter one it begins with.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachline.llm.common import text_of

# Sentences of published licences and notices as normalised words.
SENTENCES = {
    "mit_name": ["mit license", "the mit license", "the mit license mit"],
    "mit_notice": [
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "distributed under the mit license",
        "this software is released under the mit license",
    ],
    "mit_grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files the software to deal in the software without"
        " restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and or sell copies of the software and to permit persons to whom the"
        " software is furnished to do so subject to the following conditions"
    ],
    "mit_keep": [
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software"
    ],
    "as_is_mit": [
        "the software is provided as is without warranty of any kind express or implied including but"
        " not limited to the warranties of merchantability fitness for a particular purpose and"
        " noninfringement"
    ],
    "apache_notice": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "released under the apache license version 2 0",
        "this project is licensed under the apache license version 2 0",
    ],
    "apache_comply": ["you may not use this file except in compliance with the license"],
    "apache_unless": [
        "unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind either"
        " express or implied"
    ],
    "apache_see": [
        "see the license for the specific language governing permissions and limitations under the"
        " license"
    ],
    "gpl3_notice": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
        "licensed under the gnu gpl version 3",
    ],
    "gpl2_notice": [
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
    ],
    "gpl3_later": [
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation either version 3 of"
        " the license or at your option any later version"
    ],
    "gpl2_later": [
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation either version 2 of"
        " the license or at your option any later version"
    ],
    "gpl_details": ["see the gnu general public license for more details"],
    "bsd_head": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met"
    ],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice this list of conditions"
        " and the following disclaimer"
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials provided"
        " with the distribution"
    ],
    "bsd_names": [
        "neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission"
    ],
    "cc_by_nc": [
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international"
        " license",
    ],
    "cc_by_sa": [
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc_by": [
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "mpl_form": [
        "this source code form is subject to the terms of the mozilla public license v 2 0"
    ],
    "public_domain": ["this is free and unencumbered software released into the public domain"],
}

# Licence of each sequence of identifiers, longer sequences first.
RULES = [
    ("bsd_head bsd_source bsd_binary bsd_names", "BSD-3-Clause"),
    ("bsd_head bsd_source bsd_binary", "BSD-2-Clause"),
    ("apache_notice apache_comply apache_unless apache_see", "Apache-2.0"),
    ("apache_notice apache_comply apache_unless", "Apache-2.0"),
    ("mit_name mit_grant mit_keep as_is_mit", "MIT"),
    ("mit_grant mit_keep as_is_mit", "MIT"),
    ("gpl3_later gpl_details", "GPL-3.0-or-later"),
    ("gpl2_later gpl_details", "GPL-2.0-or-later"),
    ("gpl3_later", "GPL-3.0-or-later"),
    ("gpl2_later", "GPL-2.0-or-later"),
    ("gpl3_notice", "GPL-3.0-only"),
    ("gpl2_notice", "GPL-2.0-only"),
    ("apache_notice", "Apache-2.0"),
    ("mit_notice", "MIT"),
    ("mit_name", "MIT"),
    ("mit_grant mit_keep", "MIT"),
    ("cc_by_nc", "CC-BY-NC-4.0"),
    ("cc_by_sa", "CC-BY-SA-4.0"),
    ("cc_by", "CC-BY-4.0"),
    ("mpl_form", "MPL-2.0"),
    ("public_domain", "Unlicense"),
]

#: Every known sentence holds one of these in one word, so that no line break can part it;
#: other texts need no cutting into sentences.
ANCHORS = ["licen", "permi", "redistribut", "warrant", "unencumbered"]

#: A sentence may be broken over lines, or a line may be a sentence: both cuts are tried.
CUTS = [r"[.!?:]+[\t-\r ]+|[\r\n]+", r"[.!?:]+[\t-\r ]+|\n[\t-\r ]*\n"]

_TOKENS = {s: f"<{token}>" for token, listed in SENTENCES.items() for s in listed}
_RULES = {"".join(f"<{t}>" for t in rule.split()): licence for rule, licence in RULES}


def _pick(values: dict[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.element_at(table, key)


def _identifiers(text: Column, mark: str) -> Column:
    """The identifiers of the known sentences of a text, in order, as one string."""
    plain = F.lower(F.regexp_replace(F.regexp_replace(text, mark, "|"), "[^A-Za-z0-9|]+", " "))
    sentences = F.transform(F.split(plain, r"\|"), lambda s: F.trim(s))
    known = F.filter(sentences, lambda s: s.isin(*_TOKENS))
    return F.array_join(F.transform(known, lambda s: _pick(_TOKENS, s)), "")


def _licences(identifiers: Column) -> Column:
    matched = F.regexp_extract_all(identifiers, F.lit("|".join(_RULES)), F.lit(0))
    return F.transform(matched, lambda m: _pick(_RULES, m))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, sentences, licences, n_licences``.

    ``sentences`` are the identifiers found line by line, ``licences`` the distinct licences
    in alphabetical order, comma-joined; both are empty where nothing is known. Null texts
    count as empty, repeated rows are scanned row by row, an empty table gives no rows, and
    other columns are not read.
    """
    text = F.col("text")
    small = F.lower(text)
    likely = reduce(or_, [F.contains(small, F.lit(a)) for a in ANCHORS])
    found = docs.select(F.col(f"`{id_col}`"), text_of(text_col).alias("text")).select(
        F.col(f"`{id_col}`"),
        *[F.when(likely, _identifiers(text, c)).otherwise("").alias(f"cut{i}")
          for i, c in enumerate(CUTS)],
    )
    merged = F.array_sort(F.array_distinct(F.concat(_licences(F.col("cut0")), _licences(F.col("cut1")))))
    return found.withColumn("list", merged).select(
        F.col(f"`{id_col}`"),
        F.col("cut0").alias("sentences"),
        F.array_join("list", ",").alias("licences"),
        F.size("list").cast("bigint").alias("n_licences"),
    )


def scan_sql() -> str:
    """The same table in SQL, from the same sentences and rules."""
    known = ", ".join(f"('{s}', '{t}')" for s, t in _TOKENS.items())
    rules = ", ".join(f"('{r}', '{licence}')" for r, licence in _RULES.items())
    pattern = "|".join(_RULES)
    passes = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS pass, unnest(regexp_split_to_array(lower(regexp_replace("
        f"regexp_replace(coalesce(text, ''), '{c}', '|', 'g'), '[^A-Za-z0-9|]+', ' ', 'g')), '\\|'))"
        f" AS sentence, unnest(range(1, 1 + len(regexp_split_to_array(regexp_replace("
        f"coalesce(text, ''), '{c}', '|', 'g'), '\\|')))) AS place FROM documents"
        for i, c in enumerate(CUTS)
    )
    return f"""
        WITH known(sentence, token) AS (VALUES {known}), rules(sequence, licence) AS (VALUES {rules}),
        cuts AS ({passes}),
        found AS (
            SELECT doc_id, pass, string_agg(token, '' ORDER BY place) AS ids
            FROM cuts JOIN known ON trim(cuts.sentence) = known.sentence GROUP BY doc_id, pass
        ),
        matched AS (
            SELECT doc_id, unnest(regexp_extract_all(ids, '{pattern}')) AS sequence FROM found
        ),
        named AS (
            SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
                   count(DISTINCT licence) AS n
            FROM matched JOIN rules USING (sequence) GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(f.ids, '') AS sentences, coalesce(n.licences, '') AS licences,
               coalesce(n.n, 0) AS n_licences
        FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id AND f.pass = 0
        LEFT JOIN named n ON n.doc_id = d.doc_id
    """
