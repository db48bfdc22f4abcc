"""Licence scans: whole texts and whole lines looked up by the digest of their canonical form.

Canonical form: lower case, copyright notices removed, every run of other characters than letters and
digits a single space, and variant spellings written one way. Known licences go through the
same expressions, so a match is an equality of digests. Built-in functions only.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

COPYRIGHT_LINE = r"(?m)^[ \t*#/;>|-]*(copyright|\(c\)|©)[^\n]*$"
#: The lines removed: copyright with (c), a year, a placeholder or "by", or with a short owner's name. COPYRIGHT_LINE,
#: which takes reflowed prose too, is the form of the check SQL; the two differ on such prose only.
_YEAR = r"(?:©|\(c\)|[\[<{]|\d{4}\b)"
_PROSE = (
    "also|and|are|as|disclaimers?|doctrines|for|holders?|if|in|interests?|is|it|laws?|licen[cs]e[sd]?|licensing|like|lines?|may|"
    "notices?|of|on|or|owners?|ownership|patent|permissions?|protection|shall|statements?|that|this|those|to|treat(?:y|ies)|"
    r"under|which|will|with|the(?![^\n]*\b(?:authors?|company|contributors|developers|foundation|project|regents|team|university)\b)"
)
NOTICE_LINE = (
    r"(?m)^[ \t*#/;>|-]*(?:©|\(c\)[ \t]*(?:copyright\b|" + _YEAR + r")"
    r"|copyright[ \t:,]*(?:" + _YEAR + r"|by\b)"
    r"|copyright[ \t:]+(?!(?:" + _PROSE + r")\b)\p{L}\S*(?:[ \t]+\S+){0,7}[ \t]*$)[^\n]*$"
)
NOT_WORD = r"[^\p{L}\p{N}\n]+"

# Equivalent spellings of public licence-matching guidelines, as patterns and replacements.
SPELLINGS = [
    (r"\bsublicen[cs]e", "sublicense"),
    (r"\blicence", "license"),
    (r"\bhttps\b", "http"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bcopyright holders?\b", "copyright owner"),
    (r"\bcopyright owners\b", "copyright owner"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\bauthoris", "authoriz"),
    (r"\bcentre\b", "center"),
    (r"\bfavour", "favor"),
    (r"\borganis", "organiz"),
    (r"\brecognis", "recogniz"),
    (r"\bwilful", "willful"),
]

# Lines that stand above whole texts.
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "BSD License",
        "New BSD License", "Modified BSD License",
    ],
}

# Public notices, and short public licences as whole texts.
_NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    ),
]


def whole_licenses() -> list[tuple[str, str]]:
    """(license_id, text): whole texts and their usual variants of title, list marks and appendix."""
    files = sorted(Path(__file__).with_name("licenses").glob("*.txt"))
    own_notices = re.compile(NOTICE_LINE.replace(r"\p{L}", r"[^\W\d_]"), re.IGNORECASE)
    texts = [(f.name.removesuffix(".txt").removesuffix(".regents"), own_notices.sub("", f.read_text())) for f in files]
    out = []
    for name, text in [*texts, *((i, t) for i, t in _NOTICES if i in _TITLES and "\n\n" in t)]:
        body = {text: None}
        ends = re.search(r"(?m)^.*END OF TERMS AND CONDITIONS.*$", text)
        if ends:  # what follows says how to apply the licence
            body |= {text[: ends.end()]: None, text[: ends.start()]: None}
        if name == "Apache-2.0":
            body |= {t[t.index("TERMS AND CONDITIONS FOR USE") :]: None for t in list(body)}
        if name.startswith("BSD"):
            body[re.sub(r"(?m)^\d\. ", "* ", text)] = None
        above = ["", *_TITLES.get(name, [])]
        if name in _TITLES:
            above += [f"{t}\nAll rights reserved." for t in above]
        out += [(name, f"{t}\n{b}") for b in body for t in above]
    return out


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text) of notices and whole licences; any table of that shape can take its place."""
    names, texts = zip(*_NOTICES, *whole_licenses())
    return spark.createDataFrame(pa.table({"license_id": pa.array(names), "text": pa.array(texts)}))


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that hold a word, in order."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), NOTICE_LINE, ""), NOT_WORD, " ")
    found = plain.rlike("|".join(p for p, _ in SPELLINGS))
    spelled = reduce(lambda c, s: F.regexp_replace(c, *s), SPELLINGS, plain)
    lines = F.split(F.when(found, spelled).otherwise(plain), "\n")
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")


def canonical_digest(lines: Column) -> Column:
    """SHA-256 of canonical lines as one text; where line breaks stood makes no difference."""
    joined = F.array_join(lines, " ")
    across = [s for s in SPELLINGS if " " in s[0]]  # a line break may have stood inside
    spelled = reduce(lambda c, s: F.regexp_replace(c, *s), across, joined)
    return F.sha2(F.when(joined.rlike("|".join(p for p, _ in across)), spelled).otherwise(joined), 256)


def scan_licenses(documents: DataFrame, known: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, canonical text) of ``documents`` (doc_id, text).

    canonical_sha256; license_id of the whole text, else NULL; n_notices, the number of lines that
    are a whole licence or notice; notices, their distinct licence ids in order; n_rows, the number of
    rows that share doc_id and canonical text. A null text counts as empty, an empty text matches
    nothing, and a null doc_id is a doc_id of its own. Digests that ``known`` holds twice take
    the smallest id; known texts without a word are ignored. Other columns are ignored.
    """
    table = (
        known.select("license_id", canonical_lines(F.col("text")).alias("lines"))
        .where(F.size("lines") > 0)
        .groupBy(canonical_digest(F.col("lines")).alias("digest"))
        .agg(F.min("license_id").alias("license_id"))
    )
    lines = documents.select(
        "doc_id", F.coalesce(canonical_lines(F.col("text")), F.array().cast("array<string>")).alias("lines")
    )
    # The whole text is the unit at position 0, its lines follow. Units of a document are
    # neighbours in a task, so the grouping below combines nearly all of them before its shuffle.
    units = lines.select("doc_id", canonical_digest(F.col("lines")).alias("canonical_sha256"), "lines").select(
        "doc_id",
        "canonical_sha256",
        F.posexplode(
            F.concat(F.array("canonical_sha256"), F.transform("lines", lambda x: F.sha2(x, 256)))
        ).alias("at", "digest"),
    )
    matched = units.join(table, "digest", "left")
    whole, line = F.col("at") == 0, F.col("at") > 0
    return matched.groupBy("doc_id", "canonical_sha256").agg(
        F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
        (F.count(F.when(line, F.col("license_id"))) / F.count(F.when(whole, True))).cast("long").alias("n_notices"),
        F.array_sort(F.collect_set(F.when(line, F.col("license_id")))).alias("notices"),
        F.count(F.when(whole, True)).alias("n_rows"),
    )
