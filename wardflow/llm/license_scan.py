"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case, copyright lines dropped, line breaks folded,
equivalent spellings unified, punctuation and white space folded to single blanks. The digest of the
whole canonical text is joined to the digests of known licence texts. Three units of a document are
looked up: the document as a whole; each of its lines, since a notice is often one line among prose;
and each run of as many paragraphs as some known text has, since a text of several lines or
paragraphs may stand within a longer one, wrapped in any way. Paragraphs end at blank lines; those
without a letter or digit in their form (such as a copyright line of its own) do not count. The
form of a text is that of its paragraphs, joined; a run is known by the digests of its paragraphs.

Bringing a text to its canonical form takes many passes, so texts that cannot match are left out
first: every known form has a word that no spelling rule can make (``anchors``), and a text or line
without any of these words cannot have the digest of a known form. With more than ``MOST_ANCHORS``
such words, or a form without one, all texts are brought to their form; the result is the same.

Everything is DataFrame functions, and documents are read once. The known licences are a table of
(license, text); the default has short notices, the shorter licences in full, with and without their
title, and standard headers; any table may be given. The units that can match are
few, so equal digests are folded within each task before anything is shuffled: the join sees one
row per distinct digest and document. The known digests are broadcast only while there are at most
``BROADCAST_LICENSES`` of them (60 bytes each).

Null or empty texts, and texts whose canonical form is empty, match nothing. Rows that repeat a
``doc_id`` are reported as one. A licence text listed twice under several names matches all.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.license_texts import TEXTS

BROADCAST_LICENSES = 50_000
MOST_ANCHORS = 60
#: Anchors are sought for at most this many known texts.
ANCHORED_LICENSES = 1_000

# Licence notices as they are written in practice, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
)

# Spellings and what they count as, applied in this order to lower-case text.
SPELLINGS = (
    (r"licence", "license"),
    (r"https?://", " "),
    (r"copyright holder", "copyright owner"),
    (r"sub-license", "sublicense"),
    (r"non-commercial", "noncommercial"),
    (r"per cent", "percent"),
    (r"(?:version|v\.?) ?(\d)", "version $1"),
    (r"(\d)\.0\b", "$1"),
    (r"\b(?:this work is|this software is|this file is|this program is|the software is|released|distributed|available) "
     r"(?:licensed )?under\b", "licensed under"),
)
# Words that follow "copyright" where a sentence goes on, rather than a holder.
_NO_HOLDER = "owners?|holders?|notices?|licen[sc]es?|laws?|and|or|statement"
_COPYRIGHT_LINE = r"(?m)^[ \t]*(?:\(c\)|©|copyright\b(?! (?:" + _NO_HOLDER + r")\b))[^\n]*$"


def canonical(text: Column) -> Column:
    """The form in which texts of one paragraph are compared; an empty text stays empty."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, _COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, r"[\t-\r ]+", " ")
    for spelling, same in SPELLINGS:
        out = F.regexp_replace(out, spelling, same)
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def paragraph_forms(text: Column) -> Column:
    """The forms of a text's paragraphs that have one."""
    return F.filter(F.transform(F.split(text, r"\n[\t-\r ]*\n"), canonical), lambda form: form != "")


def run_digest(forms: Column) -> Column:
    """What a run of paragraphs is known by."""
    return F.sha2(F.array_join(F.transform(forms, lambda form: F.sha2(form, 256)), ""), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    rows = [*NOTICES, *((name, text) for name, _, text in TEXTS)]
    rows += [(name, f"{title}\n\n{text}") for name, titles, text in TEXTS for title in titles]
    return spark.createDataFrame(rows, "license string, text string")


def forms(licenses: DataFrame) -> DataFrame:
    """(license, forms, form) of a table of licence texts, each once; empty forms match nothing."""
    split = licenses.select("license", paragraph_forms(F.coalesce("text", F.lit(""))).alias("forms"))
    return split.where("size(forms) > 0").distinct().withColumn("form", F.array_join("forms", " "))


def anchors(known: list[str]) -> list[str] | None:
    """Words of which every known form has one, and which only texts that have them can show.

    A spelling rule writes whole words, so a word that contains none of those stems from the text.
    """
    made = {w for _, same in SPELLINGS for w in re.findall("[a-z]+", same)}
    own = [{w for w in f.split() if re.fullmatch("[a-z]+", w) and not any(m in w for m in made)} for f in known]
    if not all(own):
        return None
    often = Counter(w for words in own for w in words)
    chosen: set[str] = set()
    for words in sorted(own, key=len):
        if not words & chosen:  # prefer long words, which prose seldom holds, then shared ones
            chosen.add(max(words, key=lambda w: (min(len(w), 6), often[w], w)))
    return sorted(chosen) if len(chosen) <= MOST_ANCHORS else None


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row per document and licence found: doc_id, license, whole (the entire text), n_lines, n_runs.

    ``n_runs`` counts runs of paragraphs short of the entire text.
    """
    known = forms(licenses if licenses is not None else known_licenses(docs.sparkSession))
    n = known.count()
    words = anchors([x["form"] for x in known.select("form").collect()]) if n <= ANCHORED_LICENSES else None
    lengths = sorted(x[0] for x in known.select(F.size("forms")).distinct().collect())  # as many as differ
    known = known.select("license", F.explode(F.array(F.sha2("form", 256), run_digest(F.col("forms")))).alias("digest")).distinct()
    if n <= BROADCAST_LICENSES:
        known = F.broadcast(known)

    def may_match(text: Column) -> Column:
        return text.rlike("(?iu)" + "|".join(words)) if words else F.lit(True)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("text != ''").where(may_match(F.col("text")))
    split = rows.select(
        "doc_id", F.filter(F.split("text", "\n"), may_match).alias("lines"), paragraph_forms(F.col("text")).alias("forms")
    )
    unit = lambda kind, digest: F.struct(F.lit(kind).alias("kind"), digest.alias("digest"))
    whole = F.array(unit("whole", F.sha2(F.array_join("forms", " "), 256)))
    lines = F.transform("lines", lambda line: unit("line", F.sha2(canonical(line), 256)))
    digests = F.transform("forms", lambda form: F.sha2(form, 256))
    run = lambda k: lambda i: unit("run", F.sha2(F.array_join(F.slice("digests", i, F.lit(k)), ""), 256))
    none = F.array().cast("array<struct<kind: string, digest: string>>")
    runs = [
        F.when(F.size("digests") > k, F.transform(F.sequence(F.lit(1), F.greatest(F.size("digests") - k + 1, F.lit(1))), run(k))).otherwise(none)
        for k in lengths
    ]
    units = split.withColumn("digests", digests).select("doc_id", F.explode(F.concat(whole, lines, *runs)).alias("u")).select("doc_id", "u.*")
    found = units.join(known, "digest").groupBy("doc_id", "license")
    count = lambda kind: F.sum((F.col("kind") == kind).cast("long"))
    return found.agg((F.max(F.col("kind") == "whole")).alias("whole"), count("line").alias("n_lines"), count("run").alias("n_runs"))
