import re
import textwrap

import pytest

from wardflow.llm import license_scan as X
from wardflow.llm.license_texts import TEXTS

FULL = "Copyright (c) 2020 A. Person\nPermission is hereby granted to any person, free of charge.\nThe software is provided as is."


def found(spark, rows, licenses=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    known = None if licenses is None else spark.createDataFrame(licenses, "license string, text string")
    return {(r.doc_id, r.license, r.whole, r.n_lines, r.n_runs) for r in X.scan_licenses(docs, known).collect()}


@pytest.mark.parametrize(
    "text, license",
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("LICENSED under the Apache Licence v2", "Apache-2.0"),
        ("  released under the MIT licence", "MIT"),
        ("This work is licenced under the GNU General Public License, v. 3.0", "GPL-3.0"),
        ("All Rights Reserved!", "all-rights-reserved"),
        ("(c) 2021 Somebody\nLicensed under CC-BY-NC 4.0", "CC-BY-NC-4.0"),
    ],
)
def test_equivalent_spellings(spark, text, license):
    assert (1, license) in {x[:2] for x in found(spark, [(1, text, "x")])}


def test_whole_texts_lines_and_bystanders(spark):
    rows = [
        (1, FULL, ""), (2, FULL.upper().replace("2020 A. PERSON", "1999 B"), ""), (3, FULL + " More.", ""), (4, None, ""), (5, "", ""),
        (6, "prose\nReleased under the MIT License.\nprose\nReleased under the MIT license\n", ""), (7, "!!! ...", ""),
        (8, "Released under the MIT License. And more prose.", ""), (9, "x " * 100_000 + "\nAll rights reserved.", ""),
    ]
    own = [("own", FULL), ("twin", FULL), *X.NOTICES]
    assert found(spark, rows, own) == {
        (1, "own", True, 0, 0), (1, "twin", True, 0, 0), (2, "own", True, 0, 0), (2, "twin", True, 0, 0), (6, "MIT", False, 2, 0),
        (9, "all-rights-reserved", False, 1, 0),
    }


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


@pytest.mark.parametrize("width", [30, 57, 79, 10_000])
def test_full_texts_are_found_whole_and_within_others(spark, width):
    rows, want = [], set()
    for i, (name, titles, text) in enumerate(TEXTS):
        body, runs = wrapped(text, width), 0 if "\n\n" in text or width < 10_000 else 1
        above = f"{titles[0]}\n\n" if titles else ""
        rows.append((2 * i, f"{above}Copyright (c) 2024 Some One\n\n{body}\n", ""))
        rows.append((2 * i + 1, f"A tool.\n \nCopyright (c) 2024 Some One\n\n{body.lower()}\n\t\nUsage: read it.", ""))
        found_in_title = {(2 * i, name, True, 0, 1)} if titles else {(2 * i, name, True, 1 if "\n" not in body else 0, 0)}
        want |= found_in_title | {(2 * i + 1, name, False, 1 if "\n" not in body else 0, 1)}
    assert found(spark, rows) == want


def test_a_part_of_a_text_is_not_the_text(spark):
    parts = TEXTS[0][2].split("\n\n")
    assert found(spark, [(1, "\n\n".join(parts[:2]), ""), (2, "\n\n".join([parts[0], "and", *parts[1:]]), ""), (3, "\n\n", "")]) == set()


def test_leaving_out_texts_changes_nothing(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fast = X.scan_licenses(docs).collect()
    monkeypatch.setattr(X, "anchors", lambda known: None)
    assert sorted(map(str, fast)) == sorted(map(str, X.scan_licenses(docs).collect()))


def test_anchors_cannot_be_made_by_a_spelling_rule(spark):
    forms = [r.form for r in X.forms(X.known_licenses(spark)).collect()]
    words = X.anchors(forms)
    assert all(any(w in f.split() for w in words) for f in forms)
    assert not any(re.search("licen|version|under|owner", w) for w in words)
    assert X.anchors(["licensed under version 2"]) is None


def test_no_python_in_the_plan(spark, sf):
    plan = X.scan_licenses(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert found(spark, []) == set()
