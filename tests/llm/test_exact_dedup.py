import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wardflow.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        text = text or ""
        groups[text.translate({ord(c): None for c in "\t\n\x0b\x0c\r "})].append((-len(text), i))
    want = {}
    for body, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            want[i] = (keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest())
    return want


def found(spark, rows, **kw):
    out = X.exact_dedup(frame(spark, rows), **kw).collect()
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out}


def test_groups_of_copies(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)] + [(100, "a b"), (101, "a  b\n"), (102, "ab"), (103, None), (104, " \t")]
    rows += [(200, "é ü"), (201, "éü"), (202, "x" * 300_000), (203, "x" * 299_999 + " x")]
    assert found(spark, rows, capacity=3) == brute(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.none() | st.text("ab \n ", max_size=4), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    rows = list(enumerate(texts))
    assert found(spark, rows, capacity=2) == brute(rows)


def test_empty_table_and_null_id(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, "a"), (3, "a"), (None, "b")])[3] == (3, 2, True, hashlib.sha256(b"a").hexdigest())


def test_equal_keys_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(X, "_key", lambda body: 5)  # every text collides
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, "c"), (5, "b")]
    assert found(spark, rows, capacity=1) == brute(rows)


def test_one_of_repeated_rows_stays(spark):
    out = X.exact_dedup(frame(spark, [(1, "a"), (1, "a"), (2, "a")])).collect()
    assert sorted((r.doc_id, r.group_size, r.kept) for r in out) == [(1, 3, False), (1, 3, True), (2, 3, False)]


ODD = [(1, "a b"), (1, "a b"), (1, "a b"), (None, "n"), (None, "n"), (None, " n"), (7, "one"), (7, "two"), (7, "one"), (None, "one"), (9, None), (None, "")]


def test_rows_with_equal_or_null_ids_are_told_apart(spark):
    """One row per text, by the longest, then the smallest id, then any."""
    want = sorted([(1, "a b"), (None, " n"), (7, "one"), (7, "two"), (9, None)], key=str)
    docs = frame(spark, ODD).repartition(3)
    assert sorted(((r.doc_id, r.text) for r in X.drop_copies(docs).collect()), key=str) == want
    out = X.exact_dedup(docs).collect()
    assert len(out) == len(ODD) and sum(r.kept for r in out) == len({r.text_sha256 for r in out}) == len(want)


def test_a_table_appended_twice_passes_once(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(50)])
    out = X.drop_copies(docs.union(docs).repartition(4))
    assert sorted(r.doc_id for r in out.collect()) == list(range(50))


@pytest.mark.parametrize("capacity", [1, 4, 1000])
def test_directory_covers_every_key_once(spark, capacity):
    keys = spark.range(300).selectExpr("xxhash64(id) AS key")
    buckets = X.directory(keys, capacity, bits=16).collect()
    for row in keys.collect():
        inside = [b for b in buckets if ((row.key & (1 << 64) - 1) >> 64 - b.depth if b.depth else 0) == b.prefix]
        assert len(inside) == 1 and (inside[0].n <= capacity or inside[0].depth == 16)


def test_columns_of_the_documents_stay(spark):
    docs = frame(spark, [(1, "a"), (2, "a"), (3, "b")]).selectExpr("*", "1 AS kept", "2 AS key", "3 AS bucket")
    out = X.drop_copies(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
