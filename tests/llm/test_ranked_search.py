import math
import random
import re
from collections import Counter

import pytest

from wardflow.llm import ranked_search as rs

RUNS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return RUNS.findall((text or "").translate(LOWER))


def brute_force(docs, items):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [x for x in counted if x[1]]
    n_docs, length = len(counted), sum(c.total() for _, c in counted)
    having = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counted:
            m = 10 + (90 * c.total() * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * having[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(found)[:10], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    some = random.Random(1)
    words = ["the", "Río", "a1", "x", "ß-z", "Über", "日本", "the'end", "FOO", "foo", "bar", "q\x00w"] + [f"w{i}" for i in range(40)]
    docs = [(some.randrange(300), " ".join(some.choices(words, k=some.randint(1, 30)))) for _ in range(500)]
    docs += [(None, "foo foo bar"), (None, None), (7, ""), (8, " .;"), (None, "foo foo bar")] + docs[:90]
    items = [(i, " ".join(some.choices([*words, "zzz"], k=some.randint(1, 9)))) for i in range(25)]
    return docs, items + [(None, "foo bar"), (3, None), (4, ""), (5, "foo"), (5, "foo")]


@pytest.mark.parametrize("tile", [(2048, 512), (3, 7)])
def test_equals_brute_force(spark, corpus, tile, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_ITEMS", 16)
    docs, items = corpus
    found = rs.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), tile=tile)
    assert rows(found) == brute_force(docs, items)


def test_ties_go_to_the_smaller_id_across_tiles_and_tasks(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000, "other")]
    found = rs.search(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame([(1, "words")], ITEMS), tile=(8, 16))
    assert [r["doc_id"] for r in found.orderBy("rank").collect()] == list(range(1, 11))


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(rs, "CHUNK", 5)
    text = "Alpha béta, gamma" * 50 + "z" * 100
    assert rs.term_counts(text) == Counter(t.encode() for t in terms(text))


def test_tiles_end_before_sums_lose_digits():
    heavy = rs.EXACT // rs.MOST_IMPACT // 2 + 1
    assert rs.tiles([heavy, heavy, heavy, 1, 1]) == [(0, 1), (1, 2), (2, 5)]
    assert rs.tiles([1] * 5, most=2) == [(0, 2), (2, 4), (4, 5)]
    assert rs.tiles([]) == []


def test_no_documents_no_items_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 3, "t", 5)], DOCS + ", score long, terms string, rank int")
    items = spark.createDataFrame([(1, "a", 2, 0)], ITEMS + ", doc_id long, item int")
    assert len(rows(rs.search(docs, items))) == 1
    assert rows(rs.search(docs.limit(0), items)) == [] and rows(rs.search(docs, items.limit(0))) == []
