import re

import pytest
from pyspark.sql import functions as F

from wardflow.llm import mixing as X

SCHEMA = "doc_id long, text string, lang string, source string, p double, topic string"


def corpus(spark, n=600):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else f"s{i % 7}"
        text = ("word " * (3 + i % 40)) if i % 5 else "Released under the MIT License. " * (1 + i % 3)
        rows.append((i, text * (60 if i % 11 == 0 else 1), ("en", "de", "fr")[(i // 2) % 3], source, 9.0, "own"))
    return spark.createDataFrame(rows, SCHEMA)


def python_rake(cells, targets, rounds):
    weight = dict(cells)
    for _ in range(rounds):
        for k in range(3):
            has = {}
            for cell, w in weight.items():
                has[cell[k]] = has.get(cell[k], 0) + w
            weight = {c: w * targets[k].get(c[k], 0) / has[c[k]] if has[c[k]] else 0.0 for c, w in weight.items()}
    return weight


def test_raking_equals_python_and_meets_the_margins(spark):
    cells = X.labelled(corpus(spark)).groupBy(*X.MARGINS).agg(F.sum("tokens").alias("tokens"))
    targets = {m: X.tempered(cells, m) for m in X.MARGINS}
    got = {tuple(r[m] for m in X.MARGINS): r["weight"] for r in X.rake(cells, targets, 12).collect()}
    plain = [{r[m]: r["target"] for r in targets[m].collect()} for m in X.MARGINS]
    want = python_rake({tuple(r[m] for m in X.MARGINS): r["tokens"] for r in cells.collect()}, plain, 12)
    assert got == pytest.approx(want)
    for k, target in enumerate(plain):
        assert sum(target.values()) == pytest.approx(1)
        for value, share in target.items():
            assert sum(w for c, w in got.items() if c[k] == value) == pytest.approx(share, rel=0.02)


def test_drawn_share_follows_the_probabilities(spark):
    rows = X.mix(corpus(spark, 3000)).collect()
    assert len(rows) == 3000 and max(r.p for r in rows) == 1.0 and all(r.drawn for r in rows if r.p == 1.0)
    want, got = sum(r.p for r in rows), sum(r.drawn for r in rows)
    assert abs(want - got) < 5 * want**0.5
    assert [(r.doc_id, r.drawn) for r in sorted(rows)] == [(r.doc_id, r.drawn) for r in sorted(X.mix(corpus(spark, 3000)).collect())]


def test_a_value_without_a_target_is_not_drawn(spark):
    docs = corpus(spark)
    even = lambda m, values: spark.createDataFrame([(v, 1 / len(values)) for v in values], f"{m} string, target double")
    topics = [r.topic for r in X.labelled(docs).select("topic").distinct().collect()]
    targets = {"source": even("source", ["hot", "s0"]), "language": even("language", ["en", "de", "fr"]), "topic": even("topic", topics)}
    drawn = {r.source for r in X.mix(docs, targets).where("drawn").collect()}
    assert drawn <= {"hot", "s0"}


def test_drawn_documents_keep_their_columns(spark):
    docs = corpus(spark)
    kept = X.drawn_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in X.mix(docs).where("drawn").collect()}


def test_nulls_empty_texts_repeats_and_no_rows(spark):
    rows = [(None, None, None, None, None, None), (1, "", "en", "a", 0.1, ""), (1, "", "en", "a", 0.1, ""), (2, "x " * 99_999, "en", None, 0.1, "")]
    out = X.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.source, r.language, r.tokens) for r in out) == [(0, "", "", 1), (1, "a", "en", 1), (1, "a", "en", 1), (2, "", "en", 99_999)]
    assert len({r.drawn for r in out if r.doc_id == 1}) == 1
    none = spark.createDataFrame([], SCHEMA)
    assert X.mix(none).collect() == [] and X.drawn_documents(none).collect() == []


def test_no_python_in_the_plan(spark):
    assert not re.search("Python|Pandas|Arrow", X.mix(corpus(spark))._jdf.queryExecution().toString())


def drawn_share(rows):
    return sum(r.p * r.tokens for r in rows) / sum(r.tokens for r in rows)


def test_a_stray_row_does_not_shrink_the_draw(spark):
    stray = spark.createDataFrame([(9999, "#", "xx", "stray", 9.0, "own")], SCHEMA)
    rows = X.mix(corpus(spark).union(stray)).collect()
    assert drawn_share(rows) == pytest.approx(X.KEPT_SHARE, rel=1e-6)
    assert max(r.p for r in rows) == 1.0 and [r.drawn for r in rows if r.doc_id == 9999] == [True]


def test_the_scale_keeps_the_proportions_of_cells_under_one(spark):
    cells = spark.createDataFrame([("a", 1, 0.2), ("b", 10, 0.4), ("c", 989, 0.4), ("d", 50, 0.0)], "k string, tokens long, weight double")
    p = {r.k: r.p for r in X.probabilities(cells, 0.5).collect()}
    # a and b reach one; c gives the other 489 of 500 tokens; d is not wanted.
    assert p == pytest.approx({"a": 1.0, "b": 1.0, "c": 489 / 989, "d": 0.0})
    assert {r.p for r in X.probabilities(cells, 1.0).where("weight > 0").collect()} == {1.0}


def test_raking_goes_on_until_the_margins_hold(spark):
    # Languages go along with sources almost entirely, so each round takes off little.
    rows = [(s, l, "t", 1000 if s == l else 30) for s in "ab" for l in "ab"]
    cells = spark.createDataFrame(rows, "source string, language string, topic string, tokens long")
    to = lambda m, **w: spark.createDataFrame(list(w.items()), f"{m} string, target double")
    targets = {"source": to("source", a=0.7, b=0.3), "language": to("language", a=0.35, b=0.65), "topic": to("topic", t=1.0)}
    out = X.rake(cells, targets, 2).collect()
    assert sum(r.weight for r in out if r.source == "a") == pytest.approx(0.7, rel=X.TOLERANCE)
    assert sum(r.weight for r in out if r.language == "b") == pytest.approx(0.65, rel=X.TOLERANCE)


def test_targets_that_exclude_each_other_end_with_a_warning(spark):
    cells = spark.createDataFrame([("a", "a", "t", 10), ("b", "b", "t", 10)], "source string, language string, topic string, tokens long")
    to = lambda m, **w: spark.createDataFrame(list(w.items()), f"{m} string, target double")
    targets = {"source": to("source", a=0.7, b=0.3), "language": to("language", a=0.2, b=0.8), "topic": to("topic", t=1.0)}
    with pytest.warns(UserWarning, match="marginal error"):
        X.rake(cells, targets, 2)
