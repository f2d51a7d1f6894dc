import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import quality_cascade as X

PROSE = "The quick fox runs over some hills and then it sleeps under old trees near water. "


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


TEXTS = ["", "a", "a b c d e a b c d e", "x\nx\n \n \nx", "é\x85ü \x1c b", "#*$ & <>|%", "w " * 5000, PROSE, "\n".join([PROSE] * 3)]


def test_measures_equal_brute_force():
    assert [tuple(t[1:]) for t in X.measured(TEXTS)] == [brute(t) for t in TEXTS]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \n#", max_size=60), max_size=6))
def test_measures_of_random_texts(texts):
    assert [tuple(t[1:]) for t in X.measured(texts)] == [brute(t) for t in texts]


def test_order_changes_the_work_but_no_verdict(spark):
    texts = [*TEXTS, PROSE.upper(), PROSE.replace(" ", "%%% "), "\n".join([PROSE[:40]] * 9 + [PROSE]), "1 22 333 " * 2 + "4 55 6 77 8 9 10"]
    docs = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    rows = X.judge_quality(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 1 and not by_id[None].kept and by_id[None].base_failed
    for i, t in enumerate(X.measured(texts)):
        passes = not X.base_fails(t) and not any(rule.rejects(t) for rule in X.RULES)
        assert (by_id[i].kept, by_id[i].base_failed) == (passes, X.base_fails(t))
    backwards = X.judge_quality(docs, X.RULES[::-1], sample_rows=1).collect()
    assert sorted(map(str, backwards)) == sorted(map(str, rows))


def test_a_rule_that_rejects_more_per_second_comes_first(spark):
    def slow(t):
        return sum(range(20_000)) < 0

    rules = (X.QualityRule("slow", slow), X.QualityRule("all", lambda t: True))
    docs = spark.createDataFrame([(i, PROSE + str(i)) for i in range(50)], "doc_id long, text string")
    assert [r.name for r in X.cascade_order(docs, rules)] == ["all", "slow"]


def test_empty_table(spark):
    assert X.judge_quality(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_clean_documents_are_kept(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 AND toxic = 0")
    judged = X.judge_quality(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed")
    assert judged.join(labels, "doc_id").where("NOT kept").count() == 0
