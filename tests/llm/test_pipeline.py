"""The pipeline against a brute-force version of its deterministic stages, on a small corpus."""

import random

import pytest

import corpus_pipeline
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_language_id import SAID
from tests.llm.test_near_dedup import brute as near_brute
from wardflow.llm import mixing
from wardflow.llm.language_id import LANGUAGES
from wardflow.llm.tokens import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(3), []
    for i in range(240):
        language = LANGUAGES[i % 4]
        words = SAID[language].split(" ") * 3
        rng.shuffle(words)
        out.append((i, " ".join(words), language, "hot" if i % 3 else f"s{i % 4}"))
    texts = [r[1] for r in out]
    out += [(300 + i, texts[i] + " ", out[i][2], "hot") for i in range(0, 40, 4)]  # exact copies but for white space
    out += [(400 + i, texts[i] + " extra", out[i][2], "hot") for i in range(1, 40, 4)]  # near copies
    out += [(500, "", "en", "hot"), (501, None, "de", "s1"), (502, "12 34", "en", "s2"), (503, None, None, None)]
    return [(*r, len(r[1] or "")) for r in out]


def test_stages_equal_brute_force(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS kept")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = [r[:2] for r in rows if r[0] < 500]  # language ID rejects texts without letters
    exact = exact_brute(want)
    want = [r for r in want if exact[r[0]][2]]
    near = near_brute(want, 5, 80)
    want = [r for r in want if near[r[0]][2]]
    got = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, got, str(tmp_path))
        assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in want)
    assert len(want) < 240 + 10  # copies went
    drawn = {r.doc_id for r in mixing.mix(got).where("drawn").collect()}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == drawn
    text = dict(want)
    sizes = dict(zip(drawn, (len(x) + 1 for x in encoder(marker=True)([text[i] for i in drawn]))))
    for i in drawn:
        assert sum(r.length for r in out if r.doc_id == i) == sizes[i]


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"
    ]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
