import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardflow.llm import token_counts as X


def counted(spark, path, block):
    rows = X.count_tokens(spark.createDataFrame([(str(path),)], "file string"), block).collect()
    return [(r.n_tokens, r.ended) for r in sorted(rows, key=lambda r: r.nth)]


def brute(ids):
    out, n = [], 0
    for i in ids:
        n += 1
        if i == X.END_ID:
            out.append((n - 1, True))
            n = 0
    return out + ([(n, False)] if n else [])


@pytest.mark.parametrize("block", [1, 3, 64, 10_000])
def test_documents_longer_than_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    ids = rng.integers(0, 50_000, 700)
    ids[rng.choice(700, 30, replace=False)] = X.END_ID
    ids[:2] = ids[200:203] = X.END_ID  # documents without tokens
    path = tmp_path / "a.bin"
    path.write_bytes(ids.astype("<u2").tobytes())
    assert counted(spark, path, block) == brute(ids)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.sampled_from([1, 2, X.END_ID]), max_size=40), block=st.integers(1, 9))
def test_random_files(spark, tmp_path_factory, ids, block):
    path = tmp_path_factory.mktemp("tokens") / "a.bin"
    path.write_bytes(np.array(ids, "<u2").tobytes())
    assert counted(spark, path, block) == brute(ids)


def test_documents_round_trip(spark, sf):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(9001, None), (9002, ""), (9003, "<|endoftext|>"), (None, "x")], "doc_id long, text string")
    want = sorted((r.doc_id or 0, len(coder.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.union(more).collect())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in X.document_tokens(docs.union(more)).collect()) == want


def test_empty_table_and_clashing_columns(spark):
    assert X.document_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(1, "a b", "f", 3), (1, "a b", "f", 3)], "doc_id long, text string, file string, nth int")
    assert [tuple(r) for r in X.document_tokens(docs).collect()] == [(1, 2), (1, 2)]
