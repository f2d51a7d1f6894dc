import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import secret_scan as X

HEX = "0123456789abcdef" * 2
TEXTS = [
    None, "", "nothing here", "password=abc", 'Password : "abcdef1"', "API_KEY='ab/cd+ef=' apikey=zzzzzz",
    "token = tokens token:secret1234", "paſſword=abcdefgh KEY", "é token=abcdef\n" + HEX, "AKIA" + "Z9" * 8 + " AKIA" + "Q" * 15,
    "x" + HEX + "g" + HEX[:23] + " " + HEX.upper(), "secret=" + HEX, "passwd=" + "a" * 100_000,
    "-----BEGIN RSA PRIVATE KEY-----\n ghp_" + "z9" * 18 + " xoxb-1234567890ab",
]


def brute(text):
    text = text or ""
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(X.BASE_RULES):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    said = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
    count = lambda k: sum(s[3] == k for s in spans)
    return count("assign"), count("access"), count("hex"), hashlib.sha256(said.encode()).hexdigest()


def test_base_spans_equal_a_full_scan(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, HEX)], "doc_id long, text string")
    out = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in X.scan_secrets(docs).collect()}
    assert out == {i: brute(t) for i, t in enumerate(TEXTS)} | {None: brute(HEX)}


def test_documents_equal_a_full_scan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in X.scan_secrets(docs).collect()} == want


def test_more_kinds_are_reported_besides(spark):
    (row,) = X.scan_secrets(spark.createDataFrame([(1, TEXTS[-1], 3)], "doc_id long, text string, spans int")).collect()
    kinds = [s.split(":")[0] for s in row.spans.split(",")]
    assert kinds == ["private", "github", "slack"] and row.base_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert X.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_queries_follow_the_expressions():
    assert X.trigram_query(r"AKIA[A-Z0-9]+") == ("all", [b"aki", b"kia"])
    assert X.trigram_query(r"[0-9a-f]+") is None
    assert X.trigram_query(r"(abc|xy)+z") is None  # xy has no trigram
    assert X.trigrams(X.trigram_query(r"(?:abcd|wxyz)[0-9]?q")) >= {b"abc", b"bcd", b"wxy", b"xyz"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("pasword=tkenAKI123456 \n", max_size=40), min_size=1, max_size=8))
def test_no_match_is_filtered_out(texts):
    for rule in X.RULES:
        query = X.trigram_query(rule.pattern)
        postings = X.segment_postings([t.encode() for t in texts], sorted(X.trigrams(query)))
        kept = set(X.candidates(query, postings, len(texts)).tolist())
        assert kept >= {i for i, t in enumerate(texts) if re.search(rule.pattern, t)}


def test_runs_are_read_once():
    """Time grows with the text, not with its square, where every place might start a match."""
    for rule in X.RULES:
        for piece in ("eyJ", "AKIA", "password=", "xoxb-", "ghp_", "-----BEGIN A ", "token  ", "deadbeef"):
            start = time.perf_counter()
            sum(1 for _ in re.compile(rule.pattern).finditer(piece * (1_000_000 // len(piece))))
            assert time.perf_counter() - start < 3, (rule.kind, piece)


def test_tokens_of_three_parts():
    jwt = next(r for r in X.RULES if r.kind == "jwt")
    text = "x eyJhbGciOiJI.eyJzdWIiOiIx.abc_-9. eyJshort.eyJzdWIiOiIx.a"
    assert [m.span() for m in re.finditer(jwt.pattern, text)] == [(2, 34)]
