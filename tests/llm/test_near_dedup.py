import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wardflow.llm import near_dedup as X

SCHEMA = "doc_id long, text string"


def shingles(text, size=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size=3, link=85):
    sets = {i: shingles(t, size) for i, t in rows}
    own = {i: i for i in sets}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= link * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                own[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(spark, rows):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in X.near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_families_chains_and_bystanders(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 200]))]
        for copy in range(rng.choice([1, 3, 25])):
            rows.append((n, edited(rng, base, rng.choice([0, 1, 2, 3, 6]))))
            n += 1
        # A chain: each document is near the one before it, the ends are not near each other.
        chain = list(base)
        for step in range(6):
            chain = chain[3:] + [f"c{step}{k}" for k in range(3)] if len(chain) > 60 else chain[1:] + [f"c{step}"]
            rows.append((n, " ".join(chain)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, "One  two")]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_a_large_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "OUTSIDE", 2)
    monkeypatch.setattr(X, "MEMBERS", 5)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, edited(rng, base, rng.choice([0, 1, 2, 3, 4]))) for i in range(120)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("heavy, tile", [(1, 3), (3, 7), (8, 2048), (1000, 5)])
def test_shared_shingles_are_counted_like_sets(monkeypatch, heavy, tile):
    monkeypatch.setattr(X, "HEAVY", heavy)
    monkeypatch.setattr(X, "TILE", tile)
    rng = np.random.default_rng(heavy)
    common = rng.integers(-(2**63), 2**63, 40)
    some = lambda: np.unique(np.append(rng.choice(common, rng.integers(0, 30)), rng.integers(-(2**63), 2**63, rng.integers(1, 9))))
    members, sets = [rng.permutation(some()) for _ in range(50)], [rng.permutation(some()) for _ in range(20)]
    sets += [members[3], np.array([2**63 - 1])]
    counts = list(X._Counter(members).shared(sets))
    assert [c.tolist() for c in counts] == [[len(set(a) & set(m)) for m in members] for a in sets]


def test_documents_of_one_template_are_told_apart(spark):
    """All are about 0.74 alike, and so share buckets, but for two pairs that are near."""
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base, *(f"d{i}x{k}" for k in range(17))])) for i in range(300)]
    rows += [(300, rows[7][1] + " end"), (301, rows[250][1] + " and end")]
    assert found(spark, rows) == {i: (115 + max(0, i - 299), {300: 7, 301: 250}.get(i, i), i < 300) for i in range(302)}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.none() | st.lists(st.sampled_from("a b C c\n d".split(" ")), max_size=8).map(" ".join), min_size=1, max_size=25))
def test_random_short_texts(spark, texts):
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(rows)


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    assert found(spark, []) == {}
    docs = spark.createDataFrame(
        [(None, "a b c d", 1), (2, "a b c d", 2), (3, "a b c d", 3), (3, "a b c d", 3)], "doc_id long, text string, component long"
    )
    out = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in X.near_dedup(docs).collect()), key=str)
    assert out == [(0, None, True), (2, 2, True), (3, 2, False), (3, 2, False)]
    kept = X.drop_near_copies(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def stage(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA + ", _key string").repartition(3)
    out = X.drop_near_copies(docs)
    assert out.columns == docs.columns
    return sorted([(r.doc_id, r.text) for r in out.collect()], key=str)


def test_stage_takes_five_words_and_four_fifths(spark):
    rng, rows = random.Random(11), []
    base = [f"a{i}" for i in range(100)]
    rows += [(1, " ".join(base)), (2, " ".join([*base, *(f"x{i}" for i in range(20))]))]  # 96 of 116 shingles: near
    other = [f"b{i}" for i in range(200)]
    spread = [f"y{i}" if i % 40 == 20 else w for i, w in enumerate(other)]
    rows += [(3, " ".join(other)), (4, " ".join(spread))]  # 171 of 221: not near by five words, but by three
    for family in range(6):
        words = [f"f{family}w{rng.randrange(300)}" for _ in range(rng.choice([20, 90]))]
        rows += [(10 + 10 * family + k, edited(rng, words, rng.choice([0, 1, 2, 4]))) for k in range(8)]
    verdict = brute(rows, 5, 80)
    assert verdict[2][1] == 1 and verdict[4][2] and not brute(rows)[4][2]
    assert stage(spark, rows) == sorted([r for r in rows if verdict[r[0]][2]], key=str)


def test_stage_with_null_and_shared_ids(spark):
    """Every row is compared by itself; one of each group stays, and the rows without words."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (None, long), (None, long + " more"), (7, "one two"), (7, "three four"), (7, "one two"), (7, long), (8, "one two")]
    rows += [(9, None), (None, "")]
    groups = [{(None, long), (None, long + " more"), (7, long)}, {(7, "one two"), (8, "one two")}, {(7, "three four")}]
    out = stage(spark, rows)
    assert len(out) == 5 and all(sum(r in g for r in out) == 1 for g in groups)
    assert {(9, None), (None, "")} <= set(out)
    twice = [(i, " ".join(f"d{i}w{k}" for k in range(12))) for i in range(30)]
    assert stage(spark, twice + twice) == sorted(twice, key=str)


@pytest.mark.parametrize("size", [1, 2, 7, 100, 3000])
def test_sketches_are_full_and_agree_like_the_sets(size):
    rng = np.random.default_rng(size)
    shared = rng.integers(0, 2**63, size, dtype=np.uint64)
    other = np.concatenate([shared, rng.integers(0, 2**63, max(1, size // 4), dtype=np.uint64)])
    cells = X.sketches(np.concatenate([shared, other]), np.array([len(shared), len(other)]))
    assert not (cells == X._FREE).any()
    similarity = len(shared) / len(other)
    assert abs((cells[0] == cells[1]).mean() - similarity) < (0.15 if size > 5 else 0.6)


def test_shingles_equal_brute_force():
    texts = ["", "a", "A b", "a b c", "x  y\nz\x0bw \x85 é É", "a b c a b c a b"]
    values, sizes = X.shingle_sets(texts)
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    by_hash = defaultdict(set)
    for t, part in zip(texts, np.split(values, np.cumsum(sizes)[:-1])):
        assert (np.diff(part.astype(object)) > 0).all()
        by_hash[tuple(part.tolist())].add(frozenset(shingles(t)))
    assert all(len(same) == 1 for same in by_hash.values())


def test_components_of_long_paths(spark):
    links = [(i + 1, i) for i in range(40)] + [(101, 100), (103, 101), (103, 102)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 105)]], "node long")
    out = X.components(nodes, spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {i: 0 if i < 41 else 104 if i == 104 else 100 for i in [*range(41), *range(100, 105)]}


def test_a_full_block_is_counted_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(3)
    template = rng.integers(0, 1 << 62, 600)

    def text():
        return np.unique(np.append(rng.choice(template, 400, replace=False), rng.integers(0, 1 << 62, 110)))

    members, sets = ([text() for _ in range(n)] for n in (X.MEMBERS, X.OUTSIDE))
    tracemalloc.start()
    shared = [int(row.sum()) for row in X._Counter(members).shared(sets)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000  # 73 MB, with all sets of a block in one matrix
    some = rng.integers(0, len(sets), 5)
    assert [shared[i] for i in some] == [sum(len(np.intersect1d(sets[i], m)) for m in members) for i in some]
