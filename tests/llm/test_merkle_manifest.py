import hashlib
import random
import zlib

import pytest

from wardflow.llm import merkle_manifest as mm

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute_force(rows):
    trees = {}
    for lang in sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = mine, levels([leaf(r) for r in mine])
    top = levels([t[1][-1][0] for t in trees.values()]) if trees else []
    out = []
    for place, (mine, own) in enumerate(trees.values()):
        for i, row in enumerate(mine):
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None
            node, proof = leaf({**row, "n_chars": row["n_chars"] + 1} if hit else row), []
            for tree, at in ((own, i), (top, place)):
                for nodes in tree[:-1]:
                    other = nodes[at ^ 1 : (at ^ 1) + 1]
                    proof += other
                    node = h(*other, node) if at % 2 else h(node, *other)
                    at //= 2
            root = top[-1][0]
            out.append((row["doc_id"], leaf(row), own[-1][0], root, h(*proof), node, node == root))
    return sorted(out, key=str)


def made(n, langs, seed):
    some = random.Random(seed)
    rows = [
        dict(zip(FIELDS, (some.choice([None, some.randrange(50)]) if i % 9 == 0 else 3 * i, some.choice([None, "", "a"]),
             None if i % langs == 0 else f"l{i % langs}", some.choice([None, 4, 2**63 - 1]), some.choice([None, "", "xé", "y\n"]))))
        for i in range(n)
    ]
    return rows + rows[: n // 10]


@pytest.mark.parametrize("n, langs", [(1, 1), (3, 2), (300, 300), (700, 3)])
def test_equals_brute_force(spark, n, langs):
    rows = made(n, langs, n)
    found = mm.prove(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_no_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "s", "en", 2, "ab", "x", 1, "y")], SCHEMA + ", grp string, idx long, digest string")
    assert mm.prove(docs.limit(0)).count() == 0
    row = mm.prove(docs).first()
    assert row["root"] == row["leaf"] == leaf(dict(zip(FIELDS, (1, "s", "en", 2, "ab")))) and row["proof_sha256"] == h()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 21, 64])
@pytest.mark.parametrize("more", [0, 2])
def test_logs_are_in_postorder_and_addressed_by_closed_form(size, more):
    digests = [bytes([i]) * 32 for i in range(size)]
    height = mm.depth(size) + more
    log = mm.append_log(digests, height)
    nodes = digests
    for level in range(height + 1):
        for i, node in enumerate(nodes):
            last = min((i + 1) << level, size) - 1
            assert log[mm.position(last, level)] == node
            assert mm.subtree(i << level, last, level) <= 2 ** (level + 1) - 1 + (height if last == size - 1 else 0)
        nodes = [mm.combine(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    assert len(log) == mm.position(size - 1, height) + 1
    for i, digest in enumerate(digests):
        assert mm.fold(digest, mm.siblings(b"".join(log), i, size, height)) == log[-1]


def test_leaf_positions_tell_all_leaves_of_a_language_apart(spark):
    rows = made(600, 1, 5)
    found = mm.manifest(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA))
    assert found.select("leaf_position").distinct().count() == len(rows)
