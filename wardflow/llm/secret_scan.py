"""Secret scanning with a trigram inverted index.

Every rule is a regular expression. From its parse tree a Boolean trigram query is derived: a
text that matches must hold, for each mandatory piece of the expression, all trigrams of one of
the piece's possible strings. Tasks index their texts in segments: postings list the texts of the
segment that hold a trigram. A rule's postings are intersected and united as its query says, and
the expression runs on the remaining candidates only. A rule without a mandatory trigram (a run
of hexadecimal digits) scans every text.

Postings stay beside the segment's texts, so no text is shuffled, and only trigrams that some
rule asks for are posted. Trigrams are taken of bytes with A-Z in lower case, so a query can only
let too many texts through, never too few.

Null text counts as empty. Spans count code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import re._parser as parse_tree
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardflow.llm.common import id_text, slices


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # the group whose length counts
    least: int  # its least number of characters


# The base rules, in the order that breaks ties.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)

#: Further kinds; each has a prefix that does not occur in prose.
MORE_RULES = (
    Rule("private", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    # Only at the start of a run, which is then taken whole, so a run is read once.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+", 0, 1),
)

RULES = BASE_RULES + MORE_RULES

#: A piece of an expression with more possible strings than this counts as unknown.
MOST_STRINGS = 64

# A query is ("all", [queries]), ("any", [queries]), a trigram (bytes), or None: no condition.


def _both(queries: list) -> object:
    known = [q for q in queries if q is not None]
    return None if not known else known[0] if len(known) == 1 else ("all", known)


def _either(queries: list) -> object:
    if not queries or any(q is None for q in queries):
        return None
    return queries[0] if len(queries) == 1 else ("any", queries)


def _of_strings(strings: set[bytes]) -> object:
    """Any of the strings, each by all of its trigrams."""
    return _either([_both([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _alone(node) -> tuple[set[bytes] | None, object]:
    """(possible strings of the node or None, query of the node when they are not known)."""
    name, value = str(node[0]), node[1]
    if name == "LITERAL":
        return {chr(value).encode().lower()}, None
    if name == "IN":
        if len(value) <= 8 and all(str(op) == "LITERAL" for op, _ in value):
            return {chr(c).encode().lower() for _, c in value}, None
        return None, None
    if name == "SUBPATTERN":
        return _sequence(value[-1])
    if name == "BRANCH":
        parts = [_sequence(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            strings = set().union(*(s for s, _ in parts))
            if len(strings) <= MOST_STRINGS:
                return strings, None
        return None, _either([q if s is None else _of_strings(s) for s, q in parts])
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, body = value
        strings, query = _sequence(body)
        if strings is not None and most == 1:
            return strings | ({b""} if least == 0 else set()), None
        if least == 0:
            return None, None
        return None, query if strings is None else _of_strings(strings)
    if name == "AT":
        return {b""}, None
    return None, None


def _sequence(nodes) -> tuple[set[bytes] | None, object]:
    """Joins neighbours whose strings are known; cuts into conditions where they are not."""
    strings: set[bytes] = {b""}
    conditions, whole = [], True
    for node in nodes:
        these, query = _alone(node)
        joined = None if these is None else {a + b for a in strings for b in these}
        if joined is None or len(joined) > MOST_STRINGS:
            conditions += [_of_strings(strings), query]
            strings, whole = these or {b""}, False
        else:
            strings = joined
    if whole:
        return strings, None
    return None, _both([*conditions, _of_strings(strings)])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every match of ``pattern`` satisfies, or None."""
    strings, query = _sequence(parse_tree.parse(pattern))
    return query if strings is None else _of_strings(strings)


def trigrams(query: object) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1]))


def segment_postings(texts: list[bytes], wanted: list[bytes]) -> dict[bytes, np.ndarray]:
    """For each wanted trigram the positions in ``texts`` of the texts that hold it, ascending."""
    joined = np.frombuffer(b"\n\n\n".join(texts).lower(), dtype=np.uint8)
    if joined.size < 3 or not wanted:
        return {w: np.empty(0, np.int64) for w in wanted}
    starts = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
    number = np.zeros(1 << 24, np.uint8)
    for i, w in enumerate(wanted):
        number[int.from_bytes(w, "big")] = i + 1
    code = joined[:-2].astype(np.int32)
    code <<= 8
    code |= joined[1:-1]
    code <<= 8
    code |= joined[2:]
    tag = number[code]
    at = np.flatnonzero(tag)
    owner = np.searchsorted(starts, at, side="right") - 1
    pairs = np.unique(tag[at].astype(np.int64) * len(texts) + owner)
    cuts = np.searchsorted(pairs, np.arange(1, len(wanted) + 2) * len(texts))
    return {w: pairs[cuts[i] : cuts[i + 1]] - (i + 1) * len(texts) for i, w in enumerate(wanted)}


def candidates(query: object, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """The texts of a segment of ``n`` texts that can match."""
    if query is None:
        return np.arange(n)
    if isinstance(query, bytes):
        return postings[query]
    found = [candidates(q, postings, n) for q in query[1]]
    if query[0] == "any":
        return np.unique(np.concatenate(found))
    found.sort(key=len)
    both = found[0]
    for other in found[1:]:
        both = np.intersect1d(both, other, assume_unique=True)
    return both


def _scan(rules: tuple[Rule, ...]):
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams, queries)))
    if len(wanted) > 255:
        raise ValueError(f"{len(wanted)} trigrams; at most 255 can be posted in one index")
    base = [r.kind for r in rules if r in BASE_RULES]
    counts = [f"n_{k}" for k in base]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [re.compile(r.pattern) for r in rules]
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            postings = segment_postings([t.encode() for t in texts], wanted)
            spans: dict[int, list] = {}
            for rank, (rule, regex, query) in enumerate(zip(rules, found, queries)):
                for i in candidates(query, postings, len(texts)):
                    for m in regex.finditer(texts[i]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans.setdefault(int(i), []).append((m.start(), rank, m.end()))
            rows = []
            for i in range(len(texts)):
                here = sorted(spans.get(i, ()))
                say = [(rules[k].kind, f"{rules[k].kind}:{a}:{b}") for a, k, b in here]
                own = ",".join(s for kind, s in say if kind in base)
                kinds = [kind for kind, _ in say]
                digest = hashlib.sha256(own.encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in base), digest, ",".join(s for _, s in say)))
            columns = list(zip(*rows))
            arrays = [pa.array(c, pa.int64()) for c in columns[: len(base)]]
            arrays += [pa.array(c, pa.string()) for c in columns[len(base) :]]
            names = ["doc_id", *counts, "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=names)

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in counts), "base_sha256 string", "spans string"])
    return run, schema


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: the counts per base kind, the digest of the base spans, all spans."""
    run, schema = _scan(rules)
    return id_text(docs).mapInArrow(run, schema)
