"""Quality rules as a short-circuit cascade.

A rule looks at a few measures of a text and may reject it. On a sample, each rule's cost
(seconds a text) and selectivity (share rejected) are estimated by a Spark job that returns one
row per rule; the cascade then runs the rules in order of rejections per second and passes on to a
rule only what all rules before it let through. The order changes the work, never the verdict.

The base measures are reported for every text, so they are taken first; a text that fails the
base rule skips the cascade.

Null text counts as empty: no words, which fails the base rule.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACE_BYTES, id_text, mix, slices

#: Words of a window, and texts of the sample that orders the rules.
WINDOW = 5
SAMPLE_ROWS = 2_000

_SYMBOLS = "#*$%&|<>"
_WORDS = re.compile("[^\\x20\\x09-\\x0D]")


class Text(NamedTuple):
    """A text and the measures that every rule may use for free."""

    text: str
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


class QualityRule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


def _symbol_heavy(t: Text) -> bool:
    """More than a tenth of the word characters are symbols."""
    return 10 * t.n_symbols > t.word_chars


def _repeated_lines(t: Text) -> bool:
    """More than half of the lines repeat an earlier one."""
    return 2 * t.n_dup_lines > t.text.count("\n") + 1


def _odd_word_length(t: Text) -> bool:
    """Words of fewer than 2 or more than 20 characters on average."""
    return not 2 * t.n_words <= t.word_chars <= 20 * t.n_words


def _shouting(t: Text) -> bool:
    """More than half of the word characters are capitals."""
    return 2 * sum(map(str.isupper, t.text)) > t.word_chars


def _few_letters(t: Text) -> bool:
    """Fewer than half of the word characters are letters."""
    return 2 * sum(map(str.isalpha, t.text)) < t.word_chars


def _exclaiming(t: Text) -> bool:
    """More than one exclamation or question mark for every four words."""
    return 4 * (t.text.count("!") + t.text.count("?")) > t.n_words


RULES = (
    QualityRule("few_letters", _few_letters),
    QualityRule("shouting", _shouting),
    QualityRule("odd_word_length", _odd_word_length),
    QualityRule("repeated_lines", _repeated_lines),
    QualityRule("exclaiming", _exclaiming),
    QualityRule("symbol_heavy", _symbol_heavy),
)


def _repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text: the words that lie in a window found twice or more in that text."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.empty(int(sizes.sum()), dtype=object)
    flat[:] = [w for some in words for w in some]
    if len(flat) < WINDOW:
        return np.zeros(len(words), np.int64)
    ids = pd.util.hash_array(flat, categorize=False)
    owner = np.repeat(np.arange(len(words)), sizes)
    key = owner[: len(flat) - WINDOW + 1].astype(np.uint64)
    for k in range(WINDOW):
        key = mix(key + np.uint64(0x9E3779B97F4A7C15)) ^ ids[k : len(flat) - WINDOW + 1 + k]
    at = np.flatnonzero(owner[: len(key)] == owner[WINDOW - 1 :])  # windows inside one text
    order = at[np.argsort(mix(key[at]), kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(len(flat) + 1, dtype=np.int64)
    starts = order[twice]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(words))


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if _WORDS.search(x)]
    return len(lines) - len(set(lines))


def measured(texts: list[str]) -> list[Text]:
    """The base measures of each text."""
    words = [t.encode().split() for t in texts]  # bytes split at the six ASCII spaces only
    repeats = _repeat_words(words)
    return [
        Text(
            t,
            len(w),
            len(t) - sum(t.count(chr(c)) for c in SPACE_BYTES),
            sum(map(t.count, _SYMBOLS)),
            _dup_lines(t),
            int(r),
        )
        for t, w, r in zip(texts, words, repeats)
    ]


def base_fails(t: Text) -> bool:
    return t.n_words < 10 or 100 * t.n_repeat_words > 20 * t.n_words


def _trial(rules: tuple[QualityRule, ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for part in slices(batches):
            texts = [t for t in measured(part.column("text").to_pylist()) if not base_fails(t)]
            seen += len(texts)
            for i, rule in enumerate(rules):
                start = time.perf_counter()
                rejected[i] += sum(rule.rejects(t) for t in texts)
                spent[i] += time.perf_counter() - start
        rows = [pa.array(range(len(rules)), pa.int32()), pa.array(spent), pa.array(rejected, pa.int64())]
        yield pa.RecordBatch.from_arrays([*rows, pa.array([seen] * len(rules), pa.int64())], ["rule", "s", "r", "n"])

    return run


def cascade_order(docs: DataFrame, rules: tuple[QualityRule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[QualityRule]:
    """The rules by rejections per second, as estimated on about ``rows`` texts drawn by hash."""
    total = docs.count()
    share = min(1.0, rows / max(1, total))
    drawn = id_text(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    trial = drawn.mapInArrow(_trial(rules), "rule int, s double, r long, n long")
    found = {x["rule"]: x for x in trial.groupBy("rule").agg(F.sum("s").alias("s"), F.sum("r").alias("r")).collect()}

    def worth(i: int) -> tuple:
        x = found.get(i)
        return (-(x["r"] / (x["s"] or 1e-9)), x["s"]) if x else (0.0, 0.0)

    return [rules[i] for i in sorted(range(len(rules)), key=worth)]


def _cascade(rules: list[QualityRule]):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = measured(part.column("text").to_pylist())
            failed = [base_fails(t) for t in texts]
            left = [i for i, bad in enumerate(failed) if not bad]
            for rule in rules:
                left = [i for i in left if not rule.rejects(texts[i])]
            kept = np.zeros(len(texts), dtype=bool)
            kept[left] = True
            counts = [pa.array([getattr(t, n) for t in texts], pa.int64()) for n in names[1:6]]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts, pa.array(failed, pa.bool_()), pa.array(kept)], names=names
            )

    return run


def judge_quality(docs: DataFrame, rules: tuple[QualityRule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: the base measures, base_failed and kept."""
    ordered = cascade_order(docs, rules, sample_rows)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return id_text(docs).mapInArrow(_cascade(ordered), f"{schema}, base_failed boolean, kept boolean")
