"""Rule violations of all segments from one scan of the messages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import let
from wardflow.functions.values import hl7_ts
from wardflow.operators.quality import TEMPORAL, WARN, Rule
from wardflow.operators.segments import LAYOUTS, layout_columns


def _own_columns(kind: str) -> dict[str, Column]:
    """A segment's columns, cut from ``__parts``, as its rules see them."""
    names = [x.split()[0] for x in LAYOUTS[kind].columns.split(",")]
    columns = dict(zip(names, layout_columns(kind, F.col("__parts"))))
    if "result_status" in columns:
        columns.setdefault("observation_result_status", columns["result_status"])
    return {n: let(c, hl7_ts) if n in TEMPORAL else c for n, c in columns.items()}


def message_report(messages: DataFrame, rules: dict[str, list[Rule]]) -> DataFrame:
    """Rows, failures and failure rate per rule, for the rules of several segments.

    Each message is cut into lines once. A line is judged by the rules of its own
    segment, and one aggregate counts for all of them, so the text is read once
    however many segments have rules. Of a segment that has one row per message,
    the first line counts.
    """
    lines = F.split("raw_message", "\r")
    cut = messages.where(F.col("raw_message").like("MSH%") | F.col("raw_message").contains("\rMSH"))
    cut = cut.select(F.transform(lines, lambda x: F.substring(x, 1, 3)).alias("__kinds"), F.posexplode(lines).alias("__pos", "__line"))
    kind = F.substring("__line", 1, 3)
    first = F.array_position("__kinds", kind) == F.col("__pos") + 1
    single = [k for k in rules if not LAYOUTS[k].repeats]
    cut = cut.select(kind.alias("__kind"), first.alias("__first"), F.split("__line", r"\|").alias("__parts"))
    cut = cut.where(F.col("__kind").isin(*rules) & (F.col("__first") | ~F.col("__kind").isin(*single)))

    columns, counts = [], []
    for segment, own in rules.items():
        named = _own_columns(segment)
        # Only lines of the segment are cut up and parsed for it.
        columns += [F.when(F.col("__kind") == segment, c).alias(f"{segment}__{n}") for n, c in named.items()]
        word = re.compile(rf"(?<!')\b({'|'.join(sorted(named, key=len, reverse=True))})\b")
        mine = F.col("__kind") == segment
        counts.append(F.count_if(mine).alias(f"{segment}__rows"))
        for rule in own:
            held = F.coalesce(F.expr(word.sub(rf"{segment}__\1", rule.constraint)), F.lit(rule.action == WARN))
            counts.append(F.count_if(mine & ~held).alias(f"{segment}__failed__{rule.name}"))
    totals = cut.select("__kind", *columns).agg(*counts)
    entries = [
        F.struct(
            F.lit(segment).alias("segment"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col(f"{segment}__rows").alias("rows_checked"),
            F.col(f"{segment}__failed__{rule.name}").alias("failures"),
        )
        for segment, own in rules.items()
        for rule in own
    ]
    out = totals.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return out.withColumn("failure_rate", F.try_divide(F.col("failures"), F.col("rows_checked")))
