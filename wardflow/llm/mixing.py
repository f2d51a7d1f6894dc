"""Mixing sources to target weights by iterative proportional fitting.

The tokens of all documents are summed per cell of source, language and topic. Cell weights are
then raked: scaled to the target share of each source, then of each language, then of each topic,
again and again, ``ROUNDS`` times and then until every marginal is within ``TOLERANCE`` of its target.
Targets that cannot be met together stop the rounds when the error no longer falls, or at
``MOST_ROUNDS``, with a warning. A cell's factor over its tokens is the relative rate at which its
documents are wanted; scaled, and one at most, it is the probability with which each of the cell's
documents is drawn, by a hash of its id, so the draw can be repeated.

The scale brings the largest rate to one, so that the draw meets the targets exactly. Where a few
rare cells would thereby hold the draw under ``KEPT_SHARE`` of the wanted tokens, the scale is raised
until that share is drawn: cells that reach one are drawn whole, fall short of their targets, and
leave the rest to the others, whose rates keep their proportions.

Everything is a DataFrame. Documents are aggregated before the first shuffle, so a source with a
third of all rows costs one row per task and cell. The marginal factors are tables; the cells are
broadcast only if there are at most ``BROADCAST_CELLS`` of them.

Default targets temper the observed shares: each value's share to the power ``TEMPER``, so that
small sources, languages and topics gain weight. Null counts as a value of its own, empty texts
weigh one token, and a value without a target (or with target 0) is not drawn. Rows that repeat a
``doc_id`` share its draw; a null id hashes like any value.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import stored

MARGINS = ("source", "language", "topic")
TEMPER = 0.8
#: Rounds of raking, at least and at most; each adjusts all marginals once.
ROUNDS, MOST_ROUNDS = 8, 100
#: Relative error of a marginal at which raking ends; a round that takes off less than this part of the error is the last.
TOLERANCE, LEAST_GAIN = 0.01, 0.001
#: Share of the wanted tokens that is drawn at least.
KEPT_SHARE = 1 / 3
#: A cell row is about 100 bytes.
BROADCAST_CELLS = 20_000
SEED = "mix"
# Characters and phrases that mark a topic.
_SYMBOLS = "#*$%&|<>{}=;"
_LEGAL = r"(?i)\b(licen[sc]ed? under|all rights reserved|released under)"
#: The draw compares this many leading hexadecimal digits of a hash.
DIGITS = 13


def text_of() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def topic_of() -> Column:
    """A coarse topic by markers in the text: licence notices, numbers, symbols, else length of the prose."""
    text = text_of()
    return (
        F.when(text.rlike(_LEGAL), "legal")
        .when((F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))) * 20 > F.length(text), "symbols")
        .when(F.length(text) < 1000, "brief")
        .when(F.length(text) < 10000, "article")
        .otherwise("long")
    )


def tokens_of() -> Column:
    """Words, one at least."""
    return F.greatest(F.regexp_count(text_of(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(1).cast("long"))


def labelled(docs: DataFrame) -> DataFrame:
    """The id, the marginal values and the tokens of each document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        topic_of().alias("topic"),
        tokens_of().alias("tokens"),
    )


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """Target share per value of ``margin``: its token share to a power, scaled to one."""
    own = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("w"))
    total = F.lit(own.agg(F.sum("w")).first()[0] or 1.0)
    return own.select(margin, (F.col("w") / total).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: their shares after raking to the targets of each margin."""
    keys = list(targets)
    wanted = cells
    for margin in keys:
        wanted = wanted.join(targets[margin].withColumnRenamed("target", f"{margin}_target"), margin, "left")
    shares = stored(wanted.fillna(0.0, [f"{m}_target" for m in keys]).withColumn("weight", F.col("tokens").cast("double")), "cells")
    error = float("inf")
    for done in range(1, max(rounds, MOST_ROUNDS) + 1):
        for margin in keys:
            sums = shares.groupBy(margin).agg(F.sum("weight").alias("has"))
            factor = F.when(F.col("has") > 0, F.col(f"{margin}_target") / F.col("has")).otherwise(0.0)
            shares = shares.join(sums, margin).withColumn("weight", F.col("weight") * factor).drop("has")
        shares = stored(shares, "raked")
        if done >= rounds:
            before, error = error, marginal_error(shares, keys)
            if error <= TOLERANCE:
                break
            if error > before * (1 - LEAST_GAIN):
                warnings.warn(f"raking ended after {done} rounds at a marginal error of {error:.3g}", stacklevel=2)
                break
    else:
        if error > TOLERANCE:
            warnings.warn(f"raking ended after {done} rounds at a marginal error of {error:.3g}", stacklevel=2)
    return shares.select(*cells.columns, "weight")


def marginal_error(shares: DataFrame, margins: list[str]) -> float:
    """The largest relative distance of a marginal of ``weight`` from its target, among values with one."""
    worst = 0.0
    for margin in margins:
        sums = shares.groupBy(margin).agg(F.sum("weight").alias("has"), F.first(f"{margin}_target").alias("target"))
        found = sums.where("target > 0").agg(F.max(F.abs(F.col("has") / F.col("target") - 1))).first()[0]
        worst = max(worst, found or 0.0)
    return worst


def probabilities(cells: DataFrame, share: float = KEPT_SHARE) -> DataFrame:
    """``cells`` with ``p``: the weight per token, scaled so that the largest is one or ``share`` is drawn."""
    rate = F.col("weight") / F.col("tokens")
    wanted = cells.where("weight > 0")
    top, weight, tokens = wanted.agg(F.max(rate), F.sum("weight"), F.sum("tokens")).first()
    one = top or 1.0  # the rate that counts as one
    if top and weight / one < share * tokens:
        while True:
            # Cells drawn whole give their tokens; the others must give the rest. The former only become more.
            is_whole = rate >= F.lit(one)
            whole_tokens = F.sum(F.when(is_whole, F.col("tokens")).otherwise(0))
            whole, rest = wanted.agg(whole_tokens, F.sum(F.when(is_whole, 0.0).otherwise(F.col("weight")))).first()
            if not rest or whole >= share * tokens or rest / (share * tokens - whole) >= one * (1 - 1e-12):
                break
            one = rest / (share * tokens - whole)
    return cells.withColumn("p", F.least(rate / F.lit(one), F.lit(1.0)))


def drawn(p: Column, doc_id: Column, seed: str = SEED) -> Column:
    """Whether a document is drawn at probability ``p``."""
    spot = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, DIGITS), 16, 10)
    return spot.cast("double") / F.lit(float(16**DIGITS)) < p


def calibrated(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The probability of each cell, marked for broadcast where the cells are few."""
    targets = targets or {m: tempered(cells, m) for m in MARGINS}
    rates = stored(probabilities(rake(cells, targets, rounds)).select(*MARGINS, "p"), "mix-rates")
    return F.broadcast(rates) if rates.count() <= BROADCAST_CELLS else rates


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, language, topic, tokens, p, drawn.

    ``targets`` has a table of (value, target) for each margin; the shares of a margin sum to one.
    """
    rows = stored(labelled(docs), "labelled")
    cells = stored(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    found = rows.join(calibrated(cells, targets, rounds), list(MARGINS), "left").fillna(0.0, ["p"])
    return found.select("doc_id", *MARGINS, "tokens", F.round("p", 9).alias("p"), drawn(F.col("p"), F.col("doc_id")).alias("drawn"))


def drawn_documents(docs: DataFrame) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns; the rows carry their cell, so no join by id."""
    columns = docs.columns
    whole = docs.withColumn("_document", F.struct(*[docs[c] for c in columns]))
    rows = whole.select(
        "_document",
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        topic_of().alias("topic"),
    )
    cells = stored(labelled(docs).groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    return rows.join(calibrated(cells), list(MARGINS)).where(drawn(F.col("p"), F.col("doc_id"))).select("_document.*")
