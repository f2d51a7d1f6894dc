"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence about a text's language are combined as logarithms:

* the text: a naive Bayes model over hashed byte trigrams, tempered so that a long text does not
  drown all else;
* the language that its markup or metadata declares;
* the suffix of its address;
* a prior of its host, smoothed towards its domain and that towards the whole corpus.

The candidates are the given languages and every language that the corpus declares well: a tag
whose primary subtag has two or three letters, on at least ``LANGUAGE_ROWS`` rows and
``LANGUAGE_SHARE`` of the tagged ones. A language without any text of its own is none.

The text model is counted over every text declared in a candidate, by a grouped aggregation. A
text's own posterior then votes for its host, domain, declared tag and suffix; what its neighbours
say is the sum over all rows less the row's own vote. Nothing is collected but the counts of tags
and the text model, whose size is fixed by ``BUCKETS`` and the number of languages.

The background (every trigram equally likely) is one more class of each posterior, with the prior
``BACKGROUND`` whatever host, tag and suffix say. Words with an ASCII digit (keys, numbers) are no
evidence, for or against a language. A row is rejected when it has no letters to judge
by, when the background's posterior reaches ``SURE``, or when the best language explains its text
worse than the background and does not reach ``SURE`` itself. ``posterior`` is the best language's.
Null or empty texts are rejected with language ``und``. A null host, tag or suffix is a value of
its own. Ties go to the language first in the list: the given ones, then the others by tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import keep_rows, keyed, row_key, slices, stored

#: Languages that are candidates however few rows declare them.
LANGUAGES = ("en", "de", "fr", "es")
#: Rows, and share of all tagged rows, from which a declared language is a candidate.
LANGUAGE_ROWS, LANGUAGE_SHARE = 20, 1e-4
#: Hash buckets of the trigram model.
BUCKETS = 1 << 14
#: Trigrams after which a longer text adds little evidence.
TEMPER = 60.0
#: Weight, in rows, of the corpus in a domain's prior, and of the domain in a host's.
DOMAIN_ROWS, HOST_ROWS = 50.0, 10.0
#: Rows of smoothing in the tables of tags and suffixes.
TAG_ROWS = 5.0
SURE = 0.5
#: Prior of the background beside that of all languages together, which is one.
BACKGROUND = 0.01

# Tags that name no language.
_NO_LANGUAGE = ("und", "mul", "mis", "zxx")
# A word of ASCII characters with a digit; it is only sought at a word's start, once.
_CODE = re.compile(r"(?<![!-~])[!-/:-~]*+[0-9][!-~]*+")
_LETTER = re.compile(r"[^\W\d_]")


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and owner of every byte trigram of the lower-cased texts, each wrapped in blanks."""
    parts = [f" {_CODE.sub(' ', t).lower()} ".encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    data = np.where(data <= 32, np.uint8(32), data)
    code = data[:-2].astype(np.uint32)
    code <<= np.uint32(8)
    code |= data[1:-1]
    code <<= np.uint32(8)
    code |= data[2:]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[:-2]
    inside = np.ones(len(bucket), dtype=bool)
    for back in (1, 2):  # trigrams that reach into the next text
        at = ends[:-1] - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return bucket[inside], owner[inside]


def _counted(languages: tuple[str, ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(languages), BUCKETS), np.int64)
        for part in slices(batches):
            tags = part.column("tag").to_pylist()
            texts = part.column("text").to_pylist()
            own: dict[str, list[str]] = {}
            for tag, text in zip(tags, texts):
                own.setdefault(tag, []).append(text)
            for language, some in own.items():
                table[languages.index(language)] += np.bincount(_trigrams(some)[0], minlength=BUCKETS)
        k, bucket = np.nonzero(table)
        names = ["language", "bucket", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(table[k, bucket])], names)

    return run


def candidates(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> tuple[str, ...]:
    """The given languages that any row of ``tag`` declares, then the others that enough rows declare."""
    counts = rows.where("tag != ''").groupBy("tag").agg(F.count("*").alias("n"))
    least = max(LANGUAGE_ROWS, LANGUAGE_SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
    may_be = F.col("tag").rlike("^[a-z]{2,3}$") & ~F.col("tag").isin(*_NO_LANGUAGE) & (F.col("n") >= least)
    # At most 1 / LANGUAGE_SHARE rows and the given ones.
    found = {x["tag"] for x in counts.where(may_be | F.col("tag").isin(*languages)).collect()}
    return tuple(x for x in languages if x in found) + tuple(sorted(found.difference(languages)))


def text_model(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """log P(trigram bucket | language), one row per language, over all rows of ``tag`` and ``text``."""
    counts = np.full((len(languages), BUCKETS), 0.5)
    known = rows.where(F.col("tag").isin(*languages)).select("tag", "text")
    found = known.mapInArrow(_counted(languages), "language int, bucket int, n long")
    # At most languages x BUCKETS rows, whatever the corpus.
    found = found.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    language, bucket, n = (found.column(c).to_numpy() for c in ("language", "bucket", "n"))
    counts[language, bucket] += n
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _shares(scores: np.ndarray) -> np.ndarray:
    """Rows of logarithms as shares of their row."""
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _judged(model: np.ndarray, keep: list[str]):
    """Per text: the evidence of each language over the background, and its vote."""
    floor = -np.log(BUCKETS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            bucket, owner = _trigrams(texts)
            n = np.bincount(owner, minlength=len(texts))
            mean = np.stack([np.bincount(owner, weights=m[bucket], minlength=len(texts)) for m in model], axis=1)
            mean = mean / np.maximum(n, 1)[:, None] - floor
            weight = TEMPER * n / (n + TEMPER)
            letters = np.array([_LETTER.search(t) is not None for t in texts])
            logs = mean * weight[:, None] * letters[:, None]
            # What goes to the background is no vote for any language.
            vote = _shares(np.append(logs, np.full((len(logs), 1), np.log(BACKGROUND * len(model))), axis=1))[:, :-1]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(model), pa.int32()), pa.array(x.ravel()))
                for x in (logs, vote)
            ]
            more = [*lists, pa.array(letters), pa.array(mean.max(axis=1) > 0)]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + more, names=[*keep, "logs", "vote", "letters", "fits"]
            )

    return run


def _fused(languages: tuple[str, ...], corpus_votes: np.ndarray):
    """Rows with their own vote and the votes of their domain, host, tag and suffix: the verdict."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            table = lambda c: part.column(c).flatten().to_numpy().reshape(part.num_rows, -1)
            letters, fits = (part.column(c).to_numpy(zero_copy_only=False) for c in ("letters", "fits"))
            own = table("vote") * letters[:, None]

            def less_own(votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """What the other rows say, and its sum; never under zero by rounding."""
                others = np.maximum(votes - own, 0.0)
                return others, others.sum(axis=1, keepdims=True)

            others, total = less_own(corpus_votes)
            corpus = (others + 1.0) / (total + len(languages))
            others, total = less_own(table("domain_votes"))
            domain = (others + DOMAIN_ROWS * corpus) / (total + DOMAIN_ROWS)
            others, total = less_own(table("host_votes"))
            host = (others + HOST_ROWS * domain) / (total + HOST_ROWS)
            scores = table("logs") + np.log(host)
            for name in ("tag", "suffix"):
                # P(value | language) up to a factor: how much more often it goes with the language than the corpus does.
                others, total = less_own(table(f"{name}_votes"))
                scores = scores + np.log((others + TAG_ROWS * corpus) / (total + TAG_ROWS) / corpus)
            shares = _shares(np.append(scores, np.full((len(scores), 1), np.log(BACKGROUND)), axis=1))
            best = shares[:, :-1].argmax(axis=1)
            share = shares[np.arange(len(shares)), best]
            kept = letters & (shares[:, -1] < SURE) & (fits | (share >= SURE))
            named = [languages[i] if k else "und" for i, k in zip(best, kept)]
            columns = [part.column("id"), pa.array(named, pa.string()), pa.array(np.round(share, 6)), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "language", "posterior", "kept"])

    return run


def domain_of(host: Column) -> Column:
    """The last two labels of a host name; other names as they are."""
    return F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def identify(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``rows`` has id, text, host, tag and suffix; the result id, language, posterior, kept.

    ``languages`` are candidates beside those that the tags declare.
    """
    clean = rows.select(
        "id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("tag", F.lit("")).alias("tag"),
        F.coalesce("suffix", F.lit("")).alias("suffix"),
    )
    id_type = dict(rows.dtypes)["id"]
    languages = candidates(clean, languages)
    if not languages:  # no text of a declared language to learn from
        return clean.select("id", F.lit("und").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    model = text_model(clean, languages)
    keep = ["id", "host", "tag", "suffix"]
    schema = ", ".join(
        [f"id {id_type}", *(f"{c} string" for c in keep[1:])] + ["logs array<double>, vote array<double>, letters boolean, fits boolean"]
    )
    judged = stored(clean.mapInArrow(_judged(model, keep), schema).withColumn("domain", domain_of(F.col("host"))), "votes")

    sums = [F.sum(F.when(F.col("letters"), F.col("vote")[i]).otherwise(0.0)) for i in range(len(languages))]

    def votes(*by: str) -> DataFrame:
        return judged.groupBy(*by).agg(F.array(*sums).alias(f"{by[0]}_votes"))

    corpus_votes = np.array([x or 0.0 for x in judged.agg(*sums).first()])  # one number per language
    # One row per host; the domain's votes are joined to that smaller table.
    hosts = stored(votes("host", "domain").join(votes("domain"), "domain").drop("domain"), "host-votes")
    fused = judged.join(hosts, "host").join(votes("tag"), "tag").join(votes("suffix"), "suffix")
    evidence = ["id", "letters", "fits", "logs", "vote", "domain_votes", "host_votes", "tag_votes", "suffix_votes"]
    result = f"id {id_type}, language string, posterior double, kept boolean"
    return fused.select(evidence).mapInArrow(_fused(languages, corpus_votes), result)


def primary_subtag(tag: Column) -> Column:
    """The language of a tag such as ``pt-BR`` or ``fil_PH``, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(tag.cast("string"), r"^\s*([A-Za-z]{2,8})\s*(?:$|[-_])", 1))


def documents_evidence(docs: DataFrame, name: Column | None = None) -> DataFrame:
    """The source stands for the host, the ``lang`` column for the declared language; no address.

    Rows are named by ``doc_id`` or by ``name``.
    """
    return docs.select(
        (F.col("doc_id").cast("long") if name is None else name).alias("id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("host"),
        primary_subtag(F.col("lang")).alias("tag"),
        F.regexp_extract(F.col("source").cast("string"), r"\.([A-Za-z]+)$", 1).alias("suffix"),
    )


def pages_evidence(pages: DataFrame) -> DataFrame:
    """Host and suffix come from the address, the tag from the markup, the text from the page without tags."""
    html = F.coalesce(F.col("html"), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), "<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("id"),
        plain.alias("text"),
        host.alias("host"),
        primary_subtag(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?\s*([A-Za-z0-9_-]+)", 1)).alias("tag"),
        F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"),
    )


def identify_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, language, posterior, kept."""
    return identify(documents_evidence(docs)).withColumnRenamed("id", "doc_id")


def identify_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, language, posterior, kept."""
    return identify(pages_evidence(pages)).withColumnRenamed("id", "page_id")


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a known language, with all their columns; each is judged by itself, whatever its id."""
    judged = identify(documents_evidence(docs, row_key(docs)))
    kept = stored(judged.where("kept").select("id").distinct(), "language-kept")
    return keep_rows(keyed(docs, key=row_key(docs)), kept).select("document.*")
