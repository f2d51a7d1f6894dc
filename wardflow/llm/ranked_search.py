"""Ranked lexical search: items against all documents as dense, blocked matrix products.

Items are taken in blocks of a bounded size. A block has its own compact vocabulary, the terms that
its items use, cut into tiles. Documents are read once per block and kept as the frequencies of
these terms; then tile by tile the matrix of items and terms (the terms' weights) is multiplied
by the matrix of terms and documents (the impacts), both dense, in float64, by BLAS.

All numbers are whole. An impact is under 10^6, and a tile of the vocabulary ends before its
weights could sum to more than 2^53 / 10^6, so every partial sum is under 2^53 and exact in
whatever order it is made. Sums over tiles are kept in 64-bit integers.

A task keeps, per item, the best documents of the tiles so far by (score, doc_id), so a tie at the
last place goes to the smaller id, also across tiles. The tasks' lists are merged in two steps,
first among ``MERGE`` tasks. Nothing is shuffled but these lists and one count per term and task.

Terms are runs of digits, letters and characters beyond ASCII, only A-Z in lower case. A null or
empty text has no terms: such an item has no result, such a document is in none and does not count.
A null ``doc_id`` ranks after all others of its score. Repeated documents are ranked each, and
repeated items each have results of their own. Without documents or items there are no rows.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import id_text, once, slices, stored

RESULTS = 10
#: A block of items ends at one of these, or after one item: items, distinct terms, bytes of terms.
BLOCK_ITEMS, BLOCK_TERMS, BLOCK_BYTES = 256, 1 << 15, 4 << 20
#: Terms and documents of a tile: 8 MB of impacts.
TILE_TERMS, TILE_DOCS = 2048, 512
#: Every impact is under this, as 10^9 tf / (1000 tf + 8 m) is for m > 0.
MOST_IMPACT = 10**6
EXACT = 1 << 53
#: Tasks whose lists are merged in the first step.
MERGE = 64
#: Bytes of one text that are cut into terms at a time.
CHUNK = 4 << 20

_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
_POSTING = "doc_id long, n long, terms array<int>, tfs array<long>"
_HIT = "item int, doc_id long, score long, part int"
_LAST = np.iinfo(np.int64).max


def _chunks(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded number of bytes at a time."""
    data = text.encode().translate(_TABLE)
    at = 0
    while at < len(data):
        end = len(data) if at + CHUNK >= len(data) else data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(text: str) -> Counter:
    counts: Counter = Counter()
    for words in _chunks(text):
        counts.update(words)
    return counts


@dataclass
class Block:
    """Items with a vocabulary of their own."""

    item_ids: list = field(default_factory=list)
    terms: list[list[int]] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    size: int = 0

    def full(self, terms: Iterable[bytes]) -> bool:
        """Whether an item with these terms must go to the next block."""
        new = [t for t in terms if t not in self.vocabulary]
        return bool(self.item_ids) and (
            len(self.item_ids) >= BLOCK_ITEMS
            or len(self.vocabulary) + len(new) > BLOCK_TERMS
            or self.size + sum(map(len, new)) > BLOCK_BYTES
        )

    def add(self, item_id, terms: Iterable[bytes]) -> None:
        numbers = []
        for term in terms:
            if term not in self.vocabulary:
                self.vocabulary[term] = len(self.vocabulary)
                self.size += len(term)
            numbers.append(self.vocabulary[term])
        self.item_ids.append(item_id)
        self.terms.append(numbers)


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks; the driver holds one of them and one partition of items."""
    here = Block()
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in texts.toLocalIterator():
        terms = list(term_counts(row["text"] or ""))
        if not terms:
            continue
        if here.full(terms):
            yield here
            here = Block()
        here.add(row["item_id"], terms)
    if here.item_ids:
        yield here


def _postings(vocabulary: dict[bytes, int]):
    """Documents to their number of terms and their frequencies of the vocabulary's terms."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches):
            rows = []
            for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                counts = term_counts(text)
                if counts:
                    found = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                    rows.append((doc_id, counts.total(), [t for t, _ in found], [c for _, c in found]))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _tally(size: int):
    """Per task: documents with each term (by number), documents (-1) and terms (-2)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having, docs, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            having += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            docs += batch.num_rows
            terms += int(batch.column("n").to_numpy().sum())
        met = np.flatnonzero(having)
        keys, counts = [*met.tolist(), -1, -2], [*having[met].tolist(), docs, terms]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(counts, pa.int64())], names=["term", "n"])

    return run


def weights(having: np.ndarray, docs: int) -> list[int]:
    """The weight of each term from the number of documents that hold it."""
    return [math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in having.tolist()]


def tiles(weight: list[int], most: int = TILE_TERMS) -> list[tuple[int, int]]:
    """Ranges of terms whose scores stay exact in float64."""
    out, start, total = [], 0, 0
    for i, w in enumerate(weight):
        if i > start and (i - start >= most or (total + w) * MOST_IMPACT >= EXACT):
            out.append((start, i))
            start, total = i, 0
        total += w
    return [*out, (start, len(weight))] if weight else out


def _item_tiles(terms: list[list[int]], weight: list[int], most: int) -> list[tuple[int, int, np.ndarray]]:
    """Per tile of terms: its range and the dense matrix of items and weights."""
    whole = []
    for start, end in tiles(weight, most):
        dense = np.zeros((len(terms), end - start))
        for i, numbers in enumerate(terms):
            inside = [t for t in numbers if start <= t < end]
            dense[i, [t - start for t in inside]] = [weight[t] for t in inside]
        whole.append((start, end, dense))
    return whole


class Best:
    """The best documents of each item so far, in order of falling score and rising id."""

    def __init__(self, items: int, results: int):
        self.results = results
        self.score = np.zeros((items, results), np.int64)
        self.key = np.full((items, results), _LAST)
        self.null = np.zeros((items, results), bool)

    def add(self, scores: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        """``scores`` of items and documents, whose ids are ``key``; null ids have the last key."""
        last, last_key = self.score[:, -1:], self.key[:, -1:]
        better = (scores > last) | ((scores == last) & (scores > 0) & (key < last_key))
        rows, columns = np.nonzero(better)
        starts = np.searchsorted(rows, np.arange(len(scores) + 1))
        for item in np.unique(rows):
            found = columns[starts[item] : starts[item + 1]]
            score = np.concatenate([self.score[item], scores[item, found]])
            keys = np.concatenate([self.key[item], key[found]])
            nulls = np.concatenate([self.null[item], null[found]])
            order = np.lexsort((nulls, keys, -score))[: self.results]
            self.score[item], self.key[item], self.null[item] = score[order], keys[order], nulls[order]

    def rows(self, part: int) -> pa.RecordBatch:
        item, place = np.nonzero(self.score)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(item.astype(np.int32)),
                pa.array(self.key[item, place], pa.int64(), mask=self.null[item, place]),
                pa.array(self.score[item, place]),
                pa.array(np.full(len(item), part, np.int32)),
            ],
            names=["item", "doc_id", "score", "part"],
        )


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (10**9 * tf) // (1000 * tf + 8 * m)


def _scored(terms: list[list[int]], weight: list[int], docs: int, length: int, results: int, tile: tuple[int, int]):
    """Postings of documents to the best of them per item."""
    name = f"search-{uuid.uuid4().hex}"
    tile_terms, tile_docs = tile

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = once(name, lambda: _item_tiles(terms, weight, tile_terms))
        best = Best(len(terms), results)
        for batch in batches:
            for at in range(0, batch.num_rows, tile_docs):
                part = batch.slice(at, tile_docs)
                # Python integers: the product may pass 64 bits, m does not.
                m = np.array([10 + 90 * n * docs // length for n in part.column("n").to_pylist()], np.int64)
                lists = part.column("terms")
                numbers = lists.flatten().to_numpy()
                doc = np.repeat(np.arange(len(m)), lists.value_lengths().to_numpy())
                value = impacts(part.column("tfs").flatten().to_numpy(), m[doc])
                scores = np.zeros((len(terms), len(m)), np.int64)
                for start, end, matrix in matrices:
                    here = (numbers >= start) & (numbers < end)
                    dense = np.zeros((len(m), end - start))
                    dense[doc[here], numbers[here] - start] = value[here]
                    scores += (matrix @ dense.T).astype(np.int64)
                ids = part.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                best.add(scores, ids.fill_null(_LAST).to_numpy(), null)
        yield best.rows(TaskContext.get().partitionId())

    return run


def _ranked(rows: DataFrame, by: list[str], results: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= results)


def _search_block(docs: DataFrame, block: Block, results: int, tile: tuple[int, int]) -> DataFrame:
    spark = docs.sparkSession
    postings = stored(id_text(docs).mapInArrow(_postings(block.vocabulary), _POSTING), "search-postings")
    counted = postings.select("n", "terms").mapInArrow(_tally(len(block.vocabulary)), "term int, n long")
    counts = dict(counted.groupBy("term").agg(F.sum("n")).collect())  # one row per term of the block, and two
    n_docs, length = counts.get(-1, 0), counts.get(-2, 0)
    weight = weights(np.array([counts.get(i, 0) for i in range(len(block.vocabulary))], np.int64), n_docs)
    score = _scored(block.terms, weight, n_docs, length, results, tile)
    hits = postings.where(F.size("terms") > 0).mapInArrow(score, _HIT)
    near = _ranked(hits.withColumn("near", F.shiftright("part", MERGE.bit_length() - 1)), ["item", "near"], results)
    found = _ranked(near.drop("rank"), ["item"], results)
    names = spark.createDataFrame(list(enumerate(block.item_ids)), "item int, item_id long")
    return stored(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-results")


def search(
    docs: DataFrame, items: DataFrame, results: int = RESULTS, tile: tuple[int, int] = (TILE_TERMS, TILE_DOCS)
) -> DataFrame:
    """The best documents of each item: item_id, rank (from 1), doc_id, score.

    Documents are read once for each block of items.
    """
    found = [_search_block(docs, block, results, tile) for block in blocks(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
