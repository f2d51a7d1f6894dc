"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document's ids end with the end-of-document id; a longer document is cut into whole sequences,
its first piece taking the rest. Pieces of equal length are alike, so the packing is planned on
the number of pieces of each length, which has at most ``capacity`` entries for any corpus:

* fill a bin greedily: the longest length left, then again and again the longest that fits;
* replace its smallest document by the two unpacked documents that fill the widened gap best,
  where they hold more than it did (best-two-fit);
* repeat that bin as often as the counts allow, and go on.

A piece finds its place from its rank among the pieces of its length: the number within its task
plus a running sum of counts per task and length. The plan is bounded by the square of the
capacity, not by the data.

Ids are the library's with its default settings, so a marker between texts that stands in a text is
the marker's id. Null text counts as empty: a piece of one id. Rows that repeat a ``doc_id`` are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import id_text, slices, stored
from wardflow.llm.tokens import encoder

SEQUENCE = 1024
END_ID = 2

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _pieces(capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(marker=True)
        part = TaskContext.get().partitionId()
        met = [0] * (capacity + 1)  # pieces of each length so far
        for some in slices(batches):
            rows = []
            for doc_id, ids in zip(some.column("doc_id").to_pylist(), encode(some.column("text").to_pylist())):
                data = memoryview(np.append(ids, np.array([END_ID], "<u4")).astype("<u4").tobytes())
                total = len(data) // 4
                first = total % capacity or min(total, capacity)
                start = 0
                for piece in range(-(-total // capacity)):
                    length = capacity if piece else first
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc, part, met[length]))
                    met[length] += 1
                    start += length
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))

    return run


def _best_pair(left: np.ndarray, room: int, least: int) -> tuple[int, int] | None:
    """Two lengths left whose sum is the largest within ``room`` and over ``least``; the longer one first."""
    have = np.flatnonzero(left[: room + 1] > 0)
    if not have.size:
        return None
    best, pair = least, None
    for long in have[::-1]:
        if 2 * long <= best:
            break
        short = have[np.searchsorted(have, min(long, room - long), side="right") - 1 :][:1] if room - long >= have[0] else ()
        if not len(short):
            continue
        other = int(short[0])
        if other == long and left[long] < 2:
            below = have[have < long]
            if not below.size:
                continue
            other = int(below[-1])
        if long + other > best:
            best, pair = int(long) + other, (int(long), other)
            if best == room:
                break
    return pair


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths in order, how often), for ``counts[length]`` pieces of each length."""
    left = counts.astype(np.int64).copy()
    bins = []
    while True:
        longest = int(np.max(np.flatnonzero(left), initial=0))
        if not longest:
            return bins
        used: list[int] = []
        gap = capacity
        while gap:
            fits = np.flatnonzero(left[: gap + 1] > 0)
            if not fits.size:
                break
            length = int(fits[-1])
            # As many of it as there are and fit; the same choice again and again.
            n = min(int(left[length]), gap // length)
            used += [length] * n
            left[length] -= n
            gap -= n * length
        if gap and len(used) > 1:
            small = used[-1]
            pair = _best_pair(left, gap + small, small)
            if pair:
                left[small] += 1
                left[pair[0]] -= 1
                left[pair[1]] -= 1
                used[-1:] = pair
        lengths, each = np.unique(used, return_counts=True)
        more = int(np.min(left[lengths] // each))
        left[lengths] -= more * each
        bins.append((tuple(sorted(used, reverse=True)), 1 + more))


def _slots(bins: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each run of equal lengths in a bin kind: which ranks of that length go where."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in bins:
        offset, i = 0, 0
        while i < len(lengths):
            length = lengths[i]
            n = lengths.count(length)
            rank = taken.get(length, 0)
            rows.append((length, rank, times, sequence, offset))
            taken[length] = rank + n * times
            offset += n * length
            i += n
        sequence += times
    rows.sort()
    names = ("length", "rank", "times", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}


def _placed(slots: dict[str, np.ndarray]):
    names = ("doc_id", "piece", "start", "length", "ids_crc32")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = (slots["length"] << 48) + slots["rank"]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            nth = rank - slots["rank"][at]
            times = slots["times"][at]
            sequence = slots["sequence"][at] + nth % times
            offset = slots["offset"][at] + nth // times * length
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(id_text(docs).mapInArrow(_pieces(capacity), _PIECE), "pieces")
    tally = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "tally")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in tally.groupBy("length").agg(F.sum("n")).collect():  # at most one row per length
        counts[length] = n
    slots = _slots(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.select(*names).mapInArrow(_placed(slots), schema)
