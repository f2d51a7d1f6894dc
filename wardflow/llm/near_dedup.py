"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles as 64-bit hashes. The sketch places hashed
elements into bins in rounds: in the first rounds each element falls into one random bin, in the
last ones every element goes into the bin of the round, so that each bin
is filled in the end, however small the set; a bin keeps the smallest hash of the earliest round
that reached it. Two sets agree in a coordinate with the probability of their similarity, and the
share of agreeing coordinates concentrates around it.

Documents with equal sets form a class, of which the smallest id stands for all. Classes that
agree in all rows of some band share a bucket. At the link similarity a pair shares none with a
probability of about one in a million. A link is confirmed on the full sets, in two rounds that
together lose none found by the bands, yet never write all pairs of a group:

* every class against the smallest id of each of its buckets;
* in buckets whose members are not all connected by then, every class outside the component of
  the smallest id against all members of other components, within tasks that write no more links
  than connect their block.

In the first round pairs whose sketches agree in too few coordinates to be similar are left out before
sets are compared, and a set goes out once for up to ``SPOKES`` classes beside each of its buckets. In
the second, buckets are cut into blocks of bounded rows and bytes, whatever their share of the rows, and
the sets of a block are counted against each other at once: shingles that many of the block's sets hold
(a template's) by a matrix product, the others by the list of their holders.

Rows without words are linked with nothing. Results go by ``doc_id``: a row with a null one is linked
with nothing and kept, rows that repeat one with one text share a verdict, and of different texts
under one id, one is compared. The stage has no such limits: rows whose id is null or stands for
several documents are compared under names of their own, and of equal rows one stays. Ids of 2^62
and more are left to those names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import id_text, keep_rows, keyed, mix, one_each, row_key, slices, stored



def _least_agreeing(coordinates: int, similarity: float, odds: float = 1e-6) -> int:
    """The agreeing coordinates that a pair of this similarity reaches but for a probability of ``odds``."""
    below = 0.0
    for k in range(coordinates):
        below += math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k)
        if below > odds:
            return k
    return coordinates


@dataclass(frozen=True)
class Likeness:
    """What counts as a near copy, and the sketches that find it."""

    #: Words of a shingle.
    words: int
    #: A link: 100 * intersection >= link * union.
    link: int
    #: Bands and coordinates of a band: a pair at the link similarity shares no band with a probability
    #: of (1 - similarity ** rows) ** bands, about one in a million.
    bands: int
    rows: int = 5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @cached_property
    def agree(self) -> int:
        """Agreeing coordinates below which a pair is not compared."""
        return _least_agreeing(self.coordinates, self.link / 100)


#: Three words and 0.85, as the query wants, and five words and 0.8, as the stage does.
QUERY = Likeness(words=3, link=85, bands=24)
STAGE = Likeness(words=5, link=80, bands=35)
#: Sizes of the blocks in which a bucket is compared: classes outside its main component, members, and
#: the shingles of either that a block holds on average.
OUTSIDE, MEMBERS, ITEMS = 2048, 2048, 1 << 20
#: Classes that are compared with one copy of a hub's set, about, for each bucket of the hub.
SPOKES = 256
#: A shingle of at least this part of a block's members, and this many, is counted by matrix product.
HEAVY_PART, HEAVY = 1 / 64, 8
#: Shingles in a matrix.
TILE = 1024
#: Rows of a matrix that are multiplied at a time.
STRIP = 256
#: Bytes of text whose words and sketches a task holds at a time.
TEXT = 1 << 19

_STEP = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[str], size: int = QUERY.words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within a text, and the number of each text."""
    words = [t.encode().lower().split() for t in texts]  # bytes: A-Z and the six ASCII spaces only
    counts = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.empty(int(counts.sum()), dtype=object)
    flat[:] = [w for some in words for w in some]
    if not len(flat):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    ids = pd.util.hash_array(flat, categorize=False)
    ends = np.cumsum(counts)
    # A shingle starts at each word but the last size - 1; a shorter text is one shingle by itself.
    n = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    owner = np.repeat(np.arange(len(texts)), n)
    first = np.cumsum(n) - n
    start = np.arange(int(n.sum())) - first[owner] + (ends - counts)[owner]
    value = np.zeros(len(start), np.uint64)
    for k in range(size):
        there = start + k < ends[owner]
        word = ids[np.minimum(start + k, len(flat) - 1)]
        value = np.where(there, mix(value + _STEP + word), value + _STEP)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=len(texts))


def sketches(values: np.ndarray, sizes: np.ndarray, bins: int = QUERY.coordinates) -> np.ndarray:
    """One row of ``bins`` hashes per set; sets without elements keep free bins."""
    cells = np.full(len(sizes) * bins, _FREE, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for turn in range(2 * bins):
        if not len(values):
            break
        h = mix(values + np.uint64((turn + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        place = ((h >> np.uint64(32)) % np.uint64(bins)).astype(np.int64) if turn < bins else turn - bins
        at = owner * bins + place
        free = cells[at] == _FREE
        low = (h[free] << np.uint64(32)) | (h[free] >> np.uint64(32))
        np.minimum.at(cells, at[free], low & ~np.uint64(1))
        open_sets = (cells.reshape(-1, bins) == _FREE).any(axis=1) if turn % 4 == 3 or turn >= bins else None
        if open_sets is not None:
            more = open_sets[owner]
            values, owner = values[more], owner[more]
    return cells.reshape(-1, bins)


def _band_keys(cells: np.ndarray, bands: int) -> np.ndarray:
    parts = cells.reshape(len(cells), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(cells), bands)).copy()
    for r in range(parts.shape[2]):
        key = mix(key + _STEP) ^ parts[:, :, r]
    return mix(key).view(np.int64)


_SKETCH = "doc_id long, n_shingles long, digest binary, sketch binary, bands array<long>"


def _sketched(like: Likeness):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "digest", "sketch", "bands"]
        for part in slices(batches, most=TEXT):
            values, sizes = shingle_sets(part.column("text").to_pylist(), like.words)
            cells = sketches(values, sizes, like.coordinates)
            ends = np.cumsum(sizes)
            digests = [xxhash.xxh3_128_digest(values[e - n : e].tobytes()) if n else None for n, e in zip(sizes, ends)]
            low = (cells >> np.uint64(8)).astype(np.uint8)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1) * like.bands, pa.int32()),
                pa.array(_band_keys(cells, like.bands).ravel()),
            )
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in low]), bands]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    return run


def _sets(like: Likeness):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=TEXT):
            values, sizes = shingle_sets(part.column("text").to_pylist(), like.words)
            cuts = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(cuts, pa.array(values.view(np.int64)))], names=["node", "items"]
            )

    return run


def _agreeing(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, like: Likeness) -> np.ndarray:
    """Whether sets of these sizes and sketches may be linked."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return (100 * small >= like.link * large) & ((a == b).sum(axis=-1) >= like.agree)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _near_hub(like: Likeness):
    """Pairs of a class and the smallest id of a bucket whose sketches agree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                sizes = [part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "hub_n")]
                near = _agreeing(_matrix(part.column("sketch")), _matrix(part.column("hub_sketch")), *sizes, like)
                yield part.select(["a", "b", "salt"]).filter(pa.array(near))

    return run


def _linked(both: np.ndarray, n: np.ndarray, other: int, link: int) -> np.ndarray:
    """Whether sets of ``n`` shingles, ``both`` of them shared with one of ``other``, are similar enough."""
    return 100 * both >= link * (n + other - both)


class _Counter:
    """Counts what each of some sets shares with each of a block's members; sets are distinct hashes in any order."""

    def __init__(self, members: list[np.ndarray]):
        self.sizes = np.array([len(m) for m in members], np.int64)
        flat, owner = np.concatenate(members), np.repeat(np.arange(len(members), dtype=np.int32), self.sizes)
        order = np.argsort(flat, kind="stable")
        flat, self.owner = flat[order], owner[order]
        del order, owner
        self.first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        self.items = flat[self.first]
        self.held = np.diff(np.append(self.first, len(flat)))
        heavy = self.held >= max(HEAVY, HEAVY_PART * len(members))
        self.rank = np.where(heavy, np.cumsum(heavy, dtype=np.int32) - 1, -1).astype(np.int32)
        self.n_heavy = int(heavy.sum())

    def _holders(self, at: np.ndarray) -> np.ndarray:
        """The members that hold each of the items at these places, one after another."""
        held = self.held[at]
        return self.owner[np.arange(int(held.sum())) + np.repeat(self.first[at] - (np.cumsum(held) - held), held)]

    def shared(self, sets: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Per set, the shingles that it shares with each member."""
        places = []
        for some in sets:
            at = np.minimum(np.searchsorted(self.items, some), len(self.items) - 1)
            places.append(np.sort(at[self.items[at] == some].astype(np.int32)))
        # Sums of ones in float32 are exact below 2^24.
        exact = np.float32 if self.sizes.max() < 1 << 24 else np.float64
        total = np.zeros((len(sets), len(self.sizes)), exact)
        heavy_at = np.flatnonzero(self.rank >= 0)
        ranks = [r[r >= 0] for r in (self.rank[at] for at in places)]
        for low in range(0, self.n_heavy, TILE):
            here = heavy_at[low : low + TILE]
            theirs = np.zeros((len(self.sizes), len(here)), exact)
            theirs[self._holders(here), np.repeat(np.arange(len(here)), self.held[here])] = 1
            for top in range(0, len(sets), STRIP):
                some = ranks[top : top + STRIP]
                own = np.zeros((len(some), len(here)), exact)
                for i, r in enumerate(some):
                    own[i, r[np.searchsorted(r, low) : np.searchsorted(r, low + TILE)] - low] = 1
                total[top : top + STRIP] += own @ theirs.T
        for row, at in zip(total, places):
            light = self._holders(at[self.rank[at] < 0])
            yield row.astype(np.int64) + np.bincount(light, minlength=len(self.sizes))


def _runs(batches: Iterable[pa.RecordBatch], key: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Sorted rows by key: (key, rows); a row is the given columns and its set as an array."""
    here, rows = None, []
    for batch in batches:
        items = batch.column("items")
        for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in (*key, *columns)))):
            if row[: len(key)] != here:
                if rows:
                    yield here, rows
                here, rows = row[: len(key)], []
            # A copy, so that the batch can go before its block is complete.
            rows.append((*row[len(key) :], items[i].values.to_numpy(zero_copy_only=False).copy()))
    if rows:
        yield here, rows


def _across(like: Likeness):
    """Blocks in order: links between classes of different components, no more than connect the block."""

    def links(outside: list[tuple], members: list[tuple]) -> list[tuple[int, int]]:
        counter = _Counter([m[-1] for m in members])
        node = np.array([m[0] for m in members])
        names, place = np.unique([r[1] for r in (*members, *outside)], return_inverse=True)
        label = np.arange(len(names))
        member_part, outside_part = place[: len(members)], place[len(members) :]
        found = []
        for (a, _, a_items), a_part, both in zip(outside, outside_part, counter.shared([r[-1] for r in outside])):
            near = np.flatnonzero(_linked(both, counter.sizes, len(a_items), like.link))
            if not len(near):
                continue
            parts, at = np.unique(label[member_part[near]], return_index=True)
            for part, k in zip(parts.tolist(), near[at].tolist()):
                if part != label[a_part]:
                    label[label == part] = label[a_part]
                    found.append((max(a, int(node[k])), min(a, int(node[k]))))
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ("bucket", "chunk", "block"), ("outside", "node", "component")):
            outside, members = ([r[1:] for r in rows if r[0] == flag] for flag in (True, False))
            found = links(outside, members) if outside and members else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return run


def _confirmed(like: Likeness):
    """Rows by hub and salt, the hub's own row first: the pairs whose full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, hub = None, None
        for part in batches:
            keys = list(zip(part.column("b").to_pylist(), part.column("salt").to_pylist()))
            nodes, items, good = part.column("node").to_numpy(), part.column("items"), []
            for i, key in enumerate(keys):
                some = items[i].values.to_numpy(zero_copy_only=False)
                if key != here:
                    here, hub = key, some.copy()
                else:
                    both = len(np.intersect1d(hub, some, assume_unique=True))
                    if _linked(both, len(hub), len(some), like.link):
                        good.append((int(nodes[i]), key[0]))
            if good:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*good)], names=["a", "b"])

    return run


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached; ``links`` has columns a > b.

    Alternating large and small star steps: each hangs a node's neighbours on the smallest one,
    which halves distances, until no edge changes.
    """
    edges, last = stored(links.distinct(), "edges"), None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.distinct().groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("x"), "m"), F.struct(F.col("a").alias("x"), "m"))).alias("e"))
            .select(F.col("e.x").alias("a"), F.col("e.m").alias("b"))
            .where("a > b")
        )
        edges = stored(small.distinct(), "edges")
        n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, total) == last:
            break
        last = n, total
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _verified(pairs: DataFrame, sets: DataFrame, label: str, like: Likeness) -> DataFrame:
    """The links among ``pairs`` (a, b, salt); each set goes out once, but that of a hub b once for each salt."""
    hubs = pairs.select("b", "salt").distinct().withColumn("node", F.col("b"))
    rows = pairs.select("b", "salt", F.col("a").alias("node")).union(hubs).join(sets, "node")
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", "node")  # a hub is the smallest of its bucket
    return stored(rows.mapInArrow(_confirmed(like), "a long, b long"), label)


def near_dedup(docs: DataFrame, like: Likeness = QUERY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = id_text(docs)
    rows = stored(texts.mapInArrow(_sketched(like), _SKETCH), "sketches")
    named = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("node"))
    one = rows.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"])
    one = stored(one.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch", "bands"), "classes")

    spread = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    buckets = one.select("node", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("size"), F.sum("n").alias("items"))
    shared = stored(shared.where("size > 1"), "shared")
    # A hub has a bucket a band at most, so these join and group without a hot key.
    parts_of = shared.groupBy("hub").agg(F.ceil(F.max("size") / SPOKES).cast("int").alias("parts"))
    members = stored(buckets.join(shared.join(parts_of, "hub"), "bucket"), "buckets")
    plain = one.select("node", "n", "sketch")
    spokes = members.where("node > hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), spread(F.col("parts"), 3).alias("salt"))
    hubs = parts_of.withColumnRenamed("hub", "node").join(plain, "node").select(
        F.col("node").alias("b"), every(F.col("parts")).alias("salt"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch")
    )
    near = spokes.distinct().join(plain.withColumnRenamed("node", "a"), "a").join(hubs, ["b", "salt"])
    near = stored(near.mapInArrow(_near_hub(like), "a long, b long, salt int"), "near-hub")

    # Stored, so that its size is known before texts are joined to it: few enough, and texts are not shuffled.
    nodes = stored(members.select("node").distinct(), "nodes")
    wanted = nodes.withColumnRenamed("node", "doc_id")
    sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(like), "node long, items array<long>")
    sets = stored(sets.dropDuplicates(["node"]), "sets")
    links = _verified(near, sets, "links", like)
    parts = stored(components(nodes, links), "components")

    # Buckets that still hold several components: compare across them.
    placed = members.join(parts, "node").join(parts.select(F.col("node").alias("hub"), F.col("component").alias("main")), "hub")
    placed = placed.withColumn("outside", F.col("component") != F.col("main"))
    n_out, items_out = (F.sum(F.when(F.col("outside"), x).otherwise(0)) for x in (F.lit(1), F.col("n")))
    still = placed.groupBy("bucket").agg(n_out.alias("n_out"), items_out.alias("items_out")).where("n_out > 0")
    opened = placed.join(still, "bucket")
    chunks, blocks = (
        F.ceil(F.greatest(F.col(rows) / most, F.col(items) / ITEMS)).cast("int")
        for rows, most, items in (("n_out", OUTSIDE, "items_out"), ("size", MEMBERS, "items"))
    )
    left = opened.where("outside").withColumn("chunk", spread(chunks, 1)).withColumn("block", every(blocks))
    right = opened.withColumn("block", spread(blocks, 2)).withColumn("chunk", every(chunks)).withColumn("outside", F.lit(False))
    columns = ["bucket", "chunk", "block", "outside", "node", "component"]
    laid = left.select(columns).union(right.select(columns)).join(sets, "node")
    laid = laid.repartition("bucket", "chunk", "block").sortWithinPartitions("bucket", "chunk", "block")
    more = stored(laid.mapInArrow(_across(like), "a long, b long"), "more-links")
    parts = stored(components(nodes, links.union(more)), "components")

    label = classes.join(parts, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    # Stored, so that the join reads it from a shuffle of its own and a hot class can be split.
    label = stored(label, "class-components")
    found = rows.select("doc_id", "n_shingles", "digest").join(label, "digest", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _named(docs: DataFrame) -> DataFrame:
    """Rows (see ``keyed``) with the id as key, or one of the row's own where ids are null or stand for several documents."""
    row = row_key(docs)
    own = F.lit(1 << 62) + F.xxhash64(row).bitwiseAND(F.lit((1 << 62) - 1))
    number = F.col("doc_id").cast("long")
    several = docs.where("doc_id IS NOT NULL").groupBy(number.alias("id")).agg(F.min(row).alias("low"), F.max(row).alias("high"))
    several = stored(several.where("low <> high").select("id", F.lit(True).alias("several")), "shared-ids")
    rows = keyed(docs, id=number, own=own, text=F.col("text"))
    if several.isEmpty():
        return rows.withColumn("key", F.coalesce("id", "own"))
    shared = F.col("id").isNull() | F.col("several")
    return rows.join(several, "id", "left").withColumn("key", F.when(shared, F.col("own")).otherwise(F.col("id")))


def drop_near_copies(docs: DataFrame, like: Likeness = STAGE) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    rows = _named(docs)
    texts = rows.select(F.col("key").alias("doc_id"), "text")
    kept = stored(near_dedup(texts, like).where("kept").select("doc_id").distinct(), "near-kept")
    return one_each(keep_rows(rows.select("document", "key"), kept))
