"""A Merkle manifest of a dataset, kept as append logs in postorder.

Every row is a leaf: the SHA-256 of its fields, each written with its length. Leaves of one
language are ordered by ``doc_id`` and combined in twos, a last odd node alone, up to the
language's root; the languages' roots are combined likewise into the root of the dataset.

Trees are built by aligned builders. A builder owns ``BLOCK`` consecutive leaves, starting at a
multiple of ``BLOCK``, and appends each node to its log as soon as it is complete: a leaf, then
every inner node that this leaf completes, so the log is in postorder. The roots of the blocks are
the leaves of the next round, until one node is left. A log is one row per block.

Nothing stores where a node is. Leaf ``j`` stands after ``2 j - popcount(j)`` nodes, and the nodes
that it completes follow it level by level, also on the ragged right edge. So the node of level
``l`` over the leaves up to ``j`` stands at ``2 j - popcount(j) + l``, and a right node's sibling
lies the size of the node's own subtree before it. Proofs take their siblings from the logs by these positions: the part inside a block from
the block's own log, the rest once per block from the log above it, and so on up to the root.

Ranks come from a range partitioning of all rows by language, id, leaf and row number, with
running counts over partitions, so a language with most of the rows is spread over all tasks, and
no task ever holds more than a block of a tree and a slice of rows.

A null field is written as ``-``, an empty text as ``0:``. A null id sorts first in its language, a
null language before all others. Rows that repeat an id are ordered by their leaves; equal rows are
leaves of their own. Without rows there is no root and no result. Further columns are not part of
the manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import stored

#: Levels of a builder, and its leaves.
HEIGHT = 8
BLOCK = 1 << HEIGHT
#: Every so many-th id, by its checksum, is tampered with in the check.
TAMPERED = 7
DIGEST = 32

# How a step of a proof folds: alone, with a sibling on the left, with one on the right.
ALONE, LEFT, RIGHT = 0, 1, 2

_LOG = "grp string, blk long, size long, top binary, log binary, ids array<long>, changed array<binary>"
_PATH = "grp string, idx long, path binary"
_ROW = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, leaf_position long"
)


def field(c: Column) -> Column:
    """A field as text: the number of its bytes, a colon and its value; ``-`` for null."""
    text = c.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(n_chars: Column | None = None) -> Column:
    """The digest of a row; ``n_chars`` may stand in for the row's own."""
    length = F.col("n_chars") if n_chars is None else n_chars
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), length, F.col("text")]
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def leaves(docs: DataFrame, every: int = TAMPERED) -> DataFrame:
    """Stored: doc_id, grp (the language, '' for null), digest, that of the tampered row, row number."""
    hit = F.crc32(F.col("doc_id").cast("string")) % every == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    names = ("doc_id", "source", "lang", "n_chars", "text")
    rows = docs.select(*names).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("grp"),
        leaf().alias("digest"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf(more)).alias("changed"),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")


def ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 within ``grp``, and ``size``, the rows of ``grp``.

    ``order`` must tell all rows of a group apart. One shuffle by ranges, whatever the groups' sizes.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    dealt = rows.repartitionByRange(width, *keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), f"{label}-sorted")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    runs = dealt.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "grp",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("size"),
    )
    placed = dealt.join(runs, ["grp", "part"])
    return placed.select(*rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "size")


def combine(*digests: bytes) -> bytes:
    """The parent of consecutive nodes."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def position(last: int, level: int) -> int:
    """Where a log holds the node of ``level`` whose last leaf is number ``last``."""
    return 2 * last - last.bit_count() + level


def subtree(first: int, last: int, level: int) -> int:
    """Nodes of the subtree of ``level`` over the leaves from ``first`` to ``last``."""
    return position(last, level) - position(first, 0) + 1


def depth(size: int) -> int:
    """Levels above ``size`` leaves."""
    return (size - 1).bit_length()


def append_log(digests: list[bytes], height: int) -> list[bytes]:
    """The nodes of a tree of ``height`` over ``digests`` in the order in which they are completed."""
    log: list[bytes] = []
    waiting: list[tuple[int, bytes]] = []  # complete subtrees without their right sibling
    for node in digests:
        level = 0
        log.append(node)
        while waiting and waiting[-1][0] == level:
            node = combine(waiting.pop()[1], node)
            level += 1
            log.append(node)
        waiting.append((level, node))
    # The right edge: the last node rises to the top, alone where no sibling waits.
    level, node = waiting.pop()
    while level < height:
        node = combine(waiting.pop()[1], node) if waiting and waiting[-1][0] == level else combine(node)
        level += 1
        log.append(node)
    return log


def siblings(log: bytes, index: int, size: int, height: int) -> Iterator[tuple[int, bytes]]:
    """How to fold a leaf of one log up to its top: siblings found by their positions."""
    for level in range(height):
        node = index >> level
        if node & 1:
            first, last = node << level, min((node + 1) << level, size) - 1
            at, side = position(last, level) - subtree(first, last, level), LEFT
        elif (node + 1) << level < size:
            at, side = position(min((node + 2) << level, size) - 1, level), RIGHT
        else:
            yield ALONE, b""
            continue
        yield side, log[DIGEST * at : DIGEST * (at + 1)]


def fold(node: bytes, steps: Iterable[tuple[int, bytes]]) -> bytes:
    """The top that a leaf and its siblings lead to."""
    for side, other in steps:
        node = combine(node) if side == ALONE else combine(other, node) if side == LEFT else combine(node, other)
    return node


def _packed(steps: Iterable[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + other for side, other in steps)


def _steps(path: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(path):
        side = path[at]
        end = at + 1 + (DIGEST if side != ALONE else 0)
        out.append((side, path[at + 1 : end]))
        at = end
    return out


def _local(size: int, block: int) -> tuple[int, int]:
    """Leaves and height of a block's tree in a group of ``size`` leaves."""
    return min(BLOCK, size - block * BLOCK), HEIGHT if size > BLOCK else depth(size)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_LOG_SCHEMA = pa.schema(
    [("grp", pa.string()), ("blk", pa.int64()), ("size", pa.int64()), ("top", pa.binary()), ("log", pa.binary())]
    + [("ids", pa.list_(pa.int64())), ("changed", pa.list_(pa.binary()))]
)
_PATH_SCHEMA = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("path", pa.binary())])
_ROW_SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    + [("verified", pa.bool_()), ("leaf_position", pa.int64())]
)


def _built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (grp, idx) to the logs of their blocks."""
    here: tuple | None = None
    nodes: list[bytes] = []
    ids: list = []
    changed: list = []

    def close() -> tuple:
        grp, block, size = here
        log = append_log(nodes, _local(size, block)[1])
        return grp, block, size, log[-1], b"".join(log), ids[:], changed[:]

    for batch in batches:
        rows = []
        columns = (batch.column(n).to_pylist() for n in ("grp", "idx", "size", "digest", "doc_id", "changed"))
        for grp, idx, size, digest, doc_id, other in zip(*columns):
            place = (grp, idx // BLOCK, size)
            if place != here:
                if here:
                    rows.append(close())
                here = place
                nodes, ids, changed = [], [], []
            nodes.append(digest)
            ids.append(doc_id)
            changed.append(other)
        yield _arrow(rows, _LOG_SCHEMA)
    if here:
        yield _arrow([close()], _LOG_SCHEMA)


def build(rows: DataFrame, label: str) -> list[DataFrame]:
    """The logs of all rounds, stored, the lowest first; ``rows`` has grp, idx, size, digest, doc_id, changed."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = []
    while True:
        dealt = rows.withColumn("blk", F.shiftright("idx", HEIGHT)).repartition(width, "grp", "blk").sortWithinPartitions("grp", "idx")
        logs = stored(
            dealt.select("grp", "idx", "size", "digest", "doc_id", "changed").mapInArrow(_built, _LOG),
            f"{label}-log{len(rounds)}",
        )
        rounds.append(logs)
        if logs.where(F.col("size") > BLOCK).isEmpty():
            return rounds
        rows = logs.where(F.col("size") > BLOCK).select(
            "grp",
            F.col("blk").alias("idx"),
            F.shiftright(F.col("size") + (BLOCK - 1), HEIGHT).alias("size"),
            F.col("top").alias("digest"),
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("binary").alias("changed"),
        )


def tops(rounds: list[DataFrame]) -> DataFrame:
    """The root of each group: grp, digest."""
    done = [logs.where(F.col("size") <= BLOCK).select("grp", F.col("top").alias("digest")) for logs in rounds]
    return reduce(DataFrame.unionByName, done)


def _lowered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A path for each leaf of a log: the siblings inside the log, then the log's own path."""
    for batch in batches:
        names = ("grp", "blk", "size", "log", "path")
        for grp, block, size, log, path in zip(*(batch.column(n).to_pylist() for n in names)):
            n, height = _local(size, block)
            rows = [(grp, block * BLOCK + i, _packed(siblings(log, i, n, height)) + path) for i in range(n)]
            yield _arrow(rows, _PATH_SCHEMA)


def with_paths(rounds: list[DataFrame], ends: DataFrame, label: str) -> DataFrame:
    """The logs of the lowest round, each with the path from its top to the root.

    ``ends`` has the path (grp, path) of each group's root. A path is what ``_packed`` writes.
    """
    lower = None
    for number, logs in reversed(list(enumerate(rounds))):
        paths = ends.select("grp", F.lit(0).cast("long").alias("blk"), "path")
        done = logs.where(F.col("size") <= BLOCK).join(paths, ["grp", "blk"])
        if lower is not None:
            above = lower.select("grp", F.col("idx").alias("blk"), "path")
            done = done.unionByName(logs.where(F.col("size") > BLOCK).join(above, ["grp", "blk"]))
        if number == 0:
            return done
        names = ("grp", "blk", "size", "log", "path")
        lower = stored(done.select(*names).mapInArrow(_lowered, _PATH), f"{label}-paths{number}")
    raise ValueError("no rounds")


def _proved(root: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("blk", "size", "log", "ids", "changed", "path")
            for block, size, log, ids, changed, path in zip(*(batch.column(n).to_pylist() for n in names)):
                n, height = _local(size, block)
                above = _steps(path)
                # As many steps lead from the top of the block to the root of its language.
                subroot = fold(log[-DIGEST:], above[: depth(-(-size // BLOCK))])
                rows = []
                for i in range(n):
                    steps = [*siblings(log, i, n, height), *above]
                    at = position(i, 0)
                    node = log[DIGEST * at : DIGEST * (at + 1)]
                    proof = hashlib.sha256(b"".join(other.hex().encode() for _, other in steps)).hexdigest()
                    folded = fold(changed[i] or node, steps)
                    rows.append(
                        (ids[i], node.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root,
                         position(block * BLOCK + i, 0))
                    )
                yield _arrow(rows, _ROW_SCHEMA)

    return run


def manifest(docs: DataFrame, every: int = TAMPERED) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, leaf_position.

    ``folded_root`` is what the original siblings make of the row after tampering, which adds 1 to
    ``n_chars`` where ``every`` divides the checksum of the id; ``leaf_position`` is the leaf's
    place in the postorder of its language's whole tree.
    """
    spark = docs.sparkSession
    rows = leaves(docs, every)
    languages = build(ranked(rows, ["doc_id", "digest", "row"], "merkle"), "merkle")
    roots = stored(tops(languages), "merkle-subroots")
    nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed")]
    order = ranked(roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"], "merkle-top")
    order = stored(order, "merkle-top-ranked")
    top = build(order.select("grp", "idx", "size", "digest", *nothing), "merkle-top")
    root = tops(top).first()
    if root is None:
        return spark.createDataFrame([], _ROW)
    start = spark.createDataFrame([("", b"")], "grp string, path binary")
    names = ("grp", "blk", "size", "log", "path")
    above = with_paths(top, start, "merkle-top").select(*names).mapInArrow(_lowered, _PATH)
    ends = stored(order.join(above.select("idx", "path"), "idx").select(F.col("name").alias("grp"), "path"), "merkle-ends")
    found = with_paths(languages, ends, "merkle")
    names = ("blk", "size", "log", "ids", "changed", "path")
    return stored(found.select(*names).mapInArrow(_proved(bytes(root["digest"])), _ROW), "merkle-manifest")


def prove(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``manifest``."""
    return manifest(docs).drop("leaf_position")
