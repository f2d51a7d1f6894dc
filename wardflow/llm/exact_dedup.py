"""Exact deduplication through an extendible-hash index on shared files.

Texts are equal when they are identical after white space is deleted. A 64-bit hash of that
normal form is the key. The directory addresses a bucket by the leading bits of the key: a
bucket with more than ``capacity`` distinct keys splits in two, which doubles the directory
where needed, so a bucket is a range of keys. Owner tasks take whole ranges, walk them in key
order, compare the bytes of texts that share a key, chain those that differ, and write the
entries to the shared folder.

Copies are folded before anything is shuffled: each task sends one text for each distinct text
that it meets, with the number of copies and the best row, so a hot text costs a row per task.
The directory is built from counts per key prefix, never from the keys on the driver.

Null text counts as empty. A null ``doc_id`` ranks after all others. Of rows that agree in length and
id too, one stays: rows are numbered in a stored step, and the lowest number wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACE_BYTES, id_text, keep_rows, keyed, one_each, row_key, slices, stored

#: Distinct keys that a bucket holds before it splits.
CAPACITY = 1_000
#: Bits of the key that the directory may use; a bucket at this depth chains instead of splitting.
MOST_BITS = 20
#: Bytes of texts that a task keeps at a time to fold copies.
FOLD_BYTES = 16 << 20
#: Directories of at most this many pointers (16 bytes each) are broadcast.
BROADCAST_POINTERS = 1 << 14

_ENTRY = "doc_id long, key long, sha binary, n_chars long, row string"
_TEXT = "key long, body binary, copies long, n_chars long, doc_id long"
_CHAIN = "bucket long, key long, chain int, sha binary, group_size long, keep_id long, keep_chars long"


def _key(body: bytes) -> int:
    return xxhash.xxh64_intdigest(body) - (1 << 63)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for part in slices(batches):
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            yield doc_id, len(text), text.encode().translate(None, SPACE_BYTES)


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (n_chars, doc_id): more characters, then the smaller id, null last."""
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    return min(a, b, key=rank)


def _table(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "key", "sha", "n_chars", "row")
    for part in slices(batches):
        bodies = [t.encode().translate(None, SPACE_BYTES) for t in part.column("text").to_pylist()]
        columns = [
            part.column("doc_id"),
            pa.array([_key(b) for b in bodies], pa.int64()),
            pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
            pc.utf8_length(part.column("text")).cast(pa.int64()),
            part.column("row"),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=list(names))


def _folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text met since the last flush."""
    schema = pa.schema(
        [("key", pa.int64()), ("body", pa.binary()), ("copies", pa.int64()), ("n_chars", pa.int64()), ("doc_id", pa.int64())]
    )
    held: dict[bytes, list] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(_key(body), body, n, *best) for body, (n, best) in held.items()]
        held.clear()
        for at in range(0, len(rows), 1024):
            yield _table(rows[at : at + 1024], schema)

    for doc_id, n_chars, body in _rows(batches):
        if body in held:
            seen = held[body]
            seen[0] += 1
            seen[1] = _better(seen[1], (n_chars, doc_id))
        else:
            held[body] = [1, (n_chars, doc_id)]
            size += len(body) + 200
        if size > FOLD_BYTES:
            yield from flush()
            size = 0
    yield from flush()


def _owned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (bucket, key): one entry per distinct text, chained within its key."""
    schema = pa.schema(
        [("bucket", pa.int64()), ("key", pa.int64()), ("chain", pa.int32()), ("sha", pa.binary())]
        + [(n, pa.int64()) for n in ("group_size", "keep_id", "keep_chars")]
    )
    here, chain, rows = None, [], []

    def close() -> None:
        for i, (body, n, best) in enumerate(chain):
            rows.append((*here, i, hashlib.sha256(body).digest(), n, best[1], best[0]))
        chain.clear()

    for part in slices(batches, "body"):
        names = ("bucket", "key", "body", "copies", "n_chars", "doc_id")
        for bucket, key, body, copies, n_chars, doc_id in zip(*(part.column(n).to_pylist() for n in names)):
            if here != (bucket, key):
                close()
                here = bucket, key
            for entry in chain:
                if entry[0] == body:
                    entry[1] += copies
                    entry[2] = _better(entry[2], (n_chars, doc_id))
                    break
            else:
                chain.append([body, copies, (n_chars, doc_id)])
        if len(rows) >= 8192:
            yield _table(rows, schema)
            rows.clear()
    close()
    yield _table(rows, schema)


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = MOST_BITS) -> DataFrame:
    """The buckets: ``depth`` leading bits equal to ``prefix``, with their number of distinct keys.

    ``keys`` has one column ``key`` of longs. A bucket is the shortest prefix that holds at most
    ``capacity`` distinct keys; one with ``bits`` bits stays as it is and chains.
    """
    spread = keys.distinct().groupBy(F.shiftrightunsigned("key", 64 - bits).alias("leaf")).agg(F.count("*").alias("n"))
    nodes = stored(
        spread.select(F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"), "leaf", "n")
        .select("depth", F.expr(f"shiftrightunsigned(leaf, {bits} - depth)").alias("prefix"), "n")
        .groupBy("depth", "prefix")
        .agg(F.sum("n").alias("n")),
        "directory-nodes",
    )
    over = nodes.where((F.col("n") > capacity) & (F.col("depth") < bits))
    split = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fits = nodes.where((F.col("n") <= capacity) | (F.col("depth") == bits)).withColumn(
        "parent", F.shiftrightunsigned("prefix", 1)
    )
    root = fits.where("depth = 0").drop("parent")
    return fits.join(split, ["depth", "parent"], "left_semi").select("depth", "prefix", "n").unionByName(root)


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The index entries of all texts, stored in bucket order: one row per distinct text."""
    spark = docs.sparkSession
    buckets = stored(directory(keys, capacity), "directory")
    depth = buckets.agg(F.max("depth")).first()[0] or 0  # the global depth
    # Every pointer of the doubled directory names its bucket by the bucket's first pointer.
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {depth} - depth) - 1")
    pointers = buckets.select(F.explode(F.sequence(first, last)).alias("address"), first.alias("bucket"))
    texts = id_text(docs).mapInArrow(_folded, _TEXT)
    address = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    if (1 << depth) <= BROADCAST_POINTERS:
        pointers = F.broadcast(pointers)
    owned = texts.withColumn("address", address).join(pointers, "address").drop("address")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owned = owned.repartition(width, "bucket").sortWithinPartitions("bucket", "key")
    return stored(owned.mapInArrow(_owned, _CHAIN), "exact-index")


def _verdicts(docs: DataFrame, row: Column, capacity: int) -> DataFrame:
    """Per row of ``docs``: doc_id, key, sha, row, keep_id, group_size, best (has the id and length that stay)."""
    texts = id_text(docs.select("doc_id", "text", row.alias("row")), "row")
    entries = texts.mapInArrow(_entries, _ENTRY).withColumn("at", F.monotonically_increasing_id())
    entries = stored(entries, "exact-entries")
    index = build_index(docs, entries.select("key"), capacity)
    found = entries.join(index.select("key", "sha", "group_size", "keep_id", "keep_chars"), ["key", "sha"])
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return found.withColumn("best", best)


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts, the row with the most code points in its own text stays, then the one with
    the smallest id, then the one with the lowest number.
    """
    found = _verdicts(docs, F.lit(""), capacity)
    first = found.where("best").groupBy("key", "sha").agg(F.min("at").alias("at"))
    kept = stored(first.select("at", F.lit(True).alias("kept")), "exact-kept")
    return found.join(kept, "at", "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce("kept", F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with all their columns."""
    found = _verdicts(docs, row_key(docs), CAPACITY).where("best")
    names = stored(found.groupBy("key", "sha").agg(F.min("row").alias("row")).select("row"), "exact-kept")
    return one_each(keep_rows(keyed(docs, key=row_key(docs)), names))
