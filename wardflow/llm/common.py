"""Helpers shared by the operators: stored steps, text batches, per-process caches."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import checkpoint_dir

# The six white space characters of the word definition.
SPACES = "\t\n\x0b\x0c\r "
SPACE_BYTES = SPACES.encode()

#: Bytes of text that a task handles at a time.
SLICE_BYTES = 1 << 20


#: Settings of a written step. Spark deletes its shuffle files when it ends, as nothing needs them
#: once the step is stored; and Python workers get texts in batches of this many rows.
STEP_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/corpus/{label}-{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key, None) for key in STEP_SETTINGS}
    for key, value in STEP_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Only ``doc_id`` and ``text`` (and the column ``row``); null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([F.col(row).alias("row")] if row else []),
    )


#: The columns that make a document; rows that agree in all of them are the same document.
DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")


def row_key(docs: DataFrame) -> Column:
    """A 128-bit name of a row, from its document columns: equal for rows that repeat a document only.

    It tells rows apart whose ids are null or repeated, and is the same however often Spark computes it.
    """
    parts = [F.col(c).cast("string") for c in DOCUMENT if c in docs.columns]
    # Nulls leave a hash as it is; say where they are.
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in DOCUMENT if c in docs.columns])
    return F.concat(F.hex(F.xxhash64(F.lit("a"), nulls, *parts)), F.lit("-"), F.hex(F.xxhash64(F.lit("b"), *parts, nulls)))


def keyed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Rows as one column ``document``, whatever their own columns are called, beside the given keys."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), *[k.alias(n) for n, k in keys.items()])


def keep_rows(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Of ``rows`` (see ``keyed``) those whose ``key`` is among the values of ``kept``, which has one column."""
    return rows.join(kept.toDF("key"), "key", "left_semi")


def one_each(rows: DataFrame) -> DataFrame:
    """The documents of ``rows`` (see ``keyed``), one for each ``key``.

    Rows whose key is their own are not shuffled for it.
    """
    many = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated-rows")
    if many.isEmpty():
        return rows.select("document.*")
    alone = rows.join(many, "key", "left_anti")
    return alone.unionByName(rows.join(many, "key", "left_semi").dropDuplicates(["key"])).select("document.*")


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``most`` bytes of ``column`` (or one row) at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def once(key: str, make: Callable):
    """``make()``, kept for the life of this Python worker."""
    held = sys.modules.setdefault("_corpus_held", types.ModuleType("_corpus_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
