"""Token counts of documents in flat token files, by a scan for separators.

A flat token file is nothing but little-endian 16-bit ids; a document ends with the end-of-document
id. There is no index, so counts come from the places of that id. Files are cut into blocks of
``BLOCK_TOKENS``; a task reads a block and finds all separators with one vectorised comparison. A
document may begin blocks before the one that holds its separator, so the blocks of a file are
stitched by a prefix scan over one row per block: the number of separators before a block numbers
its documents, and the last separator before a block (a running maximum) says where its first
document began.

``write_token_files`` makes such files from texts: one per task, in the shared folder, under a name
of the attempt, so a file left by a lost executor is never read. Its rows say which document stands
where, and stand for what a corpus would keep beside the files.

Null text counts as empty, a document of 0 tokens. Ids after the last separator of a file are a
document that is not ``ended``. Rows that repeat a ``doc_id`` are counted each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import id_text, slices, stored
from wardflow.llm.tokens import encoder
from wardflow.session import checkpoint_dir

#: The vocabulary's end-of-text id, which no text encodes to.
END_ID = 50_256
BLOCK_TOKENS = 4 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within."""
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


_WRITTEN = "file string, nth long, doc_id long"


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/tokens-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        encode, system, path = encoder(), *_open(name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        nth = 0
        with system.open_output_stream(path) as out:
            for part in slices(batches):
                for ids in encode(part.column("text").to_pylist()):
                    out.write(np.append(ids, np.array([END_ID], ids.dtype)).astype("<u2").tobytes())
                n = part.num_rows
                files = pa.array([name]).take(pa.array(np.zeros(n, np.int64)))
                columns = [files, pa.array(np.arange(nth, nth + n)), part.column("doc_id")]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "nth", "doc_id"])
                nth += n

    return run


def write_token_files(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the texts' ids; returns (file, nth, doc_id) in the order of each file."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession)}/corpus/tokens-{uuid.uuid4().hex}"
    return stored(id_text(docs).mapInArrow(_writer(folder), _WRITTEN), "token-manifest")


def _sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = batch.column("file")
        sizes = []
        for file in files.to_pylist():
            system, path = _open(file)
            sizes.append(system.get_file_info(path).size // 2)
        yield pa.RecordBatch.from_arrays([files, pa.array(sizes, pa.int64())], names=["file", "size"])


def _scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The separators of each block, as token positions in the file."""
    for batch in batches:
        columns = ("file", "block", "start", "length")
        for file, block, start, length in zip(*(batch.column(c).to_pylist() for c in columns)):
            system, path = _open(file)
            with system.open_input_file(path) as data:
                ids = np.frombuffer(data.read_at(2 * length, 2 * start), "<u2")
            at = np.flatnonzero(ids == END_ID) + start
            ends = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at, pa.int64()))
            arrays = [pa.array([file]), pa.array([block], pa.int64()), ends]
            yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "ends"])


def count_tokens(files: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, nth, n_tokens, ended) of every document in the files of column ``file``."""
    sized = stored(files.select("file").distinct().mapInArrow(_sizes, "file string, size long"), "token-files")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_tokens).cast("long"))
    blocks = sized.where("size > 0").select("file", "size", F.posexplode(starts).alias("block", "start"))
    blocks = blocks.select(
        "file", F.col("block").cast("long").alias("block"), "start", F.least(F.lit(block_tokens), F.col("size") - F.col("start")).alias("length")
    )
    # Blocks are dealt out evenly, whatever the sizes of their files.
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scanned = stored(blocks.repartition(width, "file", "block").mapInArrow(_scanned, "file string, block long, ends array<long>"), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    summary = scanned.select("file", "block", F.size("ends").alias("n"), last.alias("last"))
    stitched = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).cast("long").alias("since"),
    )
    ended = scanned.join(stitched, ["file", "block"]).select(
        "file",
        "first",
        F.arrays_zip(F.col("ends").alias("end"), F.concat(F.array("since"), "ends").alias("since")).alias("documents"),
    )
    ended = ended.select("file", "first", F.posexplode("documents").alias("k", "d")).where("d.end IS NOT NULL")
    ended = ended.select(
        "file",
        (F.col("first") + F.col("k")).alias("nth"),
        (F.col("d.end") - F.col("d.since") - 1).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    tails = summary.groupBy("file").agg(F.sum("n").alias("nth"), F.coalesce(F.max("last"), F.lit(-1)).alias("last")).join(sized, "file")
    tails = tails.select("file", "nth", (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.union(tails.where("n_tokens > 0"))


def document_tokens(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and n_tokens, counted in its token file."""
    manifest = write_token_files(docs)
    return manifest.join(count_tokens(manifest), ["file", "nth"]).select("doc_id", "n_tokens")
