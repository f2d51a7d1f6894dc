"""Message files as rows, by batch or as a stream, with their lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.functions.text import BLANKS
from wardflow.session import checkpoint_dir


def _with_lineage(df: DataFrame) -> DataFrame:
    modified = F.col("_metadata.file_modification_time")
    return df.select(
        F.md5(F.concat(F.col("value"), modified.cast("string"))).alias("file_id"),
        F.col("value").alias("raw_content"),
        F.col("_metadata.file_path").alias("source_file"),
        modified.alias("file_modification_time"),
        F.current_timestamp().alias("ingested_at"),
    )


SIZE_UNITS = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def size_in_bytes(size: str | int) -> int:
    """Bytes of a size such as ``10g``; Spark's option wants a plain number."""
    text = str(size).strip().lower()
    unit = SIZE_UNITS.get(text[-1:])
    return int(text[:-1]) * unit if unit else int(text)


def _reader(spark: SparkSession, streaming: bool, max_files, max_bytes):
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if streaming and max_bytes:
        reader = reader.option("maxBytesPerTrigger", size_in_bytes(max_bytes))
    return reader


#: The most tasks of a job that lists folders. Spark's own 10 000 make one task per folder, each of
#: which sends its figures to the driver.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Frames over files that are made here list them in a few tasks per core."""
    before = spark.conf.get(LISTING, None)
    spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)


def keep_few_listing_tasks(spark: SparkSession) -> None:
    """As ``few_listing_tasks``, for streams, whose source lists by the session's settings as long as it runs.

    Left on for the session; a number that the caller has set stays.
    """
    if spark.conf.get(LISTING, None) is None:
        spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))


def read_files(
    spark: SparkSession,
    directory: str | list[str],
    streaming: bool = False,
    glob: str = "*.hl7",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One row per file of a folder, or of a list of files.

    A stream takes at most ``max_files`` files or ``max_bytes`` (such as
    ``10g``; give one of the two) per micro-batch. A file becomes one string, so
    this suits the usual drops of a few MB; see :func:`read_line_messages` and
    :func:`read_framed` for archives.
    """
    if max_bytes:
        max_files = None
    reader = _reader(spark, streaming, max_files, max_bytes)
    whole = reader.format("text").option("wholetext", True).option("pathGlobFilter", glob)
    with few_listing_tasks(spark):
        return _with_lineage(whole.option("recursiveFileLookup", recursive).load(directory))


def list_files(
    spark: SparkSession,
    directory: str,
    streaming: bool = False,
    glob: str = "*.hl7",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """One row per file, without its content: path, source_file, file_modification_time, bytes.

    ``path`` is what a reader takes, ``source_file`` the same place as lineage names it.
    """
    if max_bytes:
        max_files = None
    reader = _reader(spark, streaming, max_files, max_bytes).format("binaryFile")
    reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    with few_listing_tasks(spark):
        found = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(directory)
    return found.select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def read_lines(
    spark: SparkSession, where: str | list[str], glob: str = "*.hl7", recursive: bool = False
) -> DataFrame:
    """The lines of files of any size: Spark cuts a large file into splits for many tasks.

    ``split`` is the place of a line's split in its file; ``at`` and ``piece`` order the lines of a
    split. Lines end at CR, LF or the end of a frame. ``at`` belongs to this plan: write the lines
    before they are used twice.
    """
    reader = spark.read.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    pieces = F.split(F.regexp_replace(F.replace("value", F.lit("\x0b"), F.lit("")), "\x1c$", ""), "\x1c")
    with few_listing_tasks(spark):
        found = reader.load(where)
    lines = found.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.posexplode(pieces).alias("piece", "line"),
    )
    return lines.withColumn("line", F.btrim("line", F.lit(BLANKS)))


def line_messages(lines: DataFrame) -> DataFrame:
    """Message rows, shaped like those of ``messages``, put together from lines.

    A line's message is the number of message starts before it: counted within its split, plus a
    running sum over the splits of its file. Messages are then put together by file and number, so
    one that crosses a split is whole, and no task sees more of a file than a split. The rules are
    those of ``split_messages``: a header or a blank line starts a new group, and a group without
    a header first is dropped.
    """
    starts = (F.col("line") == "") | F.col("line").startswith("MSH|")
    place = ["source_file", "split"]
    within = Window.partitionBy(*place).orderBy("at", "piece").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("local", F.sum(starts.cast("long")).over(within))
    totals = lines.groupBy(*place).agg(F.max("local").alias("n"))
    before = Window.partitionBy("source_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = lines.where("line != ''").join(offsets, place).withColumn("number", F.col("offset") + F.col("local"))
    # No two lines of a file share a place, so the sort is total.
    ordered = F.array_sort(F.collect_list(F.struct("split", "at", "piece", "line")))
    found = numbered.groupBy("source_file", "file_modification_time", "number").agg(ordered.alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\r")
    found = found.select("source_file", "file_modification_time", text.alias("raw_message")).where("raw_message LIKE 'MSH|%'")
    # One row per file; the messages of a large file are counted in parts before they travel.
    counts = found.groupBy("source_file").agg(F.count("*").cast("int").alias("file_message_count"))
    return found.join(counts, "source_file").select(
        F.md5("raw_message").alias("message_id"),
        "raw_message",
        F.md5(F.concat("source_file", F.col("file_modification_time").cast("string"))).alias("file_id"),
        "source_file",
        "file_message_count",
        "file_modification_time",
        F.current_timestamp().alias("ingested_at"),
    )


def read_line_messages(
    spark: SparkSession, where: str | list[str], glob: str = "*.hl7", recursive: bool = False
) -> DataFrame:
    """Message rows of files of any size; see ``read_lines`` and ``line_messages``.

    The lines are written to the shared folder first, so that each file is opened once.
    """
    lines, path = read_lines(spark, where, glob, recursive), f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines.write.parquet(path)
    return line_messages(spark.read.schema(lines.schema).parquet(path))


def read_framed(
    spark: SparkSession,
    directory: str,
    streaming: bool = False,
    glob: str = "*.hl7",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
) -> DataFrame:
    """One row per framed block, for large files whose messages end in ``\\x1c``.

    Spark splits the files at the frame end, so one archive of many GB is read by
    many tasks. Columns are those of :func:`read_files`; ``file_id`` identifies
    the block. Use it only where each frame holds whole messages.
    """
    if max_bytes:
        max_files = None
    reader = _reader(spark, streaming, max_files, max_bytes)
    blocks = reader.format("text").option("lineSep", "\x1c").option("pathGlobFilter", glob).load(directory)
    return _with_lineage(blocks)
