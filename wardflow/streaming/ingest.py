"""Message files to segment tables, continuously or until caught up.

A batch is a set of files (or of bus records): a micro-batch of a stream, or some of the files that
``ingest_batch`` finds. Its tables go to folders named ``batch=<name>``, cut by the day of
``parsed_at``. A stream's batch is named after the stream's own id and epoch, a batch of files after
the files, so a batch that is run again replaces its own folders, and no other's.

``ingested_files`` is the ledger: every file taken, by path and modification time, with its batch.
Both kinds of run read it before they take files, so a file is taken once however it comes. A batch
is noted in ``ingested_batches`` before its first and after its last table is written; readers
leave out batches that were begun and not finished, and such files are taken again.

Every layer is written and read back before the next is built from it: raw files or lines, messages,
segment tables, which are written side by side. A segment table's rows are judged by ``PIPELINE_RULES``: rows that break a drop
rule go to ``quarantine_<segment>``, and every rule's failures are counted in ``rule_violations``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wardflow.operators.messages import messages, stamp, with_headers
from wardflow.operators.quality import DROP, PIPELINE_RULES, apply_rules, broken, quarantine
from wardflow.operators.segments import SILVER, segment_table
from wardflow.session import at_once, compiled_methods
from wardflow.sources.files import keep_few_listing_tasks, line_messages, list_files, read_files, read_lines
from wardflow.sources.versions import path_exists

CATCH_UP = {"availableNow": True}
FILES, LINES, MESSAGES, VIOLATIONS = "bronze_files", "bronze_lines", "silver_hl7_parsed", "rule_violations"
VIOLATION_SCHEMA = "segment string, rule string, action string, rows_checked long, failures long"
FILE_SCHEMA = (
    "file_id string, raw_content string, source_file string, file_modification_time timestamp, ingested_at timestamp"
)
LEDGER, BATCHES = "ingested_files", "ingested_batches"
LEDGER_SCHEMA = "source_file string, file_modification_time timestamp, batch string"
BATCH_SCHEMA = "batch string, finished boolean, at timestamp"
#: Files of a batch that ``ingest_batch`` makes; their paths pass through the driver.
MOST_FILES = 10_000


def silver_name(kind: str) -> str:
    return f"silver_{kind.lower()}"


def quarantine_name(kind: str) -> str:
    return f"quarantine_{kind.lower()}"


def _stored(df: DataFrame, out: str, table: str, name: str, by_day: bool = False) -> DataFrame:
    """One batch's rows of a table, replaced and read back; by day of ``parsed_at``, if asked for."""
    path = f"{out}/{table}/batch={name}"
    rows = df.withColumn("day", F.to_date("parsed_at")) if by_day else df
    if table == MESSAGES:
        # Brings days together, in as many tasks as their size asks for. Segment tables are made
        # from these files without a shuffle, so they too get few files a day.
        rows = rows.hint("rebalance", "day")
    writer = rows.write.mode("overwrite")
    (writer.partitionBy("day") if by_day else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _write_segment(headed: DataFrame, kind: str, out: str, name: str) -> list[tuple]:
    """A segment table, its rejects, and the violations of its rules."""
    rules = PIPELINE_RULES.get(kind, [])
    rows = segment_table(headed, kind, rule=False)
    if not rules:
        _stored(rows, out, silver_name(kind), name, by_day=True)
        return []
    kept, seen = apply_rules(rows, rules)
    _stored(kept, out, silver_name(kind), name, by_day=True)
    counts = seen.get or {}  # nothing is observed where there are no rows
    drops = [r for r in rules if r.action == DROP]
    if any(counts.get(r.name) for r in drops):  # only then a second pass is worth it
        _stored(quarantine(broken(rows, drops), drops)[1], out, quarantine_name(kind), name)
    return [(kind, r.name, r.action, counts.get("rows") or 0, counts.get(r.name) or 0) for r in rules]


def _note(spark: SparkSession, out: str, name: str, finished: bool) -> None:
    row = spark.range(1, numPartitions=1).select(
        F.lit(name).alias("batch"), F.lit(finished).alias("finished"), F.current_timestamp().alias("at")
    )
    row.write.mode("append").parquet(f"{out}/{BATCHES}")


def batch_states(spark: SparkSession, out: str) -> DataFrame:
    """Every batch that was begun: batch, finished."""
    if not path_exists(spark, f"{out}/{BATCHES}"):
        return spark.createDataFrame([], "batch string, finished boolean")
    return spark.read.schema(BATCH_SCHEMA).parquet(f"{out}/{BATCHES}").groupBy("batch").agg(F.max("finished").alias("finished"))


def _finished(spark: SparkSession, out: str, name: str) -> bool:
    return not batch_states(spark, out).where((F.col("batch") == name) & F.col("finished")).isEmpty()


def _left_open(spark: SparkSession, out: str) -> list[str]:
    """Batches begun and not finished: what failed runs left, and those that are under way."""
    return [r["batch"] for r in batch_states(spark, out).where("NOT finished").collect()]


def taken_files(spark: SparkSession, out: str) -> DataFrame:
    """The ledger's files of finished batches."""
    if not path_exists(spark, f"{out}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(f"{out}/{LEDGER}")
    return ledger.where(~F.col("batch").isin(_left_open(spark, out)))


def not_taken(files: DataFrame, out: str) -> DataFrame:
    """Of file rows, those that no finished batch has."""
    return files.join(taken_files(files.sparkSession, out), ["source_file", "file_modification_time"], "left_anti")


def _write_batch(
    raw: DataFrame, name: str, out: str, parsed_at: Column | None = None, lines: bool = False, taken: DataFrame | None = None
) -> None:
    """All tables of one batch of file rows (or of lines); ``taken`` goes to the ledger."""
    spark = raw.sparkSession
    if _finished(spark, out, name):
        return
    _note(spark, out, name, False)
    landed = _stored(raw, out, LINES if lines else FILES, name)
    split = line_messages(landed) if lines else messages(landed)
    with compiled_methods(spark):
        headed = _stored(with_headers(stamp(split, parsed_at)), out, MESSAGES, name, by_day=True)
        found = at_once(spark, {kind: partial(_write_segment, headed, kind, out, name) for kind in SILVER})
    violations = [v for some in found.values() for v in some]
    _stored(spark.createDataFrame(violations, VIOLATION_SCHEMA).coalesce(1), out, VIOLATIONS, name)
    if taken is not None:  # names that came through the driver
        _stored(taken.select("source_file", "file_modification_time").coalesce(1), out, LEDGER, name)
    _note(spark, out, name, True)


def _collected(files: DataFrame) -> list[Row]:
    """Listed files with their modification time in microseconds, which no time zone of the driver bends."""
    return files.select("path", "source_file", F.unix_micros("file_modification_time").alias("micros")).collect()


def _take(spark: SparkSession, found: list[Row], name: str, out: str, parsed_at: Column | None, lines: bool) -> None:
    """Ingest the listed files as one batch."""
    paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", r["path"]) for r in found]  # names, not patterns
    read = read_lines if lines else read_files
    raw = read(spark, paths, glob="*", recursive=True)
    listed = spark.createDataFrame([(r["source_file"], r["micros"]) for r in found], "source_file string, micros long")
    listed = listed.select("source_file", F.timestamp_micros("micros").alias("file_modification_time"))
    _write_batch(raw, name, out, parsed_at, lines, listed)


def ingest_stream(
    files: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    parsed_at: Column | None = None,
) -> StreamingQuery:
    """Start the ingest of a stream of file rows (from files or a bus).

    ``trigger`` is ``{"availableNow": True}`` (catch up and stop, the default) or
    ``{"processingTime": "10 seconds"}`` (keep running). The checkpoint remembers
    which files were taken.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        _write_batch(batch, _epoch_name(batch, epoch), out, parsed_at)

    return _started(files, write, checkpoint, trigger)


def _epoch_name(batch: DataFrame, epoch: int) -> str:
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{epoch}"


def _started(rows: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or CATCH_UP))
        .start()
    )


def start_ingest(
    spark: SparkSession,
    directory: str,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    parsed_at: Column | None = None,
    lines: bool = False,
    **source,
) -> StreamingQuery:
    """Ingest a folder of message files; ``source`` goes to ``list_files``.

    The stream is one of file names. The files of a micro-batch that the ledger does not know are
    read whole, or with ``lines`` by line, which spreads one large archive over many tasks.
    """
    keep_few_listing_tasks(spark)
    listing = list_files(spark, directory, streaming=True, **source)

    def write(batch: DataFrame, epoch: int) -> None:
        found = _collected(not_taken(batch, out))  # as many rows as a micro-batch takes files
        if found:
            _take(batch.sparkSession, found, _epoch_name(batch, epoch), out, parsed_at, lines)

    return _started(listing, write, checkpoint, trigger)


def files_identity(files: Iterable[Row]) -> str:
    """A name for a set of files, from their paths and times alone."""
    marks = sorted(f"{r['source_file']} {r['micros']}" for r in files)
    return f"files-{len(marks)}-{hashlib.md5(chr(10).join(marks).encode()).hexdigest()[:16]}"


def ingest_batch(
    spark: SparkSession,
    directory: str,
    out: str,
    parsed_at: Column | None = None,
    lines: bool = False,
    most_files: int = MOST_FILES,
    **source,
) -> list[str]:
    """Ingest all files that the ledger does not know yet; returns the names of the batches made.

    Files are taken by path, ``most_files`` at a time, from one listing. ``lines`` reads them by line,
    as ``start_ingest`` does.
    """
    made = []
    # A listing is a scan of as many parts as there are files; kept, it is not scanned again for each batch.
    listing = list_files(spark, directory, **source).coalesce(4 * spark.sparkContext.defaultParallelism).persist()
    try:
        while found := _collected(not_taken(listing, out).orderBy("source_file").limit(most_files)):
            made.append(files_identity(found))
            _take(spark, found, made[-1], out, parsed_at, lines)
    finally:
        listing.unpersist()
    return made


def read_ingested(
    spark: SparkSession, out: str, table: str, streaming: bool = False, batches: list[str] | None = None
) -> DataFrame:
    """A table of the ingest, without the batch and day of its folders.

    A batch that is not finished is left out; ``batches`` asks for some of the finished ones. A
    stream of a table takes all files as they come.
    """
    path = f"{out}/{table}"
    if streaming:
        schema = spark.read.parquet(path).schema
        return spark.readStream.schema(schema).parquet(path).drop("batch", "day")
    return _committed(spark, out, table, batches).drop("batch", "day")


def silver_schema(spark: SparkSession, kind: str) -> StructType:
    """Columns of a segment table; batches without a row of the segment leave no file to tell them."""
    if kind not in _SCHEMAS:
        files = spark.createDataFrame([], FILE_SCHEMA)
        _SCHEMAS[kind] = segment_table(with_headers(stamp(messages(files))), kind, rule=False).schema
    return _SCHEMAS[kind]


_SCHEMAS: dict[str, StructType] = {}


def _committed(spark: SparkSession, out: str, table: str, batches: list[str] | None = None) -> DataFrame:
    kind = table.removeprefix("silver_").upper()
    reader = spark.read.schema(silver_schema(spark, kind)) if kind in SILVER else spark.read
    rows = reader.parquet(f"{out}/{table}")
    unfinished = _left_open(spark, out)
    if unfinished:
        rows = rows.where(~F.col("batch").isin(unfinished))
    return rows if batches is None else rows.where(F.col("batch").isin(batches))


def read_days(spark: SparkSession, out: str, kind: str, batches: list[str] | None = None) -> DataFrame:
    """A segment table with the column ``day`` of its folders, by which it can be filtered."""
    rows = _committed(spark, out, silver_name(kind), batches).drop("batch")
    return rows if "day" in rows.columns else rows.withColumn("day", F.lit(None).cast("date"))


def read_silver(spark: SparkSession, out: str, kind: str, streaming: bool = False) -> DataFrame:
    return read_ingested(spark, out, silver_name(kind), streaming)


def read_quarantine(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """Rejected rows of a segment with the names of the rules they broke."""
    return read_ingested(spark, out, quarantine_name(kind))


def read_violations(spark: SparkSession, out: str) -> DataFrame:
    """Rows checked and failures per segment and rule over all batches."""
    keys = ("segment", "rule", "action")
    sums = [F.sum(c).alias(c) for c in ("rows_checked", "failures")]
    return read_ingested(spark, out, VIOLATIONS).groupBy(*keys).agg(*sums)
