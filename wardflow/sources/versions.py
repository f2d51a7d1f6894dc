"""Tables whose readers switch to a new version by one appended row.

A table is a folder with ``data`` and ``log``. The rows of a version are written to a folder of
their own under ``data``, one subfolder per value of the partition column, which no reader knows
until a row of ``log`` names it. That row is one small file, so a job that dies in between leaves
the table as it was. A version replaces the whole table, replaces some partitions, or adds rows
to them, and records the ingest batches that it accounts for: what a table has taken and what it
holds change together.

A row of the log is a JSON file named after its version, moved into place when it is complete. Readers
look at the last ``FOLD`` of them at most: one per refresh, with one entry per partition written (a
day, or one of a fixed number of buckets). Every ``FOLD``-th row lists the table in full. A table
has one writer at a time; of two that make the same version, the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Log rows that a reader takes at most.
FOLD = 50
#: The name that Spark gives the partition of NULL.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return system.exists(where)


def _parts(spark: SparkSession, folder: str, by: str) -> list[str]:
    """The partitions that a write has made, from the names of its subfolders."""
    system, where = _file_system(spark, folder)
    names = (status.getPath().getName() for status in system.listStatus(where) if status.isDirectory())
    return sorted(name.removeprefix(f"{by}=") for name in names if name.startswith(f"{by}="))


def is_versioned(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/log")


def _put(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small file that is there whole or not at all."""
    system, where = _file_system(spark, f"{folder}/{name}")
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = system.create(hidden)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(where) or not system.rename(hidden, where):
        raise RuntimeError(f"{where} was written by another job")


def _last_rows(spark: SparkSession, path: str) -> list[dict]:
    system, where = _file_system(spark, f"{path}/log")
    files = sorted((s.getPath() for s in system.listStatus(where) if s.getPath().getName().endswith(".json")), key=str)
    rows = []
    for file in files[-FOLD:]:
        stream = system.open(file)
        try:
            rows.append(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()
    return rows


class State:
    """What the newest version of a table holds: its folders by partition."""

    def __init__(self, rows: Iterable):
        self.version, self.by, self.schema = 0, None, None
        self.folders: dict[str, list[str]] = {}
        rows = sorted(rows, key=lambda r: r["version"])  # from a whole one on, if there were more than FOLD
        start = max((i for i, r in enumerate(rows) if r["whole"]), default=0)
        for row in rows[start:]:
            self.version, self.by, self.schema = row["version"], row["by"], row["schema"]
            if row["whole"]:
                self.folders = {}
            for part in row["replaced"]:
                self.folders.pop(part, None)
            for entry in row["entries"]:
                self.folders.setdefault(entry["part"], []).append(entry["folder"])


def state(spark: SparkSession, path: str) -> State:
    """The table as its last complete version left it; an empty one where there is no log."""
    if not is_versioned(spark, path):
        return State([])
    return State(_last_rows(spark, path))


def taken_batches(spark: SparkSession, path: str) -> DataFrame:
    """The ingest batches that the table accounts for."""
    if not is_versioned(spark, path):
        return spark.createDataFrame([], "batch string")
    return spark.read.schema("batches array<string>").json(f"{path}/log").select(F.explode("batches").alias("batch"))


def write_version(
    df: DataFrame,
    path: str,
    by: str | None = None,
    add: bool = False,
    replaced: Iterable[str] | None = None,
    batches: Iterable[str] = (),
    sort_by: tuple[str, ...] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Write rows as a new version and switch to it.

    Without ``add`` and ``replaced`` the rows are the whole table. With ``replaced`` they take the
    place of these partitions; with ``add`` they come on top of what is there. ``by`` is the
    partition column. ``sort_by`` orders rows inside each task's files, without a shuffle.
    ``check`` gets the rows as they were written; if it raises, no reader ever sees them.
    """
    spark = df.sparkSession
    before = state(spark, path)
    if (add or replaced is not None) and before.version and before.by != by:
        raise ValueError(f"{path} is partitioned by {before.by}, not by {by}")
    folder = f"__v={uuid.uuid4().hex}"  # read as a column of that name, and left out
    if sort_by:
        df = df.sortWithinPartitions(*([by] if by else []), *sort_by)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(f"{path}/data/{folder}")
    if check:
        check(spark.read.schema(df.schema).parquet(f"{path}/data/{folder}"))
    parts = _parts(spark, f"{path}/data/{folder}", by) if by else [""]
    whole = not add and replaced is None
    row = {
        "version": before.version + 1,
        "whole": whole,
        "by": by,
        "schema": df.schema.json(),
        "replaced": list(replaced or ()),
        "entries": [{"part": p, "folder": folder} for p in parts],
        "batches": list(batches),
    }
    if not whole and row["version"] % FOLD == 0:
        after = State([])
        after.folders = before.folders
        for part in row["replaced"]:
            after.folders.pop(part, None)
        for part in parts:
            after.folders.setdefault(part, []).append(folder)
        row |= {
            "whole": True,
            "replaced": [],
            "entries": [{"part": p, "folder": f} for p, some in after.folders.items() for f in some],
        }
    _put(spark, f"{path}/log", f"{row['version']:012d}.json", json.dumps(row))


def read_version(spark: SparkSession, path: str, keep_part: bool = False) -> DataFrame:
    """The newest version; filters on the partition column choose folders before anything is read.

    The partition column is left out unless ``keep_part``.
    """
    now = state(spark, path)
    schema = StructType.fromJson(json.loads(now.schema))
    names = [f.name for f in schema.fields if keep_part or f.name != now.by]
    root = f"{path}/data"
    folders = [f"{root}/{f}" + (f"/{now.by}={part}" if now.by else "") for part, some in now.folders.items() for f in some]
    if not folders:
        return spark.createDataFrame([], schema).select(*names)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*names)


def in_parts(column: str, parts: Iterable[str]) -> Column:
    """Rows of the given partitions, as a filter on the partition column."""
    named = [p for p in parts if p != NULL_PART]
    hit = F.col(column).cast("string").isin(named) if named else F.lit(False)
    return hit | F.col(column).isNull() if NULL_PART in parts else hit


def part_names(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a partition column (days or buckets), as folders name them."""
    return sorted(NULL_PART if r[0] is None else r[0] for r in df.select(F.col(column).cast("string")).distinct().collect())
