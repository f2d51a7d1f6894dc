"""Published tables with a feed of the changes from version to version.

A publish writes the changes against the version before as rows of their own, marked with the
version they lead to, and then switches the table to its new rows. A consumer that remembers the
version it has seen reads only the changes since. Changes whose publish died before the switch are
not shown, and the next publish replaces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.tables import snapshot_changes
from wardflow.sources.versions import is_versioned, read_version, state, write_version

VERSION = "table_version"


def current_version(spark: SparkSession, path: str) -> int:
    """The newest version of a published table; 0 before the first."""
    return state(spark, f"{path}/rows").version


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return read_version(spark, f"{path}/rows")


def publish_version(df: DataFrame, path: str, keys: list[str]) -> int:
    """Make ``df`` the table's next version, with the changes that lead to it; returns its number.

    ``keys`` identify a row. The first version is all inserts.
    """
    spark = df.sparkSession
    number = current_version(spark, path) + 1
    before = read_published(spark, path) if number > 1 else spark.createDataFrame([], df.schema)
    changes = snapshot_changes(before, df, keys).withColumn(VERSION, F.lit(number).cast("long"))
    write_version(changes, f"{path}/changes", VERSION, replaced=[str(number)])
    write_version(df, f"{path}/rows")
    return number


def read_changes(spark: SparkSession, path: str, since: int = 0) -> DataFrame:
    """The changes of all versions after ``since``, with the version that each leads to."""
    if not is_versioned(spark, f"{path}/rows"):
        raise ValueError(f"nothing was published to {path}")
    changes = read_version(spark, f"{path}/changes", keep_part=True)
    return changes.where((F.col(VERSION) > since) & (F.col(VERSION) <= current_version(spark, path)))


def replay(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``base`` after all ``changes``, whatever number of versions they span."""
    columns = base.columns
    rows = F.struct("change_type", *columns)
    last = changes.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(rows, VERSION).alias("__row"))
    touched = last.select(*[f"__{k}" for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    kept = base.join(touched, same, "left_anti")
    return kept.unionByName(last.where("__row.change_type <> 'delete'").select(*[F.col(f"__row.{c}").alias(c) for c in columns]))
