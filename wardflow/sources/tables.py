"""Reading, writing and updating the layer tables (parquet folders)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow.sources.versions import is_versioned, path_exists, read_version


def read_table(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A table in full, or as a stream of the files added to it.

    Of a table with versions the newest one is read; such a table cannot be streamed.
    """
    if not streaming:
        return read_version(spark, path) if is_versioned(spark, path) else spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def write_table(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Replace a table with the frame.

    ``sort_by`` orders rows inside each task's files (no shuffle), which lets a
    later filter on those columns skip row groups.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows, creating the table when it is absent."""
    df.write.mode("append").parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a table, each input file once.

    ``trigger`` is what ``DataStreamWriter.trigger`` takes: by default the stream
    catches up and stops; ``{"processingTime": "10 seconds"}`` keeps it running.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def update_by_key(target: DataFrame, updates: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Target rows with ``cols`` taken from the matching update row.

    Unmatched rows stay as they are, and a matched NULL does overwrite. The
    result is to be written to a new path: parquet has no update in place.
    """
    marked = updates.select(
        F.col(key).alias("__key"), F.struct(*cols).alias("__new")
    )
    joined = target.join(marked, F.col(key) == F.col("__key"), "left")
    hit = F.col("__key").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )


def sanitize(df: DataFrame) -> DataFrame:
    """NaN and infinite numbers become NULL; so do decimals beyond 64-bit integers."""
    return df.select(*[_clean(f).alias(f.name) for f in df.schema.fields])


def _clean(f) -> Column:
    c = F.col(f"`{f.name}`")
    kind = f.dataType.simpleString()
    if kind in ("double", "float"):
        bad = F.isnan(c) | (F.abs(c) == float("inf"))
        return F.when(~bad, c)
    if kind.startswith("decimal") and kind.endswith(",0)"):
        # The 64-bit integer range.
        low, high = -9223372036854775808, 9223372036854775807
        return F.when(c.between(F.lit(low), F.lit(high)), c)
    return c


def check_primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are repeated or hold a NULL, with their row count."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .where((F.col("row_count") > 1) | any_null)
    )


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert, update and delete rows that turn ``old`` into ``new``.

    Deletes carry the old values, the others the new ones. Rows are compared
    whole, NULLs being equal to each other.
    """
    cols = new.columns
    body = [c for c in cols if c not in keys]
    left = old.select(*keys, F.struct(*body).alias("__old"), F.lit(True).alias("__in_old"))
    right = new.select(*keys, F.struct(*body).alias("__new"), F.lit(True).alias("__in_new"))
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    )
    both = left.alias("o").join(right.alias("n"), same_key, "full_outer")
    kind = (
        F.when(F.col("__in_old").isNull(), "insert")
        .when(F.col("__in_new").isNull(), "delete")
        .when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    )
    gone = F.col("__in_new").isNull()
    changed = both.withColumn("change_type", kind).where("change_type IS NOT NULL")
    return changed.select(
        "change_type",
        *[F.when(gone, F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys],
        *[F.when(gone, F.col(f"__old.{c}")).otherwise(F.col(f"__new.{c}")).alias(c) for c in body],
    )
