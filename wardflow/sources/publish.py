"""Publishing gold tables to a serving store, with a load report.

A gold table is read once. Its rows are written, without a shuffle, to a version that nobody reads
yet; the primary key is checked on what was written, reading and shuffling the key columns alone,
with counts per task before; then readers are switched, or the database is filled from that version.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.session import checkpoint_dir
from wardflow.sources.predictions import read_gold
from wardflow.sources.tables import check_primary_key, read_table, sanitize
from wardflow.sources.versions import read_version, write_version

# Published tables and their primary keys.
SERVING_KEYS = {
    "gold_ed_hourly_census": ["event_hour", "location_facility"],
    "gold_icu_hourly_census": ["event_hour", "location_facility"],
    "gold_ed_daily_summary": ["activity_date", "location_facility"],
    "gold_icu_daily_summary": ["activity_date", "location_facility"],
    "gold_department_census_current": ["location_facility", "department"],
    "gold_forecast_predictions": ["prediction_id"],
    "gold_forecast_accuracy": [
        "prediction_date",
        "model_name",
        "model_version",
        "department",
        "target_metric",
        "forecast_horizon_hours",
    ],
    "gold_encounter_fact": ["encounter_key"],
    "gold_patient_dim": ["patient_key"],
    "gold_observation_fact": ["observation_key"],
    "gold_diagnosis_fact": ["diagnosis_key"],
    "gold_allergy_fact": ["allergy_key"],
    "gold_order_fact": ["order_key"],
    "gold_message_metrics": ["processing_hour", "message_type", "sending_facility"],
    "gold_patient_activity": ["activity_date", "location_facility", "patient_class_desc"],
    "gold_ed_forecast_features": ["event_hour", "location_facility"],
    "gold_icu_forecast_features": ["event_hour", "location_facility"],
    "gold_combined_forecast_features": ["event_hour"],
}

# Column types of the serving store, by Spark's own names.
SERVING_TYPES = {
    "string": "TEXT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE PRECISION", "float": "REAL",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "binary": "BYTEA",
}
#: What a missing text in a key column is published as, since a key holds no NULL.
NO_VALUE = ""


def create_statement(table: str, df: DataFrame, keys: list[str]) -> str:
    """DDL of a serving table with its primary key; run it once before the first publish.

    Spark's writer only truncates and fills, so the key and the types stay.
    """
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    columns = [
        f"{quoted(name)} {SERVING_TYPES.get(kind, kind.upper())}{' NOT NULL' if name in keys else ''}" for name, kind in df.dtypes
    ]
    key = ", ".join(map(quoted, keys))
    return f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(columns)}, PRIMARY KEY ({key}))"


def serving_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows as they are published: missing texts in key columns become a value."""
    texts = [name for name, kind in df.dtypes if name in keys and kind == "string"]
    return df.na.fill(NO_VALUE, texts) if texts else df


def key_report(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row on a serving table's stored rows against its key: rows, distinct keys, rows that lack a part of it.

    Counted per key within each task first, so that a frequent key costs one row per task.
    """
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    none = F.lit(0).cast("long")
    return counts.agg(
        F.coalesce(F.sum("__n"), none).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(lacking, F.col("__n"))), none).alias("rows_without_key"),
    ).select(F.lit(table).alias("table"), F.lit(create_statement(table, df, keys)).alias("ddl"), "*")


REPORT_SCHEMA = "table string, status string, rows long, error string"


def publish_jdbc(df: DataFrame, url: str, table: str, partitions: int = 16, **properties) -> None:
    """Replace a database table from the executors, 1000 rows per insert.

    The target is truncated, not dropped, so its keys and grants stay. At most
    ``partitions`` connections are open at a time: the database, not the scan, sets
    the pace.
    """
    (
        df.coalesce(partitions)
        .write.option("truncate", "true")
        .option("batchsize", 1000)
        .jdbc(url, table, mode="overwrite", properties={k: str(v) for k, v in properties.items()})
    )


class BadKeys(ValueError):
    """Rows repeat a primary key or lack one."""


def _unique(keys: list[str]) -> Callable[[DataFrame], None]:
    def check(written: DataFrame) -> None:
        bad = check_primary_key(written, keys).count()
        if bad:
            raise BadKeys(f"{bad} key values are repeated or missing in {', '.join(keys)}")

    return check


def publish_snapshot(df: DataFrame, target: str, table: str, keys: list[str] | None = None, **properties) -> int:
    """Sanitize and publish one table; returns the rows written.

    ``target`` is a JDBC url or a folder. Rows are counted while they are
    written, not by a second pass. With ``keys``, rows that repeat or lack one
    raise ``BadKeys`` and the target keeps what it has.
    """
    seen = Observation()
    clean = sanitize(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    check = _unique(keys) if keys else None
    if not target.startswith("jdbc:"):
        write_version(clean, f"{target}/{table}", check=check)
    elif check:
        stage = f"{checkpoint_dir(df.sparkSession)}/publish/{table}-{uuid.uuid4().hex}"
        write_version(clean, stage, check=check)
        publish_jdbc(read_version(df.sparkSession, stage), target, table, **properties)
    else:
        publish_jdbc(clean, target, table, **properties)
    return seen.get["rows"]


def clear_target(spark: SparkSession, target: str, table: str, **properties) -> None:
    """Empty a published table, when there is one, keeping its columns.

    Only a missing table is passed over; a refused connection or a broken table
    is the caller's to report.
    """
    if target.startswith("jdbc:"):
        options = {k: str(v) for k, v in properties.items()}
        try:
            old = spark.read.jdbc(target, table, properties=options)
        except Exception as err:
            # Drivers differ in how they name a missing table: SQL states 42P01, 42S02 and 42000-series texts.
            if re.search(r"42P01|42S02|does not exist|doesn't exist|not found|no such table", str(err), re.I):
                return
            raise
    else:
        try:
            old = read_table(spark, f"{target}/{table}")
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return
            raise
    publish_snapshot(spark.createDataFrame([], old.schema), target, table, **properties)


def publish_all(
    spark: SparkSession, source: str, target: str, tables: list[str] | None = None, **properties
) -> DataFrame:
    """Publish every gold table and report what happened to each.

    A missing or empty table empties its target. A table whose rows repeat a
    primary key, or lack one, is not published. A failure is reported and does not
    stop the others.
    """
    report = []
    for table in tables or list(SERVING_KEYS):
        try:
            df = read_gold(spark, source, table)
        except AnalysisException:
            df = None
        try:
            if df is None:
                clear_target(spark, target, table, **properties)
                report.append((table, "SKIPPED_NOT_FOUND", 0, None))
                continue
            keys = SERVING_KEYS.get(table, [])
            rows = publish_snapshot(serving_rows(df, keys), target, table, keys, **properties)
            report.append((table, "SUCCESS" if rows else "SKIPPED_EMPTY", rows, None))
        except Exception as err:  # reported per table
            report.append((table, "FAILED", 0, str(err)))
    return spark.createDataFrame(report, REPORT_SCHEMA)
