"""Freshness of the tables against their targets, and the daily digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.values import when_run
from wardflow.operators.filters import since, top_k
from wardflow.plans.reports import daily_encounters

# Layer, area, table, activity column and freshness target in hours.
MONITORED = [
    ("Stream", "HL7 throughput", "gold_message_metrics", "last_message_at", 36),
    ("Gold", "Encounters", "gold_encounter_fact", "created_at", 72),
    ("Gold", "Patients", "gold_patient_dim", "last_updated_at", 168),
    ("Gold", "ED census (hourly)", "gold_ed_hourly_census", "event_hour", 48),
    ("Gold", "ICU census (hourly)", "gold_icu_hourly_census", "event_hour", 48),
    ("Gold", "Department snapshot", "gold_department_census_current", "snapshot_at", 48),
    ("ML", "Forecast features", "gold_ed_forecast_features", "event_hour", 72),
    ("ML", "Forecast features", "gold_icu_forecast_features", "event_hour", 72),
    ("ML", "Combined features", "gold_combined_forecast_features", "event_hour", 72),
    ("ML", "Predictions", "gold_forecast_predictions", "forecast_generated_at", 48),
    ("ML", "Accuracy rollup", "gold_forecast_accuracy", "prediction_date", None),
]
NO_TARGET = "no SLO"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def age_hours(ts: Column, as_of=None) -> Column:
    now = F.unix_micros(when_run(as_of).cast("timestamp"))
    return (now - F.unix_micros(ts.cast("timestamp"))) / 3.6e9


def slo_tier(age: Column, target: Column) -> Column:
    """``ok`` within the target, ``stale`` within twice that, else ``critical``.

    NULL without an age; the no-target label without a target.
    """
    return (
        F.when(age.isNull(), F.lit(None).cast("string"))
        .when(target.isNull(), NO_TARGET)
        .when(age <= target, "ok")
        .when(age <= target * 2, "stale")
        .otherwise("critical")
    )


def data_freshness(message_metrics: DataFrame) -> DataFrame:
    return message_metrics.agg(
        F.max("last_message_at").alias("latest_message"),
        F.max("processing_hour").alias("latest_processing_hour"),
        F.count("*").alias("total_metric_rows"),
    )


def freshness_signals(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Newest moment, age and tier of messages, encounters and predictions."""
    named = {m[2]: m for m in MONITORED}
    signals = [
        ("messages", "gold_message_metrics"),
        ("encounters", "gold_encounter_fact"),
        ("predictions", "gold_forecast_predictions"),
    ]
    rows = [
        tables[table]
        .agg(F.max(named[table][3]).alias("latest"))
        .select(
            F.lit(signal).alias("signal"),
            "latest",
            slo_tier(age_hours(F.col("latest"), as_of), F.lit(named[table][4])).alias("tier"),
        )
        for signal, table in signals
    ]
    return _union(rows)


def status_board(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Rows, last activity, age and label of every monitored table.

    Each table is reduced to one row on its own; a table that is not there reads
    ``missing``, one without rows or activity ``empty``.
    """
    rows = []
    for layer, area, name, col, target in MONITORED:
        lead = [F.lit(layer).alias("layer"), F.lit(area).alias("area"), F.lit(name).alias("table_name")]
        goal = F.lit(target).cast("int")
        if name not in tables:
            continue
        found = tables[name].agg(
            F.count("*").alias("row_count"), F.max(F.col(col).cast("timestamp")).alias("last_activity")
        )
        age = age_hours(F.col("last_activity"), as_of)
        label = F.when(
            (F.col("row_count") == 0) & F.col("last_activity").isNull(), "empty"
        ).otherwise(slo_tier(age, goal))
        rows.append(
            found.select(
                *lead, "row_count", "last_activity", F.round(age, 1).alias("age_hours"), label.alias("status")
            )
        )
    board = _union(rows)
    gone = [m for m in MONITORED if m[2] not in tables]
    if gone:
        spark = board.sparkSession
        schema = board.schema
        absent = [(m[0], m[1], m[2], None, None, None, "missing") for m in gone]
        board = board.unionByName(spark.createDataFrame(absent, _nullable(schema)))
    return board


def _nullable(schema):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return fields


def status_counts(board: DataFrame) -> DataFrame:
    return board.agg(
        F.count_if(F.col("status") == "ok").alias("tables_ok"),
        F.count_if(F.col("status") == "stale").alias("tables_stale"),
        F.count_if(F.col("status") == "critical").alias("tables_critical"),
        F.count("*").alias("tables_tracked"),
    )


def is_stale(message_metrics: DataFrame, hours: float = 36, as_of=None) -> DataFrame:
    """1.0 when no message came for more than ``hours``, or ever; else 0.0."""
    now = F.unix_timestamp(when_run(as_of))
    last = F.col("last_message_at")
    late = last.isNull() | ((now - F.unix_timestamp(last)) / 3600.0 > hours)
    newest = message_metrics.agg(F.max("last_message_at").alias("last_message_at"))
    return newest.select(F.when(late, 1.0).otherwise(0.0).alias("should_alert"))


def digest(
    encounters: DataFrame, message_metrics: DataFrame, patients: DataFrame, predictions: DataFrame, as_of=None
) -> DataFrame:
    """Headline figures in one row.

    Each table gives one partial row; the rows are stacked and folded into one.
    """
    now = when_run(as_of)
    today = F.to_date(now)
    day_ago = now - F.expr("INTERVAL 1 DAY")
    created = F.col("created_at")
    parts = [
        encounters.where(created >= F.date_sub(today, 7)).agg(
            F.count("*").alias("encounters_7d"),
            F.count_if(F.to_date(created) == today).alias("encounters_today"),
        ),
        message_metrics.agg(
            F.coalesce(
                F.sum(F.when(F.col("processing_hour") >= day_ago, F.col("message_count"))), F.lit(0)
            ).alias("messages_24h"),
            F.max("last_message_at").alias("last_message_at"),
        ),
        patients.agg(F.count("*").alias("total_patients")),
        predictions.agg(
            F.count_if(F.col("forecast_generated_at") >= day_ago).alias("ml_predictions_24h")
        ),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [
        "encounters_7d",
        "messages_24h",
        "total_patients",
        "ml_predictions_24h",
        "last_message_at",
        "encounters_today",
    ]
    return stacked.agg(*[F.max(n).alias(n) for n in names])


def digest_daily(encounters: DataFrame, as_of=None) -> DataFrame:
    return daily_encounters(encounters, as_of)


def digest_hourly(message_metrics: DataFrame, as_of=None) -> DataFrame:
    hour = F.date_trunc("hour", "processing_hour").alias("hr")
    return (
        since(message_metrics, "processing_hour", "3 days", as_of)
        .groupBy(hour)
        .agg(F.sum("message_count").cast("double").alias("total_messages"))
        .orderBy("hr")
    )


def digest_mix(message_metrics: DataFrame, n: int = 10) -> DataFrame:
    counted = message_metrics.groupBy("message_type").agg(
        F.sum("message_count").cast("double").alias("c")
    )
    named = counted.select(F.coalesce("message_type", F.lit("Unknown")).alias("message_type"), "c")
    return top_k(named, [F.col("c").desc(), "message_type"], n)
