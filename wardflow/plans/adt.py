"""Admission, discharge and transfer events: row model, totals and slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.values import label_blank, when_run
from wardflow.operators.filters import top_k

# Label of a blank, by column.
BLANK_LABELS = {
    "message_event_type": "(null)",
    "patient_class": "(null)",
    "department": "(empty)",
    "facility": "(empty)",
    "sending_facility": "(empty)",
    "admission_type": "(null)",
    "financial_class": "(null)",
    "discharge_disposition": "(null)",
}

SLICES = ("event_day", "hour_of_day", "day_kind", *BLANK_LABELS)


def recent_adt(events: DataFrame, as_of=None, days: int = 365) -> DataFrame:
    first = F.date_sub(F.to_date(when_run(as_of)), days)
    return events.where(
        (F.col("message_type") == "ADT")
        & F.col("event_time_stamp").isNotNull()
        & (F.col("event_time_stamp") >= first)
    )


def adt_rows(events: DataFrame, as_of=None, days: int = 365) -> DataFrame:
    """ADT rows of the last year with calendar parts and filled labels.

    ``events`` has ``event_time_stamp, message_type, patient_mrn`` and the labelled
    columns.
    """
    ts = F.col("event_time_stamp")
    trigger = F.nullif(F.trim("message_event_type"), F.lit(""))
    return recent_adt(events, as_of, days).select(
        "event_time_stamp",
        F.to_date(ts).alias("event_date"),
        F.date_format(ts, "yyyy-MM-dd").alias("event_day"),
        F.hour(ts).alias("hour_of_day"),
        F.when(F.dayofweek(ts).isin(1, 7), "Weekend").otherwise("Weekday").alias("day_kind"),
        *[label_blank(c, label).alias(c) for c, label in BLANK_LABELS.items()],
        "patient_mrn",
        F.lit(1).alias("row_n"),
        F.when(trigger == "A01", 1).otherwise(0).alias("a01_f"),
    )


def adt_total(events: DataFrame, as_of=None) -> DataFrame:
    return recent_adt(events, as_of).agg(F.count("*").alias("total_events"))


def adt_admissions_today(events: DataFrame, as_of=None) -> DataFrame:
    today = F.to_date(when_run(as_of))
    ts = F.col("event_time_stamp")
    return events.where(
        (F.col("message_type") == "ADT")
        & (F.col("message_event_type") == "A01")
        & (ts >= today)
        & (ts < F.date_add(today, 1))
    ).agg(F.count("*").alias("admissions_today"))


def adt_by_day(events: DataFrame, as_of=None) -> DataFrame:
    day = F.date_format("event_time_stamp", "yyyy-MM-dd").alias("event_day")
    return recent_adt(events, as_of).groupBy(day).agg(F.count("*").alias("event_count")).orderBy("event_day")


def adt_by_trigger(events: DataFrame, as_of=None) -> DataFrame:
    return (
        recent_adt(events, as_of)
        .where("message_event_type IS NOT NULL")
        .groupBy("message_event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.col("event_count").desc(), "message_event_type")
    )


def adt_kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("row_n").alias("adt_rows"),
        F.count_distinct("patient_mrn").alias("distinct_patients"),
        F.sum("a01_f").alias("a01_count"),
    )


def adt_slice(rows: DataFrame, dim: str) -> DataFrame:
    """Rows and admissions by one of :data:`SLICES`."""
    return (
        rows.groupBy(dim)
        .agg(F.sum("row_n").alias("event_count"), F.sum("a01_f").alias("a01_count"))
        .orderBy(dim)
    )


def adt_sample(rows: DataFrame, n: int = 100) -> DataFrame:
    """Newest rows, five columns."""
    cols = ["event_time_stamp", "message_event_type", "patient_class", "department", "facility"]
    return top_k(rows.select(*cols, "patient_mrn"), [F.col(cols[0]).desc(), "patient_mrn"], n).select(*cols)
