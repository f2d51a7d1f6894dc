"""Row subsets, labels and reshaping shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.values import when_run


def subset(df: DataFrame, col: str, values) -> DataFrame:
    """Rows whose ``col`` is one of ``values``; no values means all rows."""
    return df.where(F.col(col).isin(*values)) if values else df


def facility_subset(df: DataFrame, values, col: str = "location_facility") -> DataFrame:
    """Rows of the given facilities; a frame without the column is an error."""
    return subset(df, col, values)


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows from ``start`` to ``end``, both days included.

    Written as bounds on the column itself, so a timestamp column's filter reaches
    the file scan.
    """
    first, after = F.lit(str(start)).cast("date"), F.date_add(F.lit(str(end)).cast("date"), 1)
    return df.where((F.col(col) >= first) & (F.col(col) < after))


def day_kind(df: DataFrame, choice: str = "All") -> DataFrame:
    """``All``, ``Weekdays`` or ``Weekends``."""
    if choice == "All":
        return df
    if choice not in ("Weekdays", "Weekends"):
        raise ValueError(f"day kind {choice!r} is none of All, Weekdays, Weekends")
    return df.where(F.col("is_weekend") == (1 if choice == "Weekends" else 0))


def since(df: DataFrame, col: str, interval: str, as_of=None) -> DataFrame:
    """Rows no older than an interval such as ``24 hours`` before ``as_of``."""
    return df.where(F.col(col) >= when_run(as_of) - F.expr(f"INTERVAL {interval}"))


def search(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose column contains the text, upper or lower case."""
    return df.where(F.lower(col).contains(text.lower())) if text else df


def day_type() -> Column:
    return F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")


def shift_type() -> Column:
    return F.when(F.col("hour_of_day").between(7, 18), "Day Shift").otherwise("Night Shift")


def shift_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({"day_type": day_type(), "shift_type": shift_type()})


def with_metadata(df: DataFrame, run_id: str, as_of=None) -> DataFrame:
    """Processing time, day and the first 8 characters of the run id."""
    now = when_run(as_of)
    return df.withColumns(
        {"processed_at": now, "processing_date": F.to_date(now), "pipeline_id": F.lit(run_id[:8])}
    )


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """First ``k`` rows; ``order`` should end in columns that break ties."""
    return df.orderBy(*order).limit(k)


def heatmap(df: DataFrame, row: Column, col: str, values: list, measure: Column) -> DataFrame:
    """A pivot over known column values, so no pass is spent on finding them."""
    return df.groupBy(row).pivot(col, values).agg(measure).na.fill(0)
