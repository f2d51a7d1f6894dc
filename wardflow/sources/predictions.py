"""The prediction log, kept by the day that is predicted.

New predictions are added to the folders of their target days. Actual values, known hours later,
are filled in by writing the days that got some anew (``sources.versions``), so a job that dies in
between leaves the log whole, closed days are never read again, and readers see one table without
a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.tables import read_table, update_by_key
from wardflow.sources.versions import in_parts, is_versioned, part_names, read_version, write_version

PREDICTIONS = "gold_forecast_predictions"
FOUND_LATER = ["actual_value", "absolute_error"]
DAY = "target_day"


def _by_day(spark: SparkSession, gold: str) -> DataFrame:
    return read_version(spark, f"{gold}/{PREDICTIONS}", keep_part=True)


def has_predictions(spark: SparkSession, gold: str) -> bool:
    return is_versioned(spark, f"{gold}/{PREDICTIONS}")


def read_predictions(spark: SparkSession, gold: str) -> DataFrame:
    """All predictions, with their actual value and error where known."""
    return _by_day(spark, gold).drop(DAY)


def append_predictions(rows: DataFrame, gold: str) -> None:
    """Add predictions whose ids the log does not have; only the days they are for are looked at."""
    spark = rows.sparkSession
    rows = rows.withColumn(DAY, F.to_date("target_hour"))
    if has_predictions(spark, gold):
        known = _by_day(spark, gold).where(in_parts(DAY, part_names(rows, DAY)))
        rows = rows.join(known.select("prediction_id"), "prediction_id", "left_anti").select(*rows.columns)
    write_version(rows, f"{gold}/{PREDICTIONS}", DAY, add=True)


def open_days(spark: SparkSession, gold: str, until) -> list[str]:
    """The target days up to ``until`` (a column) with a prediction that has no actual value."""
    return part_names(_by_day(spark, gold).where("actual_value IS NULL").where(F.col(DAY) <= until), DAY)


def predictions_of(spark: SparkSession, gold: str, days: list[str]) -> DataFrame:
    """The predictions for some target days, from their folders alone."""
    return _by_day(spark, gold).where(in_parts(DAY, days))


def fill_in(spark: SparkSession, gold: str, days: list[str], updates) -> list[str]:
    """Rewrite the days among ``days`` for which ``updates(predictions)`` finds values; returns them."""
    rows = predictions_of(spark, gold, days)
    found = updates(rows)
    hit = part_names(rows.join(found.select("prediction_id"), "prediction_id", "left_semi"), DAY)
    if hit:
        touched = rows.where(in_parts(DAY, hit))
        filled = update_by_key(touched, found, "prediction_id", FOUND_LATER)
        write_version(filled, f"{gold}/{PREDICTIONS}", DAY, replaced=hit)
    return hit


def read_gold(spark: SparkSession, gold: str, table: str) -> DataFrame:
    """A gold table as its readers should see it."""
    return read_table(spark, f"{gold}/{table}")
