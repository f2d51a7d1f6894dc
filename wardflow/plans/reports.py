"""Operational, clinical and forecast reports over the gold tables.

Reports that look back from now take ``as_of``. Listings are ordered; ties are
broken by the remaining keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions.values import steady_avg, when_run
from wardflow.operators.filters import day_type, heatmap, shift_type, since, top_k

HOURS = list(range(24))


def _sums(**cols: str) -> list[Column]:
    return [F.sum(c).alias(n) for n, c in cols.items()]


# --- census -----------------------------------------------------------------


def current_census(current: DataFrame) -> DataFrame:
    return current.orderBy("department", "location_facility")


def census_total(current: DataFrame) -> DataFrame:
    return current.agg(*_sums(total_census="estimated_census"))


def census_snapshot(current: DataFrame, dept: str) -> DataFrame:
    d = dept.lower()
    return current.where(F.col("department") == dept).agg(
        F.sum("estimated_census").alias(f"{d}_census"),
        F.sum("total_arrivals").alias(f"{d}_arrivals"),
        F.sum("total_discharges").alias(f"{d}_discharges"),
    )


def census_share(current: DataFrame) -> DataFrame:
    return current.groupBy("department").agg(*_sums(census="estimated_census"))


def hourly(census: DataFrame, as_of=None, last_day: bool = False) -> DataFrame:
    """Hourly listing, all of it or the last 24 hours."""
    rows = since(census, "event_hour", "24 hours", as_of) if last_day else census
    return rows.orderBy("event_hour", "location_facility")


def daily(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("activity_date").desc(), "location_facility")


def _both(ed: DataFrame, icu: DataFrame, cols: list[str]) -> DataFrame:
    return ed.select(F.lit("ED").alias("department"), *cols).unionByName(
        icu.select(F.lit("ICU").alias("department"), *cols)
    )


def hourly_all(ed: DataFrame, icu: DataFrame) -> DataFrame:
    """Both departments' hours with day and shift labels."""
    cols = [
        "event_hour",
        "location_facility",
        "arrivals",
        "discharges",
        "net_change",
        "hour_of_day",
        "day_of_week",
        "is_weekend",
    ]
    labelled = _both(ed, icu, cols).withColumns(
        {"event_date": F.to_date("event_hour"), "day_type": day_type(), "shift_type": shift_type()}
    )
    return labelled.orderBy("event_hour", "department", "location_facility")


def daily_all(ed: DataFrame, icu: DataFrame) -> DataFrame:
    cols = ["activity_date", "location_facility", "total_arrivals", "total_discharges", "unique_patients"]
    return _both(ed, icu, cols).orderBy("activity_date", "department", "location_facility")


def daily_comparison(ed: DataFrame, icu: DataFrame) -> DataFrame:
    """Daily arrivals and discharges of both departments side by side."""
    names = ("arrivals", "discharges")

    def side(df, own):
        return df.select(
            "activity_date",
            *[
                (F.col(f"total_{n}") if d == own else F.lit(0)).cast("long").alias(f"{d}_{n}")
                for d in ("ed", "icu")
                for n in names
            ],
        )

    cols = [f"{d}_{n}" for d in ("ed", "icu") for n in names]
    return (
        side(ed, "ed")
        .unionByName(side(icu, "icu"))
        .groupBy("activity_date")
        .agg(*_sums(**{c: c for c in cols}))
        .orderBy("activity_date")
    )


def clock_hour_profile(ed: DataFrame, icu: DataFrame) -> DataFrame:
    return (
        _both(ed, icu, ["hour_of_day", "arrivals"])
        .groupBy("department", "hour_of_day")
        .agg(F.round(F.avg("arrivals"), 2).alias("avg_arrivals"))
        .orderBy("department", "hour_of_day")
    )


def hourly_kpis(census: DataFrame) -> DataFrame:
    """Totals and the first hour with the most arrivals."""
    first_max = F.max_by("event_hour", F.struct("arrivals", -F.unix_timestamp("event_hour")))
    return census.agg(
        F.sum("arrivals").alias("total_arrivals"),
        F.sum("discharges").alias("total_discharges"),
        first_max.alias("peak_hour"),
    )


def weekly_heatmap(census: DataFrame) -> DataFrame:
    """Mean arrivals by day of week (rows) and hour (columns)."""
    return heatmap(census, F.col("day_of_week"), "hour_of_day", HOURS, F.avg("arrivals"))


def daily_heatmap(features: DataFrame) -> DataFrame:
    """Arrivals by date (rows) and hour (columns)."""
    dated = features.select(
        F.to_date("event_hour").alias("event_date"), F.hour("event_hour").alias("hour"), "arrivals"
    )
    return heatmap(dated, F.col("event_date"), "hour", HOURS, F.sum("arrivals"))


def trend_averages(summary: DataFrame) -> DataFrame:
    """Mean arrivals, stay and patients (or beds) per day row."""
    stay = next(c for c in summary.columns if c.startswith("avg_los_"))
    crowd = "beds_used" if "beds_used" in summary.columns else "unique_patients"
    return summary.agg(
        F.round(F.avg("total_arrivals"), 1).alias("avg_daily_arrivals"),
        F.round(steady_avg(stay), 1).alias(stay),
        F.round(F.avg(crowd), 1).alias(f"avg_{crowd}"),
        F.count("*").alias("total_days"),
    )


def encounter_trend(encounters: DataFrame) -> DataFrame:
    return (
        encounters.groupBy(F.to_date("created_at").alias("encounter_date"), "patient_class_desc")
        .agg(F.count("*").alias("encounter_count"))
        .orderBy("encounter_date", "patient_class_desc")
    )


# --- patients and clinical --------------------------------------------------


def demographics(patients: DataFrame) -> DataFrame:
    counted = patients.groupBy("sex").agg(F.count("*").alias("patient_count"))
    return counted.orderBy(F.col("patient_count").desc(), "sex")


def patient_counts(patients: DataFrame) -> DataFrame:
    return patients.agg(
        F.count("*").alias("total_patients"),
        F.count_distinct("address_state").alias("states_represented"),
        F.count_distinct("source_system").alias("source_systems"),
    )


def _ranked(df: DataFrame, keys: list[str], count: str, n: int | None, *extra: Column) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count("*").alias(count), *extra)
    order = [F.col(count).desc(), *keys]
    return counted.orderBy(*order) if n is None else top_k(counted, order, n)


def top_diagnoses(diagnoses: DataFrame, n: int = 20) -> DataFrame:
    named = diagnoses.where("diagnosis_code IS NOT NULL AND diagnosis_code != ''")
    keys = ["diagnosis_code", "diagnosis_description", "diagnosis_coding_system"]
    patients = F.count_distinct("patient_id").alias("unique_patients")
    return _ranked(named, keys, "diagnosis_count", n, patients)


def observation_summary(observations: DataFrame, n: int | None = 20) -> DataFrame:
    value = "observation_value_numeric"
    return _ranked(
        observations.where("observation_id IS NOT NULL"),
        ["observation_id", "observation_text", "value_type"],
        "obs_count",
        n,
        F.count_if("is_abnormal").alias("abnormal_count"),
        F.round(F.avg(value), 2).alias("avg_value"),
        F.round(F.min(value), 2).alias("min_value"),
        F.round(F.max(value), 2).alias("max_value"),
    )


def abnormal_rate(summary: DataFrame) -> DataFrame:
    """Tests, observations and the mean of the tests' abnormal percentages."""
    pct = F.round(F.col("abnormal_count") / F.col("obs_count") * 100, 1)
    return summary.agg(
        F.count("*").alias("tests_tracked"),
        F.sum("obs_count").alias("total_observations"),
        F.round(steady_avg(pct), 1).alias("abnormal_rate_pct"),
    )


def abnormal_flags(observations: DataFrame) -> DataFrame:
    flagged = observations.where("abnormal_flags IS NOT NULL AND abnormal_flags != ''")
    return _ranked(flagged, ["abnormal_flags"], "flag_count", None)


def allergy_overview(allergies: DataFrame, n: int = 20) -> DataFrame:
    return _ranked(
        allergies.where("allergen_description IS NOT NULL"),
        ["allergen_description", "allergen_type_text", "severity_text", "is_severe"],
        "allergy_count",
        n,
        F.count_distinct("patient_id").alias("unique_patients"),
    )


def allergy_severity(allergies: DataFrame) -> DataFrame:
    counted = allergies.groupBy("severity_text", "is_severe").agg(F.count("*").alias("allergy_count"))
    return counted.select(
        F.coalesce("severity_text", F.lit("Unknown")).alias("severity"), "is_severe", "allergy_count"
    ).orderBy(F.col("allergy_count").desc(), "severity", "is_severe")


def order_activity(orders: DataFrame, n: int = 20) -> DataFrame:
    return _ranked(
        orders.where("universal_service_text IS NOT NULL"),
        ["universal_service_text", "priority", "result_status"],
        "order_count",
        n,
        F.count_distinct("patient_id").alias("unique_patients"),
    )


def provider_volume(orders: DataFrame, n: int = 15) -> DataFrame:
    named = orders.where("ordering_provider_name IS NOT NULL AND ordering_provider_name != ''")
    return _ranked(named, ["ordering_provider_name", "ordering_provider_id"], "order_count", n)


# --- messages and activity --------------------------------------------------


def metrics(message_metrics: DataFrame) -> DataFrame:
    return message_metrics.orderBy(F.col("processing_hour").desc(), "message_type", "sending_facility")


def activity(patient_activity: DataFrame) -> DataFrame:
    return patient_activity.orderBy(
        F.col("activity_date").desc(), "location_facility", "patient_class_desc"
    )


def throughput(message_metrics: DataFrame) -> DataFrame:
    return (
        message_metrics.groupBy("processing_hour")
        .agg(
            F.sum("message_count").alias("total_messages"),
            F.sum("unique_messages").alias("total_unique"),
            F.count_distinct("message_type").alias("message_types"),
            F.count_distinct("sending_facility").alias("facilities"),
        )
        .orderBy("processing_hour")
    )


def throughput_totals(per_hour: DataFrame) -> DataFrame:
    return per_hour.agg(
        F.sum("total_messages").alias("total_messages"),
        F.sum("total_unique").alias("total_unique"),
        F.count("*").alias("hours_covered"),
    )


def recent_throughput(message_metrics: DataFrame, as_of=None, interval: str = "72 hours") -> DataFrame:
    return (
        since(message_metrics, "processing_hour", interval, as_of)
        .groupBy("processing_hour")
        .agg(F.sum("message_count").alias("total_messages"))
        .orderBy("processing_hour")
    )


def messages_since(message_metrics: DataFrame, interval: str = "24 hours", as_of=None) -> DataFrame:
    recent = since(message_metrics, "processing_hour", interval, as_of)
    return recent.agg(F.coalesce(F.sum("message_count"), F.lit(0)).alias("messages"))


def message_mix(message_metrics: DataFrame, n: int = 50) -> DataFrame:
    """Largest type and sender pairs, missing names shown as Unknown."""
    counted = message_metrics.groupBy("message_type", "sending_facility").agg(
        F.sum("message_count").alias("msg_count")
    )
    named = counted.select(
        F.coalesce("message_type", F.lit("Unknown")).alias("message_type"),
        F.coalesce("sending_facility", F.lit("Unknown")).alias("sending_facility"),
        "msg_count",
    )
    return top_k(named, [F.col("msg_count").desc(), "message_type", "sending_facility"], n)


def volume_by(message_metrics: DataFrame, col: str) -> DataFrame:
    return (
        message_metrics.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(*_sums(total_messages="message_count", total_unique="unique_messages"))
        .orderBy(F.col("total_messages").desc(), col)
    )


def encounters_since(encounters: DataFrame, interval: str = "7 days", as_of=None) -> DataFrame:
    return since(encounters, "created_at", interval, as_of).agg(F.count("*").alias("n"))


def daily_encounters(encounters: DataFrame, as_of=None, interval: str = "30 days") -> DataFrame:
    return (
        since(encounters, "created_at", interval, as_of)
        .groupBy(F.to_date("created_at").alias("d"))
        .agg(F.count("*").alias("encounter_count"))
        .orderBy("d")
    )


def activity_by_class(patient_activity: DataFrame) -> DataFrame:
    return (
        patient_activity.where("patient_class_desc IS NOT NULL")
        .groupBy("patient_class_desc")
        .agg(
            *_sums(
                total_encounters="encounter_count",
                total_patients="unique_patients",
                total_providers="unique_providers",
            )
        )
    )


def activity_by_facility(patient_activity: DataFrame) -> DataFrame:
    return (
        patient_activity.where("location_facility IS NOT NULL")
        .groupBy("location_facility")
        .agg(*_sums(total_encounters="encounter_count", total_patients="unique_patients"))
        .orderBy(F.col("total_encounters").desc(), "location_facility")
    )


def activity_totals(patient_activity: DataFrame) -> DataFrame:
    return patient_activity.agg(
        F.sum("encounter_count").alias("total_encounters"),
        F.sum("unique_patients").alias("unique_patients"),
        F.count_distinct("activity_date").alias("activity_days"),
    )


# --- forecasts --------------------------------------------------------------


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """All predictions, newest run first, rounded for display."""
    return predictions.select(
        "model_name",
        "model_version",
        "department",
        "target_metric",
        "forecast_horizon_hours",
        "target_hour",
        F.round("predicted_value", 1).alias("predicted_value"),
        F.round("prediction_lower_bound", 1).alias("lower_bound"),
        F.round("prediction_upper_bound", 1).alias("upper_bound"),
        F.round(F.col("confidence_level").cast("decimal(10,3)") * 100, 0)
        .cast("double")
        .alias("confidence_pct"),
        F.round("actual_value", 1).alias("actual_value"),
        F.round("absolute_error", 2).alias("error"),
        "forecast_generated_at",
    ).orderBy(
        F.col("forecast_generated_at").desc(), "department", "target_metric", "forecast_horizon_hours"
    )


def predictions_since(
    predictions: DataFrame,
    interval: str = "7 days",
    as_of=None,
    dept: str | None = None,
    metric: str | None = None,
    horizon: int | None = None,
) -> DataFrame:
    """Recent predictions, or one slice of them, in order of target hour."""
    rows = since(predictions, "forecast_generated_at", interval, as_of)
    for col, value in (
        ("department", dept),
        ("target_metric", metric),
        ("forecast_horizon_hours", horizon),
    ):
        if value is not None:
            rows = rows.where(F.col(col) == value)
    return rows.select(
        "model_name",
        "department",
        "target_metric",
        "forecast_horizon_hours",
        "target_hour",
        "predicted_value",
        "prediction_lower_bound",
        "prediction_upper_bound",
        "actual_value",
        "absolute_error",
        "forecast_generated_at",
    ).orderBy("target_hour", "model_name", "forecast_horizon_hours")


def predicted_vs_actual(predictions: DataFrame, n: int = 500) -> DataFrame:
    """Newest scored predictions."""
    cols = [
        "model_name",
        "department",
        "target_metric",
        "forecast_horizon_hours",
        "target_hour",
        "predicted_value",
        "actual_value",
        "absolute_error",
    ]
    ties = [c for c in cols if c != "target_hour"]
    scored = predictions.where("actual_value IS NOT NULL").select(*cols)
    return top_k(scored, [F.col("target_hour").desc(), *ties], n)


def latest_batch(predictions: DataFrame, dept: str | None = None) -> DataFrame:
    """Rows of the newest run, of one department if given."""
    newest = predictions.agg(F.max("forecast_generated_at").alias("forecast_generated_at"))
    rows = predictions.join(F.broadcast(newest), "forecast_generated_at", "left_semi")  # one row
    return rows if dept is None else rows.where(F.col("department") == dept)


def batch_by_horizon(predictions: DataFrame) -> DataFrame:
    return (
        latest_batch(predictions)
        .groupBy("forecast_horizon_hours")
        .agg(F.count("*").alias("prediction_rows"))
        .orderBy("forecast_horizon_hours")
    )


def accuracy(forecast_accuracy: DataFrame, model: str | None = None) -> DataFrame:
    """Newest first; one model's rows oldest first."""
    day = F.col("prediction_date")
    ties = ["model_name", "department", "target_metric", "forecast_horizon_hours"]
    if model is None:
        return forecast_accuracy.orderBy(day.desc(), *ties)
    return forecast_accuracy.where(F.col("model_name") == model).orderBy(day, *ties)


def accuracy_summary(forecast_accuracy: DataFrame) -> DataFrame:
    return (
        forecast_accuracy.groupBy("model_name", "department", "target_metric", "forecast_horizon_hours")
        .agg(
            F.count("*").alias("total_periods"),
            F.round(steady_avg("mae"), 2).alias("avg_mae"),
            F.round(steady_avg("mape"), 1).alias("avg_mape_pct"),
            F.round(steady_avg("coverage_pct"), 1).alias("avg_coverage_pct"),
            F.sum("prediction_count").alias("total_predictions"),
        )
        .orderBy("model_name", "forecast_horizon_hours", "department", "target_metric")
    )


def scoreboard(summary: DataFrame) -> DataFrame:
    """Models tracked, and their mean MAE and MAPE."""
    return summary.agg(
        F.count_distinct("model_name").alias("models_tracked"),
        F.round(steady_avg("avg_mae"), 2).alias("overall_avg_mae"),
        F.round(steady_avg("avg_mape_pct"), 1).alias("overall_avg_mape"),
    )


def forecast_activity(predictions: DataFrame, as_of=None) -> DataFrame:
    recent = F.col("forecast_generated_at") >= when_run(as_of) - F.expr("INTERVAL 24 HOURS")
    return predictions.agg(
        F.max("forecast_generated_at").alias("last_run"),
        F.count_if(recent).alias("rows_24h"),
        F.count_distinct("model_name").alias("distinct_models"),
    )


def prediction_overview(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("*").alias("total_predictions"),
        F.count("actual_value").alias("scored_predictions"),
        F.max("forecast_generated_at").alias("latest_forecast_run"),
    )


# --- features ---------------------------------------------------------------

# Columns of the feature listings.
FEATURE_COLUMNS = {
    "combined": (
        "event_hour", "ed_arrivals", "ed_discharges", "ed_net_change", "icu_arrivals", "icu_discharges",
        "icu_net_change", "total_arrivals", "total_discharges", "ed_to_icu_ratio", "net_system_pressure",
        "hour_of_day", "day_of_week", "is_weekend", "ed_arrivals_rolling_24h", "icu_arrivals_rolling_24h",
        "ed_discharges_rolling_24h", "icu_discharges_rolling_24h",
    ),
    "department": (
        "event_hour", "location_facility", "arrivals", "discharges", "net_change", "arrivals_lag_1h",
        "arrivals_lag_24h", "arrivals_rolling_6h", "arrivals_rolling_24h", "arrivals_avg_24h",
        "arrivals_std_24h", "discharges_rolling_24h", "cumulative_net_census", "arrivals_wow_ratio",
        "is_night_shift", "is_holiday_window",
    ),
    "sample": (
        "event_hour", "location_facility", "arrivals", "discharges", "arrivals_lag_1h",
        "arrivals_rolling_24h", "cumulative_net_census", "is_night_shift", "is_holiday_window",
    ),
}


def features(table: DataFrame, kind: str) -> DataFrame:
    """Feature listing by hour; ``kind`` is ``combined`` or ``department``."""
    cols = FEATURE_COLUMNS[kind]
    return table.select(*cols).orderBy(*cols[:2])


def feature_sample(table: DataFrame, n: int = 24) -> DataFrame:
    cols = FEATURE_COLUMNS["sample"]
    return top_k(table.select(*cols), [F.col("event_hour").desc(), *cols[1:]], n)


def feature_long(table: DataFrame, cols: list[str]) -> DataFrame:
    """One row per hour and feature, for all columns given."""
    wide = table.select("event_hour", *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot("event_hour", cols, "feature", "value")


def combined_latest(combined: DataFrame) -> DataFrame:
    return top_k(
        combined.select(
            "net_system_pressure",
            F.round("ed_to_icu_ratio", 2).alias("ed_to_icu_ratio"),
            "total_arrivals",
            "total_discharges",
            "ed_arrivals",
            "icu_arrivals",
            "event_hour",
        ),
        [F.col("event_hour").desc()],
        1,
    )


def pressure(combined: DataFrame) -> DataFrame:
    return combined.select("event_hour", "net_system_pressure", "ed_arrivals", "icu_arrivals").orderBy(
        "event_hour"
    )


def ratio_series(combined: DataFrame) -> DataFrame:
    """ED arrivals per ICU arrival and hour; NULL in hours without ICU arrivals."""
    ed, icu = (F.coalesce(c, F.lit(0)).cast("double") for c in ("ed_arrivals", "icu_arrivals"))
    return combined.select("event_hour", F.try_divide(ed, icu).alias("ratio")).orderBy("event_hour")


def ratio_average(combined: DataFrame) -> DataFrame:
    return ratio_series(combined).agg(F.avg("ratio").alias("avg_ratio"))


def pressure_kpis(combined: DataFrame) -> DataFrame:
    """Values of the last hour and the number of hours."""
    last = F.max_by(
        F.struct(
            "net_system_pressure",
            F.try_divide(F.col("ed_arrivals").cast("double"), F.col("icu_arrivals")).alias("ed_icu_ratio"),
            "total_arrivals",
            "total_discharges",
        ),
        "event_hour",
    )
    return combined.agg(last.alias("last"), F.count("*").alias("data_points")).select(
        "last.*", "data_points"
    )
