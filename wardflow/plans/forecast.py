"""The forecast loop: train, predict, back-fill."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import forecast as fc
from wardflow.sources.predictions import append_predictions, fill_in, has_predictions, open_days, read_predictions
from wardflow.sources.tables import append_table, read_table, table_exists
from wardflow.sources.versions import in_parts, is_versioned, read_version, write_version

FEATURE_TABLES = {
    "ed": "gold_ed_forecast_features",
    "icu": "gold_icu_forecast_features",
    "combined": "gold_combined_forecast_features",
}
METADATA, RUNS = "gold_model_training_metadata", "gold_model_training_runs"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _outcome(spark, gold: str, models_dir: str, model: fc.Model, now: datetime, search, folds: int) -> tuple[dict, dict | None]:
    """What became of one model: its status row and, when it was trained, its metadata."""
    version = now.strftime("%Y%m%d%H%M%S%f")
    status = {"model_name": model.name, "training_timestamp": now, "training_samples": 0}
    try:
        features = read_table(spark, f"{gold}/{FEATURE_TABLES[model.features]}")
        trained = fc.train(features, model.target, search, folds)
        if isinstance(trained, int):
            reason = f"{trained} rows, at least {fc.MIN_TRAINING_ROWS} are needed"
            return {**status, "status": "SKIPPED", "reason": reason, "training_samples": trained}, None
        fitted, metrics = trained
        path = f"{models_dir}/{model.name}/{version}"
        fitted.write().overwrite().save(path)
    except Exception as err:  # one model's failure is reported and leaves the others alone
        return {**status, "status": "FAILED", "reason": str(err)}, None
    samples = int(metrics["samples"])
    row = {
        "model_name": model.name,
        "model_version": version,
        "training_timestamp": now,
        "rmse": float(metrics["rmse"]),
        "r2_score": float(metrics["r2"]),
        "mae": float(metrics["mae"]),
        "best_trial_description": metrics["best_trial"],
        "run_id": uuid.uuid4().hex,
        "training_samples": samples,
        "champion": True,
        "model_path": path,
    }
    return {**status, "status": "SUCCESS", "reason": None, "training_samples": samples}, row


def train_all(spark: SparkSession, gold: str, models_dir: str, search=None, folds: int = 3) -> DataFrame:
    """Train every model on its feature table; returns one status row per model.

    A newly trained version becomes its model's champion. A model that is skipped
    or fails keeps the champion it had. The status rows are appended to
    ``gold_model_training_runs``, and the metadata table, one champion per model,
    gets a new version only when something was trained; the old champions stay in
    place until it is whole.
    """
    now = _now()
    outcomes = [_outcome(spark, gold, models_dir, m, now, search, folds) for m in fc.MODELS]
    report = spark.createDataFrame([s for s, _ in outcomes], fc.RUN_SCHEMA)
    append_table(report, f"{gold}/{RUNS}")
    trained = [row for _, row in outcomes if row]
    if trained:
        rows = trained
        if table_exists(spark, f"{gold}/{METADATA}"):
            names = {row["model_name"] for row in trained}
            old = read_table(spark, f"{gold}/{METADATA}").collect()  # one row per model
            rows = [*trained, *(r.asDict() for r in old if r["model_name"] not in names)]
        write_version(fc.training_metadata(spark, rows), f"{gold}/{METADATA}")
    return report


def predict_all(spark: SparkSession, gold: str, run_ts=None) -> int:
    """Append predictions of every champion, all with one run time; returns the models that ran.

    The rows of all models are appended at once. Their ids follow from model,
    version, run and horizon, so a run repeated for the same time is recognized
    and adds nothing.
    """
    run = F.lit(_now()) if run_ts is None else run_ts
    metadata = read_table(spark, f"{gold}/{METADATA}")
    parts = []
    for model in fc.MODELS:
        loaded = fc.champion(metadata, model.name)
        if loaded is None:
            continue
        fitted, version = loaded
        newest = fc.latest_rows(read_table(spark, f"{gold}/{FEATURE_TABLES[model.features]}"))
        points = fc.latest_score(fc.score(newest, fitted, model))
        parts.append(fc.prediction_rows(fc.expand_horizons(points), model, version, run))
    if parts:
        append_predictions(reduce(DataFrame.unionByName, parts), gold)
    return len(parts)


def _census(spark: SparkSession, gold: str) -> list[DataFrame]:
    return [read_table(spark, f"{gold}/gold_{d}_hourly_census") for d in ("ed", "icu")]


def backfill(spark: SparkSession, gold: str) -> list[str] | None:
    """Fill in the actuals that became known for open predictions; None without predictions.

    Only target days with an open prediction are read, and only those that got a value
    are written; they are returned.
    """
    if not has_predictions(spark, gold):
        return None
    census = _census(spark, gold)
    newest = reduce(DataFrame.unionByName, [c.select("event_hour") for c in census]).agg(F.max("event_hour")).first()[0]
    if newest is None:
        return []
    days = open_days(spark, gold, F.to_date(F.lit(newest)))
    known = [c.where(F.to_date("event_hour").cast("string").isin(days)) for c in census]
    return fill_in(spark, gold, days, lambda rows: fc.actual_updates(rows, *known)) if days else []


def refresh_accuracy(spark: SparkSession, gold: str, days: list[str] | None = None) -> None:
    """``gold_forecast_accuracy`` by target day: of some days only, or of all.

    Give the days that ``backfill`` returned; all others keep their figures.
    """
    path = f"{gold}/gold_forecast_accuracy"
    rows = read_predictions(spark, gold)
    if days is None or not is_versioned(spark, path):
        table, how = fc.forecast_accuracy(rows), {}
    else:
        by_day = read_version(spark, f"{gold}/gold_forecast_predictions", keep_part=True)
        table, how = fc.forecast_accuracy(by_day.where(in_parts("target_day", days))), {"replaced": days}
    write_version(table.withColumn("target_day", F.col("prediction_date")).repartition("target_day"), path, "target_day", **how)
