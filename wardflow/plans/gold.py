"""Gold refresh: facts, dimension, census and features from the segment tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.operators import census, facts, features
from wardflow.operators.forecast import forecast_accuracy
from wardflow.plans.forecast import refresh_accuracy
from wardflow.sources.predictions import read_gold
from wardflow.sources.tables import table_exists
from wardflow.sources.versions import write_version
from wardflow.streaming.ingest import read_ingested

# Each gold table as a function of a lookup for the tables before it and of the moment
# it is for, in the order they are written. Census and features read the written tables, so a table is
# computed once per refresh and a lost executor costs only the running stage.
Lookup = Callable[[str], DataFrame]
GOLD: dict[str, Callable[[Lookup, object], DataFrame]] = {
    "gold_patient_dim": lambda t, at: facts.patient_dim(t("silver_pid")),
    "gold_encounter_fact": lambda t, at: facts.encounter_fact(t("silver_pv1")),
    "gold_observation_fact": lambda t, at: facts.observation_fact(t("silver_obx")),
    "gold_diagnosis_fact": lambda t, at: facts.diagnosis_fact(t("silver_dg1")),
    "gold_allergy_fact": lambda t, at: facts.allergy_fact(t("silver_al1")),
    "gold_order_fact": lambda t, at: facts.order_fact(t("silver_obr")),
    "gold_message_metrics": lambda t, at: facts.message_metrics(t("silver_msh")),
    "gold_patient_activity": lambda t, at: facts.patient_activity(t("gold_encounter_fact")),
    "gold_ed_hourly_census": lambda t, at: census.ed_hourly_census(t("gold_encounter_fact")),
    "gold_icu_hourly_census": lambda t, at: census.icu_hourly_census(t("gold_encounter_fact")),
    "gold_ed_daily_summary": lambda t, at: census.ed_daily_summary(t("gold_encounter_fact")),
    "gold_icu_daily_summary": lambda t, at: census.icu_daily_summary(t("gold_encounter_fact")),
    "gold_department_census_current": lambda t, at: census.census_current(t("gold_encounter_fact"), at),
    "gold_ed_forecast_features": lambda t, at: features.forecast_features(t("gold_ed_hourly_census"), "ED"),
    "gold_icu_forecast_features": lambda t, at: features.forecast_features(t("gold_icu_hourly_census"), "ICU"),
    "gold_combined_forecast_features": lambda t, at: features.combined_features(
        t("gold_ed_hourly_census"), t("gold_icu_hourly_census")
    ),
    "gold_forecast_accuracy": lambda t, at: forecast_accuracy(t("gold_forecast_predictions")),
}

# Time column the rows of a big table are sorted by inside each file.
SORTED = {
    name: ("created_at",)
    for name in (
        "gold_encounter_fact",
        "gold_observation_fact",
        "gold_diagnosis_fact",
        "gold_allergy_fact",
        "gold_order_fact",
    )
}


def refresh_gold(
    spark: SparkSession, silver: str, gold: str, only: list[str] | None = None, as_of=None
) -> list[str]:
    """Recompute gold tables from the segment tables; returns those written.

    Each table is written beside its old version, which readers have until the new one is whole.
    ``plans.increment`` takes only what is new. ``as_of`` stands in for the clock.

    ``gold_forecast_accuracy`` needs predictions and is left out until there are
    some.
    """

    def table(name: str) -> DataFrame:
        return read_ingested(spark, silver, name) if name.startswith("silver_") else read_gold(spark, gold, name)

    written = []
    for name, build in GOLD.items():
        if only and name not in only:
            continue
        if name == "gold_forecast_accuracy":
            if table_exists(spark, f"{gold}/gold_forecast_predictions"):
                refresh_accuracy(spark, gold)
                written.append(name)
            continue
        write_version(build(table, as_of), f"{gold}/{name}", sort_by=SORTED.get(name, ()))
        written.append(name)
    return written
