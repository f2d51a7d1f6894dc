"""The pipeline's tables over the feed, stored as they are needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed
from checks.oracle import AS_OF
from wardflow.operators import forecast
from wardflow.operators.messages import message_time, messages, parse_messages, stamp, with_headers
from wardflow.operators.segments import segment_table
from wardflow.plans.forecast import backfill
from wardflow.plans.gold import GOLD, refresh_gold
from wardflow.plans.status import MONITORED
from wardflow.sources.predictions import PREDICTIONS, append_predictions, read_gold
from wardflow.streaming.ingest import ingest_batch, read_ingested


# Short names of the gold tables, which the shipped jobs write.
TABLES = {
    "encounters": "gold_encounter_fact",
    "observations": "gold_observation_fact",
    "diagnoses": "gold_diagnosis_fact",
    "allergies": "gold_allergy_fact",
    "orders": "gold_order_fact",
    "patients": "gold_patient_dim",
    "metrics": "gold_message_metrics",
    "activity": "gold_patient_activity",
    "ed_hour": "gold_ed_hourly_census",
    "icu_hour": "gold_icu_hourly_census",
    "ed_day": "gold_ed_daily_summary",
    "icu_day": "gold_icu_daily_summary",
    "current": "gold_department_census_current",
    "ed_feat": "gold_ed_forecast_features",
    "icu_feat": "gold_icu_forecast_features",
    "combined": "gold_combined_forecast_features",
    "predictions": PREDICTIONS,
    "accuracy": "gold_forecast_accuracy",
}
# Gold tables that other gold tables are made of.
_CENSUS = ["gold_ed_hourly_census", "gold_icu_hourly_census"]
NEEDS = {
    **{f"gold_{d}_{t}": ["gold_encounter_fact"] for d in ("ed", "icu") for t in ("hourly_census", "daily_summary")},
    "gold_patient_activity": ["gold_encounter_fact"],
    "gold_department_census_current": ["gold_encounter_fact"],
    "gold_ed_forecast_features": _CENSUS[:1],
    "gold_icu_forecast_features": _CENSUS[1:],
    "gold_combined_forecast_features": _CENSUS,
    PREDICTIONS: _CENSUS,
    "gold_forecast_accuracy": [PREDICTIONS],
}
_LAKES: dict[tuple[str, str], str] = {}
_READY: set[tuple[str, str]] = set()


def lake(spark: SparkSession, sf_dir: str, tables=tuple(TABLES.values())) -> str:
    """The folder where the jobs run over the feed: ``silver`` and ``gold``.

    The ingest runs once per session, and so does the refresh of each gold table
    that is asked for.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        path = feed.new_path(spark, "lake")
        folder = feed.landing_drops(spark, sf_dir)
        ingest_batch(spark, folder, f"{path}/silver", message_time(), glob="*.txt", recursive=True)
        _LAKES[key] = path
    path = _LAKES[key]
    for table in tables:
        if table.startswith("gold_") and (path, table) not in _READY:
            lake(spark, sf_dir, NEEDS.get(table, ()))
            if table == PREDICTIONS:
                append_predictions(Context(spark, sf_dir).open_predictions, f"{path}/gold")
                backfill(spark, f"{path}/gold")
            else:
                refresh_gold(spark, f"{path}/silver", f"{path}/gold", [table], F.lit(AS_OF).cast("timestamp"))
            _READY.add((path, table))
    return path


class Context:
    """The pipeline's tables for one session and data folder.

    An attribute such as ``c.encounters`` or ``c.silver_pv1`` is the table that the
    shipped jobs wrote, run once per session; ``c.make("encounters")`` computes it
    anew from the tables before it. All times come from the messages.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def make(self, name: str) -> DataFrame:
        if name.startswith("silver_"):
            return self.segment(name.removeprefix("silver_").upper())
        if name == "predictions":
            return forecast.backfill_actuals(self.open_predictions, self.ed_hour, self.icu_hour)
        return GOLD[TABLES[name]](self.stored, self.as_of)

    def stored(self, table: str) -> DataFrame:
        """A table by its full name, as the jobs wrote it."""
        path = lake(self.spark, self.sf_dir, (table,))
        if table.startswith("silver_"):
            return read_ingested(self.spark, f"{path}/silver", table)
        return read_gold(self.spark, f"{path}/gold", table)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and not name.startswith("silver_"):
            raise AttributeError(name)
        return self.stored(TABLES.get(name, name))

    @property
    def open_predictions(self) -> DataFrame:
        """The predictions before any actual is known."""
        return feed.landed(
            self.spark, self.sf_dir, "open_predictions", lambda spark, sf_dir: Context(spark, sf_dir).naive_predictions()
        )

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("timestamp")

    @property
    def files(self) -> DataFrame:
        return feed.landed_files(self.spark, self.sf_dir)

    @property
    def messages(self) -> DataFrame:
        return stamp(feed.feed_messages(self.spark, self.sf_dir), message_time())

    @property
    def split(self) -> DataFrame:
        return messages(self.files)

    @property
    def parsed(self) -> DataFrame:
        return parse_messages(feed.feed_messages(self.spark, self.sf_dir), message_time())

    @property
    def headed(self) -> DataFrame:
        return with_headers(self.messages)

    def segment(self, kind: str, **kw) -> DataFrame:
        return segment_table(self.headed, kind, **kw)

    def _predicted(self, points: DataFrame, model: str) -> DataFrame:
        config = next(m for m in forecast.MODELS if m.name == model)
        ident = F.md5(
            F.concat_ws(
                "|",
                F.lit(model),
                "location_facility",
                F.date_format("feature_snapshot_hour", "yyyyMMddHH"),
                F.col("forecast_horizon_hours").cast("string"),
                F.col("n_a").cast("string"),
                F.col("n_d").cast("string"),
            )
        )
        run = F.col("feature_snapshot_hour")
        return forecast.prediction_rows(forecast.expand_horizons(points), config, "1", run, ident)

    def naive_predictions(self) -> DataFrame:
        """One point per census hour: a naive forecast from the last day's mean."""

        def dept(table, value):
            return table.select(
                F.col("event_hour").alias("feature_snapshot_hour"),
                F.coalesce("location_facility", F.lit("None")).alias("location_facility"),
                F.expr(value).alias("prediction"),
                F.coalesce("arrivals_std_24h", F.lit(0.0)).alias("spread"),
                F.col("arrivals").alias("n_a"),
                F.col("discharges").alias("n_d"),
            )

        system = self.combined.select(
            F.col("event_hour").alias("feature_snapshot_hour"),
            F.lit("ALL").alias("location_facility"),
            (F.col("ed_arrivals_rolling_24h") / 25.0).alias("prediction"),
            F.lit(1.5).alias("spread"),
            F.col("total_arrivals").alias("n_a"),
            F.col("total_discharges").alias("n_d"),
        )
        rows = self._predicted(dept(self.ed_feat, "arrivals_avg_24h"), "ed_arrivals_forecast")
        for points, model in (
            (dept(self.ed_feat, "discharges_avg_24h"), "ed_discharges_forecast"),
            (dept(self.icu_feat, "arrivals_avg_24h - 0.75D"), "icu_arrivals_forecast"),
            (system, "combined_arrivals_forecast"),
        ):
            rows = rows.unionByName(self._predicted(points, model))
        return rows

    @property
    def adt(self) -> DataFrame:
        """ADT events as one flat source, from the message header and visit."""
        visit = self.segment("PV1", wide=True)
        return visit.select(
            F.col("parsed_at").alias("event_time_stamp"),
            "message_type",
            F.col("trigger_event").alias("message_event_type"),
            "patient_class",
            F.col("location_point_of_care").alias("department"),
            F.col("location_facility").alias("facility"),
            "sending_facility",
            "admission_type",
            "financial_class",
            "discharge_disposition",
            F.col("patient_id").alias("patient_mrn"),
        )

    @property
    def gold(self) -> dict[str, DataFrame]:
        return {table: self.stored(table) for _, _, table, _, _ in MONITORED}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so results do not depend on who reads them."""
    return df.select(
        *[
            F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(f"`{n}`")
            for n, kind in df.dtypes
        ]
    )
