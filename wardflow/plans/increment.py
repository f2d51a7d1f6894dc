"""Gold tables kept up to date from the ingest batches that are new to them.

Every table records the batches that it has taken, in the same step that shows its new rows
(``sources.versions``), so each one moves on by itself, exactly once per batch, and a refresh that
died is simply run again. Rows may arrive late and for any day:

* facts are added to, by day;
* message metrics and patient activity are counted anew for the days that the new rows touch,
  from the silver folders of those days alone;
* hourly and current census are sums, so the new rows' counts are added to the stored ones, and only
  the touched days are written;
* daily summaries hold medians and distinct counts: encounters are kept by the day they count
  for, and the touched days are summarized again;
* the patient dimension is a stored state per patient, in ``BUCKETS`` buckets, merged with that of
  the new rows;
* features are computed from the first touched hour on, behind the rows that their windows reach
  back to, with the running census carried on from the stored table.

Tables are refreshed side by side, each after those it reads. After any sequence of refreshes each
table equals a full one. Days and batches that are new pass
through the driver as names; no rows do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import census, facts, features
from wardflow.session import at_once, compiled_methods
from wardflow.sources.versions import in_parts, is_versioned, part_names, read_version, state, taken_batches, write_version
from wardflow.streaming.ingest import batch_states, read_days

#: Parts of the patient dimension.
BUCKETS = 64
#: Days before a touched one in which the rows that windows reach back to are looked for first.
HALO_DAYS = 30
STATE, VISITS = "gold_patient_state", "gold_encounter_days"
DAY, BUCKET = "day", "bucket"


class Shared:
    """Values that steps of one refresh ask for with the same key, made by the first of them."""

    def __init__(self):
        self._guard, self._locks, self._values = Lock(), {}, {}

    def get(self, key, make: Callable[[], object]):
        with self._guard:
            lock = self._locks.setdefault(key, Lock())
        with lock:
            if key not in self._values:
                self._values[key] = make()
            return self._values[key]


@dataclass
class Refresh:
    """The refresh of one table: where things are and which batches are new to it."""

    spark: SparkSession
    silver: str
    gold: str
    name: str
    new: list[str]
    as_of: object = None
    shared: Shared = field(default_factory=Shared)

    def once(self, what: str, make: Callable[[], object]):
        """A value that depends on the new batches alone; tables to which the same ones are new share it."""
        return self.shared.get((what, *self.new), make)

    def rows(self, kind: str) -> DataFrame:
        """The new rows of a segment, with the day of their folder."""
        return read_days(self.spark, self.silver, kind, self.new)

    def rows_of(self, kind: str, days: list[str]) -> DataFrame:
        """All rows of a segment for some days."""
        return read_days(self.spark, self.silver, kind).where(in_parts(DAY, days))

    def table(self, name: str | None = None) -> DataFrame | None:
        """A gold table with its partition column, if there is one yet."""
        path = f"{self.gold}/{name or self.name}"
        return read_version(self.spark, path, keep_part=True) if is_versioned(self.spark, path) else None

    def write(self, df: DataFrame, by: str | None = DAY, **how) -> None:
        write_version(df, f"{self.gold}/{self.name}", by, batches=self.new, **how)


def _fact(kind: str, build: Callable[[DataFrame], DataFrame]):
    def run(r: Refresh) -> None:
        rows = build(r.rows(kind)).withColumn(DAY, F.to_date("created_at"))
        r.write(rows, add=True, sort_by=("created_at",))

    return run


def _counted_anew(kind: str, build: Callable[[DataFrame], DataFrame], day: Callable[[], Column]):
    """Tables whose days depend on the silver rows of the same day alone."""

    def run(r: Refresh) -> None:
        days = part_names(r.rows(kind), DAY)
        table = build(r.rows_of(kind, days))
        r.write(table.withColumn(DAY, day()).repartition(DAY), replaced=days)

    return run


def _hourly(dept: str):
    def run(r: Refresh) -> None:
        new = census.hourly_census(facts.encounter_fact(r.rows("PV1")), dept).withColumn(DAY, F.to_date("event_hour"))
        new = new.persist()  # a row per hour and facility
        try:
            days, old = part_names(new, DAY), r.table()
            whole = new if old is None else census.merged_hours(new, old.where(in_parts(DAY, days)))
            r.write(whole.withColumn(DAY, F.to_date("event_hour")).repartition(DAY), replaced=days)
        finally:
            new.unpersist()

    return run


def _current(r: Refresh) -> None:
    new = census.census_current(facts.encounter_fact(r.rows("PV1")), r.as_of)
    old = r.table()
    r.write(new if old is None else census.merged_current(new, old, as_of=r.as_of), by=None)


def _visits_by_day(r: Refresh) -> None:
    rows = facts.encounter_fact(r.rows("PV1")).select(
        "patient_id", "patient_class", "location_facility", "location_point_of_care", "location_bed", "hospital_service",
        "attending_doctor_id", "admit_datetime", "discharge_datetime", "trigger_event", "created_at",
    )
    r.write(rows.withColumn(DAY, census.activity_day()), add=True)


def _daily(build: Callable[[DataFrame], DataFrame]):
    def run(r: Refresh) -> None:
        visits = facts.encounter_fact(r.rows("PV1")).select(census.activity_day().alias(DAY))
        days = r.once("activity days", lambda: part_names(visits, DAY))
        table = build(r.table(VISITS).where(in_parts(DAY, days)))
        r.write(table.withColumn(DAY, F.col("activity_date")).repartition(DAY), replaced=days)

    return run


def _bucket() -> Column:
    return F.pmod(F.xxhash64("patient_id", "patient_id_authority"), F.lit(BUCKETS)).cast("int")


def _patient_state(r: Refresh) -> None:
    new, old = facts.patient_states(r.rows("PID")).withColumn(BUCKET, _bucket()), r.table()
    # A patient's bucket is told by the rows themselves, before their states are made.
    touched = r.once("buckets", lambda: part_names(r.rows("PID").select(_bucket().alias(BUCKET)), BUCKET))
    if old is not None:
        new = new.unionByName(old.where(in_parts(BUCKET, touched)))
    merged = facts.merged_patients(new.drop(BUCKET)).withColumn(BUCKET, _bucket())
    r.write(merged.repartition(BUCKET), by=BUCKET, replaced=touched)


def _patient_dim(r: Refresh) -> None:
    touched = r.once("buckets", lambda: part_names(r.rows("PID").select(_bucket().alias(BUCKET)), BUCKET))
    states = r.table(STATE).where(in_parts(BUCKET, touched)).drop(BUCKET)
    r.write(facts.patient_rows(states).withColumn(BUCKET, _bucket()).repartition(BUCKET), by=BUCKET, replaced=touched)


def _first_day(r: Refresh):
    """The first day whose census the new rows may change."""
    visits = facts.encounter_fact(r.rows("PV1"))
    days = visits.select(F.explode(census.move_days()).alias(DAY))
    return r.once("first day", lambda: days.agg(F.min(DAY)).first()[0])


def _from_day(r: Refresh, day) -> list[str]:
    """The stored days from ``day`` on, which the new rows replace."""
    return [p for p in state(r.spark, f"{r.gold}/{r.name}").folders if p >= str(day)]


def _recent(before: DataFrame, fresh: DataFrame, by: list[str], day, rows_back: int) -> DataFrame:
    """The rows of a feature table from before ``day`` that hold all its windows can reach.

    The last ``HALO_DAYS`` days are read; earlier ones only for groups that have fewer than
    ``rows_back`` rows in them.
    """
    floor = F.date_sub(F.lit(day), HALO_DAYS)
    near = before.where((F.col(DAY) >= floor) & (F.col(DAY) < F.lit(day)))
    counts = near.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")) if by else near.agg(F.count(F.lit(1)).alias("__n"))
    far = before.where(F.col(DAY) < floor)
    if not by:
        enough = counts.first()[0] >= rows_back
        return near if enough else near.unionByName(far)
    key = [F.coalesce(F.col(c), F.lit("")).alias(f"__{c}") for c in by] + [F.col(c).isNull().alias(f"__{c}_null") for c in by]
    names = [f"__{c}" for c in by] + [f"__{c}_null" for c in by]
    short = fresh.select(*key).distinct().join(counts.where(F.col("__n") >= rows_back).select(*key), names, "left_anti")
    return near.unionByName(far.select("*", *key).join(short, names, "left_semi").drop(*names))


def _features(dept: str):
    source = f"gold_{dept.lower()}_hourly_census"

    def run(r: Refresh) -> None:
        hourly, before, day = r.table(source), r.table(), _first_day(r)
        if before is None or day is None:
            rows = features.forecast_features(hourly.drop(DAY), dept)
            r.write(rows.withColumn(DAY, F.to_date("event_hour")).repartition(DAY))
            return
        start = F.lit(day).cast("timestamp")
        fresh = hourly.where(F.col(DAY) >= F.lit(day))
        past = _recent(before, fresh, ["location_facility"], day, features.ROWS_BACK)
        rows = features.forecast_features(features.with_history(fresh, past, start), dept)
        rows = rows.where(F.col("event_hour") >= start).withColumn(DAY, F.to_date("event_hour"))
        r.write(rows.repartition(DAY), replaced=_from_day(r, day))

    return run


def _system_features(r: Refresh) -> None:
    sides = [r.table(f"gold_{d}_hourly_census") for d in ("ed", "icu")]
    before, day = r.table(), _first_day(r)
    if before is None or day is None:
        rows = features.combined_features(*[s.drop(DAY) for s in sides])
        r.write(rows.withColumn(DAY, F.to_date("event_hour")).repartition(DAY))
        return
    start = F.lit(day).cast("timestamp")
    hours = features.system_hours(*[s.where(F.col(DAY) >= F.lit(day)).drop(DAY) for s in sides])
    past = _recent(before, hours, [], day, features.DAY_BACK)
    past = features.halo(past, [], start, features.DAY_BACK, features.DAY_BACK).select(*hours.columns)
    rows = features.system_features(past.unionByName(hours)).where(F.col("event_hour") >= start)
    r.write(rows.withColumn(DAY, F.to_date("event_hour")).repartition(DAY), replaced=_from_day(r, day))


def _activity(pv1: DataFrame) -> DataFrame:
    return facts.patient_activity(facts.encounter_fact(pv1))


# Each table after those it reads.
STEPS: dict[str, Callable[[Refresh], None]] = {
    STATE: _patient_state,
    "gold_patient_dim": _patient_dim,
    "gold_encounter_fact": _fact("PV1", facts.encounter_fact),
    "gold_observation_fact": _fact("OBX", facts.observation_fact),
    "gold_diagnosis_fact": _fact("DG1", facts.diagnosis_fact),
    "gold_allergy_fact": _fact("AL1", facts.allergy_fact),
    "gold_order_fact": _fact("OBR", facts.order_fact),
    "gold_message_metrics": _counted_anew("MSH", facts.message_metrics, lambda: F.to_date("processing_hour")),
    "gold_patient_activity": _counted_anew("PV1", _activity, lambda: F.col("activity_date")),
    "gold_ed_hourly_census": _hourly("ED"),
    "gold_icu_hourly_census": _hourly("ICU"),
    VISITS: _visits_by_day,
    "gold_ed_daily_summary": _daily(census.ed_daily_summary),
    "gold_icu_daily_summary": _daily(census.icu_daily_summary),
    "gold_department_census_current": _current,
    "gold_ed_forecast_features": _features("ED"),
    "gold_icu_forecast_features": _features("ICU"),
    "gold_combined_forecast_features": _system_features,
}
# What must have taken the same batches before.
NEEDS = {
    "gold_patient_dim": [STATE],
    "gold_ed_daily_summary": [VISITS],
    "gold_icu_daily_summary": [VISITS],
    "gold_ed_forecast_features": ["gold_ed_hourly_census"],
    "gold_icu_forecast_features": ["gold_icu_hourly_census"],
    "gold_combined_forecast_features": ["gold_ed_hourly_census", "gold_icu_hourly_census"],
}


def finished_batches(spark: SparkSession, silver: str) -> DataFrame:
    """The finished batches of the ingest, as names that the driver holds."""
    names = [(r["batch"],) for r in batch_states(spark, silver).where("finished").collect()]
    return spark.createDataFrame(names, "batch string")


def new_batches(spark: SparkSession, finished: DataFrame, gold: str, table: str) -> list[str]:
    """Of finished ingest batches, those that a gold table has not taken."""
    left = finished.join(taken_batches(spark, f"{gold}/{table}"), "batch", "left_anti")
    return sorted(r["batch"] for r in left.collect())


def refresh_increment(
    spark: SparkSession, silver: str, gold: str, only: list[str] | None = None, as_of=None
) -> dict[str, list[str]]:
    """Bring gold tables up to the finished batches of the ingest; returns what each one took.

    ``only`` names tables; those they read are refreshed with them. ``as_of`` stands in for the
    clock. Keep a folder to one kind of refresh: a table that ``refresh_gold`` wrote is refused.
    """
    wanted = set(only or STEPS) | {n for t in only or () for n in NEEDS.get(t, ())}
    # Asked once for all tables: batches that finish meanwhile are new to none of them.
    finished = finished_batches(spark, silver)
    names = [name for name in STEPS if name in wanted]
    new = at_once(spark, {name: partial(new_batches, spark, finished, gold, name) for name in names})
    shared = Shared()
    steps = {n: partial(STEPS[n], Refresh(spark, silver, gold, n, new[n], as_of, shared)) for n in names if new[n]}
    with compiled_methods(spark):
        at_once(spark, steps, NEEDS)
    return {name: new[name] for name in steps}
