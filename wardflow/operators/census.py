"""Emergency and intensive-care census from encounters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.values import hl7_ts, when_run


@dataclass(frozen=True)
class Moves:
    """Trigger events that count as arrival and as discharge."""

    arrive: tuple[str, ...]
    leave: tuple[str, ...]


# Which trigger events count where. A transfer (A02) is an hourly
# ED arrival but no daily one, and both an arrival and a discharge for the ICU.
HOURLY = {"ED": Moves(("A01", "A04", "A02"), ("A03",)), "ICU": Moves(("A01", "A02"), ("A03", "A02"))}
DAILY = {"ED": Moves(("A01", "A04"), ("A03",)), "ICU": Moves(("A01", "A02"), ("A03", "A02"))}
CURRENT = Moves(("A01", "A04", "A02"), ("A03",))

# Text that marks a department.
ED_POINTS = ("ED", "ER", "EMER")
ICU_SERVICES = ("ICU", "CCU", "MICU", "SICU", "NICU", "PICU")


def department() -> Column:
    """ED before ICU before OTHER, from class, point of care and service."""
    point = F.upper(F.coalesce("location_point_of_care", F.lit("")))
    emergency = F.col("patient_class") == "E"
    for mark in ED_POINTS:
        emergency = emergency | point.contains(mark)
    service = F.upper(F.coalesce("hospital_service", F.lit("")))
    intensive = point.contains("ICU") | service.isin(*ICU_SERVICES)
    return F.when(emergency, "ED").when(intensive, "ICU").otherwise("OTHER")


def classify_department(df: DataFrame) -> DataFrame:
    return df.withColumn("department", department())


def _event_hour(text: str) -> Column:
    return F.date_trunc("hour", F.coalesce(hl7_ts(text), F.col("created_at")))


def calendar(hour: str = "event_hour") -> dict[str, Column]:
    day = F.dayofweek(hour)
    return {
        "hour_of_day": F.hour(hour),
        "day_of_week": day,
        "is_weekend": day.isin(1, 7).cast("int"),
    }


def hourly_census(encounters: DataFrame, dept: str) -> DataFrame:
    """Arrivals, discharges and net change per hour and facility.

    One scan and one shuffle: an encounter turns into the one or two moves it
    stands for, and the counts are summed per task before they travel. Arrivals
    and discharges meet on facility and an unknown one matches nothing, so there
    they stay two rows (``__side``).
    """
    moves = HOURLY[dept]
    arrived = F.when(
        F.col("trigger_event").isin(*moves.arrive),
        F.struct(_event_hour("admit_datetime").alias("event_hour"), F.lit(1).alias("a"), F.lit(0).alias("d")),
    )
    left = F.when(
        F.col("trigger_event").isin(*moves.leave),
        F.struct(_event_hour("discharge_datetime").alias("event_hour"), F.lit(0).alias("a"), F.lit(1).alias("d")),
    )
    each = (
        encounters.where(
            (department() == dept) & F.col("trigger_event").isin(*{*moves.arrive, *moves.leave})
        )
        .select("location_facility", F.explode(F.array(arrived, left)).alias("m"))
        .where("m IS NOT NULL")
        .select("location_facility", "m.*")
    )
    return _hour_rows(each)


def merged_hours(*parts: DataFrame) -> DataFrame:
    """Hourly census tables of separate encounters as one: counts of an hour and facility add up."""
    moves = [p.select("event_hour", "location_facility", F.col("arrivals").alias("a"), F.col("discharges").alias("d")) for p in parts]
    return _hour_rows(reduce(DataFrame.unionByName, moves))


def _hour_rows(moves: DataFrame) -> DataFrame:
    """Census rows from counts; arrivals and discharges of an unknown facility stay two rows."""
    counted = moves.groupBy(
        "event_hour",
        "location_facility",
        F.when(F.col("location_facility").isNull(), F.col("a") > 0).alias("__side"),
    ).agg(F.sum("a").alias("arrivals"), F.sum("d").alias("discharges"))
    return counted.select(
        "event_hour",
        "location_facility",
        "arrivals",
        "discharges",
        (F.col("arrivals") - F.col("discharges")).alias("net_change"),
        *[c.alias(n) for n, c in calendar().items()],
    )


def ed_hourly_census(encounters: DataFrame) -> DataFrame:
    return hourly_census(encounters, "ED")


def icu_hourly_census(encounters: DataFrame) -> DataFrame:
    return hourly_census(encounters, "ICU")


def _daily(encounters: DataFrame, dept: str, unit: str, seconds: int, extra: list[Column]) -> DataFrame:
    """Daily volume, length of stay and peak hour per facility.

    The mean stay is a sum of whole seconds over their count, so it does not
    depend on the order in which tasks finish.
    """
    moves = DAILY[dept]
    admit, discharge = hl7_ts("admit_datetime"), hl7_ts("discharge_datetime")
    came = F.coalesce("admit_ts", "created_at")
    rows = (
        encounters.where(department() == dept)
        .withColumns({"admit_ts": admit, "discharge_ts": discharge})
        .select(
            "*",
            F.to_date(came).alias("activity_date"),
            F.hour(came).alias("admit_hour"),
            (F.unix_timestamp("discharge_ts") - F.unix_timestamp("admit_ts")).alias("stay"),
        )
    )
    stay = F.col("stay") / seconds
    trigger = F.col("trigger_event")
    return rows.groupBy("activity_date", "location_facility").agg(
        F.count("*").alias("total_encounters"),
        F.count_if(trigger.isin(*moves.arrive)).alias("total_arrivals"),
        F.count_if(trigger.isin(*moves.leave)).alias("total_discharges"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.round(F.try_divide(F.sum("stay"), F.count("stay")) / seconds, 1).alias(f"avg_los_{unit}"),
        F.round(F.percentile_approx(stay, 0.5), 1).alias(f"median_los_{unit}"),
        F.max(stay).alias(f"max_los_{unit}"),
        F.mode("admit_hour", True).alias("peak_arrival_hour"),
        F.count_distinct("attending_doctor_id").alias("unique_providers"),
        *extra,
    )


def ed_daily_summary(encounters: DataFrame) -> DataFrame:
    return _daily(encounters, "ED", "minutes", 60, [])


def icu_daily_summary(encounters: DataFrame) -> DataFrame:
    beds = F.count_distinct("location_bed").alias("beds_used")
    return _daily(encounters, "ICU", "hours", 3600, [beds])


def activity_day() -> Column:
    """The day that an encounter counts for in the daily summaries."""
    return F.to_date(F.coalesce(hl7_ts("admit_datetime"), "created_at"))


def move_days() -> Column:
    """The days whose hourly census an encounter may change."""
    return F.array(*[F.to_date(_event_hour(c)) for c in ("admit_datetime", "discharge_datetime")])


def census_current(encounters: DataFrame, as_of=None) -> DataFrame:
    """Arrivals less discharges so far, per facility and department."""
    arrived = F.col("trigger_event").isin(*CURRENT.arrive)
    moved = encounters.where(F.col("trigger_event").isin(*CURRENT.arrive, *CURRENT.leave))
    moves = classify_department(moved).select(
        "location_facility", "department", arrived.cast("long").alias("a"), (~arrived).cast("long").alias("d")
    )
    return _current_rows(moves, as_of)


def merged_current(*parts: DataFrame, as_of=None) -> DataFrame:
    """Current census tables of separate encounters as one, for the moment ``as_of``."""
    names = {"total_arrivals": "a", "total_discharges": "d"}
    moves = [p.select("location_facility", "department", *[F.col(n).alias(c) for n, c in names.items()]) for p in parts]
    return _current_rows(reduce(DataFrame.unionByName, moves), as_of)


def _current_rows(moves: DataFrame, as_of) -> DataFrame:
    counted = moves.groupBy(
        "location_facility",
        "department",
        F.when(F.col("location_facility").isNull(), F.col("a") > 0).alias("__side"),
    ).agg(F.sum("a").alias("total_arrivals"), F.sum("d").alias("total_discharges"))
    return counted.select(
        "location_facility",
        "department",
        "total_arrivals",
        "total_discharges",
        (F.col("total_arrivals") - F.col("total_discharges")).alias("estimated_census"),
        when_run(as_of).alias("snapshot_at"),
    )


def merge_counts(a: DataFrame, b: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Full-outer match of two count tables; a missing count is 0.

    For counts that come from different sources. NULL keys match nothing.
    """
    both = a.join(b, keys, "full_outer")
    return both.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
