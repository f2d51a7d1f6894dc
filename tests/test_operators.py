"""Census, features, quality and table operators on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.operators import census, features, quality
from wardflow.operators.filters import date_range, search, subset
from wardflow.operators.segments import segment_table
from wardflow.plans import reports, status
from wardflow.sources import tables as store

ENC = (
    "patient_id string, patient_class string, location_point_of_care string, hospital_service string, "
    "location_facility string, location_bed string, attending_doctor_id string, trigger_event string, "
    "admit_datetime string, discharge_datetime string, created_at timestamp"
)
T0 = datetime(2024, 1, 6, 5, 30)


def encounters(spark, *rows):
    base = dict(
        patient_id="p", patient_class="I", location_point_of_care=None, hospital_service=None, location_facility="H",
        location_bed="b", attending_doctor_id="d", trigger_event="A01", admit_datetime=None, discharge_datetime=None, created_at=T0,
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], ENC)


@pytest.mark.parametrize(
    "row, dept",
    [
        (dict(patient_class="E"), "ED"),
        (dict(location_point_of_care="MED"), "ED"),
        (dict(location_point_of_care="SURGERY"), "ED"),
        (dict(location_point_of_care="emer"), "ED"),
        (dict(location_point_of_care="CCU", hospital_service="MED"), "OTHER"),
        (dict(hospital_service="ccu"), "ICU"),
        (dict(location_point_of_care="micu 2"), "ICU"),
        (dict(patient_class="E", location_point_of_care="ICU"), "ED"),
        (dict(patient_class=None), "OTHER"),
    ],
)
def test_department(spark, row, dept):
    assert census.classify_department(encounters(spark, row)).first()["department"] == dept


def test_hourly_census(spark):
    ed = dict(patient_class="E")
    icu = dict(hospital_service="ICU")
    rows = [
        {**ed, "trigger_event": "A01", "admit_datetime": "20240106071500"},
        {**ed, "trigger_event": "A02", "admit_datetime": "202401060759"},
        {**ed, "trigger_event": "A04"},
        {**ed, "trigger_event": "A03", "discharge_datetime": "20240106072000"},
        {**ed, "trigger_event": "A08"},
        {**ed, "trigger_event": "A01", "location_facility": None, "admit_datetime": "2024010607"},
        {**ed, "trigger_event": "A03", "location_facility": None},
        {**icu, "trigger_event": "A02", "admit_datetime": "20240106090000", "discharge_datetime": "20240106110000"},
        {**icu, "trigger_event": "A04"},
    ]
    df = encounters(spark, *rows)
    got = {
        (r["event_hour"].hour, r["location_facility"], r["arrivals"], r["discharges"], r["net_change"])
        for r in census.ed_hourly_census(df).collect()
    }
    assert got == {(7, "H", 2, 1, 1), (5, "H", 1, 0, 1), (5, None, 1, 0, 1), (5, None, 0, 1, -1)}
    got = {(r["event_hour"].hour, r["arrivals"], r["discharges"]) for r in census.icu_hourly_census(df).collect()}
    assert got == {(9, 1, 0), (11, 0, 1)}
    weekend = census.ed_hourly_census(df).first()
    assert (weekend["day_of_week"], weekend["is_weekend"]) == (7, 1)


def test_daily_summary(spark):
    stay = lambda h, **kw: dict(
        hospital_service="ICU", admit_datetime="20240106050000", discharge_datetime=f"202401{6 + h // 24:02d}{5 + h % 24:02d}0000", **kw
    )
    df = encounters(spark, stay(1, trigger_event="A02"), stay(2, trigger_event="A03", patient_id="q"), stay(24, location_bed="c"), dict(hospital_service="ICU"))
    row = census.icu_daily_summary(df).first()
    assert (row["total_encounters"], row["total_arrivals"], row["total_discharges"]) == (4, 3, 2)
    assert (row["avg_los_hours"], row["median_los_hours"], row["max_los_hours"]) == (9.0, 2.0, 24.0)
    assert (row["unique_patients"], row["beds_used"], row["peak_arrival_hour"]) == (2, 2, 5)


def test_census_counts_in_one_shuffle(spark):
    df = encounters(spark, dict(patient_class="E"))
    plan = census.ed_hourly_census(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def hourly(spark, rows):
    kind = "event_hour timestamp, location_facility string, arrivals long, discharges long, net_change long"
    df = spark.createDataFrame([(t, f, a, d, a - d) for t, f, a, d in rows], kind)
    return df.withColumns(census.calendar())


def test_features_over_missing_hours(spark):
    start = datetime(2024, 1, 1)
    hours = [0, 1, 2, 6, 7, 12, 13]
    df = hourly(spark, [(start + timedelta(hours=h), "A", h + 1, 1) for h in hours] + [(start, "B", 5, 0)])
    rows = features.forecast_features(df, "ED").where("location_facility = 'A'").orderBy("event_hour").collect()
    assert [r["arrivals_lag_1h"] for r in rows] == [None, 1, 2, 3, 7, 8, 13]
    assert [r["arrivals_rolling_6h"] for r in rows] == [1, 3, 6, 13, 20, 28, 35]
    assert rows[0]["arrivals_std_24h"] is None and rows[1]["arrivals_std_24h"] == 0.71
    assert [r["cumulative_net_census"] for r in rows] == [0, 1, 3, 9, 16, 28, 41]
    assert all(r["arrivals_wow_ratio"] is None and r["department"] == "ED" for r in rows)
    plan = features.forecast_features(df, "ED")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_week_over_week(spark):
    start = datetime(2024, 1, 1)
    df = hourly(spark, [(start + timedelta(hours=h), "A", 0 if h == 1 else 2 + h % 3, 0) for h in range(171)])
    rows = features.forecast_features(df, "ED").orderBy("event_hour").collect()
    assert rows[167]["arrivals_wow_ratio"] is None and rows[168]["arrivals_wow_ratio"] == 1.0
    assert rows[169]["arrivals_lag_168h"] == 0 and rows[169]["arrivals_wow_ratio"] is None
    assert rows[170]["arrivals_rolling_7d"] == sum(2 + h % 3 for h in range(2, 171))


def test_holidays(spark):
    days = [datetime(2024, 12, 24), datetime(2024, 1, 1), datetime(2024, 7, 4), datetime(2024, 11, 28), datetime(2024, 11, 27), datetime(2024, 5, 1, 19)]
    df = hourly(spark, [(d, "A", 1, 0) for d in days]).withColumns(features.calendar_features())
    found = {r["event_hour"]: (r["is_holiday_window"], r["is_night_shift"]) for r in df.collect()}
    assert [found[d] for d in days] == [(1, 1), (1, 1), (1, 1), (1, 1), (0, 1), (0, 1)]


def test_combined_features_fill_missing_sides(spark):
    t = datetime(2024, 1, 1)
    ed = hourly(spark, [(t, "A", 3, 1), (t, "B", 1, 0)])
    icu = hourly(spark, [(t, "A", 2, 2), (t + timedelta(hours=1), "A", 0, 1)])
    a, b = features.combined_features(ed, icu).orderBy("event_hour").collect()
    assert (a["ed_arrivals"], a["icu_arrivals"], a["ed_to_icu_ratio"], a["total_discharges"]) == (4, 2, 2.0, 3)
    assert (b["ed_arrivals"], b["ed_to_icu_ratio"], b["net_system_pressure"]) == (0, None, -1)
    assert (b["ed_arrivals_lag_1h"], b["ed_arrivals_rolling_24h"]) == (4, 4)


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, o int")
    latest = features.dedup_by_key(df, ["k"], "o")
    assert sorted(map(tuple, latest.collect())) == [("a", 3), ("b", 2)]
    assert sorted(map(tuple, features.dedup_by_key(df, ["k"], "o", ascending=True).collect())) == [("a", 1), ("b", 2)]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


# rule -> (passing, failing, null) value of its column
RULE_ROWS = {
    "msh_message_type_not_null": ("message_type", "ADT", None, None),
    "msh_control_id_not_null": ("message_control_id", "1", None, None),
    "msh_sending_facility_not_null": ("sending_facility", "F", None, None),
    "msh_valid_version": ("version_id", "2.5", "3.0", None),
    "msh_datetime_not_future": ("message_datetime", "20240101", "20990101", None),
    "pid_patient_id_not_null": ("patient_id", "p", "", None),
    "pid_patient_name_not_null": ("patient_name_family", "Doe", None, None),
    "pid_valid_sex": ("sex", "F", "X", None),
    "pid_dob_not_future": ("date_of_birth", "19800101", "20990101", None),
    "pid_dob_reasonable": ("date_of_birth", "19800101", "18000101", None),
    "pid_valid_zip_format": ("address_zip", "73301-1234", "733", None),
    "pv1_patient_class_not_null": ("patient_class", "I", None, None),
    "pv1_valid_patient_class": ("patient_class", "B", "Z", None),
    "pv1_admit_before_discharge": ("admit_datetime", "20240101", "20240301", None),
    "pv1_admit_not_future": ("admit_datetime", "20240101", "20990101", None),
    "obx_observation_id_not_null": ("observation_id", "G", "", None),
    "obx_value_type_not_null": ("value_type", "NM", None, None),
    "obx_valid_value_type": ("value_type", "CWE", "QQ", None),
    "obx_numeric_has_units": ("value_type", "ST", "NM", None),
    "obx_valid_result_status": ("result_status", "F", "Q", None),
    "dg1_code_not_null": ("diagnosis_code", "I10", "", None),
    "dg1_valid_coding_system": ("diagnosis_coding_system", "ICD10", None, None),
    "dg1_icd10_format": ("diagnosis_code", "R07.9", "401.9", None),
}
OTHERS = {
    "pid_patient_name_not_null": {"patient_name_given": None},
    "pv1_admit_before_discharge": {"discharge_datetime": "20240201"},
    "obx_numeric_has_units": {"units": None},
    "dg1_icd10_format": {"diagnosis_coding_system": "ICD10"},
}


def test_every_rule(spark):
    catalog = {r.name: r for rules in quality.RULES.values() for r in rules}
    assert set(catalog) == set(RULE_ROWS) and len(catalog) == 23
    for name, (col, good, bad, null) in RULE_ROWS.items():
        rule, other = catalog[name], OTHERS.get(name, {})
        kind = ", ".join(f"{c} string" for c in [col, *other])
        df = spark.createDataFrame([(x, *other.values()) for x in (good, bad, null)], kind)
        good_rows, bad_rows = quality.quarantine(df, [rule])
        kept = [r[col] for r in good_rows.collect()]
        assert good in kept and (bad is None or bad not in kept), name
        null_kept = bad is not None and rule.action == quality.WARN
        assert (None in kept) == null_kept, name
        assert all(r["failed_rules"] == [name] for r in bad_rows.collect())


def test_broken_rows_are_found_before_their_columns_are_cut(spark):
    drops = [r for r in quality.PIPELINE_RULES["OBX"] if r.action == quality.DROP]
    text = "MSH|^~\\&|A|F|||20240115||ORU^R01|1|P|2.5\rOBX|1|NM|GLU||95\rOBX|2|NM|||5\rOBX|3||^a||7\rOBX|4||K"
    df = spark.createDataFrame([("m", text, T0)], "message_id string, raw_message string, parsed_at timestamp")
    rows = segment_table(df, "OBX", rule=False)
    found = quality.broken(rows, drops)
    assert sorted(r["set_id"] for r in found.collect()) == [2, 3]
    assert quality.quarantine(found, drops)[1].collect() == quality.quarantine(rows, drops)[1].collect()
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    held, cut = (next(i for i, line in enumerate(plan) if text in line) for text in ("Filter", "AS observation_value"))
    assert cut < held  # a plan is printed from its end


def test_rules_observe_drop_and_fail(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("", None)], "observation_id string, value_type string")
    kept, seen = quality.apply_rules(df, quality.PIPELINE_RULES["OBX"])
    assert kept.count() == 1
    assert seen.get == {"rows": 3, "obx_observation_id_not_null": 2, "obx_value_type_present": 1}
    strict = [quality.Rule("has_id", "", "observation_id IS NOT NULL", quality.FAIL)]
    with pytest.raises(Exception, match="has_id"):
        quality.apply_rules(df, strict)[0].collect()
    assert len(quality.rules_by(action=quality.DROP)) == 5 and len(quality.rules_by(tag="temporal")) == 5
    assert list(quality.as_expectations(strict)) == ["has_id"]
    report = {r["rule"]: (r["rows_checked"], r["failures"]) for r in quality.rule_report(df, quality.PIPELINE_RULES["OBX"]).collect()}
    assert report["obx_observation_id_not_null"] == (3, 2)


def test_filters(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 23, 59), "Ann"), (datetime(2024, 1, 6), "bob")], "t timestamp, n string")
    assert date_range(df, "t", "2024-01-05", "2024-01-05").count() == 1
    assert search(df, "n", "ANN").count() == 1 and subset(df, "n", []).count() == 2


def test_slo_tiers(spark):
    df = spark.createDataFrame([(1.0, 36), (36.0, 36), (72.0, 36), (72.1, 36), (None, 36), (5.0, None)], "age double, goal int")
    got = [r[0] for r in df.select(status.slo_tier(F.col("age"), F.col("goal"))).collect()]
    assert got == ["ok", "ok", "stale", "critical", None, "no SLO"]


def test_status_board_with_missing_and_empty_tables(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    some = spark.createDataFrame([(datetime(2024, 1, 1),)], "created_at timestamp")
    none = spark.createDataFrame([], "last_message_at timestamp")
    board = status.status_board({"gold_encounter_fact": some, "gold_message_metrics": none}, now)
    got = {r["table_name"]: r["status"] for r in board.collect()}
    assert len(got) == 11 and got["gold_encounter_fact"] == "ok" and got["gold_message_metrics"] == "empty"
    assert got["gold_patient_dim"] == "missing"
    assert status.is_stale(none.withColumn("x", F.lit(1)), 36, now).first()["should_alert"] == 1.0


def test_hourly_kpis_take_the_first_peak(spark):
    t = datetime(2024, 1, 1)
    df = hourly(spark, [(t + timedelta(hours=h), "A", a, 0) for h, a in enumerate([1, 5, 5])])
    assert reports.hourly_kpis(df).first()["peak_hour"] == t + timedelta(hours=1)


def test_update_and_changes(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "id int, s string, x double")
    new = spark.createDataFrame([(2, "b", None), (3, "d", 3.0), (4, "e", None)], "id int, s string, x double")
    got = {(r["change_type"], r["id"], r["s"]) for r in store.snapshot_changes(old, new, ["id"]).collect()}
    assert got == {("delete", 1, "a"), ("update", 3, "d"), ("insert", 4, "e")}
    updated = store.update_by_key(old, new.where("id > 2"), "id", ["x"]).orderBy("id")
    assert [tuple(r) for r in updated.collect()] == [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)]


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.5, 3), (None, 4)], "x double, i int")
    big = df.withColumn("d", (F.lit("9223372036854775807").cast("decimal(20,0)") + F.col("i") - 2))
    rows = store.sanitize(big).orderBy("i").collect()
    assert [r["x"] for r in rows] == [None, None, 1.5, None]
    assert [r["d"] is None for r in rows] == [False, False, True, True]
