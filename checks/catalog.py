"""Every registered query with its checking SQL, by inventory id.

An entry is ``name: (frame from a Context, SQL or None)``. SQL names the tables of
:mod:`checks.oracle`; None leaves a query to the test suite.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import feed
from checks.context import TABLES, Context, lake
from checks.oracle import AS_OF, NOW, mean, n, predicted, rnd
from wardflow.functions import values as v
from wardflow.functions.sqlfuncs import register_sql_functions
from wardflow.functions.text import field, first_segment
from wardflow.operators import census, codes, features, filters, forecast, quality
from wardflow.operators import messages as msgs
from wardflow.operators.report import message_report
from wardflow.operators.segments import SILVER
from wardflow.plans import adt, reports, status
from wardflow.plans.forecast import FEATURE_TABLES, METADATA, RUNS, backfill, predict_all, refresh_accuracy, train_all
from wardflow.plans.increment import refresh_increment
from wardflow.sources import tables as store
from wardflow.sources.bus import messages_from
from wardflow.sources.files import read_files, read_line_messages
from wardflow.sources.changes import publish_version, read_changes, replay
from wardflow.sources.predictions import PREDICTIONS, append_predictions, read_predictions
from wardflow.sources.publish import SERVING_KEYS, key_report, publish_all
from wardflow.sources.versions import write_version
from wardflow.streaming.ingest import (
    FILES,
    LINES,
    MESSAGES,
    ingest_batch,
    read_ingested,
    read_quarantine,
    read_silver,
    read_violations,
    start_ingest,
)

Entry = tuple[Callable[[Context], DataFrame], str | None]
QUERIES: dict[str, Entry] = {}


def q(name: str, build: Callable[[Context], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = (build, sql)


BIG = lambda x: f"CAST({x} AS BIGINT)"
INT = lambda x: f"CAST({x} AS INTEGER)"
SUM = lambda x: BIG(f"sum({x})")

# --- messages -----------------------------------------------------------------

_file_no = "CAST(floor(event_id / 50) AS BIGINT)"
_file_cols = (
    f"'file-' || CAST({_file_no} AS VARCHAR) AS file_id, "
    f"'feed/' || CAST({_file_no} AS VARCHAR) || '.hl7' AS source_file, "
    f"{INT(f'count(*) OVER (PARTITION BY {_file_no})')} AS file_message_count, "
    f"max(t) OVER (PARTITION BY {_file_no}) AS file_modification_time"
)
_split = ["message_id", "raw_message", "file_id", "source_file", "file_message_count", "file_modification_time"]

q(
    "M1_split_files",
    lambda c: c.files.select("file_id", F.posexplode(msgs.split_messages("raw_content")).alias("pos", "raw_message")),
    f"SELECT 'file-' || CAST({_file_no} AS VARCHAR) AS file_id, {INT('event_id % 50')} AS pos, "
    "rtrim(raw_message, chr(13)) AS raw_message FROM msg",
)
q(
    "M2_messages",
    lambda c: c.split.select(*_split),
    f"SELECT md5(rtrim(raw_message, chr(13))) AS message_id, rtrim(raw_message, chr(13)) AS raw_message, {_file_cols} FROM msg",
)
q(
    "M3_start_rule",
    lambda c: quality.apply_rules(c.split, quality.PIPELINE_RULES["messages"])[0].groupBy("file_id").agg(F.count("*").alias("n")),
    f"SELECT 'file-' || CAST({_file_no} AS VARCHAR) AS file_id, count(*) AS n FROM msg GROUP BY 1",
)


def _m4(c):
    hl7 = F.col("hl7")
    msh, pid, pv1 = (first_segment(hl7, k) for k in ("MSH", "PID", "PV1"))
    return c.parsed.select(
        "message_id",
        F.size(hl7).alias("segment_types"),
        field(msh, 1).alias("separator"),
        field(msh, 2).alias("encoding"),
        field(msh, 9, 2).alias("trigger"),
        field(pid, 3, rep=1).alias("second_id"),
        field(pid, 5, 1, 2).alias("name_prefix"),
        field(pid, 19).alias("absent_field"),
        field(pv1, 3, 3).alias("bed"),
        F.coalesce(F.size(F.col("hl7")["OBX"]), F.lit(0)).alias("observations"),
        "parsed_at",
    )


q(
    "M4_parsed_map",
    _m4,
    "SELECT message_id, CAST(2 + CAST(NOT oru AS INT) * 2 + CAST(has_pid AS INT) + CAST(n_nk1 > 0 AS INT) + "
    "CAST(n_al1 > 0 AS INT) + CAST(n_dg1 > 0 AS INT) + CAST(n_in1 > 0 AS INT) + CAST(n_orc > 0 AS INT) + "
    "CAST(n_obr > 0 AS INT) + CAST(n_obx > 0 AS INT) AS INTEGER) AS segment_types, '|' AS separator, "
    "'^~' || chr(92) || '&' AS encoding, trig AS trigger, "
    "CASE WHEN has_pid THEN 'ALT' || CAST(user_id AS VARCHAR) END AS second_id, "
    "CASE WHEN has_pid THEN 'VAN' END AS name_prefix, CAST(NULL AS VARCHAR) AS absent_field, "
    f"CASE WHEN NOT oru THEN bed END AS bed, {INT('n_obx')} AS observations, parsed_at FROM msg",
)


def _m5(c):
    exploded = msgs.explode_segment(c.parsed.select("message_id", F.col("hl7")["OBX"].alias("obx")), "obx", "seg")
    return exploded.select(
        "message_id",
        F.col("seg.index").alias("set_id"),
        field(F.col("seg"), 2).alias("value_type"),
        field(F.col("seg"), 3, 2).alias("observation_text"),
        field(F.col("seg"), 5).alias("observation_value"),
        field(F.col("seg"), 40).alias("absent"),
    )


_obx_i = lambda col: n("(" + feed.OBX[col].format(i="i") + ")")
q(
    "M5_M7_field_accessor_explode_outer",
    _m5,
    f"SELECT message_id, {INT('i + 1')} AS set_id, {_obx_i('value_type')} AS value_type, "
    f"{_obx_i('observation_text')} AS observation_text, {_obx_i('observation_value')} AS observation_value, "
    "CAST(NULL AS VARCHAR) AS absent FROM msg, (VALUES (0), (1), (2)) AS r(i) WHERE i < n_obx UNION ALL "
    "SELECT message_id, NULL, NULL, NULL, NULL, NULL FROM msg WHERE n_obx = 0",
)
_lines = "string_split(rtrim(raw_message, chr(13)), chr(13))"
_known = "('MSH', 'PID', 'PV1', 'OBR', 'OBX', 'DG1', 'IN1', 'NK1', 'EVN', 'ORC')"
q(
    "M6_M10_segment_rows",
    lambda c: msgs.segments(c.messages.select("message_id", "raw_message")),
    f"SELECT message_id, {INT('i - 1')} AS seq, CASE WHEN substring(raw, 1, 3) IN {_known} THEN substring(raw, 1, 3) "
    f"ELSE 'OTHER' END AS segment_type, substring(raw, 1, 3) AS segment_code, raw, {INT('n_lines')} AS segment_count, "
    "mtype AS message_type, ctl AS message_control_id, sfac AS sending_facility, CAST(NULL AS VARCHAR) AS error "
    f"FROM (SELECT *, unnest({_lines}) AS raw, unnest(range(1, len({_lines}) + 1)) AS i, len({_lines}) AS n_lines FROM msg)",
)
q(
    "M8_timestamp",
    lambda c: c.silver_pv1.select("message_id", v.hl7_ts("admit_datetime").alias("admit"), v.hl7_ts("discharge_datetime").alias("discharge")),
    "SELECT message_id, admit_at AS admit, discharge_at AS discharge FROM t_pv1",
)
q(
    "M9_timestamp_text",
    lambda c: c.silver_pv1.select(
        "message_id",
        v.hl7_ts_text("admit_datetime").alias("plain"),
        v.hl7_ts_text(F.concat("admit_datetime", F.lit("-0500"))).alias("zoned"),
        v.hl7_ts_text(F.concat("admit_datetime", F.lit("12+01"))).alias("padded"),
    ),
    "SELECT message_id, CASE WHEN admit_datetime = 'N/A' THEN 'N/A' ELSE strftime(admit_at, '%Y-%m-%dT%H:%M:%S') END AS plain, "
    "CASE WHEN admit_datetime = 'N/A' THEN 'N/A' ELSE strftime(admit_at, '%Y-%m-%dT%H:%M:%S') END AS zoned, "
    "CASE WHEN admit_datetime = 'N/A' THEN 'N/A12' WHEN length(admit_datetime) = 12 THEN "
    "strftime(admit_at + INTERVAL 12 SECOND, '%Y-%m-%dT%H:%M:%S') ELSE strftime(admit_at, '%Y-%m-%dT%H:%M:%S') END AS padded FROM t_pv1",
)

# --- segment tables -----------------------------------------------------------

q(
    "G1_hl7_parsed",
    lambda c: c.headed,
    "SELECT message_id, raw_message, parsed_at, message_type, trigger_event, sending_facility, "
    f"{n('ctl')} AS message_control_id, pat_any AS patient_id FROM (SELECT *, CASE WHEN has_pid THEN {n('pid')} END AS pat_any FROM msg)",
)
for _id, _kind, _table in (
    ("G2", "MSH", "t_msh"),
    ("G3", "PID", "t_pid"),
    ("G5", "EVN", "t_evn"),
    ("G6", "OBR", "t_obr"),
    ("G7", "OBX", "t_obx"),
    ("G8", "DG1", "t_dg1"),
    ("G9", "AL1", "t_al1"),
    ("G10", "IN1", "t_in1"),
    ("G11", "NK1", "t_nk1"),
    ("G12", "ORC", "t_orc"),
):
    q(f"{_id}_{_kind.lower()}", lambda c, k=_kind: c.segment(k), f"SELECT * FROM {_table}")
q("G4_pv1", lambda c: c.make("silver_pv1"), "SELECT * EXCLUDE (admit_at, discharge_at, fin, dispo) FROM t_pv1")
q(
    "G13_wide_pid",
    lambda c: c.segment("PID", wide=True).select(
        "message_id", "set_id", "patient_id_external", "patient_name_suffix", "address_country", "language", "ssn", "ethnicity"
    ),
    "SELECT message_id, '1' AS set_id, 'EXT' || CAST(user_id AS VARCHAR) AS patient_id_external, 'JR' AS patient_name_suffix, "
    "'USA' AS address_country, 'EN' AS language, CAST(NULL AS VARCHAR) AS ssn, 'H' AS ethnicity FROM msg WHERE has_pid AND pid <> ''",
)
q(
    "G13_wide_pv1",
    lambda c: c.segment("PV1", wide=True).select(
        "message_id", "set_id", "financial_class", "discharge_disposition", "attending_doctor_family", "attending_doctor_given", "vip_indicator"
    ),
    f"SELECT message_id, '1' AS set_id, {n('fin')} AS financial_class, {n('dispo')} AS discharge_disposition, "
    f"doc_fam AS attending_doctor_family, {n('doc_giv')} AS attending_doctor_given, CAST(NULL AS VARCHAR) AS vip_indicator FROM msg WHERE NOT oru",
)
q(
    "G13_wide_repeats",
    lambda c: c.segment("OBR", wide=True)
    .select("message_id", "set_id", F.lit("OBR").alias("kind"), F.col("ordering_provider_family").alias("value"))
    .unionByName(c.segment("OBX", wide=True).select("message_id", "set_id", F.lit("OBX").alias("kind"), F.col("probability").alias("value")))
    .unionByName(c.segment("DG1", wide=True).select("message_id", "set_id", F.lit("DG1").alias("kind"), F.col("diagnosing_clinician").alias("value")))
    .unionByName(c.segment("IN1", wide=True).select("message_id", "set_id", F.lit("IN1").alias("kind"), F.col("insured_dob").alias("value"))),
    "SELECT message_id, set_id, 'OBR' AS kind, ordering_provider_family AS value FROM t_obr0 UNION ALL "
    "SELECT message_id, set_id, 'OBX', NULL FROM t_obx UNION ALL SELECT message_id, set_id, 'DG1', NULL FROM t_dg1 UNION ALL "
    "SELECT message_id, set_id, 'IN1', NULL FROM t_in1",
)

# --- quality ------------------------------------------------------------------

_zip_ok = "regexp_matches(address_zip, '^[0-9]{5}(-[0-9]{4})?$')"
_icd_ok = r"regexp_matches(diagnosis_code, '^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$')"
_codes_in = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs.split()) + ")"
# rule -> condition under which it fails, over the segment before its drop rule
FAILS = {
    "MSH": (
        "raw_msh",
        {
            "msh_message_type_not_null": "FALSE",
            "msh_control_id_not_null": "message_control_id IS NULL",
            "msh_sending_facility_not_null": "sending_facility IS NULL",
            "msh_valid_version": "version_id NOT LIKE '2.%'",
            "msh_datetime_not_future": f"parsed_at > {NOW}",
        },
    ),
    "PID": (
        "raw_pid",
        {
            "pid_patient_id_not_null": "patient_id IS NULL",
            "pid_patient_name_not_null": "FALSE",
            "pid_valid_sex": "sex = 'X'",
            "pid_dob_not_future": f"strptime(date_of_birth, '%Y%m%d') > CAST({NOW} AS DATE)",
            "pid_dob_reasonable": f"strptime(date_of_birth, '%Y%m%d') < CAST({NOW} AS DATE) - 54750",
            "pid_valid_zip_format": f"NOT {_zip_ok}",
        },
    ),
    "PV1": (
        "t_pv1",
        {
            "pv1_patient_class_not_null": "patient_class IS NULL",
            "pv1_valid_patient_class": "patient_class = 'Z'",
            "pv1_admit_before_discharge": "admit_at > discharge_at",
            "pv1_admit_not_future": f"admit_at > {NOW}",
        },
    ),
    "OBX": (
        "raw_obx",
        {
            "obx_observation_id_not_null": "observation_id IS NULL",
            "obx_value_type_not_null": "value_type IS NULL",
            "obx_valid_value_type": "FALSE",
            "obx_numeric_has_units": "value_type = 'NM' AND units IS NULL",
            "obx_valid_result_status": "result_status NOT IN " + _codes_in("C D F I N O P R S U W X"),
        },
    ),
    "DG1": (
        "raw_dg1",
        {
            "dg1_code_not_null": "diagnosis_code IS NULL",
            "dg1_valid_coding_system": "diagnosis_coding_system IS NULL",
            "dg1_icd10_format": f"diagnosis_coding_system = 'ICD10' AND NOT {_icd_ok}",
        },
    ),
}


def _rejects(c, kind):
    return c.segment(kind, rule=False)


def _all_reports(c):
    return message_report(c.messages, {kind: quality.rules_for(kind, AS_OF) for kind in FAILS})


def _one_report(c):
    return quality.rule_report(_rejects(c, "OBX"), quality.rules_for("OBX", AS_OF), "OBX")


_action = {r.name: r.action for rules in quality.RULES.values() for r in rules}


def _report_sql(kinds):
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS segment, '{rule}' AS rule, '{_action[rule]}' AS action, count(*) AS rows_checked, "
        f"count(*) FILTER ({fails}) AS failures, count(*) FILTER ({fails}) / count(*)::DOUBLE AS failure_rate FROM {FAILS[kind][0]}"
        for kind in kinds
        for rule, fails in FAILS[kind][1].items()
    )


q("Q2_Q9_rule_report", _all_reports, _report_sql(FAILS))
q("Q9_table_report", _one_report, _report_sql(["OBX"]))
q(
    "Q3_expect_warn",
    lambda c: quality.apply_rules(c.silver_pv1, quality.rules_for("PV1", AS_OF))[0],
    "SELECT * EXCLUDE (admit_at, discharge_at, fin, dispo) FROM t_pv1",
)
q(
    "Q4_expect_or_drop",
    lambda c: quality.apply_rules(_rejects(c, "OBX"), quality.PIPELINE_RULES["OBX"])[0],
    "SELECT * FROM t_obx",
)
_code_present = quality.Rule("code_present", "", "diagnosis_code IS NOT NULL", quality.FAIL)


def _fails_on_bad_rows(c):
    """Rows of the clean table, and whether the same rule stops on the table with bad rows."""
    good = quality.apply_rules(c.silver_dg1, [_code_present])[0].groupBy("diagnosis_code").agg(F.count("*").alias("n"))
    try:
        quality.apply_rules(_rejects(c, "DG1"), [_code_present])[0].write.format("noop").mode("overwrite").save()
        stopped = False
    except Exception as err:
        stopped = "code_present" in str(err)
    return good.withColumn("stopped_on_bad_rows", F.lit(stopped))


q(
    "Q5_expect_or_fail",
    _fails_on_bad_rows,
    "SELECT diagnosis_code, count(*) AS n, (SELECT count(*) FROM raw_dg1 WHERE diagnosis_code IS NULL) > 0 AS stopped_on_bad_rows "
    "FROM t_dg1 GROUP BY 1",
)
q(
    "Q6_Q7_rules_by_action_as_expectations",
    lambda c: quality.apply_rules(
        _rejects(c, "PID"),
        [
            quality.Rule(name, "", text, quality.DROP)
            for name, text in quality.as_expectations(
                [r for r in quality.rules_by(action=quality.DROP, tag="required") if r.name.startswith("pid")]
            ).items()
        ],
    )[0],
    "SELECT * FROM t_pid",
)
q(
    "Q8_quarantine_good",
    lambda c: quality.quarantine(_rejects(c, "DG1"), quality.rules_for("DG1"))[0],
    f"SELECT * FROM raw_dg1 WHERE diagnosis_code IS NOT NULL AND diagnosis_coding_system IS NOT NULL "
    f"AND NOT (diagnosis_coding_system = 'ICD10' AND NOT {_icd_ok})",
)
q(
    "Q8_quarantine_bad",
    lambda c: quality.quarantine(_rejects(c, "DG1"), quality.rules_for("DG1"))[1].withColumn(
        "failed_rules", F.concat_ws(",", "failed_rules")
    ),
    "SELECT * FROM (SELECT *, concat_ws(',', CASE WHEN diagnosis_code IS NULL THEN 'dg1_code_not_null' END, "
    "CASE WHEN diagnosis_coding_system IS NULL THEN 'dg1_valid_coding_system' END, "
    f"CASE WHEN diagnosis_coding_system = 'ICD10' AND NOT {_icd_ok} THEN 'dg1_icd10_format' END) AS failed_rules FROM raw_dg1) "
    "WHERE failed_rules <> ''",
)

# --- projections and filters --------------------------------------------------

q(
    "P1_P2_project_present",
    lambda c: c.silver_al1.select("message_id", F.col("allergen_code").alias("code"), "set_id"),
    "SELECT message_id, allergen_code AS code, set_id FROM t_al1",
)
q(
    "P3_subset",
    lambda c: filters.subset(filters.subset(c.orders, "priority", ["S", "R"]), "result_status", []),
    "SELECT * FROM ord WHERE priority IN ('S', 'R')",
)
q(
    "P4_facility_subset",
    lambda c: filters.facility_subset(c.ed_hour, ["HOSPITAL_A"]),
    "SELECT * FROM ed_hour WHERE location_facility = 'HOSPITAL_A'",
)
q(
    "P5_date_range",
    lambda c: filters.date_range(c.ed_hour, "event_hour", "2024-01-05", "2024-01-09"),
    "SELECT * FROM ed_hour WHERE CAST(event_hour AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'",
)
q(
    "P6_day_kind",
    lambda c: filters.day_kind(c.ed_hour, "Weekends"),
    "SELECT * FROM ed_hour WHERE is_weekend = 1",
)
q(
    "P7_since",
    lambda c: filters.since(c.encounters, "created_at", "72 hours", c.as_of),
    f"SELECT * FROM enc WHERE created_at >= {NOW} - INTERVAL 72 HOUR",
)
q(
    "P8_search",
    lambda c: filters.search(c.orders, "ordering_provider_name", "Doc1"),
    "SELECT * FROM ord WHERE lower(ordering_provider_name) LIKE '%doc1%'",
)
q(
    "P9_label_blank",
    lambda c: c.encounters.select("encounter_key", v.label_blank("admission_type", "(null)").alias("admission_type")),
    "SELECT encounter_key, coalesce(nullif(trim(admission_type), ''), '(null)') AS admission_type FROM enc",
)
q(
    "P10_classify_department",
    lambda c: census.classify_department(c.encounters).select("encounter_key", "department"),
    "SELECT encounter_key, department FROM enc_all",
)
_shift = "CASE WHEN hour_of_day BETWEEN 7 AND 18 THEN 'Day Shift' ELSE 'Night Shift' END AS shift_type"
_dtype = "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type"
q(
    "P11_shift_labels",
    lambda c: filters.shift_labels(c.icu_hour),
    f"SELECT *, {_dtype}, {_shift} FROM icu_hour",
)
q(
    "P12_metadata",
    lambda c: filters.with_metadata(c.silver_evn, "0123456789abcdef", c.as_of),
    f"SELECT *, {NOW} AS processed_at, CAST({NOW} AS DATE) AS processing_date, '01234567' AS pipeline_id FROM t_evn",
)
q(
    "P13_fill_zero",
    lambda c: c.ed_feat.na.fill(0).select("event_hour", "location_facility", "arrivals", "discharges", "arrivals_lag_168h", "arrivals_std_24h"),
    "SELECT event_hour, location_facility, arrivals, discharges, coalesce(arrivals_lag_168h, 0) AS arrivals_lag_168h, "
    "coalesce(arrivals_std_24h, 0) AS arrivals_std_24h FROM ed_feat",
)
q("P14_severe_only", lambda c: filters.subset(c.allergies, "is_severe", [True]), "SELECT * FROM alg WHERE is_severe")

# --- joins --------------------------------------------------------------------


def _counts(c, events, ts, name):
    hour = F.date_trunc("hour", F.coalesce(v.hl7_ts(ts), F.col("created_at"))).alias("event_hour")
    return (
        census.classify_department(c.encounters)
        .where((F.col("department") == "ED") & F.col("trigger_event").isin(*events))
        .groupBy(hour, "location_facility")
        .agg(F.count("*").alias(name))
    )


q(
    "J1_merge_counts_hour_facility",
    lambda c: census.merge_counts(
        _counts(c, ["A01", "A04", "A02"], "admit_datetime", "arrivals"),
        _counts(c, ["A03"], "discharge_datetime", "discharges"),
        ["event_hour", "location_facility"],
        ["arrivals", "discharges"],
    ),
    "SELECT event_hour, location_facility, arrivals, discharges FROM ed_hour",
)


def _moves(c, events, name):
    return (
        census.classify_department(c.encounters)
        .where(F.col("trigger_event").isin(*events))
        .groupBy("location_facility", "department")
        .agg(F.count("*").alias(name))
    )


q(
    "J2_merge_counts_facility_department",
    lambda c: census.merge_counts(
        _moves(c, ["A01", "A04", "A02"], "total_arrivals"),
        _moves(c, ["A03"], "total_discharges"),
        ["location_facility", "department"],
        ["total_arrivals", "total_discharges"],
    ),
    "SELECT location_facility, department, total_arrivals, total_discharges FROM cur",
)
_side_cols = ["event_hour", "ed_arrivals", "ed_discharges", "ed_net_change", "icu_arrivals", "icu_discharges", "icu_net_change"]
q("J3_combined_hours", lambda c: c.make("combined").select(*_side_cols), f"SELECT {', '.join(_side_cols)} FROM comb")
q(
    "J4_combined_actuals",
    lambda c: forecast.combined_actuals(c.ed_hour, c.icu_hour),
    "SELECT * FROM actuals WHERE department = 'ALL'",
)
q(
    "J5_match_actuals",
    lambda c: forecast.match_actuals(
        c.open_predictions.select("prediction_id", "target_hour", "department"), forecast.hourly_actuals(c.ed_hour, c.icu_hour)
    ),
    "SELECT p.prediction_id, p.target_hour, p.department, a.actual_arrivals, a.actual_discharges FROM pred_open p "
    "LEFT JOIN actuals a ON date_trunc('hour', p.target_hour) = a.event_hour AND p.department = a.department",
)
q(
    "J6_daily_comparison",
    lambda c: reports.daily_comparison(c.ed_day, c.icu_day),
    "SELECT activity_date, "
    + ", ".join(f"{BIG(f'coalesce({d}_{x}, 0)')} AS {d}_{x}" for d in ("ed", "icu") for x in ("arrivals", "discharges"))
    + " FROM (SELECT activity_date, sum(total_arrivals) AS ed_arrivals, sum(total_discharges) AS ed_discharges FROM ed_day GROUP BY 1) "
    "FULL OUTER JOIN (SELECT activity_date, sum(total_arrivals) AS icu_arrivals, sum(total_discharges) AS icu_discharges FROM icu_day "
    "GROUP BY 1) USING (activity_date)",
)
q("J7_S10_update_by_key", lambda c: c.make("predictions"), "SELECT * FROM pred")

# --- dimension, facts and rollups ----------------------------------------------

q("K1_encounter_fact", lambda c: c.make("encounters"), "SELECT * FROM enc")
q("K2_observation_fact", lambda c: c.make("observations"), "SELECT * FROM obs")
q("K3_diagnosis_fact", lambda c: c.make("diagnoses"), "SELECT * FROM dx")
q("K4_allergy_fact", lambda c: c.make("allergies"), "SELECT * FROM alg")
q("K5_order_fact", lambda c: c.make("orders"), "SELECT * FROM ord")
q("A1_patient_dim", lambda c: c.make("patients"), "SELECT * FROM dim")
q("A2_message_metrics", lambda c: c.make("metrics"), "SELECT * FROM metrics")
q("A3_patient_activity", lambda c: c.make("activity"), "SELECT * FROM activity")
q("A4_ed_hourly_census", lambda c: c.make("ed_hour"), "SELECT * FROM ed_hour")
q("A5_icu_hourly_census", lambda c: c.make("icu_hour"), "SELECT * FROM icu_hour")
q("A6_ed_daily_summary", lambda c: c.make("ed_day"), "SELECT * FROM ed_day")
q("A7_icu_daily_summary", lambda c: c.make("icu_day"), "SELECT * FROM icu_day")
q("A8_department_census_current", lambda c: c.make("current"), "SELECT * FROM cur")
q("A9_F12_forecast_accuracy", lambda c: c.make("accuracy"), "SELECT * FROM acc")
_hours = lambda src, d: (
    f"SELECT event_hour, {SUM('arrivals')} AS {d}_arrivals, {SUM('discharges')} AS {d}_discharges, {SUM('net_change')} AS {d}_net_change FROM {src} GROUP BY 1"
)
q(
    "A10_hour_totals",
    lambda c: features.hour_totals(c.ed_hour, "ed"),
    _hours("ed_hour", "ed"),
)
q("A11_U3_hourly_actuals", lambda c: forecast.hourly_actuals(c.ed_hour, c.icu_hour), "SELECT * FROM actuals")
_raw_pct = "CASE WHEN actual_value > 0 THEN abs(predicted_value - actual_value) / actual_value * 100 END"
q(
    "A12_prediction_summary",
    lambda c: forecast.prediction_summary(c.predictions),
    "SELECT model_name, department, target_metric, forecast_horizon_hours, count(*) AS prediction_count, "
    f"{rnd(mean('predicted_value'), 2)} AS avg_predicted, {rnd(mean('actual_value'), 2)} AS avg_actual, "
    f"{rnd(mean('absolute_error'), 2)} AS avg_error, {rnd(mean(_raw_pct), 1)} AS mape_pct FROM pred GROUP BY ALL",
)
q(
    "A13_encounter_trend",
    lambda c: reports.encounter_trend(c.encounters),
    "SELECT CAST(created_at AS DATE) AS encounter_date, patient_class_desc, count(*) AS encounter_count FROM enc GROUP BY ALL",
)
_acc_sum = (
    "SELECT model_name, department, target_metric, forecast_horizon_hours, count(*) AS total_periods, "
    f"{rnd(mean('mae'), 2)} AS avg_mae, {rnd(mean('mape'), 1)} AS avg_mape_pct, "
    f"{rnd(mean('coverage_pct'), 1)} AS avg_coverage_pct, {SUM('prediction_count')} AS total_predictions FROM acc GROUP BY ALL"
)
q("A14_accuracy_summary", lambda c: reports.accuracy_summary(c.accuracy), _acc_sum)
q("A15_demographics", lambda c: reports.demographics(c.patients), "SELECT sex, count(*) AS patient_count FROM dim GROUP BY 1")
q(
    "A16_patient_counts",
    lambda c: reports.patient_counts(c.patients),
    "SELECT count(*) AS total_patients, count(DISTINCT address_state) AS states_represented, "
    "count(DISTINCT source_system) AS source_systems FROM dim",
)
_dx_keys = "diagnosis_code, diagnosis_description, diagnosis_coding_system"
_dx = (
    f"SELECT {_dx_keys}, count(*) AS diagnosis_count, count(DISTINCT patient_id) AS unique_patients FROM dx GROUP BY ALL "
    "ORDER BY diagnosis_count DESC, diagnosis_code NULLS FIRST, diagnosis_description NULLS FIRST, diagnosis_coding_system NULLS FIRST LIMIT "
)
q("A17_T2_top_diagnoses", lambda c: reports.top_diagnoses(c.diagnoses), _dx + "20")
_obs_sum = (
    "SELECT observation_id, observation_text, value_type, count(*) AS obs_count, count(*) FILTER (is_abnormal) AS abnormal_count, "
    f"{rnd('avg(observation_value_numeric)', 2)} AS avg_value, {rnd('min(observation_value_numeric)', 2)} AS min_value, "
    f"{rnd('max(observation_value_numeric)', 2)} AS max_value FROM obs WHERE observation_id IS NOT NULL GROUP BY ALL "
    "ORDER BY obs_count DESC, observation_id NULLS FIRST, observation_text NULLS FIRST, value_type NULLS FIRST LIMIT 20"
)
q("A18_observation_summary", lambda c: reports.observation_summary(c.observations), _obs_sum)
_abn = rnd("abnormal_count / obs_count * 100", 1)
q(
    "A19_abnormal_rate",
    lambda c: reports.abnormal_rate(reports.observation_summary(c.observations, None)),
    f"SELECT count(*) AS tests_tracked, {SUM('obs_count')} AS total_observations, {rnd(mean(_abn), 1)} AS abnormal_rate_pct FROM ({_obs_sum.removesuffix(' LIMIT 20')})",
)
q(
    "A20_abnormal_flags",
    lambda c: reports.abnormal_flags(c.observations),
    "SELECT abnormal_flags, count(*) AS flag_count FROM obs WHERE abnormal_flags <> '' GROUP BY 1",
)
q(
    "A21_allergy_overview",
    lambda c: reports.allergy_overview(c.allergies),
    "SELECT allergen_description, allergen_type_text, severity_text, is_severe, count(*) AS allergy_count, "
    "count(DISTINCT patient_id) AS unique_patients FROM alg WHERE allergen_description IS NOT NULL GROUP BY ALL "
    "ORDER BY allergy_count DESC, allergen_description, allergen_type_text NULLS FIRST, severity_text NULLS FIRST, is_severe LIMIT 20",
)
q(
    "A22_allergy_severity",
    lambda c: reports.allergy_severity(c.allergies),
    "SELECT coalesce(severity_text, 'Unknown') AS severity, is_severe, allergy_count FROM "
    "(SELECT severity_text, is_severe, count(*) AS allergy_count FROM alg GROUP BY ALL)",
)
q(
    "A23_order_activity",
    lambda c: reports.order_activity(c.orders),
    "SELECT universal_service_text, priority, result_status, count(*) AS order_count, count(DISTINCT patient_id) AS unique_patients "
    "FROM ord WHERE universal_service_text IS NOT NULL GROUP BY ALL ORDER BY order_count DESC, universal_service_text, priority, result_status LIMIT 20",
)
q(
    "A24_provider_volume",
    lambda c: reports.provider_volume(c.orders),
    "SELECT ordering_provider_name, ordering_provider_id, count(*) AS order_count FROM ord WHERE ordering_provider_name <> '' "
    "GROUP BY ALL ORDER BY order_count DESC, ordering_provider_name, ordering_provider_id LIMIT 15",
)
_thru = (
    f"SELECT processing_hour, {SUM('message_count')} AS total_messages, {SUM('unique_messages')} AS total_unique, "
    "count(DISTINCT message_type) AS message_types, count(DISTINCT sending_facility) AS facilities FROM metrics GROUP BY 1"
)
q("A25_throughput", lambda c: reports.throughput(c.metrics), _thru)
q(
    "A26_data_freshness",
    lambda c: status.data_freshness(c.metrics),
    "SELECT max(last_message_at) AS latest_message, max(processing_hour) AS latest_processing_hour, count(*) AS total_metric_rows FROM metrics",
)
_age = f"((epoch_us({NOW}) - epoch_us(latest)) / 3600000000.0::DOUBLE)"
_tier = lambda goal: (
    f"CASE WHEN latest IS NULL THEN NULL WHEN {goal} IS NULL THEN 'no SLO' WHEN {_age} <= {goal} THEN 'ok' "
    f"WHEN {_age} <= {goal} * 2 THEN 'stale' ELSE 'critical' END"
)
_SQL_TABLES = {
    "gold_message_metrics": "metrics",
    "gold_encounter_fact": "enc",
    "gold_patient_dim": "dim",
    "gold_ed_hourly_census": "ed_hour",
    "gold_icu_hourly_census": "icu_hour",
    "gold_department_census_current": "cur",
    "gold_ed_forecast_features": "ed_feat",
    "gold_icu_forecast_features": "icu_feat",
    "gold_combined_forecast_features": "comb",
    "gold_forecast_predictions": "pred",
    "gold_forecast_accuracy": "acc",
}
q(
    "A27_A29_freshness_signals",
    lambda c: status.freshness_signals(c.gold, c.as_of),
    " UNION ALL ".join(
        f"SELECT '{sig}' AS signal, latest, {_tier(goal)} AS tier FROM (SELECT max({col}) AS latest FROM {src})"
        for sig, src, col, goal in (
            ("messages", "metrics", "last_message_at", 36),
            ("encounters", "enc", "created_at", 72),
            ("predictions", "pred", "forecast_generated_at", 48),
        )
    ),
)
_board = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{area}' AS area, '{name}' AS table_name, row_count, latest AS last_activity, "
    f"{rnd(_age, 1)} AS age_hours, CASE WHEN row_count = 0 AND latest IS NULL THEN 'empty' ELSE "
    f"{_tier('CAST(NULL AS INT)' if goal is None else goal)} END AS status FROM "
    f"(SELECT count(*) AS row_count, max(CAST({col} AS TIMESTAMP)) AS latest FROM {_SQL_TABLES[name]})"
    for layer, area, name, col, goal in status.MONITORED
)
q("A28_status_board", lambda c: status.status_board(c.gold, c.as_of), _board)
q(
    "A30_status_counts",
    lambda c: status.status_counts(status.status_board(c.gold, c.as_of)),
    "SELECT count(*) FILTER (status = 'ok') AS tables_ok, count(*) FILTER (status = 'stale') AS tables_stale, "
    f"count(*) FILTER (status = 'critical') AS tables_critical, count(*) AS tables_tracked FROM ({_board})",
)
q(
    "A31_forecast_activity",
    lambda c: reports.forecast_activity(c.predictions, c.as_of),
    f"SELECT max(forecast_generated_at) AS last_run, count(*) FILTER (forecast_generated_at >= {NOW} - INTERVAL 24 HOUR) AS rows_24h, "
    "count(DISTINCT model_name) AS distinct_models FROM pred",
)
q(
    "A32_encounters_since",
    lambda c: reports.encounters_since(c.encounters, "7 days", c.as_of),
    f"SELECT count(*) AS n FROM enc WHERE created_at >= {NOW} - INTERVAL 7 DAY",
)
q(
    "A33_prediction_overview",
    lambda c: reports.prediction_overview(c.predictions),
    "SELECT count(*) AS total_predictions, count(actual_value) AS scored_predictions, max(forecast_generated_at) AS latest_forecast_run FROM pred",
)
q(
    "A34_messages_since",
    lambda c: reports.messages_since(c.metrics, "24 hours", c.as_of),
    f"SELECT {BIG('coalesce(sum(message_count), 0)')} AS messages FROM metrics WHERE processing_hour >= {NOW} - INTERVAL 24 HOUR",
)
q(
    "A35_recent_throughput",
    lambda c: reports.recent_throughput(c.metrics, c.as_of),
    f"SELECT processing_hour, {SUM('message_count')} AS total_messages FROM metrics WHERE processing_hour >= {NOW} - INTERVAL 72 HOUR GROUP BY 1",
)
_daily_enc = f"SELECT CAST(created_at AS DATE) AS d, count(*) AS encounter_count FROM enc WHERE created_at >= {NOW} - INTERVAL 30 DAY GROUP BY 1"
q("A36_daily_encounters", lambda c: reports.daily_encounters(c.encounters, c.as_of), _daily_enc)
q(
    "A37_message_mix",
    lambda c: reports.message_mix(c.metrics),
    "SELECT coalesce(message_type, 'Unknown') AS message_type, coalesce(sending_facility, 'Unknown') AS sending_facility, "
    f"{SUM('message_count')} AS msg_count FROM metrics GROUP BY metrics.message_type, metrics.sending_facility ORDER BY msg_count DESC LIMIT 50",
)
q("A38_census_total", lambda c: reports.census_total(c.current), f"SELECT {SUM('estimated_census')} AS total_census FROM cur")
for _d in ("ED", "ICU"):
    q(
        f"A39_{_d.lower()}_snapshot",
        lambda c, d=_d: reports.census_snapshot(c.current, d),
        f"SELECT {SUM('estimated_census')} AS {_d.lower()}_census, {SUM('total_arrivals')} AS {_d.lower()}_arrivals, "
        f"{SUM('total_discharges')} AS {_d.lower()}_discharges FROM cur WHERE department = '{_d}'",
    )
q(
    "A40_census_share",
    lambda c: reports.census_share(c.current),
    f"SELECT department, {SUM('estimated_census')} AS census FROM cur GROUP BY 1",
)
q(
    "A41_clock_hour_profile",
    lambda c: reports.clock_hour_profile(c.ed_hour, c.icu_hour),
    f"SELECT department, hour_of_day, {rnd('avg(arrivals)', 2)} AS avg_arrivals FROM (SELECT 'ED' AS department, hour_of_day, arrivals "
    "FROM ed_hour UNION ALL SELECT 'ICU', hour_of_day, arrivals FROM icu_hour) GROUP BY ALL",
)

# --- ADT ----------------------------------------------------------------------

_adt_rows = (
    "SELECT parsed_at AS event_time_stamp, CAST(parsed_at AS DATE) AS event_date, strftime(parsed_at, '%Y-%m-%d') AS event_day, "
    f"{INT('hour(parsed_at)')} AS hour_of_day, CASE WHEN dayofweek(parsed_at) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_kind, "
    + ", ".join(
        f"coalesce(nullif(trim({src}), ''), '{adt.BLANK_LABELS[name]}') AS {name}"
        for name, src in {
            "message_event_type": "trigger_event",
            "patient_class": "patient_class",
            "department": "location_point_of_care",
            "facility": "location_facility",
            "sending_facility": "sending_facility",
            "admission_type": "admission_type",
            "financial_class": "fin",
            "discharge_disposition": "dispo",
        }.items()
    )
    + f", patient_id AS patient_mrn, 1 AS row_n, {INT('CASE WHEN trigger_event = ' + chr(39) + 'A01' + chr(39) + ' THEN 1 ELSE 0 END')} AS a01_f "
    f"FROM t_pv1 WHERE message_type = 'ADT' AND parsed_at >= CAST({NOW} AS DATE) - 365"
)
q("A42_adt_rows", lambda c: adt.adt_rows(c.adt, c.as_of), _adt_rows)
q("A43_adt_total", lambda c: adt.adt_total(c.adt, c.as_of), f"SELECT count(*) AS total_events FROM ({_adt_rows})")
q(
    "A44_adt_admissions_today",
    lambda c: adt.adt_admissions_today(c.adt, c.as_of),
    f"SELECT count(*) AS admissions_today FROM t_pv1 WHERE trigger_event = 'A01' AND CAST(parsed_at AS DATE) = CAST({NOW} AS DATE)",
)
q(
    "A45_adt_by_day",
    lambda c: adt.adt_by_day(c.adt, c.as_of),
    f"SELECT event_day, count(*) AS event_count FROM ({_adt_rows}) GROUP BY 1",
)
q(
    "A46_adt_by_trigger",
    lambda c: adt.adt_by_trigger(c.adt, c.as_of),
    f"SELECT message_event_type, count(*) AS event_count FROM ({_adt_rows}) GROUP BY 1",
)
q(
    "A47_adt_kpis",
    lambda c: adt.adt_kpis(adt.adt_rows(c.adt, c.as_of)),
    f"SELECT count(*) AS adt_rows, count(DISTINCT patient_mrn) AS distinct_patients, {SUM('a01_f')} AS a01_count FROM ({_adt_rows})",
)
for _dim in adt.SLICES:
    q(
        f"A48_adt_by_{_dim}",
        lambda c, d=_dim: adt.adt_slice(adt.adt_rows(c.adt, c.as_of), d),
        f"SELECT {_dim}, {SUM('row_n')} AS event_count, {SUM('a01_f')} AS a01_count FROM ({_adt_rows}) GROUP BY 1",
    )

# --- digest and staleness -------------------------------------------------------

q(
    "A49_digest",
    lambda c: status.digest(c.encounters, c.metrics, c.patients, c.predictions, c.as_of),
    f"SELECT (SELECT count(*) FROM enc WHERE CAST(created_at AS DATE) >= CAST({NOW} AS DATE) - 7) AS encounters_7d, "
    f"(SELECT {BIG('coalesce(sum(message_count), 0)')} FROM metrics WHERE processing_hour >= {NOW} - INTERVAL 1 DAY) AS messages_24h, "
    "(SELECT count(*) FROM dim) AS total_patients, "
    f"(SELECT count(*) FROM pred WHERE forecast_generated_at >= {NOW} - INTERVAL 1 DAY) AS ml_predictions_24h, "
    "(SELECT max(last_message_at) FROM metrics) AS last_message_at, "
    f"(SELECT count(*) FROM enc WHERE CAST(created_at AS DATE) = CAST({NOW} AS DATE)) AS encounters_today",
)
q("A50_digest_daily", lambda c: status.digest_daily(c.encounters, c.as_of), _daily_enc)
q(
    "A51_digest_hourly",
    lambda c: status.digest_hourly(c.metrics, c.as_of),
    f"SELECT processing_hour AS hr, CAST(sum(message_count) AS DOUBLE) AS total_messages FROM metrics WHERE processing_hour >= {NOW} - INTERVAL 3 DAY GROUP BY 1",
)
q(
    "A52_digest_mix",
    lambda c: status.digest_mix(c.metrics),
    "SELECT coalesce(message_type, 'Unknown') AS message_type, CAST(sum(message_count) AS DOUBLE) AS c FROM metrics "
    "GROUP BY metrics.message_type ORDER BY c DESC LIMIT 10",
)
q(
    "A53_is_stale",
    lambda c: status.is_stale(c.metrics, 36, F.lit("2024-02-02 00:00:00").cast("timestamp")),
    "SELECT CASE WHEN max(last_message_at) IS NULL OR (epoch(TIMESTAMP '2024-02-02 00:00:00') - epoch(max(last_message_at))) / 3600.0 > 36 "
    "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS should_alert FROM metrics",
)
q(
    "A54_hourly_kpis",
    lambda c: reports.hourly_kpis(c.ed_hour),
    f"SELECT {SUM('arrivals')} AS total_arrivals, {SUM('discharges')} AS total_discharges, "
    "(SELECT event_hour FROM ed_hour ORDER BY arrivals DESC, event_hour LIMIT 1) AS peak_hour FROM ed_hour",
)
_pivot = lambda key, val, agg: ", ".join(f'coalesce({agg}({val}) FILTER ({key} = {h}), 0) AS "{h}"' for h in range(24))
q(
    "A55_weekly_heatmap",
    lambda c: reports.weekly_heatmap(c.ed_hour),
    f"SELECT day_of_week, {_pivot('hour_of_day', 'arrivals', 'avg')} FROM ed_hour GROUP BY 1",
)
q(
    "A56_daily_heatmap",
    lambda c: reports.daily_heatmap(c.icu_feat),
    "SELECT event_date, "
    + ", ".join(f'{BIG(f"coalesce(sum(arrivals) FILTER (hour = {h}), 0)")} AS "{h}"' for h in range(24))
    + " FROM (SELECT CAST(event_hour AS DATE) AS event_date, hour(event_hour) AS hour, arrivals FROM icu_feat) GROUP BY 1",
)
q(
    "A57_ed_trend_averages",
    lambda c: reports.trend_averages(c.ed_day),
    f"SELECT {rnd('avg(total_arrivals)', 1)} AS avg_daily_arrivals, {rnd(mean('avg_los_minutes'), 1)} AS avg_los_minutes, "
    f"{rnd('avg(unique_patients)', 1)} AS avg_unique_patients, count(*) AS total_days FROM ed_day",
)
q(
    "A57_icu_trend_averages",
    lambda c: reports.trend_averages(c.icu_day),
    f"SELECT {rnd('avg(total_arrivals)', 1)} AS avg_daily_arrivals, {rnd(mean('avg_los_hours'), 1)} AS avg_los_hours, "
    f"{rnd('avg(beds_used)', 1)} AS avg_beds_used, count(*) AS total_days FROM icu_day",
)
_newest = "forecast_generated_at = (SELECT max(forecast_generated_at) FROM pred)"
q(
    "A58_latest_batch",
    lambda c: reports.latest_batch(c.predictions, "ED"),
    f"SELECT * FROM pred WHERE department = 'ED' AND {_newest}",
)
q(
    "A59_batch_by_horizon",
    lambda c: reports.batch_by_horizon(c.predictions),
    f"SELECT forecast_horizon_hours, count(*) AS prediction_rows FROM pred WHERE {_newest} GROUP BY 1",
)
q(
    "A60_scoreboard",
    lambda c: reports.scoreboard(reports.accuracy_summary(c.accuracy)),
    f"SELECT count(DISTINCT model_name) AS models_tracked, {rnd(mean('avg_mae'), 2)} AS overall_avg_mae, "
    f"{rnd(mean('avg_mape_pct'), 1)} AS overall_avg_mape FROM ({_acc_sum})",
)
q(
    "A61_ratio_series",
    lambda c: reports.ratio_series(c.combined),
    "SELECT event_hour, CASE WHEN icu_arrivals <> 0 THEN ed_arrivals::DOUBLE / icu_arrivals END AS ratio FROM comb",
)
q(
    "A61_ratio_average",
    lambda c: reports.ratio_average(c.combined).select(F.round("avg_ratio", 6).alias("avg_ratio")),
    f"SELECT {rnd('avg(CASE WHEN icu_arrivals <> 0 THEN ed_arrivals::DOUBLE / icu_arrivals END)', 6)} AS avg_ratio FROM comb",
)
q(
    "A62_pressure_kpis",
    lambda c: reports.pressure_kpis(c.combined),
    "SELECT net_system_pressure, CASE WHEN icu_arrivals <> 0 THEN ed_arrivals::DOUBLE / icu_arrivals END AS ed_icu_ratio, "
    "total_arrivals, total_discharges, (SELECT count(*) FROM comb) AS data_points FROM comb ORDER BY event_hour DESC LIMIT 1",
)
for _id, _col in (("A63", "message_type"), ("A64", "sending_facility")):
    q(
        f"{_id}_volume_by_{_col}",
        lambda c, col=_col: reports.volume_by(c.metrics, col),
        f"SELECT {_col}, {SUM('message_count')} AS total_messages, {SUM('unique_messages')} AS total_unique FROM metrics "
        f"WHERE {_col} IS NOT NULL GROUP BY 1",
    )
q(
    "A65_activity_by_class",
    lambda c: reports.activity_by_class(c.activity),
    f"SELECT patient_class_desc, {SUM('encounter_count')} AS total_encounters, {SUM('unique_patients')} AS total_patients, "
    f"{SUM('unique_providers')} AS total_providers FROM activity WHERE patient_class_desc IS NOT NULL GROUP BY 1",
)
q(
    "A66_activity_by_facility",
    lambda c: reports.activity_by_facility(c.activity),
    f"SELECT location_facility, {SUM('encounter_count')} AS total_encounters, {SUM('unique_patients')} AS total_patients "
    "FROM activity WHERE location_facility IS NOT NULL GROUP BY 1",
)
q(
    "A67_activity_totals",
    lambda c: reports.activity_totals(c.activity),
    f"SELECT {SUM('encounter_count')} AS total_encounters, {SUM('unique_patients')} AS unique_patients, "
    "count(DISTINCT activity_date) AS activity_days FROM activity",
)
_long = ["arrivals", "discharges", "arrivals_lag_1h", "arrivals_rolling_24h", "cumulative_net_census", "is_night_shift"]
q(
    "A68_feature_long",
    lambda c: reports.feature_long(c.ed_feat, _long),
    " UNION ALL ".join(f"SELECT event_hour, '{x}' AS feature, CAST({x} AS DOUBLE) AS value FROM ed_feat" for x in _long),
)
q(
    "A69_throughput_totals",
    lambda c: reports.throughput_totals(reports.throughput(c.metrics)),
    f"SELECT {SUM('total_messages')} AS total_messages, {SUM('total_unique')} AS total_unique, count(*) AS hours_covered FROM ({_thru})",
)

# --- windows and features -------------------------------------------------------

_feat_key = ["event_hour", "location_facility", "arrivals", "discharges"]


def _feat(name, table, cols):
    picked = [*_feat_key, *[c for c in cols if c not in _feat_key]]
    q(name, lambda c: c.make(table).select(*picked), f"SELECT {', '.join(picked)} FROM {table}")


_feat("W1_arrival_lags", "ed_feat", [f"arrivals_lag_{k}h" for k in features.ARRIVAL_LAGS])
_feat(
    "W2_discharge_net_lags",
    "ed_feat",
    [f"discharges_lag_{k}h" for k in features.DISCHARGE_LAGS] + [f"net_change_lag_{k}h" for k in features.NET_LAGS],
)
_feat("W3_rolling_sums", "icu_feat", [f"{x}_rolling_{k}" for x in ("arrivals", "discharges") for k in features.ROLLING])
_feat("W4_rolling_mean_std", "ed_feat", ["arrivals_avg_6h", "arrivals_avg_24h", "arrivals_std_24h", "discharges_avg_24h"])
_feat("W5_cumulative_census", "icu_feat", ["cumulative_net_census"])
_feat("W6_week_over_week", "ed_feat", ["arrivals_wow_ratio"])
_sys = ["event_hour"] + [f"{d}_arrivals_lag_{k}h" for d in ("ed", "icu") for k in (1, 24)] + [
    f"{d}_{x}_rolling_24h" for d in ("ed", "icu") for x in ("arrivals", "discharges")
]
q("W7_system_windows", lambda c: c.make("combined").select(*_sys), f"SELECT {', '.join(_sys)} FROM comb")
q(
    "W8_dedup_latest",
    lambda c: features.dedup_by_key(
        c.encounters.withColumn("o", F.concat(F.date_format("created_at", "yyyyMMddHHmmss"), "encounter_key")), ["patient_id"], "o"
    ).drop("o"),
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY created_at DESC, encounter_key DESC) AS rn FROM enc) WHERE rn = 1",
)
for _d, _src in (("ed", "ed_hour"), ("icu", "icu_hour")):
    q(
        f"W9_{_d}_cumulative_census",
        lambda c, s=_src: features.cumulative_census(getattr(c, s)),
        f"SELECT event_hour, {SUM('arrivals')} AS arrivals, {SUM('discharges')} AS discharges, {SUM('net_change')} AS net_change, "
        f"{BIG('sum(sum(net_change)) OVER (ORDER BY event_hour)')} AS cumulative_census FROM {_src} GROUP BY 1",
    )
q(
    "W10_running_net",
    lambda c: features.running_net(c.ed_hour),
    f"SELECT *, {BIG('sum(net_change) OVER (ORDER BY event_hour, location_facility NULLS FIRST, arrivals, discharges ROWS UNBOUNDED PRECEDING)')} "
    "AS running_net FROM ed_hour",
)
_feat("F1_calendar", "ed_feat", ["month", "day_of_month", "week_of_year", "is_night_shift", "is_holiday_window"])
q("F2_ed_forecast_features", lambda c: c.make("ed_feat"), "SELECT * FROM ed_feat")
q("F2_icu_forecast_features", lambda c: c.make("icu_feat"), "SELECT * FROM icu_feat")
q("F3_combined_features", lambda c: c.make("combined"), "SELECT * FROM comb")


q(
    "F4_training_set",
    lambda c: forecast.training_set(c.ed_feat, "arrivals"),
    "SELECT coalesce(COLUMNS(* EXCLUDE (event_hour, location_facility, department)), 0) FROM ed_feat",
)


def _search():
    """Both learners, with one candidate each."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    linear = LinearRegression(labelCol="label", featuresCol="x")
    trees = GBTRegressor(labelCol="label", featuresCol="x", maxIter=3, maxDepth=2, seed=7)
    return [
        ("linear", linear, ParamGridBuilder().addGrid(linear.regParam, [0.1]).build()),
        ("boosted_trees", trees, ParamGridBuilder().addGrid(trees.maxDepth, [2]).build()),
    ]


_TRAINED: dict[tuple[str, str], str] = {}


def _trained(c):
    """A gold folder where all models were trained and have predicted by the clock; once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _TRAINED:
        gold = feed.new_path(c.spark, "forecast")
        for table in FEATURE_TABLES.values():
            store.write_table(c.stored(table), f"{gold}/{table}")
        train_all(c.spark, gold, feed.new_path(c.spark, "models"), _search(), folds=2)
        predict_all(c.spark, gold)
        _TRAINED[key] = gold
    return _TRAINED[key]


def _training(c):
    gold = _trained(c)
    runs = store.read_table(c.spark, f"{gold}/{RUNS}").select("model_name", "status", "training_samples")
    fitted = store.read_table(c.spark, f"{gold}/{METADATA}")
    sound = (F.col("rmse") >= 0) & (F.col("mae") >= 0) & (F.col("r2_score") <= 1)
    return runs.join(fitted.select("model_name", "champion", sound.alias("metrics_sound")), "model_name")


_model_tables = {"ed": "ed_feat", "icu": "icu_feat", "combined": "comb"}
q(
    "F5_F6_train",
    _training,
    " UNION ALL ".join(
        f"SELECT '{m.name}' AS model_name, 'SUCCESS' AS status, count({m.target}) AS training_samples, TRUE AS champion, "
        f"TRUE AS metrics_sound FROM {_model_tables[m.features]}"
        for m in forecast.MODELS
    ),
)


def _champion_run(c):
    """What is fixed of a run by the clock: one run time, every model's place and horizons."""
    rows = store.read_table(c.spark, f"{_trained(c)}/{PREDICTIONS}")
    runs = rows.select(F.count_distinct("forecast_generated_at").alias("runs"))
    newest = reports.latest_batch(rows)
    kept = newest.select(
        "model_name", "department", "location_facility", "target_metric", "forecast_horizon_hours", "target_hour", "feature_snapshot_hour"
    )
    return kept.withColumn("runs", F.lit(runs.first()["runs"]).cast("long"))


def _run_sql(m):
    table = _model_tables[m.features]
    place = "'ALL'" if m.features == "combined" else "max(coalesce(location_facility, 'None'))"
    return (
        f"SELECT '{m.name}' AS model_name, '{m.department}' AS department, place AS location_facility, '{m.target}' AS target_metric, "
        f"{INT('h')} AS forecast_horizon_hours, event_hour + to_hours(h) AS target_hour, event_hour AS feature_snapshot_hour, 1::BIGINT AS runs "
        f"FROM (SELECT event_hour, {place} AS place FROM {table} GROUP BY event_hour ORDER BY event_hour DESC LIMIT 1), "
        "(VALUES (1), (4), (8), (24)) AS v(h)"
    )


q("F7_champion_run", _champion_run, " UNION ALL ".join(_run_sql(m) for m in forecast.MODELS))
_last48 = "SELECT * FROM ed_feat ORDER BY event_hour DESC, location_facility DESC NULLS LAST LIMIT 48"
q("F8_latest_rows", lambda c: forecast.latest_rows(c.ed_feat), _last48)


def _naive(c):
    newest = forecast.latest_rows(c.ed_feat.where("location_facility IS NOT NULL"))
    scored = newest.select("event_hour", "location_facility", F.col("arrivals_rolling_24h").cast("double").alias("prediction"))
    return forecast.expand_horizons(forecast.latest_score(scored))


_naive_pts = (
    "SELECT 'ed_arrivals_forecast' AS model_name, '1' AS model_version, 'ED' AS department, "
    "arg_max(location_facility, (event_hour, location_facility)) AS location_facility, "
    f"{NOW} AS forecast_generated_at, 'arrivals' AS target_metric, max(event_hour) AS feature_snapshot_hour, "
    "arg_max(arrivals_rolling_24h::DOUBLE, (event_hour, location_facility)) AS prediction, stddev_pop(arrivals_rolling_24h::DOUBLE) AS spread "
    "FROM (SELECT * FROM ed_feat WHERE location_facility IS NOT NULL ORDER BY event_hour DESC, location_facility DESC LIMIT 48)"
)
q(
    "F9_expand_horizons",
    _naive,
    "SELECT feature_snapshot_hour, location_facility, forecast_horizon_hours, target_hour, predicted_value, prediction_lower_bound, "
    f"prediction_upper_bound, confidence_level FROM ({predicted(_naive_pts, 'CAST(h AS VARCHAR)')})",
)
q(
    "F10_prediction_rows",
    lambda c: forecast.prediction_rows(
        _naive(c), forecast.MODELS[0], "1", c.as_of, F.col("forecast_horizon_hours").cast("string")
    ),
    predicted(_naive_pts, "CAST(h AS VARCHAR)"),
)
q(
    "F11_backfill_updates",
    lambda c: forecast.actual_updates(c.open_predictions, c.ed_hour, c.icu_hour),
    "SELECT prediction_id, actual_value, absolute_error FROM pred WHERE actual_value IS NOT NULL",
)

# --- listings ------------------------------------------------------------------

q("T1_current_census", lambda c: reports.current_census(c.current), "SELECT * FROM cur")
q(
    "T3_ed_hourly_last_day",
    lambda c: reports.hourly(c.ed_hour, c.as_of, last_day=True),
    f"SELECT * FROM ed_hour WHERE event_hour >= {NOW} - INTERVAL 24 HOUR",
)
q(
    "T3_icu_hourly_last_day",
    lambda c: reports.hourly(c.icu_hour, c.as_of, last_day=True),
    f"SELECT * FROM icu_hour WHERE event_hour >= {NOW} - INTERVAL 24 HOUR",
)
q("T4_hourly_all", lambda c: reports.hourly(c.ed_hour), "SELECT * FROM ed_hour")
q("T4_icu_hourly_all", lambda c: reports.hourly(c.icu_hour), "SELECT * FROM icu_hour")
q("T5_ed_daily", lambda c: reports.daily(c.ed_day), "SELECT * FROM ed_day")
q("T5_icu_daily", lambda c: reports.daily(c.icu_day), "SELECT * FROM icu_day")
q(
    "T6_latest_predictions",
    lambda c: reports.latest_predictions(c.predictions),
    "SELECT model_name, model_version, department, target_metric, forecast_horizon_hours, target_hour, "
    f"{rnd('predicted_value', 1)} AS predicted_value, {rnd('prediction_lower_bound', 1)} AS lower_bound, "
    f"{rnd('prediction_upper_bound', 1)} AS upper_bound, CAST(round(CAST(confidence_level AS DECIMAL(10, 3)) * 100) AS DOUBLE) AS confidence_pct, "
    f"{rnd('actual_value', 1)} AS actual_value, {rnd('absolute_error', 2)} AS error, forecast_generated_at FROM pred",
)
_seven = (
    "SELECT model_name, department, target_metric, forecast_horizon_hours, target_hour, predicted_value, prediction_lower_bound, "
    f"prediction_upper_bound, actual_value, absolute_error, forecast_generated_at FROM pred WHERE forecast_generated_at >= {NOW} - INTERVAL 7 DAY"
)
q("T7_predictions_since", lambda c: reports.predictions_since(c.predictions, as_of=c.as_of), _seven)
q(
    "T7_prediction_slice",
    lambda c: reports.predictions_since(c.predictions, as_of=c.as_of, dept="ED", metric="arrivals", horizon=4),
    _seven + " AND department = 'ED' AND target_metric = 'arrivals' AND forecast_horizon_hours = 4",
)
q(
    "T8_predicted_vs_actual",
    lambda c: reports.predicted_vs_actual(c.predictions),
    "SELECT model_name, department, target_metric, forecast_horizon_hours, target_hour, predicted_value, actual_value, absolute_error "
    "FROM pred WHERE actual_value IS NOT NULL ORDER BY target_hour DESC, model_name, department, target_metric, forecast_horizon_hours, "
    "predicted_value, actual_value, absolute_error LIMIT 500",
)
q("T9_accuracy", lambda c: reports.accuracy(c.accuracy), "SELECT * FROM acc")
q(
    "T9_accuracy_of_model",
    lambda c: reports.accuracy(c.accuracy, "ed_arrivals_forecast"),
    "SELECT * FROM acc WHERE model_name = 'ed_arrivals_forecast'",
)
for _name, _src, _kind in (
    ("combined", "comb", "combined"),
    ("ed", "ed_feat", "department"),
    ("icu", "icu_feat", "department"),
):
    q(
        f"T10_{_name}_features",
        lambda c, s={"comb": "combined"}.get(_src, _src), k=_kind: reports.features(getattr(c, s), k),
        f"SELECT {', '.join(reports.FEATURE_COLUMNS[_kind])} FROM {_src}",
    )
q("T11_metrics", lambda c: reports.metrics(c.metrics), "SELECT * FROM metrics")
q("T11_activity", lambda c: reports.activity(c.activity), "SELECT * FROM activity")
_sample = reports.FEATURE_COLUMNS["sample"]
q(
    "T12_feature_sample",
    lambda c: reports.feature_sample(c.ed_feat),
    f"SELECT {', '.join(_sample)} FROM ed_feat ORDER BY event_hour DESC, "
    + ", ".join(f"{x} NULLS FIRST" for x in _sample[1:])
    + " LIMIT 24",
)
q(
    "T13_combined_latest",
    lambda c: reports.combined_latest(c.combined),
    f"SELECT net_system_pressure, {rnd('ed_to_icu_ratio', 2)} AS ed_to_icu_ratio, total_arrivals, total_discharges, ed_arrivals, "
    "icu_arrivals, event_hour FROM comb ORDER BY event_hour DESC LIMIT 1",
)
q(
    "T14_pressure",
    lambda c: reports.pressure(c.combined),
    "SELECT event_hour, net_system_pressure, ed_arrivals, icu_arrivals FROM comb",
)
q("T15_top_n_diagnoses", lambda c: reports.top_diagnoses(c.diagnoses, 7), _dx + "7")
q(
    "T16_adt_sample",
    lambda c: adt.adt_sample(adt.adt_rows(c.adt, c.as_of)),
    f"SELECT event_time_stamp, message_event_type, patient_class, department, facility FROM ({_adt_rows}) "
    "ORDER BY event_time_stamp DESC, patient_mrn NULLS FIRST LIMIT 100",
)

# --- unions --------------------------------------------------------------------

q(
    "U1_hourly_all",
    lambda c: reports.hourly_all(c.ed_hour, c.icu_hour),
    f"SELECT *, CAST(event_hour AS DATE) AS event_date, {_dtype}, {_shift} FROM (SELECT 'ED' AS department, * FROM ed_hour UNION ALL "
    "SELECT 'ICU', * FROM icu_hour)",
)
_day_cols = "activity_date, location_facility, total_arrivals, total_discharges, unique_patients"
q(
    "U2_U4_daily_all",
    lambda c: reports.daily_all(c.ed_day, c.icu_day),
    f"SELECT 'ED' AS department, {_day_cols} FROM ed_day UNION ALL SELECT 'ICU', {_day_cols} FROM icu_day",
)

# --- scalar functions ------------------------------------------------------------

q(
    "X2_surrogate_keys",
    lambda c: c.silver_pid.select(
        "message_id",
        v.surrogate_key("patient_id", "patient_id_authority").alias("skipping"),
        v.surrogate_key("patient_id", "patient_id_authority", nulls="blank").alias("blank"),
    ),
    "SELECT message_id, md5(concat_ws('|', patient_id, patient_id_authority)) AS skipping, "
    "md5(coalesce(patient_id, '') || '|' || coalesce(patient_id_authority, '')) AS blank FROM t_pid",
)
q(
    "X3_content_id",
    lambda c: c.messages.select("message_id", v.content_id("raw_message", F.date_format("parsed_at", "yyyyMMddHHmmss")).alias("content_id")),
    "SELECT message_id, substring(sha256(raw_message || msg_at), 1, 32) AS content_id FROM msg",
)
q(
    "X4_entity_key",
    lambda c: c.silver_pid.select("message_id", v.entity_key("patient_id", "date_of_birth", "race").alias("entity_key")),
    "SELECT message_id, md5(concat_ws('|', patient_id, date_of_birth, race)) AS entity_key FROM t_pid",
)
q(
    "X1_X5_X6_string_date_math",
    lambda c: c.silver_pid.select(
        "message_id",
        F.concat_ws("-", "address_state", "address_zip").alias("place"),
        F.upper("address_city").alias("city"),
        F.regexp_extract("address_zip", r"^(\d{5})", 1).alias("zip5"),
        F.replace("address_street", F.lit("MAIN"), F.lit("OAK")).alias("street"),
        F.split_part("address_street", F.lit(" "), F.lit(1)).alias("house"),
        F.to_date("parsed_at").alias("day"),
        F.weekofyear("parsed_at").alias("week"),
        F.dayofweek("parsed_at").alias("dow"),
        F.date_sub(F.to_date("parsed_at"), 7).alias("week_ago"),
        (F.unix_timestamp("parsed_at") - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))).alias("epoch"),
        F.pow(F.hour("parsed_at").cast("double"), F.lit(2)).alias("hour_squared"),
        F.try_divide(F.hour("parsed_at"), F.dayofmonth("parsed_at") - 5).alias("guarded"),
    ),
    "SELECT message_id, concat_ws('-', address_state, address_zip) AS place, upper(address_city) AS city, "
    "regexp_extract(address_zip, '^([0-9]{5})', 1) AS zip5, replace(address_street, 'MAIN', 'OAK') AS street, "
    "split_part(address_street, ' ', 1) AS house, CAST(parsed_at AS DATE) AS day, "
    f"{INT('week(parsed_at)')} AS week, {INT('dayofweek(parsed_at) + 1')} AS dow, CAST(parsed_at AS DATE) - 7 AS week_ago, "
    f"{BIG('epoch(parsed_at) - epoch(TIMESTAMP ' + chr(39) + '2024-01-01 00:00:00' + chr(39) + ')')} AS epoch, pow(hour(parsed_at), 2) AS hour_squared, "
    "CASE WHEN day(parsed_at) <> 5 THEN hour(parsed_at) / (day(parsed_at) - 5)::DOUBLE END AS guarded FROM t_pid",
)
_class_map = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in v.CLASS_TEXT.items())
_sex_map = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in v.SEX_TEXT.items())
q(
    "X7_X12_class_text",
    lambda c: c.silver_pv1.select(
        "message_id", v.class_desc("patient_class").alias("gold"), v.class_text(F.lower("patient_class")).alias("library")
    ),
    "SELECT message_id, CASE patient_class WHEN 'I' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient' WHEN 'E' THEN 'Emergency' "
    f"WHEN 'P' THEN 'Preadmit' ELSE patient_class END AS gold, CASE patient_class {_class_map} ELSE lower(patient_class) END AS library FROM t_pv1",
)
q(
    "X8_X18_abnormal",
    lambda c: c.silver_obx.select(
        "message_id", "set_id", v.is_abnormal("abnormal_flags").alias("gold"), v.is_abnormal_any("abnormal_flags").alias("library")
    ),
    "SELECT message_id, set_id, coalesce(abnormal_flags IN ('H', 'HH', 'L', 'LL', 'A', 'AA', 'C'), FALSE) AS gold, "
    "coalesce(upper(abnormal_flags) IN ('H', 'HH', 'L', 'LL', 'A', 'AA', 'C', 'CR'), FALSE) AS library FROM t_obx",
)
q(
    "X9_severe",
    lambda c: c.silver_al1.select("message_id", "set_id", v.is_severe("severity_code").alias("is_severe")),
    "SELECT message_id, set_id, coalesce(severity_code IN ('SV', 'SE'), FALSE) AS is_severe FROM t_al1",
)
q(
    "X10_X14_numbers",
    lambda c: c.silver_obx.select(
        "message_id", "set_id", v.nm_value("value_type", "observation_value").alias("nm"), v.numeric_text("observation_value").alias("any_number")
    ),
    "SELECT message_id, set_id, CASE WHEN value_type = 'NM' THEN TRY_CAST(regexp_extract(observation_value, '^-?[0-9.]+') AS DOUBLE) END AS nm, "
    "TRY_CAST(regexp_replace(observation_value, '[^0-9.-]', '', 'g') AS DOUBLE) AS any_number FROM t_obx",
)
q(
    "X11_sex_text",
    lambda c: c.patients.select("patient_key", v.sex_text("sex").alias("sex_text")),
    f"SELECT patient_key, CASE sex {_sex_map} ELSE sex END AS sex_text FROM dim",
)
_ranges = {"70-110": (70, 110), "<5.5": (None, 5.5), ">2": (2, None)}
_case = lambda k: " ".join(f"WHEN '{r}' THEN {x[k]}" for r, x in _ranges.items() if x[k] is not None)
q(
    "X13_reference_range",
    lambda c: c.segment("OBX")
    .select("message_id", "set_id", v.reference_range("reference_range").alias("r"))
    .select("message_id", "set_id", "r.low", "r.high"),
    f"SELECT message_id, set_id, CAST(CASE reference_range {_case(0)} END AS DOUBLE) AS low, "
    f"CAST(CASE reference_range {_case(1)} END AS DOUBLE) AS high FROM t_obx",
)
q(
    "X15_age",
    lambda c: c.patients.select("patient_key", v.age_years(v.hl7_ts("date_of_birth"), c.as_of).alias("age")),
    f"SELECT patient_key, {INT(f'date_sub({chr(39)}year{chr(39)}, CAST(strptime(date_of_birth, {chr(39)}%Y%m%d{chr(39)}) AS DATE), CAST({NOW} AS DATE))')} AS age FROM dim",
)
q(
    "X16_X17_name_address",
    lambda c: c.segment("PID", wide=True).select(
        "message_id",
        v.full_name("patient_name_family", "patient_name_given", "patient_name_middle").alias("name"),
        v.full_address("address_street", "address_city", "address_state", "address_zip", "address_country").alias("address"),
    ),
    "SELECT message_id, concat_ws(' ', patient_name_given, patient_name_middle, patient_name_family) AS name, "
    "concat_ws(', ', address_street, address_city, address_state, address_zip) AS address FROM t_pid",
)
q(
    "X19_los_hours",
    lambda c: c.encounters.select("encounter_key", v.los_hours(v.hl7_ts("admit_datetime"), v.hl7_ts("discharge_datetime")).alias("los")),
    "SELECT encounter_key, (epoch(discharge_at) - epoch(admit_at)) / 3600.0::DOUBLE AS los FROM enc_all",
)
q(
    "X20_clean_id",
    lambda c: c.silver_pid.select("message_id", v.clean_id(F.concat(F.lit(" "), F.lower("patient_id"), F.lit(" "))).alias("id")),
    "SELECT message_id, patient_id AS id FROM t_pid",
)
q(
    "X21_arrays",
    lambda c: c.messages.select(
        "message_id",
        F.size(F.split("raw_message", "\r")).alias("lines"),
        F.size(F.filter(F.split("raw_message", "\r"), lambda x: x.startswith("DG1"))).alias("diagnoses"),
    ),
    f"SELECT message_id, {INT(f'len({_lines})')} AS lines, {INT('n_dg1')} AS diagnoses FROM msg",
)


def _labelled(c):
    rows = c.silver_obx.select("message_id", "set_id", "value_type", "result_status", "abnormal_flags")
    for name, col in (("value_types", "value_type"), ("result_status", "result_status"), ("abnormal_flags", "abnormal_flags")):
        rows = codes.with_code(rows, name, col, f"{col}_text")
    return rows


_code_case = lambda name, col: "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in codes.CODES[name].items()) + " END"
q(
    "X22_code_labels",
    _labelled,
    "SELECT message_id, set_id, value_type, result_status, abnormal_flags, "
    f"{_code_case('value_types', 'value_type')} AS value_type_text, {_code_case('result_status', 'result_status')} AS result_status_text, "
    f"{_code_case('abnormal_flags', 'abnormal_flags')} AS abnormal_flags_text FROM t_obx",
)
q(
    "X22_message_types",
    lambda c: codes.with_code(
        c.headed.select("message_id", F.concat_ws("^", "message_type", "trigger_event").alias("code")), "message_types", "code", "meaning"
    ),
    f"SELECT message_id, mtype || '^' || trig AS code, {_code_case('message_types', 'mtype || ' + chr(39) + '^' + chr(39) + ' || trig')} AS meaning FROM msg",
)


def _sql_functions(c):
    register_sql_functions(c.spark)
    c.silver_pid.createOrReplaceTempView("z3_pid")
    return c.spark.sql(
        "SELECT message_id, generate_key(array(patient_id, race)) AS k, try_numeric(address_zip) AS zip_number, "
        "format_name(patient_name_family, patient_name_given, patient_name_middle) AS name, standardize_sex(lower(sex)) AS sex_text, "
        "standardize_patient_class(marital_status) AS class_text, is_abnormal(race) AS odd FROM z3_pid"
    )


q(
    "Z3_sql_functions",
    _sql_functions,
    "SELECT message_id, md5(concat_ws('|', patient_id, race)) AS k, "
    "TRY_CAST(regexp_replace(address_zip, '[^0-9.-]', '', 'g') AS DOUBLE) AS zip_number, "
    "concat_ws(' ', patient_name_given, patient_name_middle, patient_name_family) AS name, "
    f"CASE sex {_sex_map} ELSE lower(sex) END AS sex_text, CASE marital_status {_class_map} ELSE marital_status END AS class_text, "
    "FALSE AS odd FROM t_pid",
)

# --- sources and sinks ------------------------------------------------------------


def _bus(c):
    sent = c.messages.select(F.col("raw_message").cast("binary").alias("value"), F.lit("hl7").alias("topic"), F.col("parsed_at").alias("timestamp"))
    return msgs.messages(messages_from(sent)).select("raw_message", "source_file", "file_message_count", "file_modification_time")


q(
    "S4_bus_messages",
    _bus,
    "SELECT rtrim(raw_message, chr(13)) AS raw_message, 'hl7' AS source_file, 1 AS file_message_count, parsed_at AS file_modification_time FROM msg",
)


def _landing(c, **kw):
    return read_files(c.spark, feed.landing_folder(c.spark, c.sf_dir), glob="*.txt", recursive=True, **kw)


q(
    "S1_S2_read_files",
    lambda c: msgs.messages(_landing(c))
    .groupBy(F.regexp_extract("source_file", "file_id=(file-[0-9]+)", 1).alias("file"), F.length("file_id").alias("id_size"))
    .agg(F.count("*").alias("message_rows"), F.max("file_message_count").alias("file_message_count")),
    f"SELECT 'file-' || CAST({_file_no} AS VARCHAR) AS file, 32 AS id_size, count(*) AS message_rows, "
    f"{INT('count(*)')} AS file_message_count FROM msg GROUP BY 1",
)


q(
    "S1_line_messages",
    lambda c: read_line_messages(c.spark, feed.landing_folder(c.spark, c.sf_dir), glob="*.txt", recursive=True).select(
        "message_id",
        "raw_message",
        F.regexp_extract("source_file", "file_id=(file-[0-9]+)", 1).alias("file"),
        "file_message_count",
    ),
    f"SELECT md5(rtrim(raw_message, chr(13))) AS message_id, rtrim(raw_message, chr(13)) AS raw_message, "
    f"'file-' || CAST({_file_no} AS VARCHAR) AS file, {INT(f'count(*) OVER (PARTITION BY {_file_no})')} AS file_message_count FROM msg",
)
_sql_names = {
    **{"encounters": "enc", "observations": "obs", "diagnoses": "dx", "allergies": "alg", "orders": "ord", "patients": "dim"},
    **{"current": "cur", "combined": "comb", "predictions": "pred", "accuracy": "acc"},
}
_sql_tables = {full: _sql_names.get(short, short) for short, full in TABLES.items()}
q(
    "S11_serving_ddl",
    lambda c: reduce(DataFrame.unionByName, [key_report(c.stored(t), t, k) for t, k in SERVING_KEYS.items()]).select(
        "table",
        F.regexp_extract("ddl", r"PRIMARY KEY \((.*)\)\)$", 1).alias("key"),
        F.regexp_count("ddl", F.lit(" NOT NULL")).alias("required"),
        "rows",
        "distinct_keys",
        "rows_without_key",
    ),
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{', '.join(chr(34) + x + chr(34) for x in k)}' AS key, {len(k)} AS required, count(*) AS rows, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {_sql_tables[t]})) AS distinct_keys, "
        f"count(*) FILTER (WHERE {' OR '.join(f'{x} IS NULL' for x in k)}) AS rows_without_key FROM {_sql_tables[t]}"
        for t, k in SERVING_KEYS.items()
    ),
)


def _streamed(c):
    out, checkpoint = feed.new_path(c.spark, "stream"), feed.new_path(c.spark, "checkpoint")
    folder = feed.landing_folder(c.spark, c.sf_dir)
    start_ingest(
        c.spark, folder, out, checkpoint, parsed_at=msgs.message_time(), glob="*.txt", recursive=True, max_files=1000
    ).awaitTermination()
    return read_silver(c.spark, out, "PV1")


q("R1_R2_R3_S3_stream_ingest", _streamed, "SELECT * EXCLUDE (admit_at, discharge_at, fin, dispo) FROM t_pv1")


def _ingested(c):
    """The feed ingested by three runs into one folder, the last of which finds nothing new; once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _INGESTED:
        out, folder = feed.new_path(c.spark, "ingested"), feed.landing_folder(c.spark, c.sf_dir)
        # A folder that grows, and files that are all known.
        _RUNS[out] = [
            ingest_batch(c.spark, f"{folder}/file_id=file-{some}", out, msgs.message_time(), glob="*.txt", recursive=True)
            for some in ("*[02468]", "*", "*[13579]")
        ]
        _INGESTED[key] = out
    return _INGESTED[key]


def _run_files(c):
    """How many runs took how many files; a run of many files makes more than one batch."""
    out = _ingested(c)
    batches = [(batch, run) for run, made in enumerate(_RUNS[out]) for batch in made]
    files = c.spark.read.parquet(f"{out}/{FILES}").groupBy("batch").agg(F.count("*").alias("n"))
    runs = files.join(c.spark.createDataFrame(batches, "batch string, run int"), "batch").groupBy("run").agg(F.sum("n").alias("files"))
    return runs.groupBy("files").agg(F.count("*").alias("runs"))


_INGESTED: dict[tuple[str, str], str] = {}
_RUNS: dict[str, list[list[str]]] = {}
for _kind in SILVER:
    _own = "SELECT * EXCLUDE (admit_at, discharge_at, fin, dispo) FROM t_pv1" if _kind == "PV1" else f"SELECT * FROM t_{_kind.lower()}"
    q(f"R1_ingest_{_kind.lower()}", lambda c, k=_kind: read_silver(c.spark, _ingested(c), k), _own)
q(
    "R1_ingest_hl7_parsed",
    lambda c: read_ingested(c.spark, _ingested(c), MESSAGES).select(
        "message_id", "raw_message", "parsed_at", "message_type", "trigger_event", "sending_facility", "message_control_id", "patient_id"
    ),
    QUERIES["G1_hl7_parsed"][1].replace("raw_message, parsed_at", "rtrim(raw_message, chr(13)) AS raw_message, parsed_at"),
)
q(
    "R3_two_runs",
    _run_files,
    f"SELECT files, count(*) AS runs FROM (SELECT CAST(substr(file, 6) AS INTEGER) % 2 AS half, count(*) AS files FROM "
    f"(SELECT DISTINCT 'file-' || CAST({_file_no} AS VARCHAR) AS file FROM msg) GROUP BY 1) GROUP BY 1",
)
q(
    "R3_grown_folder",
    lambda c: read_ingested(c.spark, _ingested(c), MESSAGES).groupBy("message_id").agg(F.count("*").alias("times")),
    "SELECT md5(rtrim(raw_message, chr(13))) AS message_id, count(*) AS times FROM msg GROUP BY 1",
)


def _archive(c):
    """The feed as one file; once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _ARCHIVES:
        path = feed.new_path(c.spark, "archive")
        text = feed.feed_messages(c.spark, c.sf_dir).select(F.concat("raw_message", F.lit("\n")).alias("value"))
        text.coalesce(1).write.text(path)
        _ARCHIVES[key] = path
    return _ARCHIVES[key]


_ARCHIVES: dict[tuple[str, str], str] = {}


def _archived(c, streamed: bool):
    """The archive's messages, read by line from more than one split."""
    out, source = feed.new_path(c.spark, "archived"), {"glob": "*.txt", "lines": True}
    before = c.spark.conf.get("spark.sql.files.maxPartitionBytes")
    c.spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        if streamed:
            start_ingest(
                c.spark, _archive(c), out, feed.new_path(c.spark, "checkpoint"), parsed_at=msgs.message_time(), **source
            ).awaitTermination()
        else:
            ingest_batch(c.spark, _archive(c), out, msgs.message_time(), **source)
    finally:
        c.spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    splits = read_ingested(c.spark, out, LINES).agg((F.count_distinct("split") > 1).alias("many_splits"))
    return read_ingested(c.spark, out, MESSAGES).select("message_id", "raw_message", "parsed_at", "patient_id").join(splits)


for _streams in (False, True):
    q(
        f"S1_archive_{'stream' if _streams else 'batch'}",
        lambda c, s=_streams: _archived(c, s),
        f"SELECT message_id, raw_message, parsed_at, patient_id, TRUE AS many_splits FROM ({QUERIES['R1_ingest_hl7_parsed'][1]})",
    )


def _increments(c):
    """Gold kept up to date over three ingests of the feed; once per session.

    The first takes the earlier files, the second the later ones, the third those that were late:
    every tenth file, whenever it is from.
    """
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _INCREMENTS:
        path, folder = feed.new_path(c.spark, "increments"), feed.landing_folder(c.spark, c.sf_dir)
        last = c.spark.read.parquet(f"{c.sf_dir}/events.parquet").agg(F.max("event_id")).first()[0] // feed.FILE_SIZE
        on_time = [i for i in range(last + 1) if i % 10 != 7]
        early = [i for i in on_time if i < 0.6 * last]
        for some in (early, on_time, range(last + 1)):
            folders = [f"{folder}/file_id=file-{i}" for i in some]
            ingest_batch(c.spark, folders, f"{path}/silver", msgs.message_time(), glob="*.txt", recursive=True)
            refresh_increment(c.spark, f"{path}/silver", f"{path}/gold", as_of=c.as_of)
        _INCREMENTS[key] = path
    return _INCREMENTS[key]


_INCREMENTS: dict[tuple[str, str], str] = {}
for _id, _table in (
    ("A1_patient_dim", "patients"), ("K1_encounter_fact", "encounters"), ("K2_observation_fact", "observations"),
    ("K3_diagnosis_fact", "diagnoses"), ("K4_allergy_fact", "allergies"), ("K5_order_fact", "orders"),
    ("A2_message_metrics", "metrics"), ("A3_patient_activity", "activity"), ("A4_ed_hourly_census", "ed_hour"),
    ("A5_icu_hourly_census", "icu_hour"), ("A6_ed_daily_summary", "ed_day"), ("A7_icu_daily_summary", "icu_day"),
    ("A8_department_census_current", "current"), ("F2_ed_forecast_features", "ed_feat"),
    ("F2_icu_forecast_features", "icu_feat"), ("F3_combined_features", "combined"),
):
    q(
        f"R4_increment_{_id}",
        lambda c, t=_table: store.read_table(c.spark, f"{_increments(c)}/gold/{TABLES[t]}"),
        QUERIES[_id][1],
    )


def _backfilled(c):
    """A prediction log whose actuals came in two steps, and its accuracy by target day; once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _BACKFILLED:
        gold = feed.new_path(c.spark, "backfilled")
        append_predictions(c.open_predictions, gold)
        half = F.lit("2024-01-16").cast("timestamp")
        days = None
        for known in (F.col("event_hour") < half, F.lit(True)):
            for table in ("ed_hour", "icu_hour"):
                write_version(c.stored(TABLES[table]).where(known), f"{gold}/{TABLES[table]}")
            filled = backfill(c.spark, gold)
            refresh_accuracy(c.spark, gold, days if days is None else filled)
            days = filled
        _BACKFILLED[key] = gold
    return _BACKFILLED[key]


_BACKFILLED: dict[tuple[str, str], str] = {}
q("F11_two_backfills", lambda c: read_predictions(c.spark, _backfilled(c)), "SELECT * FROM pred")
q(
    "A9_accuracy_of_touched_days",
    lambda c: store.read_table(c.spark, f"{_backfilled(c)}/gold_forecast_accuracy"),
    QUERIES["A9_F12_forecast_accuracy"][1],
)
_rule_sources = {k: f"raw_{k.lower()}" if k in ("MSH", "PID", "OBX", "DG1") else f"t_{k.lower()}" for k in quality.PIPELINE_RULES if k != "messages"}
q(
    "Q3_violation_counts",
    lambda c: read_violations(c.spark, _ingested(c)),
    " UNION ALL ".join(
        f"SELECT '{k}' AS segment, '{r.name}' AS rule, '{r.action}' AS action, count(*) AS rows_checked, "
        f"count(*) FILTER (NOT coalesce({r.constraint}, {r.action == quality.WARN})) AS failures FROM {_rule_sources[k]}"
        for k, rules in quality.PIPELINE_RULES.items()
        if k != "messages"
        for r in rules
    ),
)
q(
    "Q8_ingest_quarantine",
    lambda c: read_quarantine(c.spark, _ingested(c), "DG1").withColumn("failed_rules", F.concat_ws(",", "failed_rules")),
    "SELECT *, 'dg1_code_not_null' AS failed_rules FROM raw_dg1 WHERE diagnosis_code IS NULL",
)


def _copied(c):
    source, out = feed.new_path(c.spark, "table"), feed.new_path(c.spark, "copy")
    store.write_table(c.encounters, source, ("created_at",))
    rows = store.read_table(c.spark, source, streaming=True)
    store.write_stream(rows, out, feed.new_path(c.spark, "checkpoint")).awaitTermination()
    return store.read_table(c.spark, out)


q("S5_S6_S7_S8_stream_table", _copied, "SELECT * FROM enc")


def _appended(c):
    out = feed.new_path(c.spark, "append")
    for priority in ("R", "S", "A"):
        store.append_table(c.orders.where(F.col("priority") == priority), out)
    return store.read_table(c.spark, out)


q("S9_append_table", _appended, "SELECT * FROM ord")


def _published(c):
    return publish_all(c.spark, f"{lake(c.spark, c.sf_dir)}/gold", feed.new_path(c.spark, "serving"))


def _published_partly(c):
    source = feed.new_path(c.spark, "gold")
    store.write_table(c.diagnoses, f"{source}/gold_diagnosis_fact")
    store.write_table(c.orders.where("priority IS NULL"), f"{source}/gold_order_fact")
    names = ["gold_diagnosis_fact", "gold_order_fact", "gold_patient_dim"]
    return publish_all(c.spark, source, feed.new_path(c.spark, "serving"), names)


def _publish_sql(table, keys):
    grouped = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    bad = f"(SELECT count(*) FROM (SELECT 1 FROM {_sql_tables[table]} GROUP BY {grouped} HAVING count(*) > 1))"
    return (
        f"SELECT '{table}' AS \"table\", CASE WHEN {bad} > 0 THEN 'FAILED' WHEN count(*) = 0 THEN 'SKIPPED_EMPTY' ELSE 'SUCCESS' END AS status, "
        f"CASE WHEN {bad} > 0 THEN 0 ELSE count(*) END AS rows, "
        f"CASE WHEN {bad} > 0 THEN {bad} || ' key values are repeated or missing in {', '.join(keys)}' END AS error FROM {_sql_tables[table]}"
    )


q("S13_publish_all", _published, " UNION ALL ".join(_publish_sql(t, k) for t, k in SERVING_KEYS.items()))
q(
    "S13_publish_report",
    _published_partly,
    "SELECT 'gold_diagnosis_fact' AS \"table\", 'SUCCESS' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM dx UNION ALL "
    "SELECT 'gold_order_fact', 'SKIPPED_EMPTY', 0, NULL UNION ALL SELECT 'gold_patient_dim', 'SKIPPED_NOT_FOUND', 0, NULL",
)
q(
    "S12_sanitize",
    lambda c: store.sanitize(
        c.observations.select(
            "observation_key",
            F.when(F.col("units").isNull(), F.lit(float("nan"))).otherwise(F.col("observation_value_numeric")).alias("x"),
            F.when(F.col("is_abnormal"), F.lit(float("inf"))).otherwise(F.lit(1.0)).alias("y"),
            F.lit(1).alias("z"),
            F.when(F.col("is_abnormal"), F.lit("9223372036854775808")).otherwise(F.lit("-9223372036854775808")).cast("decimal(20,0)").alias("w"),
        )
    ).withColumn("w", F.col("w").cast("long")),
    "SELECT observation_key, CASE WHEN units IS NOT NULL THEN observation_value_numeric END AS x, "
    "CASE WHEN NOT is_abnormal THEN 1.0::DOUBLE END AS y, 1 AS z, CASE WHEN NOT is_abnormal THEN (-9223372036854775808)::BIGINT END AS w FROM obs",
)
q(
    "S14_primary_key_check",
    lambda c: store.check_primary_key(c.ed_hour, ["event_hour", "location_facility"]),
    "SELECT event_hour, location_facility, count(*) AS row_count FROM ed_hour GROUP BY ALL HAVING count(*) > 1 OR location_facility IS NULL",
)
def _all_keys(c):
    found = [
        store.check_primary_key(c.stored(table), keys).agg(F.count("*").alias("bad_keys")).withColumn("table", F.lit(table))
        for table, keys in SERVING_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, found)


q(
    "S14_all_serving_keys",
    _all_keys,
    " UNION ALL ".join(
        f"SELECT count(*) AS bad_keys, '{table}' AS \"table\" FROM (SELECT {', '.join(keys)} FROM {_sql_tables[table]} "
        f"GROUP BY ALL HAVING count(*) > 1 OR {' OR '.join(f'{k} IS NULL' for k in keys)})"
        for table, keys in SERVING_KEYS.items()
    ),
)
q(
    "S15_snapshot_changes",
    lambda c: store.snapshot_changes(
        c.ed_day.where("location_facility IS NOT NULL AND activity_date < DATE'2024-01-20'")
        .select("activity_date", "location_facility", "total_arrivals", F.lit(0).alias("mark")),
        c.ed_day.where("location_facility IS NOT NULL AND activity_date > DATE'2024-01-10'")
        .select("activity_date", "location_facility", "total_arrivals", (F.dayofmonth("activity_date") % 2).alias("mark")),
        ["activity_date", "location_facility"],
    ),
    "SELECT CASE WHEN activity_date <= DATE '2024-01-10' THEN 'delete' WHEN activity_date >= DATE '2024-01-20' THEN 'insert' "
    f"ELSE 'update' END AS change_type, activity_date, location_facility, total_arrivals, "
    f"{INT('CASE WHEN activity_date <= DATE ' + chr(39) + '2024-01-10' + chr(39) + ' THEN 0 ELSE day(activity_date) % 2 END')} AS mark FROM ed_day "
    "WHERE location_facility IS NOT NULL AND (activity_date <= DATE '2024-01-10' OR activity_date >= DATE '2024-01-20' OR day(activity_date) % 2 = 1)",
)


def _fed(c):
    """The orders published in three versions: a part with other values, a part that ends later, and all; once per session."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _FED:
        path, third = feed.new_path(c.spark, "published"), F.pmod(F.xxhash64("order_key"), F.lit(3))
        orders = c.orders
        publish_version(orders.where(third != 0).withColumn("priority", F.lit("?")), path, ["order_key"])
        publish_version(orders.where(third != 1), path, ["order_key"])
        publish_version(orders, path, ["order_key"])
        _FED[key] = path
    return _FED[key]


_FED: dict[tuple[str, str], str] = {}
q(
    "S15_replayed_feed",
    lambda c: replay(c.orders.limit(0), read_changes(c.spark, _fed(c)), ["order_key"]),
    "SELECT * FROM ord",
)
