"""SQL twins of the derived tables, from the feed's values and without parsing.

``sql(text)`` puts the tables a query names (and those they need) in front of it.
"""

from __future__ import annotations

import re

from checks import feed as f

AS_OF = "2024-01-29 12:00:00"
NOW = f"TIMESTAMP '{AS_OF}'"

TABLES: dict[str, str] = {}


def table(name: str, text: str) -> None:
    TABLES[name] = text


def rnd(x: str, n: int) -> str:
    """Half-up rounding of the shortest decimal text, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {n}) AS DOUBLE)"


def mean(x: str) -> str:
    """Mean of the exact decimal sum."""
    exact = f"CAST({x} AS DECIMAL(38, 10))"
    return f"(CAST(sum({exact}) AS DOUBLE) / nullif(count({exact}), 0))"


def n(x: str) -> str:
    return f"nullif({x}, '')"


def sql(text: str) -> str:
    needed: list[str] = []

    def visit(body):
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", body):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(text)
    if not needed:
        return text
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed)
    return f"WITH {ctes}\n{text}"


# --- feed and messages --------------------------------------------------------

_layers = f.feed_layers(f.Duck)
table("feed_0", f"SELECT {_layers[0]} FROM events")
for _i, _layer in enumerate(_layers[1:], 1):
    _name = "feed_v" if _i == len(_layers) - 1 else f"feed_{_i}"
    table(_name, f"SELECT {_layer} FROM feed_{_i - 1}")
table(
    "msg",
    f"SELECT *, md5(raw_message) AS message_id, CASE WHEN has_pid THEN {n('pid')} END AS pat, "
    f"{n('sfac')} AS sending_facility, mtype AS message_type, trig AS trigger_event, t AS parsed_at "
    f"FROM (SELECT *, {f.raw_message(f.Duck)} AS raw_message FROM feed_v)",
)

# --- segment tables -----------------------------------------------------------

table(
    "raw_msh",
    f"SELECT message_id, app AS sending_application, sending_facility, 'LAB' AS receiving_application, "
    f"'HUB' AS receiving_facility, msg_at AS message_datetime, message_type, trigger_event, "
    f"{n('ctl')} AS message_control_id, 'P' AS processing_id, ver AS version_id, parsed_at FROM msg",
)
table("t_msh", "SELECT * FROM raw_msh WHERE message_control_id IS NOT NULL")
_pid_cols = ", ".join(
    f"{n(expr)} AS {name}"
    for name, expr in {
        "patient_id": "pid",
        "patient_id_authority": "auth",
        "patient_name_family": "fam",
        "patient_name_given": "giv",
        "patient_name_middle": "mid",
        "date_of_birth": "dob",
        "sex": "sex",
        "race": "race",
        "address_street": "street",
        "address_city": "city",
        "address_state": "state",
        "address_zip": "zip",
        "phone_home": "phone",
        "marital_status": "marital",
        "patient_account_number": "acct",
    }.items()
)
table(
    "raw_pid",
    f"SELECT message_id, {_pid_cols}, message_type, sending_facility, parsed_at FROM msg WHERE has_pid",
)
table("t_pid", "SELECT * FROM raw_pid WHERE patient_id IS NOT NULL")
_pv1_cols = ", ".join(
    f"{expr if name == 'attending_doctor_name' else n(expr)} AS {name}"
    for name, expr in {
        "patient_class": "cls",
        "location_point_of_care": "poc",
        "location_room": "room",
        "location_bed": "bed",
        "location_facility": "fac",
        "admission_type": "adm",
        "attending_doctor_id": "doc",
        "attending_doctor_name": "CASE WHEN doc_giv = '' THEN doc_fam ELSE doc_giv || ' ' || doc_fam END",
        "hospital_service": "svc",
        "admit_source": "src",
        "visit_number": "visit",
        "admit_datetime": "admit",
        "discharge_datetime": "discharge",
    }.items()
)
table(
    "t_pv1",
    f"SELECT message_id, pat AS patient_id, {_pv1_cols}, message_type, trigger_event, sending_facility, "
    "parsed_at, admit_at, discharge_at, fin, dispo FROM msg WHERE NOT oru",
)
table(
    "t_evn",
    "SELECT message_id, pat AS patient_id, trig AS event_type_code, msg_at AS recorded_datetime, "
    "CAST(NULL AS VARCHAR) AS planned_event_datetime, CAST(NULL AS VARCHAR) AS event_reason_code, "
    "'OP' || CAST(event_id % 5 AS VARCHAR) AS operator_id, msg_at AS event_occurred, "
    "message_type, trigger_event, sending_facility, parsed_at FROM msg WHERE NOT oru",
)


def _repeat(name, count, cols, where="TRUE"):
    picked = ", ".join(f"{n('(' + expr.format(i='i') + ')')} AS {col}" for col, expr in cols.items())
    table(
        name,
        f"SELECT message_id, pat AS patient_id, CAST(i + 1 AS INTEGER) AS set_id, {picked}, "
        f"message_type, sending_facility, parsed_at FROM msg, (VALUES (0), (1), (2)) AS r(i) "
        f"WHERE i < {count} AND {where}",
    )


_repeat("raw_obx", "n_obx", f.OBX)
_repeat("raw_dg1", "n_dg1", f.DG1)
_repeat("t_obx", "n_obx", f.OBX, f"{f.OBX['observation_id'].format(i='i')} <> ''")
_repeat("t_dg1", "n_dg1", f.DG1, f"{f.DG1['diagnosis_code'].format(i='i')} <> ''")
_repeat("t_al1", "n_al1", f.AL1)
_repeat("t_in1", "n_in1", f.IN1)
_repeat("t_nk1", "n_nk1", f.NK1)
_repeat(
    "t_orc", "n_orc", {k: v.replace("'1^once'", "'1'") for k, v in f.ORC.items()}
)
_repeat("t_obr0", "n_obr", f.OBR)
table(
    "t_obr",
    "SELECT * EXCLUDE (ordering_provider_family, ordering_provider_given), "
    "concat_ws(' ', ordering_provider_given, ordering_provider_family) AS ordering_provider_name FROM t_obr0",
)

# --- facts --------------------------------------------------------------------

_tail = "message_id, sending_facility AS source_system, parsed_at AS created_at"
_head = "md5(patient_id) AS patient_key, patient_id"
table(
    "enc_all",
    "SELECT md5(concat_ws('|', message_id, patient_id, visit_number)) AS encounter_key, "
    f"{_head}, visit_number, patient_class, CASE patient_class WHEN 'I' THEN 'Inpatient' "
    "WHEN 'O' THEN 'Outpatient' WHEN 'E' THEN 'Emergency' WHEN 'P' THEN 'Preadmit' ELSE patient_class END "
    "AS patient_class_desc, admission_type, admit_source, location_facility, location_point_of_care, "
    "location_room, location_bed, hospital_service, attending_doctor_id, attending_doctor_name, "
    f"admit_datetime, discharge_datetime, message_type, trigger_event, {_tail}, admit_at, discharge_at, "
    "CASE WHEN coalesce(patient_class, '') = 'E' OR upper(coalesce(location_point_of_care, '')) LIKE '%ED%' "
    "OR upper(coalesce(location_point_of_care, '')) LIKE '%ER%' "
    "OR upper(coalesce(location_point_of_care, '')) LIKE '%EMER%' THEN 'ED' "
    "WHEN upper(coalesce(location_point_of_care, '')) LIKE '%ICU%' OR upper(coalesce(hospital_service, '')) "
    "IN ('ICU', 'CCU', 'MICU', 'SICU', 'NICU', 'PICU') THEN 'ICU' ELSE 'OTHER' END AS department "
    "FROM t_pv1",
)
table("enc", "SELECT * EXCLUDE (admit_at, discharge_at, department) FROM enc_all")
table(
    "obs",
    "SELECT md5(concat_ws('|', message_id, observation_id, set_id)) AS observation_key, "
    f"{_head}, observation_id, observation_text, value_type, observation_value AS observation_value_text, "
    "CASE WHEN value_type = 'NM' THEN TRY_CAST(regexp_extract(observation_value, '^-?[0-9.]+') AS DOUBLE) END "
    "AS observation_value_numeric, units, reference_range, abnormal_flags, "
    "coalesce(abnormal_flags IN ('H', 'HH', 'L', 'LL', 'A', 'AA', 'C'), FALSE) AS is_abnormal, "
    f"result_status AS observation_result_status, observation_datetime, {_tail} FROM t_obx",
)
table(
    "dx",
    f"SELECT md5(concat_ws('|', message_id, diagnosis_code, set_id)) AS diagnosis_key, {_head}, diagnosis_code, "
    "diagnosis_description, diagnosis_coding_system, diagnosis_datetime, diagnosis_type, diagnosis_priority, "
    f"{_tail} FROM t_dg1",
)
table(
    "alg",
    f"SELECT md5(concat_ws('|', message_id, allergen_code, set_id)) AS allergy_key, {_head}, allergen_type_code, "
    "allergen_type_text, allergen_code, allergen_description, severity_code, severity_text, "
    f"coalesce(severity_code IN ('SV', 'SE'), FALSE) AS is_severe, reaction, identification_date, {_tail} FROM t_al1",
)
table(
    "ord",
    "SELECT md5(concat_ws('|', message_id, coalesce(placer_order_number, filler_order_number), set_id)) AS order_key, "
    f"{_head}, placer_order_number, filler_order_number, universal_service_id, universal_service_text, "
    "universal_service_coding_system, priority, requested_datetime, observation_datetime, "
    f"observation_end_datetime, ordering_provider_id, ordering_provider_name, result_status, {_tail} FROM t_obr",
)
table(
    "dim",
    "SELECT md5(concat_ws('|', patient_id, patient_id_authority)) AS patient_key, patient_id, patient_id_authority, "
    "concat_ws(' ', patient_name_given, patient_name_family) AS patient_name_full, patient_name_family, "
    "patient_name_given, date_of_birth, sex, race, "
    "concat_ws(', ', address_street, address_city, address_state, address_zip) AS address_full, address_city, "
    "address_state, address_zip, phone_home AS phone_primary, marital_status, first_seen_at, last_updated_at, "
    "sending_facility AS source_system FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, "
    "patient_id_authority ORDER BY parsed_at DESC, message_id DESC) AS rn, "
    "min(parsed_at) OVER (PARTITION BY patient_id, patient_id_authority) AS first_seen_at, "
    "max(parsed_at) OVER (PARTITION BY patient_id, patient_id_authority) AS last_updated_at FROM t_pid) WHERE rn = 1",
)
table(
    "metrics",
    "SELECT date_trunc('hour', parsed_at) AS processing_hour, message_type, sending_facility, count(*) AS message_count, "
    "count(DISTINCT message_control_id) AS unique_messages, min(parsed_at) AS first_message_at, "
    "max(parsed_at) AS last_message_at FROM t_msh GROUP BY ALL",
)
table(
    "activity",
    "SELECT CAST(created_at AS DATE) AS activity_date, location_facility, patient_class_desc, "
    "count(DISTINCT patient_id) AS unique_patients, count(*) AS encounter_count, "
    "count(DISTINCT attending_doctor_id) AS unique_providers FROM enc GROUP BY ALL",
)

# --- census -------------------------------------------------------------------


def _hourly(dept, arrive, leave):
    side = lambda events, ts, col: (
        f"SELECT date_trunc('hour', coalesce({ts}, created_at)) AS event_hour, location_facility, count(*) AS {col} "
        f"FROM enc_all WHERE department = '{dept}' AND trigger_event IN ({events}) GROUP BY ALL"
    )
    return (
        "SELECT event_hour, location_facility, coalesce(arrivals, 0) AS arrivals, coalesce(discharges, 0) AS discharges, "
        "coalesce(arrivals, 0) - coalesce(discharges, 0) AS net_change, CAST(hour(event_hour) AS INTEGER) AS hour_of_day, "
        "CAST(dayofweek(event_hour) + 1 AS INTEGER) AS day_of_week, "
        "CAST(dayofweek(event_hour) IN (0, 6) AS INTEGER) AS is_weekend FROM "
        f"({side(arrive, 'admit_at', 'arrivals')}) a FULL OUTER JOIN ({side(leave, 'discharge_at', 'discharges')}) d "
        "USING (event_hour, location_facility)"
    )


table("ed_hour", _hourly("ED", "'A01', 'A04', 'A02'", "'A03'"))
table("icu_hour", _hourly("ICU", "'A01', 'A02'", "'A03', 'A02'"))


def _daily(dept, arrive, leave, unit, secs, extra=""):
    los = f"((epoch(discharge_at) - epoch(admit_at)) / {secs}.0)"
    whole = "CAST(epoch(discharge_at) - epoch(admit_at) AS BIGINT)"
    avg = f"CAST(sum({whole}) AS DOUBLE) / count({whole}) / {secs}"
    base = (
        f"SELECT *, CAST(coalesce(admit_at, created_at) AS DATE) AS activity_date, "
        f"CAST(hour(coalesce(admit_at, created_at)) AS INTEGER) AS admit_hour FROM enc_all WHERE department = '{dept}'"
    )
    peak = (
        "SELECT activity_date, location_facility, admit_hour FROM (SELECT activity_date, location_facility, admit_hour, "
        "row_number() OVER (PARTITION BY activity_date, location_facility ORDER BY count(*) DESC, admit_hour) AS rn "
        f"FROM ({base}) GROUP BY activity_date, location_facility, admit_hour) WHERE rn = 1"
    )
    return (
        f"SELECT g.*, p.admit_hour AS peak_arrival_hour FROM (SELECT activity_date, location_facility, count(*) AS total_encounters, "
        f"count(*) FILTER (trigger_event IN ({arrive})) AS total_arrivals, "
        f"count(*) FILTER (trigger_event IN ({leave})) AS total_discharges, "
        f"count(DISTINCT patient_id) AS unique_patients, {rnd(avg, 1)} AS avg_los_{unit}, "
        f"{rnd(f'quantile_disc({los}, 0.5)', 1)} AS median_los_{unit}, max({los}) AS max_los_{unit}, "
        f"count(DISTINCT attending_doctor_id) AS unique_providers{extra} FROM ({base}) GROUP BY ALL) g "
        f"JOIN ({peak}) p ON g.activity_date = p.activity_date AND g.location_facility IS NOT DISTINCT FROM p.location_facility"
    )


table("ed_day", _daily("ED", "'A01', 'A04'", "'A03'", "minutes", 60))
table(
    "icu_day",
    _daily("ICU", "'A01', 'A02'", "'A03', 'A02'", "hours", 3600, ", count(DISTINCT location_bed) AS beds_used"),
)
table(
    "cur",
    "SELECT location_facility, department, coalesce(total_arrivals, 0) AS total_arrivals, "
    "coalesce(total_discharges, 0) AS total_discharges, coalesce(total_arrivals, 0) - coalesce(total_discharges, 0) "
    f"AS estimated_census, {NOW} AS snapshot_at FROM (SELECT location_facility, department, count(*) AS total_arrivals "
    "FROM enc_all WHERE trigger_event IN ('A01', 'A04', 'A02') GROUP BY ALL) FULL OUTER JOIN "
    "(SELECT location_facility, department, count(*) AS total_discharges FROM enc_all WHERE trigger_event = 'A03' "
    "GROUP BY ALL) USING (location_facility, department)",
)

# --- features -----------------------------------------------------------------

RANGE = "PARTITION BY location_facility ORDER BY epoch(event_hour) RANGE BETWEEN {s} PRECEDING AND CURRENT ROW"


def _features(src, dept):
    rows = "(PARTITION BY location_facility ORDER BY event_hour, arrivals, discharges)"
    span = lambda h: "(" + RANGE.format(s=h * 3600) + ")"
    lag = lambda c, ks: ", ".join(f"lag({c}, {k}) OVER {rows} AS {c}_lag_{k}h" for k in ks)
    roll = lambda c: ", ".join(
        f"CAST(sum({c}) OVER {span(h)} AS BIGINT) AS {c}_rolling_{k}"
        for k, h in (("6h", 6), ("12h", 12), ("24h", 24), ("7d", 168))
    )
    inner = (
        f"SELECT *, '{dept}' AS department, CAST(month(event_hour) AS INTEGER) AS month, "
        "CAST(day(event_hour) AS INTEGER) AS day_of_month, CAST(week(event_hour) AS INTEGER) AS week_of_year, "
        "CAST(hour_of_day >= 19 OR hour_of_day <= 6 AS INTEGER) AS is_night_shift, "
        "CAST((month(event_hour) = 12 AND day(event_hour) BETWEEN 24 AND 31) OR (month(event_hour) = 1 AND day(event_hour) = 1) "
        "OR (month(event_hour) = 7 AND day(event_hour) = 4) OR (month(event_hour) = 11 AND day(event_hour) BETWEEN 22 AND 28 "
        "AND day_of_week = 5) AS INTEGER) AS is_holiday_window, "
        f"{lag('arrivals', (1, 2, 4, 6, 12, 24, 168))}, {lag('discharges', (1, 2, 6, 12, 24, 168))}, "
        f"{lag('net_change', (1, 6, 24))}, {roll('arrivals')}, {roll('discharges')}, "
        f"avg(arrivals) OVER {span(6)} AS a6, avg(arrivals) OVER {span(24)} AS a24, "
        f"stddev_samp(arrivals) OVER {span(24)} AS s24, avg(discharges) OVER {span(24)} AS d24, "
        f"CAST(sum(net_change) OVER (PARTITION BY location_facility ORDER BY event_hour, arrivals, discharges "
        f"ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_net_census FROM {src}"
    )
    return (
        f"SELECT * EXCLUDE (a6, a24, s24, d24), {rnd('a6', 2)} AS arrivals_avg_6h, {rnd('a24', 2)} AS arrivals_avg_24h, "
        f"{rnd('s24', 2)} AS arrivals_std_24h, {rnd('d24', 2)} AS discharges_avg_24h, "
        f"CASE WHEN arrivals_lag_168h > 0 THEN {rnd('arrivals / arrivals_lag_168h', 2)} END AS arrivals_wow_ratio FROM ({inner})"
    )


table("ed_feat", _features("ed_hour", "ED"))
table("icu_feat", _features("icu_hour", "ICU"))


def _combined():
    side = lambda src, d: (
        f"SELECT event_hour, CAST(sum(arrivals) AS BIGINT) AS {d}_arrivals, CAST(sum(discharges) AS BIGINT) AS {d}_discharges, "
        f"CAST(sum(net_change) AS BIGINT) AS {d}_net_change FROM {src} GROUP BY ALL"
    )
    cols = [f"{d}_{c}" for d in ("ed", "icu") for c in ("arrivals", "discharges", "net_change")]
    both = (
        "SELECT event_hour, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols)
        + f" FROM ({side('ed_hour', 'ed')}) FULL OUTER JOIN ({side('icu_hour', 'icu')}) USING (event_hour)"
    )
    rows = "(ORDER BY event_hour)"
    day = "(ORDER BY epoch(event_hour) RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)"
    lags = ", ".join(
        f"lag({d}_arrivals, {k}) OVER {rows} AS {d}_arrivals_lag_{k}h" for d in ("ed", "icu") for k in (1, 24)
    )
    rolls = ", ".join(
        f"CAST(sum({c}) OVER {day} AS BIGINT) AS {c}_rolling_24h"
        for c in ("ed_arrivals", "icu_arrivals", "ed_discharges", "icu_discharges")
    )
    return (
        "SELECT *, CAST(hour(event_hour) AS INTEGER) AS hour_of_day, CAST(dayofweek(event_hour) + 1 AS INTEGER) AS day_of_week, "
        "CAST(dayofweek(event_hour) IN (0, 6) AS INTEGER) AS is_weekend, CAST(month(event_hour) AS INTEGER) AS month, "
        "ed_arrivals + icu_arrivals AS total_arrivals, ed_discharges + icu_discharges AS total_discharges, "
        f"{lags}, {rolls}, CASE WHEN icu_arrivals > 0 THEN {rnd('ed_arrivals / icu_arrivals', 2)} END AS ed_to_icu_ratio, "
        f"ed_net_change + icu_net_change AS net_system_pressure FROM ({both})"
    )


table("comb", _combined())

# --- predictions --------------------------------------------------------------

HORIZONS = "(VALUES (1), (4), (8), (24)) AS z(h)"


def predicted(points: str, ident: str = "prediction_id") -> str:
    """The 17 prediction columns from points with model columns, value and spread."""
    margin = "spread * (1 + h::DOUBLE * 0.1::DOUBLE) * 1.96::DOUBLE"
    return (
        f"SELECT {ident} AS prediction_id, model_name, model_version, department, location_facility, forecast_generated_at, "
        "target_metric, CAST(h AS INTEGER) AS forecast_horizon_hours, feature_snapshot_hour + to_hours(h) AS target_hour, "
        f"{rnd('greatest(0.0::DOUBLE, prediction)', 2)} AS predicted_value, "
        f"{rnd(f'greatest(0.0::DOUBLE, prediction - {margin})', 2)} AS prediction_lower_bound, "
        f"{rnd(f'prediction + {margin}', 2)} AS prediction_upper_bound, "
        f"{rnd('greatest(0.5::DOUBLE, 1 - h::DOUBLE * 0.02::DOUBLE)', 3)} AS confidence_level, feature_snapshot_hour, "
        "CAST(NULL AS DOUBLE) AS actual_value, CAST(NULL AS DOUBLE) AS absolute_error, "
        f"forecast_generated_at AS created_at FROM ({points}), {HORIZONS}"
    )


def _points():
    """One point per census hour: a naive forecast from the last day's mean."""
    dept = lambda feat, model, metric, d, value: (
        f"SELECT '{model}' AS model_name, '1' AS model_version, '{d}' AS department, "
        f"coalesce(location_facility, 'None') AS location_facility, event_hour AS forecast_generated_at, "
        f"'{metric}' AS target_metric, event_hour AS feature_snapshot_hour, {value} AS prediction, "
        f"coalesce(arrivals_std_24h, 0.0)::DOUBLE AS spread, arrivals AS n_a, discharges AS n_d FROM {feat}"
    )
    return " UNION ALL ".join(
        [
            dept("ed_feat", "ed_arrivals_forecast", "arrivals", "ED", "arrivals_avg_24h"),
            dept("ed_feat", "ed_discharges_forecast", "discharges", "ED", "discharges_avg_24h"),
            dept("icu_feat", "icu_arrivals_forecast", "arrivals", "ICU", "arrivals_avg_24h - 0.75::DOUBLE"),
            "SELECT 'combined_arrivals_forecast', '1', 'ALL', 'ALL', event_hour, 'total_arrivals', event_hour, "
            "ed_arrivals_rolling_24h / 25.0::DOUBLE, 1.5::DOUBLE, total_arrivals, total_discharges FROM comb",
        ]
    )


IDENT = (
    "md5(concat_ws('|', model_name, location_facility, strftime(feature_snapshot_hour, '%Y%m%d%H'), "
    "CAST(h AS VARCHAR), CAST(n_a AS VARCHAR), CAST(n_d AS VARCHAR)))"
)
table("pred_open", predicted(_points(), IDENT))
table(
    "actuals",
    "SELECT event_hour, department, CAST(sum(arrivals) AS BIGINT) AS actual_arrivals, "
    "CAST(sum(discharges) AS BIGINT) AS actual_discharges FROM (SELECT *, 'ED' AS department FROM ed_hour UNION ALL "
    "SELECT *, 'ICU' FROM icu_hour UNION ALL SELECT *, 'ALL' FROM ed_hour UNION ALL SELECT *, 'ALL' FROM icu_hour) GROUP BY ALL",
)
table(
    "pred",
    "SELECT p.* EXCLUDE (actual_value, absolute_error, actual), actual AS actual_value, "
    f"CASE WHEN actual IS NOT NULL THEN {rnd('abs(predicted_value - actual)', 2)} END AS absolute_error FROM "
    "(SELECT p.*, CAST(CASE target_metric WHEN 'discharges' THEN a.actual_discharges ELSE a.actual_arrivals END AS DOUBLE) AS actual "
    "FROM pred_open p LEFT JOIN actuals a ON date_trunc('hour', p.target_hour) = a.event_hour AND p.department = a.department) p",
)
_pct = rnd("abs(predicted_value - actual_value) / actual_value * 100", 2)
table(
    "acc",
    "SELECT CAST(target_hour AS DATE) AS prediction_date, model_name, model_version, department, target_metric, "
    f"forecast_horizon_hours, count(*) AS prediction_count, {rnd(mean('absolute_error'), 2)} AS mae, "
    f"{rnd(mean('absolute_error * absolute_error'), 2)} AS mse, "
    f"{rnd(mean(f'CASE WHEN actual_value > 0 THEN {_pct} END'), 2)} AS mape, "
    f"{rnd('avg(CASE WHEN actual_value >= prediction_lower_bound AND actual_value <= prediction_upper_bound THEN 1 ELSE 0 END) * 100', 1)} "
    "AS coverage_pct FROM pred WHERE actual_value IS NOT NULL GROUP BY ALL",
)
