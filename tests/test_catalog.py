"""Registered queries against their SQL, at the smallest scale.

A few per family run here; ``python -m checks.compare`` runs all of them.
"""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

NAMES = """M1_split_files M2_messages M4_parsed_map M6_M10_segment_rows G1_hl7_parsed G3_pid G4_pv1 G7_obx
Q2_Q9_rule_report Q8_quarantine_bad P9_label_blank P10_classify_department J1_merge_counts_hour_facility
J6_daily_comparison J7_S10_update_by_key K2_observation_fact A1_patient_dim A2_message_metrics
A4_ed_hourly_census A7_icu_daily_summary A8_department_census_current A9_F12_forecast_accuracy
A17_T2_top_diagnoses A28_status_board A42_adt_rows A49_digest A55_weekly_heatmap W7_system_windows
W10_running_net F2_ed_forecast_features F3_combined_features F10_prediction_rows T8_predicted_vs_actual
U1_hourly_all X13_reference_range X15_age Z3_sql_functions S15_snapshot_changes""".split()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, con, name):
    assert compare(spark, con, sf, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_flagship_runs(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and rows.columns[:2] == ["event_hour", "location_facility"]


def test_no_query_goes_without_sql():
    assert set(entry.queries()) - set(entry.CORPUS) <= set(entry.oracle_sql())
