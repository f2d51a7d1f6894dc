"""One flat table per segment type.

A table is described by its layout: output column, then field and component. All
values stay text. Columns marked ``wide`` come on request.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import first_line, line_field, segment_lines
from wardflow.operators.messages import with_headers
from wardflow.operators.quality import DROP, PIPELINE_RULES


@dataclass(frozen=True)
class Layout:
    """Columns as ``name field[.component]``; ``+`` joins two with a blank.

    A field without a component gives its first component (``wide`` columns: the
    whole field as written). ``repeats`` tables have one row per line.
    """

    columns: str
    wide: str = ""
    repeats: bool = False
    carries: tuple[str, ...] = ("message_type", "sending_facility", "parsed_at")


# Columns and field positions of the segment tables.
LAYOUTS = {
    "MSH": Layout(
        """sending_application 3, sending_facility 4, receiving_application 5,
        receiving_facility 6, message_datetime 7, message_type 9.1, trigger_event 9.2,
        message_control_id 10, processing_id 11, version_id 12""",
        wide="encoding_characters 2, security 8",
        carries=("parsed_at",),
    ),
    "PID": Layout(
        """patient_id 3.1, patient_id_authority 3.4, patient_name_family 5.1,
        patient_name_given 5.2, patient_name_middle 5.3, date_of_birth 7, sex 8, race 10,
        address_street 11.1, address_city 11.3, address_state 11.4, address_zip 11.5,
        phone_home 13, marital_status 16, patient_account_number 18""",
        wide="""set_id 1, patient_id_external 2, alternate_patient_id 4,
        patient_name_suffix 5.4, patient_alias 9, address_country 11.6, phone_business 14,
        language 15, religion 17, ssn 19, drivers_license 20, ethnicity 22,
        death_indicator 30""",
    ),
    "PV1": Layout(
        """patient_class 2, location_point_of_care 3.1, location_room 3.2, location_bed 3.3,
        location_facility 3.4, admission_type 4, attending_doctor_id 7.1,
        attending_doctor_name 7.3+7.2, hospital_service 10, admit_source 14,
        visit_number 19, admit_datetime 44, discharge_datetime 45""",
        wide="""set_id 1, preadmit_number 5, prior_location 6, attending_doctor_family 7.2,
        attending_doctor_given 7.3, readmission_indicator 13, ambulatory_status 15,
        vip_indicator 16, admitting_doctor 17, patient_type 18, financial_class 20,
        discharge_disposition 36""",
        carries=("message_type", "trigger_event", "sending_facility", "parsed_at"),
    ),
    "EVN": Layout(
        """event_type_code 1, recorded_datetime 2, planned_event_datetime 3,
        event_reason_code 4, operator_id 5, event_occurred 6""",
        carries=("message_type", "trigger_event", "sending_facility", "parsed_at"),
    ),
    "OBR": Layout(
        """placer_order_number 2, filler_order_number 3, universal_service_id 4.1,
        universal_service_text 4.2, universal_service_coding_system 4.3, priority 5,
        requested_datetime 6, observation_datetime 7, observation_end_datetime 8,
        ordering_provider_id 16.1, ordering_provider_name 16.3+16.2, result_status 25""",
        wide="""collection_volume 9, collector_identifier 10, specimen_action_code 11,
        ordering_provider_family 16.2, ordering_provider_given 16.3, reason_for_study 31""",
        repeats=True,
    ),
    "OBX": Layout(
        """value_type 2, observation_id 3.1, observation_text 3.2,
        observation_coding_system 3.3, observation_sub_id 4, observation_value 5, units 6,
        reference_range 7, abnormal_flags 8, result_status 11, observation_datetime 14,
        producer_id 15""",
        wide="probability 9, nature_of_abnormal_test 10, responsible_observer 16",
        repeats=True,
    ),
    "DG1": Layout(
        """diagnosis_coding_method 2, diagnosis_code 3.1, diagnosis_description 3.2,
        diagnosis_coding_system 3.3, diagnosis_datetime 5, diagnosis_type 6,
        diagnosis_priority 15""",
        wide="""major_diagnostic_category 7, diagnostic_related_group 8,
        drg_approval_indicator 9, drg_grouper_review_code 10, diagnosing_clinician 16""",
        repeats=True,
    ),
    "AL1": Layout(
        """allergen_type_code 2.1, allergen_type_text 2.2, allergen_code 3.1,
        allergen_description 3.2, severity_code 4.1, severity_text 4.2, reaction 5,
        identification_date 6""",
        repeats=True,
    ),
    "IN1": Layout(
        """insurance_plan_id 2, insurance_company_id 3, insurance_company_name 4,
        group_number 8, group_name 9, plan_effective_date 12, plan_expiration_date 13,
        plan_type 15, insured_name_family 16.1, insured_name_given 16.2,
        insured_relationship 17, policy_number 36""",
        wide="""insurance_company_address 5, insurance_company_contact 6,
        insured_group_emp_id 10, insured_group_emp_name 11, authorization_info 14,
        insured_dob 18""",
        repeats=True,
    ),
    "NK1": Layout(
        """name_family 2.1, name_given 2.2, relationship 3, address_street 4.1,
        address_city 4.3, address_state 4.4, address_zip 4.5, phone_home 5,
        phone_business 6, contact_role 7""",
        repeats=True,
    ),
    "ORC": Layout(
        """order_control 1, placer_order_number 2, filler_order_number 3,
        placer_group_number 4, order_status 5, response_flag 6, quantity_timing 7,
        parent_order 8, transaction_datetime 9, entered_by 10, verified_by 11,
        ordering_provider_id 12.1, ordering_provider_family 12.2,
        ordering_provider_given 12.3, enterer_location 13, order_effective_datetime 15""",
        repeats=True,
    ),
}

# Tables the streaming job and the gold layer keep.
SILVER = ("MSH", "PID", "PV1", "EVN", "OBR", "OBX", "DG1", "AL1", "IN1")


def _pick(parts: Column, place: str, header: bool, whole: bool) -> Column:
    if "+" in place:
        return F.concat_ws(" ", *[_pick(parts, p, header, whole) for p in place.split("+")])
    number, _, comp = place.partition(".")
    return line_field(parts, int(number), int(comp) if comp else (0 if whole else 1), header)


# Columns that the message row already has, by the table they belong to.
HEADERS = {
    "MSH": ("message_type", "trigger_event", "sending_facility", "message_control_id"),
    "PID": ("patient_id",),
}


def layout_columns(kind: str, parts: Column, wide: bool = False, known=()) -> list[Column]:
    """Output columns of a segment type from a line split at ``|``.

    Columns in ``known`` are taken from the row as they are, which also lets a
    drop rule on them run before the line is cut up.
    """
    layout = LAYOUTS[kind]
    out = []
    for text, whole in ((layout.columns, False), (layout.wide if wide else "", True)):
        for item in filter(None, (x.split() for x in text.split(","))):
            name, place = item
            value = F.col(name) if name in known else _pick(parts, place, kind == "MSH", whole)
            out.append(value.alias(name))
    return out


def segment_table(df: DataFrame, kind: str, wide: bool = False, rule: bool = True) -> DataFrame:
    """The table of one segment type from message rows.

    Takes ``message_id, raw_message, parsed_at`` (header columns are added when
    missing). Only messages that hold the segment are cut up. ``rule`` applies
    the pipeline's drop rules; pass False to keep rejects for a quarantine.
    """
    layout = LAYOUTS[kind]
    if "message_control_id" not in df.columns:
        df = with_headers(df)
    raw = F.col("raw_message")
    rows = df if kind == "MSH" else df.where(raw.contains("\r" + kind))
    own = {c for c, *_ in (x.split() for x in layout.columns.split(","))}
    lead = ["message_id"] + [c for c in ("patient_id",) if c not in own and kind != "MSH"]
    carried = [c for c in layout.carries if c not in own]
    known: tuple[str, ...] = ()
    if layout.repeats:
        rows = rows.select(
            *lead, *carried, F.posexplode(segment_lines(raw, kind)).alias("__pos", "__line")
        )
        lead = [*lead, (F.col("__pos") + 1).alias("set_id")]
        line = F.col("__line")
    else:
        known = HEADERS.get(kind, ())
        rows = rows.select(*lead, *carried, *known, first_line(raw, kind).alias("__line"))
        line = F.col("__line")
    rows = rows.withColumn("__parts", F.split(line, r"\|"))
    table = rows.select(*lead, *layout_columns(kind, F.col("__parts"), wide, known), *carried)
    drops = [r.constraint for r in PIPELINE_RULES.get(kind, []) if r.action == DROP] if rule else []
    for constraint in drops:
        table = table.where(constraint)
    return table


def silver_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All kept segment tables of a frame of message rows."""
    headed = with_headers(df)
    return {kind: segment_table(headed, kind) for kind in SILVER}
