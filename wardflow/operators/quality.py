"""Declarative row rules: warn, drop, fail, quarantine and report."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardflow.functions.values import hl7_ts

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    constraint: str
    action: str = WARN
    tags: tuple[str, ...] = ()


# The rule catalog, by segment.
RULES = {
    "MSH": [
        Rule("msh_message_type_not_null", "tells which kind of event a message reports",
             "message_type IS NOT NULL", DROP, ("required", "msh")),
        Rule("msh_control_id_not_null", "identifies a message to its sender",
             "message_control_id IS NOT NULL", DROP, ("required", "msh")),
        Rule("msh_sending_facility_not_null", "needed to attribute a message to a site",
             "sending_facility IS NOT NULL", WARN, ("recommended", "msh")),
        Rule("msh_valid_version", "only the pipe-delimited family is read",
             "version_id LIKE '2.%'", WARN, ("format", "msh")),
        Rule("msh_datetime_not_future", "a sender's clock that runs ahead",
             "message_datetime <= current_timestamp()", WARN, ("temporal", "msh")),
    ],
    "PID": [
        Rule("pid_patient_id_not_null", "rows without it join to nobody",
             "patient_id IS NOT NULL AND patient_id != ''", DROP, ("required", "pid")),
        Rule("pid_patient_name_not_null", "family or given name, either will do",
             "patient_name_family IS NOT NULL OR patient_name_given IS NOT NULL",
             WARN, ("recommended", "pid")),
        Rule("pid_valid_sex", "one-letter administrative code, or none",
             "sex IS NULL OR sex IN ('M', 'F', 'U', 'O', 'A', 'N')", WARN, ("format", "pid")),
        Rule("pid_dob_not_future", "born by today",
             "date_of_birth IS NULL OR date_of_birth <= current_date()",
             WARN, ("temporal", "pid")),
        Rule("pid_dob_reasonable", "nobody is older than 54 750 days",
             "date_of_birth IS NULL OR date_of_birth >= date_sub(current_date(), 54750)",
             WARN, ("temporal", "pid")),
        Rule("pid_valid_zip_format", "five digits, four more after a dash",
             "address_zip IS NULL OR address_zip RLIKE '^[0-9]{5}(-[0-9]{4})?$'",
             WARN, ("format", "pid")),
    ],
    "PV1": [
        Rule("pv1_patient_class_not_null", "inpatient, outpatient and so on",
             "patient_class IS NOT NULL", WARN, ("recommended", "pv1")),
        Rule("pv1_valid_patient_class", "one-letter visit class, or none",
             "patient_class IS NULL OR patient_class IN "
             "('I', 'O', 'E', 'P', 'R', 'B', 'C', 'N', 'U')", WARN, ("format", "pv1")),
        Rule("pv1_admit_before_discharge", "nobody leaves before coming",
             "discharge_datetime IS NULL OR admit_datetime IS NULL "
             "OR admit_datetime <= discharge_datetime", WARN, ("temporal", "pv1")),
        Rule("pv1_admit_not_future", "planned stays do not count as admissions",
             "admit_datetime IS NULL OR admit_datetime <= current_timestamp()",
             WARN, ("temporal", "pv1")),
    ],
    "OBX": [
        Rule("obx_observation_id_not_null", "a result without it cannot be named",
             "observation_id IS NOT NULL AND observation_id != ''", DROP, ("required", "obx")),
        Rule("obx_value_type_not_null", "says how to read the value",
             "value_type IS NOT NULL", WARN, ("recommended", "obx")),
        Rule("obx_valid_value_type", "one of the types that results come in",
             "value_type IS NULL OR value_type IN "
             "('NM', 'ST', 'TX', 'CE', 'DT', 'TM', 'TS', 'FT', 'ED', 'SN', 'CWE')",
             WARN, ("format", "obx")),
        Rule("obx_numeric_has_units", "a bare number means nothing",
             "value_type != 'NM' OR units IS NOT NULL", WARN, ("completeness", "obx")),
        Rule("obx_valid_result_status", "final, preliminary, corrected and the like",
             "observation_result_status IS NULL OR observation_result_status IN "
             "('C', 'D', 'F', 'I', 'N', 'O', 'P', 'R', 'S', 'U', 'W', 'X')",
             WARN, ("format", "obx")),
    ],
    "DG1": [
        Rule("dg1_code_not_null", "a diagnosis without it cannot be counted",
             "diagnosis_code IS NOT NULL AND diagnosis_code != ''", DROP, ("required", "dg1")),
        Rule("dg1_valid_coding_system", "codes repeat across systems",
             "diagnosis_coding_system IS NOT NULL", WARN, ("recommended", "dg1")),
        Rule("dg1_icd10_format", "letter, two digits, up to four places after a point",
             "diagnosis_coding_system != 'ICD10' OR "
             r"diagnosis_code RLIKE '^[A-Z][0-9]{2}(\\.[0-9A-Z]{1,4})?$'",
             WARN, ("format", "dg1")),
    ],
}

# The rules the pipeline itself applies, by table.
PIPELINE_RULES = {
    "messages": [Rule("valid_hl7_start", "", "raw_message LIKE 'MSH|%'", DROP)],
    "MSH": [
        Rule("msh_message_type_not_null", "", "message_type IS NOT NULL", DROP),
        Rule("msh_control_id_not_null", "", "message_control_id IS NOT NULL", DROP),
        Rule("msh_sending_facility_not_null", "", "sending_facility IS NOT NULL"),
    ],
    "PID": [
        Rule("pid_patient_id_not_null", "", "patient_id IS NOT NULL AND patient_id != ''", DROP),
        Rule("pid_patient_name_present", "",
             "patient_name_family IS NOT NULL OR patient_name_given IS NOT NULL"),
        Rule("pid_valid_sex", "", "sex IS NULL OR sex IN ('M', 'F', 'U', 'O', 'A', 'N')"),
    ],
    "PV1": [
        Rule("pv1_patient_class_present", "", "patient_class IS NOT NULL"),
        Rule("pv1_valid_patient_class", "",
             "patient_class IS NULL OR patient_class IN "
             "('I', 'O', 'E', 'P', 'R', 'B', 'C', 'N', 'U')"),
    ],
    "OBR": [
        Rule("obr_order_number_present", "",
             "placer_order_number IS NOT NULL OR filler_order_number IS NOT NULL"),
    ],
    "OBX": [
        Rule("obx_observation_id_not_null", "",
             "observation_id IS NOT NULL AND observation_id != ''", DROP),
        Rule("obx_value_type_present", "", "value_type IS NOT NULL"),
    ],
    "DG1": [
        Rule("dg1_code_not_null", "", "diagnosis_code IS NOT NULL AND diagnosis_code != ''", DROP),
    ],
}

# Text timestamps that rules compare with the clock or with each other.
TEMPORAL = ("message_datetime", "date_of_birth", "admit_datetime", "discharge_datetime")


def rules_for(segment: str, as_of: str | None = None) -> list[Rule]:
    """Catalog rules of a segment; ``as_of`` stands in for the clock."""
    rules = RULES[segment]
    if as_of is None:
        return list(rules)
    moment, day = f"TIMESTAMP'{as_of}'", f"DATE'{as_of[:10]}'"
    return [
        replace(
            r,
            constraint=r.constraint.replace("current_timestamp()", moment).replace("current_date()", day),
        )
        for r in rules
    ]


def rules_by(action: str | None = None, tag: str | None = None) -> list[Rule]:
    """Catalog rules with an action and/or a tag."""
    return [
        r
        for rules in RULES.values()
        for r in rules
        if (action is None or r.action == action) and (tag is None or tag in r.tags)
    ]


def as_expectations(rules: list[Rule]) -> dict[str, str]:
    return {r.name: r.constraint for r in rules}


def _passes(rule: Rule) -> Column:
    """A warning is raised only on FALSE; a row is kept only on TRUE."""
    held = F.expr(rule.constraint)
    return F.coalesce(held, F.lit(rule.action == WARN))


def _checked(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The row as ``row`` plus one boolean per rule (``ok_<name>``).

    Timestamps kept as text are compared as timestamps, and a result status goes
    by its gold name too.
    """
    typed = [
        (hl7_ts(c) if kind == "string" and c in TEMPORAL else F.col(c)).alias(c)
        for c, kind in df.dtypes
    ]
    if "observation_result_status" not in df.columns and "result_status" in df.columns:
        typed.append(F.col("result_status").alias("observation_result_status"))
    wide = df.select(F.struct(*df.columns).alias("row"), *typed)
    return wide.select("row", *[_passes(r).alias(f"ok_{r.name}") for r in rules])


def apply_rules(df: DataFrame, rules: list[Rule], name: str | None = None):
    """Apply all rules: ``(rows kept, observation of failures per rule)``.

    The observation fills in when an action runs over the returned frame. A FAIL
    rule stops the job at the first bad row. Streams need ``name`` (the metric's
    name in the query progress) and get None in place of an observation.
    """
    checked = _checked(df, rules)
    failed = [F.sum(F.when(F.col(f"ok_{r.name}"), 0).otherwise(1)).alias(r.name) for r in rules]
    counts = [F.count(F.lit(1)).alias("rows"), *failed]
    if df.isStreaming:
        seen, watched = None, checked.observe(name, *counts)
    else:
        seen = Observation(name) if name else Observation()
        watched = checked.observe(seen, *counts)
    for rule in rules:
        ok = F.col(f"ok_{rule.name}")
        if rule.action == DROP:
            watched = watched.where(ok)
        elif rule.action == FAIL:
            watched = watched.where(ok | F.raise_error(F.lit(f"rule {rule.name} violated")).cast("boolean"))
    return watched.select("row.*"), seen


def broken(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break one of the drop rules, judged by the columns as they are.

    The filter runs before the other columns of a segment table are cut, which ``quarantine`` needs all of.
    """
    return df.where(reduce(or_, [~_passes(r) for r in rules]))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(good rows, bad rows with the names of the rules they broke)``."""
    checked = _checked(df, rules)
    names = F.array_compact(
        F.array(*[F.when(~F.col(f"ok_{r.name}"), F.lit(r.name)) for r in rules])
    )
    marked = checked.select("row", names.alias("failed_rules"))
    good = marked.where(F.size("failed_rules") == 0).select("row.*")
    bad = marked.where(F.size("failed_rules") > 0).select("row.*", "failed_rules")
    return good, bad


def rule_report(df: DataFrame, rules: list[Rule], segment: str = "") -> DataFrame:
    """Rows, failures and failure rate per rule, from one pass."""
    checked = _checked(df, rules)
    totals = checked.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~F.col(f"ok_{r.name}")).alias(r.name) for r in rules],
    )
    per_rule = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(segment).alias("segment"),
                    F.lit(r.name).alias("rule"),
                    F.lit(r.action).alias("action"),
                    F.col("rows").alias("rows_checked"),
                    F.col(r.name).alias("failures"),
                )
                for r in rules
            ]
        )
    )
    out = totals.select(per_rule.alias("r")).select("r.*")
    return out.withColumn("failure_rate", F.try_divide(F.col("failures"), F.col("rows_checked")))
