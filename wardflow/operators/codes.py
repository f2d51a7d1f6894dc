"""Code sets as small tables, and labelling by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code sets by name.
CODES = {
    "message_types": {
        "ADT^A01": "Admit/Visit Notification",
        "ADT^A02": "Transfer a Patient",
        "ADT^A03": "Discharge/End Visit",
        "ADT^A04": "Register a Patient",
        "ADT^A05": "Pre-admit a Patient",
        "ADT^A06": "Change Outpatient to Inpatient",
        "ADT^A07": "Change Inpatient to Outpatient",
        "ADT^A08": "Update Patient Information",
        "ADT^A11": "Cancel Admit",
        "ADT^A12": "Cancel Transfer",
        "ADT^A13": "Cancel Discharge",
        "ORU^R01": "Unsolicited Observation Result",
        "ORM^O01": "Order Message",
        "SIU^S12": "Notification of New Appointment Booking",
        "SIU^S14": "Notification of Appointment Modification",
        "SIU^S15": "Notification of Appointment Cancellation",
    },
    "value_types": {
        "NM": "Numeric",
        "ST": "String Data",
        "TX": "Text Data",
        "CE": "Coded Element",
        "DT": "Date",
        "TM": "Time",
        "TS": "Timestamp",
        "FT": "Formatted Text",
        "ED": "Encapsulated Data",
        "SN": "Structured Numeric",
        "CWE": "Coded with Exceptions",
    },
    "patient_class": {
        "I": "Inpatient",
        "O": "Outpatient",
        "E": "Emergency",
        "P": "Preadmit",
        "R": "Recurring Patient",
        "B": "Obstetrics",
        "C": "Commercial Account",
        "N": "Not Applicable",
        "U": "Unknown",
    },
    "result_status": {
        "C": "Correction",
        "D": "Deleted",
        "F": "Final",
        "I": "In Process",
        "N": "Not Asked",
        "O": "Order Received",
        "P": "Preliminary",
        "R": "Results Entered",
        "S": "Partial Results",
        "U": "Status Changed to Final",
        "W": "Original Posted as Wrong",
        "X": "Cannot Obtain",
    },
    "abnormal_flags": {
        "L": "Below Low Normal",
        "H": "Above High Normal",
        "LL": "Below Lower Panic Limit",
        "HH": "Above Upper Panic Limit",
        "N": "Normal",
        "A": "Abnormal",
        "AA": "Very Abnormal",
        "U": "Significant Change Up",
        "D": "Significant Change Down",
        "B": "Better",
        "W": "Worse",
    },
}


def code_table(spark: SparkSession, name: str) -> DataFrame:
    """``code, meaning`` of a code set; message types are coded ``TYPE^EVENT``."""
    return spark.createDataFrame(list(CODES[name].items()), "code string, meaning string")


def segment_field_names(spark: SparkSession, path: str) -> DataFrame:
    """``segment, field, name`` rows from a site's mapping file.

    The file is one JSON object ``{"segments": {SEG: {"fields": {"1": name}}}}``.
    """
    kind = "struct<segments: map<string, struct<name: string, fields: map<string, string>>>>"
    text = spark.read.option("wholetext", True).text(path)
    mapping = text.select(F.from_json("value", kind).alias("m"))
    return (
        mapping.select(F.explode("m.segments").alias("segment", "spec"))
        .select("segment", F.explode("spec.fields").alias("field", "name"))
        .select("segment", F.col("field").cast("int").alias("field"), "name")
    )


def with_code(df: DataFrame, name: str, col: str, label: str) -> DataFrame:
    """Add the meaning of a code column; unknown codes give NULL.

    The code set is a literal map (at most 16 entries), so no join is needed.
    """
    entries = [F.lit(x) for pair in CODES[name].items() for x in pair]
    return df.withColumn(label, F.create_map(*entries)[F.col(col)])
