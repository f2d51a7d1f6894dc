"""Value functions on hand-made cases."""

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from wardflow.functions import values as v
from wardflow.functions.sqlfuncs import register_sql_functions
from wardflow.operators.codes import code_table, segment_field_names, with_code


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_timestamps(spark):
    texts = ["20240115103059", "202401151030", "20240115", "", None, "20240115-0500", "N/A", "20241301", "20240230", "2024011510"]
    assert column(spark, texts, v.hl7_ts) == [
        datetime(2024, 1, 15, 10, 30, 59),
        datetime(2024, 1, 15, 10, 30),
        datetime(2024, 1, 15),
        *[None] * 7,
    ]


def test_timestamp_text(spark):
    cases = {
        "20240115103059": "2024-01-15T10:30:59",
        "20240115103059-0500": "2024-01-15T10:30:59",
        "20240115103059.123+0100": "2024-01-15T10:30:59",
        "202401151030": "2024-01-15T10:30:00",
        "20240115": "2024-01-15T00:00:00",
        "2024": "2024",
        "20249999": "20249999",
        "": None,
        None: None,
    }
    assert column(spark, list(cases), v.hl7_ts_text) == list(cases.values())


def test_numbers(spark):
    texts = ["1.2", "-3", "<5", "1.2.3", "", None, "abc", "95 mg", "-1-2"]
    assert column(spark, texts, v.numeric_text) == [1.2, -3.0, 5.0, None, None, None, None, 95.0, None]
    nm = lambda c: v.nm_value(F.lit("NM"), c)
    assert column(spark, texts, nm) == [1.2, -3.0, None, None, None, None, None, 95.0, -1.0]
    assert column(spark, ["7"], lambda c: v.nm_value(F.lit("ST"), c)) == [None]


def test_reference_range(spark):
    cases = {
        "70-110": (70.0, 110.0),
        " 3.5 - 5 ": (3.5, 5.0),
        "<5.5": (None, 5.5),
        ">2": (2.0, None),
        "-1": (None, None),
        "-1-5": (None, None),
        "1-2-3": (None, None),
        "5-x": (5.0, None),
        "x-5": (None, None),
        "<-5": (None, None),
        "normal": (None, None),
        None: (None, None),
    }
    found = column(spark, list(cases), v.reference_range)
    assert [(r["low"], r["high"]) for r in found] == list(cases.values())


def test_age(spark):
    days = [date(2000, 1, 30), date(2000, 1, 31), date(2024, 1, 30), date(2030, 1, 1), None]
    at = F.lit("2024-01-30").cast("date")
    assert column(spark, days, lambda c: v.age_years(c, at), "date") == [24, 23, 0, None, None]


def test_names_and_addresses(spark):
    df = spark.createDataFrame(
        [("Doe", "John", "Q", "1 St", "Town", "TX", "73301", "USA"), ("Doe", "", None, "", "Town", None, "", "CAN"), ("", None, None, None, None, None, None, "usa")],
        "f string, g string, m string, s string, c string, st string, z string, co string",
    )
    rows = df.select(v.full_name("f", "g", "m").alias("n"), v.full_address("s", "c", "st", "z", "co").alias("a")).collect()
    assert [tuple(r) for r in rows] == [
        ("John Q Doe", "1 St, Town, TX, 73301"),
        ("Doe", "Town, CAN"),
        (None, None),
    ]


def test_codes(spark):
    assert column(spark, ["m", "F", "Z", "", None], v.sex_text) == ["Male", "Female", "Z", None, None]
    assert column(spark, ["b", "I", "?", None], v.class_text) == ["Observation", "Inpatient", "?", None]
    assert column(spark, ["I", "E", "R", "i", None], v.class_desc) == ["Inpatient", "Emergency", "R", "i", None]
    assert column(spark, ["H", "CR", "h", None], v.is_abnormal) == [True, False, False, False]
    assert column(spark, ["H", "CR", "h", None], v.is_abnormal_any) == [True, True, True, False]
    assert column(spark, ["SV", "SE", "MO", None], v.is_severe) == [True, True, False, False]
    assert column(spark, [" p1 ", "", None], v.clean_id) == ["P1", None, None]
    assert column(spark, [" ", "a ", None], lambda c: v.label_blank(c, "(null)")) == ["(null)", "a", "(null)"]


def test_code_tables(spark, tmp_path):
    assert code_table(spark, "message_types").where("code = 'ORU^R01'").first()["meaning"] == "Unsolicited Observation Result"
    df = spark.createDataFrame([("NM",), ("??",)], "t string")
    assert [r["x"] for r in with_code(df, "value_types", "t", "x").collect()] == ["Numeric", None]
    path = tmp_path / "map.json"
    path.write_text('{"segments": {"PID": {"name": "Patient", "fields": {"3": "patient_id", "5": "name"}}}}')
    rows = segment_field_names(spark, str(path)).orderBy("field").collect()
    assert [tuple(r) for r in rows] == [("PID", 3, "patient_id"), ("PID", 5, "name")]


def test_keys(spark):
    df = spark.createDataFrame([("a", None, ""), (None, None, "")], "x string, y string, z string")
    rows = df.select(
        v.surrogate_key("x", "y").alias("skip"),
        v.surrogate_key("x", "y", nulls="blank").alias("blank"),
        v.entity_key("x", "y", "z").alias("entity"),
        v.content_id(F.coalesce("x", F.lit("")), F.lit("t")).alias("content"),
    ).collect()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert rows[0]["skip"] == md5("a") and rows[0]["blank"] == md5("a|") and rows[0]["entity"] == md5("a")
    assert rows[0]["content"] == hashlib.sha256(b"at").hexdigest()[:32]
    assert len(rows[1]["entity"]) == 32 and rows[1]["entity"] != md5("")


def test_sql_functions(spark):
    assert len(register_sql_functions(spark)) == 6
    row = spark.sql(
        "SELECT generate_key(array('a', NULL, '', 'b')) AS k, generate_key(array()) AS r, try_numeric('<5 x') AS n, is_abnormal('cr') AS ab, "
        "is_abnormal(CAST(NULL AS STRING)) AS no, format_name('Doe', 'Jo', '') AS name, standardize_sex('u') AS s, "
        "standardize_patient_class('q') AS c"
    ).first()
    found = (row["n"], row["ab"], row["no"], row["name"], row["s"], row["c"])
    assert found == (5.0, True, False, "Jo Doe", "Unknown", "q")
    assert row["k"] == hashlib.md5(b"a|b").hexdigest() and len(row["r"]) == 32
