"""Parsing messages: nested map, accessor, text fields and segment rows."""

import pytest
from pyspark.sql import functions as F

from checks.context import Context
from wardflow.functions.text import _fields, field, first_segment
from wardflow.operators.messages import explode_segment, message_time, messages, parse_messages, segments, stamp
from wardflow.operators.quality import rules_for
from wardflow.operators.report import _own_columns, message_report
from wardflow.operators.segments import LAYOUTS, layout_columns, segment_table
from wardflow.functions.text import segment_lines

ADT = "\r".join(
    [
        "MSH|^~\\&|SEND|FAC^1|RECV|RFAC|20240115103000||ADT^A01|C1|P|2.5.1",
        "EVN|A01|20240115103000",
        "PID|1|E1|M1^^^AUTH^MR~M2^^^OTHER||DOE&VAN^JOHN^Q||19800515|M||W|1 ST^^TOWN^TX^73301^USA",
        "PV1|1|I|ICU^101^A^HOSP|E|||D1^SMITH^ANN|||MED||||1|||||V1" + "|" * 25 + "20240115103000|",
        "OBX|1|NM|GLU^Glucose^LN||95.5|mg/dL|70-110|H|||F",
        "ZZZ|anything",
        "OBX|2|ST|COL^Colour^LN||red||||||F",
    ]
)


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([("m1", ADT)], "message_id string, raw_message string")


def test_nested_map(spark, one):
    hl7 = F.col("hl7")
    msh, pid = first_segment(hl7, "MSH"), first_segment(hl7, "PID")
    row = parse_messages(one).select(
        F.map_keys(hl7).alias("kinds"),
        field(msh, 1).alias("sep"),
        field(msh, 2).alias("enc"),
        field(msh, 9, 1).alias("type"),
        field(msh, 9, 2).alias("trigger"),
        field(pid, 3, 1, 1, 1).alias("second"),
        field(pid, 5, 1, 2).alias("sub"),
        field(pid, 4).alias("empty"),
        field(pid, 99).alias("absent"),
        field(first_segment(hl7, "AL1"), 1).alias("no_segment"),
        field(F.get(hl7["OBX"], 1), 3).alias("second_obx"),
        F.get(hl7["OBX"], 1)["index"].alias("index"),
    ).first()
    assert row["kinds"] == ["MSH", "EVN", "PID", "PV1", "OBX", "ZZZ"]
    assert (row["sep"], row["enc"]) == ("|", "^~\\&")
    assert (row["type"], row["trigger"]) == ("ADT", "A01")
    assert (row["second"], row["sub"]) == ("M2", "VAN")
    assert row["empty"] is None and row["absent"] is None and row["no_segment"] is None
    assert (row["second_obx"], row["index"]) == ("COL", 2)


def test_no_python_in_the_plan(one):
    for df in (parse_messages(one), segment_table(stamp(one), "OBX"), segments(one)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "BatchEval" not in plan


def test_segment_tables(spark, one):
    df = stamp(one)
    pv1 = segment_table(df, "PV1").first()
    assert pv1["location_bed"] == "A" and pv1["location_facility"] == "HOSP"
    assert pv1["attending_doctor_name"] == "ANN SMITH"
    assert pv1["visit_number"] == "V1" and pv1["admit_datetime"] == "20240115103000"
    assert pv1["discharge_datetime"] is None and pv1["trigger_event"] == "A01"
    obx = segment_table(df, "OBX").orderBy("set_id").collect()
    assert [(r["set_id"], r["observation_value"]) for r in obx] == [(1, "95.5"), (2, "red")]
    assert segment_table(df, "AL1").count() == 0
    pid = segment_table(df, "PID", wide=True).first()
    assert pid["patient_id"] == "M1" and pid["patient_id_authority"] == "AUTH"
    assert pid["patient_name_family"] == "DOE" and pid["address_country"] == "USA"


def test_text_fields_equal_map_fields(spark, sf):
    """Every silver column of every table, by both ways of reading it."""
    rows = Context(spark, sf).messages
    hl7 = parse_messages(rows.select("message_id", "raw_message"), F.lit(None).cast("timestamp"))
    for kind, layout in LAYOUTS.items():
        places = [item.split() for item in layout.columns.split(",")]
        by_map = hl7.select(
            "message_id", F.posexplode_outer(F.col("hl7")[kind]).alias("pos", "seg")
        ).where("seg IS NOT NULL")
        picked = []
        for name, place in places:
            if "+" in place:
                parts = [p.split(".") for p in place.split("+")]
                picked.append(
                    F.concat_ws(" ", *[field(F.col("seg"), int(a), int(b)) for a, b in parts]).alias(name)
                )
            else:
                number, _, comp = place.partition(".")
                picked.append(field(F.col("seg"), int(number), int(comp or 1)).alias(name))
        left = by_map.select("message_id", "pos", *picked)
        lines = rows.select("message_id", F.posexplode(segment_lines(F.col("raw_message"), kind)).alias("pos", "l"))
        right = lines.withColumn("p", F.split("l", r"\|")).select(
            "message_id", "pos", *layout_columns(kind, F.col("p"))
        )
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0, kind
        assert left.count() > 0


def test_explode_keeps_messages_without_the_segment(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None), (3, [])], "i int, s array<string>")
    rows = explode_segment(df, "s", "one").select("i", "one").collect()
    assert sorted((r["i"], r["one"] or "") for r in rows) == [(1, "a"), (1, "b"), (2, ""), (3, "")]


def test_segment_rows(spark):
    raw = "MSH|^~\\&|A|F|||2024||ADT^A01|C9|P|2.5\nPID|1\r\rZZZ|x\n"
    df = spark.createDataFrame([(raw,), ("",), (None,)], "raw_message string")
    rows = segments(df).collect()
    good = [(r["seq"], r["segment_type"], r["segment_code"]) for r in rows if r["error"] is None]
    assert good == [(0, "MSH", "MSH"), (1, "PID", "PID"), (2, "OTHER", "ZZZ")]
    assert {r["segment_count"] for r in rows if r["error"] is None} == {3}
    assert {(r["message_type"], r["message_control_id"], r["sending_facility"]) for r in rows if not r["error"]} == {
        ("ADT", "C9", "F")
    }
    assert sum(r["error"] == "Empty message" for r in rows) == 2


def test_message_rows(spark):
    text = f"{ADT}\n\n{ADT.replace('C1', 'C2')}"
    files = spark.createDataFrame(
        [("f1", text, "a.hl7"), ("f2", "no message", "b.hl7")], "file_id string, raw_content string, source_file string"
    ).withColumns({"file_modification_time": F.current_timestamp(), "ingested_at": F.current_timestamp()})
    rows = messages(files).collect()
    assert [r["file_message_count"] for r in rows] == [2, 2]
    assert len({r["message_id"] for r in rows}) == 2


def test_a_time_cuts_its_line_once(spark, one):
    timed = one.select(message_time().alias("t"))
    text = timed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1
    assert timed.select(F.col("t").cast("string")).first()[0] == "2024-01-15 10:30:00"
    odd = spark.createDataFrame([("MSH|^~\\&|A|B|C|D|2024|",), ("MSH",), ("PID|1",), ("",), (None,)], "raw_message string")
    assert [r[0] for r in odd.select(message_time()).collect()] == [None] * 5


def test_a_rule_cuts_a_time_once(spark, one):
    cut = one.select(F.split("raw_message", r"\|").alias("__parts")).select(_own_columns("PV1")["admit_datetime"].alias("t"))
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("__parts") <= 3
    found = message_report(one, {"PV1": rules_for("PV1", "2024-01-10 00:00:00")})
    failures = {r["rule"]: r["failures"] for r in found.collect()}
    assert failures["pv1_admit_not_future"] == 1 and sum(failures.values()) == 1


def test_fields_of_odd_lines(spark):
    lines = ["MSH", "MSH|", "MSH|^~\\&", "MSH|^~\\&||A^B|", "", "PID", "PID|", "PID||a|x~y^z&w", "^A|~|&"]
    plain = lambda t: [[[t]]] if t else None
    nested = lambda t: [[c.split("&") for c in r.split("^")] for r in t.split("~")]

    def want(line):
        cut = line.split("|")
        cut = ["MSH", "|", *cut[1:]] if line.startswith("MSH") else cut
        head = 3 if line.startswith("MSH") else 0
        return [plain(t) if i < head or not set(t) & set("~^&") else nested(t) for i, t in enumerate(cut)]

    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(_fields(F.col("line")).alias("f"))
    assert [r["f"] for r in rows.collect()] == [want(x) for x in lines]
    # The header is told apart once per line.
    assert "<= 2" not in rows._jdf.queryExecution().optimizedPlan().toString()
