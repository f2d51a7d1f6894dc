"""The clinical feed that stands behind the ``events`` table.

Every event becomes one message. The values of a message are stated once, in SQL
both engines read; Spark builds message text and files from them for the package
to take apart again, and the checking SQL uses the values directly, without any
parsing. ``''`` is a blank field.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import METHOD_BYTES, checkpoint_dir, compiled_methods  # noqa: F401

CR = "chr(13)"


class Spark:
    @staticmethod
    def text(ts, digits):
        return f"substring(date_format({ts}, 'yyyyMMddHHmmss'), 1, {digits})"

    @staticmethod
    def hours(ts, n):
        return f"({ts} + make_dt_interval(0, CAST({n} AS INT)))"

    @staticmethod
    def days(day, n):
        return f"date_add(DATE'{day}', CAST({n} AS INT))"

    @staticmethod
    def date_text(day):
        return f"date_format({day}, 'yyyyMMdd')"

    @staticmethod
    def lines(line, count, most):
        # No lambda: Spark does not compile those, and a message's repeats are most of its text. A line with
        # an unknown value is left out.
        return " || ".join(f"CASE WHEN {count} > {i} THEN coalesce({line.format(i=i)}, '') ELSE '' END" for i in range(most))


class Duck:
    @staticmethod
    def text(ts, digits):
        return f"substring(strftime({ts}, '%Y%m%d%H%M%S'), 1, {digits})"

    @staticmethod
    def hours(ts, n):
        return f"({ts} + to_hours(CAST({n} AS BIGINT)))"

    @staticmethod
    def days(day, n):
        return f"(DATE '{day}' + CAST({n} AS INTEGER))"

    @staticmethod
    def date_text(day):
        return f"strftime({day}, '%Y%m%d')"

    @staticmethod
    def lines(line, count, most):
        return " || ".join(
            f"CASE WHEN {count} > {i} THEN {line.format(i=i)} ELSE '' END" for i in range(most)
        )


def _str(x):
    return f"CAST({x} AS STRING)"


def _pick(x, *values):
    """Value by modulus: 0 gives the first one."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({x}) % {len(values)} {cases} END"


def _blank_if(cond, value):
    return f"CASE WHEN {cond} THEN '' ELSE {value} END"


def feed_layers(d) -> list[str]:
    """Select lists, each adding columns to the one before it."""
    def stamped(ts, fmt):
        return (
            f"CASE {fmt} WHEN 14 THEN {d.text(ts, 14)} WHEN 12 THEN {d.text(ts, 12)} "
            f"WHEN 8 THEN {d.text(ts, 8)} WHEN 1 THEN 'N/A' ELSE '' END"
        )

    def known(ts, fmt):
        return (
            f"CASE {fmt} WHEN 14 THEN {ts} WHEN 12 THEN date_trunc('minute', {ts}) "
            f"WHEN 8 THEN date_trunc('day', {ts}) END"
        )

    base = {
        "oru": "event_id % 10 = 7",
        "has_pid": "event_id % 211 <> 0",
        "mtype": "CASE WHEN event_id % 10 = 7 THEN 'ORU' ELSE 'ADT' END",
        "trig": "CASE WHEN event_id % 10 = 7 THEN 'R01' WHEN event_type = 'signup' THEN 'A01' "
        "WHEN event_type = 'view' THEN 'A04' WHEN event_type = 'purchase' THEN 'A03' "
        "WHEN event_type = 'click' THEN 'A02' ELSE 'A08' END",
        "app": f"'APP' || {_str('user_id % 4')}",
        "sfac": _blank_if("event_id % 41 = 0", f"'FAC' || {_str('user_id % 3')}"),
        "ctl": _blank_if("event_id % 97 = 0", f"'MSG' || lpad({_str('event_id')}, 9, '0')"),
        "msg_at": d.text("t", 14),
        "ver": "CASE WHEN event_id % 19 = 0 THEN '3.0' ELSE '2.5.1' END",
        "pid": _blank_if("event_id % 101 = 0", f"'P' || lpad({_str('user_id')}, 6, '0')"),
        "auth": _blank_if("user_id % 10 = 9", _pick("user_id", "HOSPITAL_A", "HOSPITAL_B")),
        "fam": f"'FAM' || {_str('user_id % 50')}",
        "giv": _blank_if("user_id % 13 = 0", f"'GIV' || {_str('user_id % 20')}"),
        "mid": _blank_if("user_id % 4 <> 0", "'M'"),
        "dob": _blank_if("user_id % 17 = 0", d.date_text(d.days("1940-01-01", "(user_id * 97) % 25000"))),
        "sex": _pick("user_id", "M", "F", "U", "O", "A", "N", "X"),
        "race": _blank_if("user_id % 6 = 0", f"'R' || {_str('user_id % 5')}"),
        "street": f"{_str('event_id % 100')} || ' MAIN ST'",
        "city": _blank_if("event_id % 15 = 0", _pick("event_id", "AUSTIN", "BOISE", "CHICAGO")),
        "state": _pick("user_id", "TX", "ID", "IL", "NY"),
        "zip": _pick("event_id", "73301", "83702-1234", "6060", "", "10001"),
        "phone": _blank_if("event_id % 12 = 0", f"'555-' || lpad({_str('user_id')}, 4, '0')"),
        "marital": _pick("user_id", "S", "M", "D", ""),
        "acct": f"'AC' || {_str('user_id')}",
        "cls": "CASE WHEN event_id % 53 = 0 THEN 'Z' WHEN event_id % 59 = 0 THEN '' "
        f"ELSE {_pick('event_id', 'E', 'I', 'O', 'P')} END",
        "poc": _pick("event_id", "ED", "ER", "ICU", "MICU", "MED", "WARD", ""),
        "room": f"'R' || {_str('event_id % 30')}",
        "bed": f"'B' || {_str('event_id % 12')}",
        "fac": _blank_if("event_id % 37 = 0", _pick("user_id", "HOSPITAL_A", "HOSPITAL_B")),
        "adm": _pick("event_id", "E", "U", "R", "", " "),
        "doc": f"'D' || {_str('event_id % 17')}",
        "doc_fam": f"'DOC' || {_str('event_id % 17')}",
        "doc_giv": _blank_if("event_id % 17 = 0", "'ANN'"),
        "svc": _pick("event_id", "MED", "CCU", "sicu", "FAM", ""),
        "src": _pick("event_id", "1", "7", ""),
        "visit": f"'V' || {_str('CAST(floor(event_id / 3) AS BIGINT)')}",
        "fin": _pick("event_id", "SELF", "MEDICARE", "", "PRIVATE"),
        "dispo": _pick("event_id", "01", "", "20"),
        "a_fmt": "CASE WHEN event_id % 13 = 0 THEN 0 WHEN event_id % 11 = 0 THEN 12 "
        "WHEN event_id % 29 = 0 THEN 8 WHEN event_id % 31 = 0 THEN 1 ELSE 14 END",
        "n_obx": "event_id % 4",
        "n_dg1": "event_id % 3",
        "n_al1": "CASE WHEN event_id % 5 = 0 THEN 1 + event_id % 2 ELSE 0 END",
        "n_obr": "CASE WHEN event_id % 10 = 7 THEN 1 + CAST(floor(event_id / 10) AS BIGINT) % 2 ELSE 0 END",
        "n_in1": "event_id % 2",
        "n_nk1": "CASE WHEN event_id % 4 = 1 THEN 2 ELSE 0 END",
        "n_orc": "CASE WHEN event_id % 10 = 7 THEN 1 ELSE 0 END",
    }
    stays = {
        "a_ts": f"CASE WHEN trig = 'A03' THEN {d.hours('t', '-(event_id % 96)')} ELSE t END",
        "d_ts": f"CASE WHEN trig = 'A03' THEN t ELSE {d.hours('t', '1 + event_id % 5')} END",
        "d_fmt": "CASE WHEN trig = 'A03' THEN (CASE WHEN event_id % 23 = 0 THEN 12 "
        "WHEN event_id % 47 = 0 THEN 0 ELSE 14 END) "
        "WHEN trig = 'A02' AND event_id % 4 < 3 THEN 14 WHEN event_id % 6 = 0 THEN 14 ELSE 0 END",
    }
    texts = {
        "admit": stamped("a_ts", "a_fmt"),
        "discharge": stamped("d_ts", "d_fmt"),
        "admit_at": known("a_ts", "a_fmt"),
        "discharge_at": known("d_ts", "d_fmt"),
    }
    first = "event_id, user_id, event_type, value, date_trunc('second', ts) AS t"
    return [first] + [
        "*, " + ", ".join(f"{expr} AS {name}" for name, expr in layer.items())
        for layer in (base, stays, texts)
    ]


# Values of the repeated segments; ``{i}`` is the repeat, counted from 0.
OBX = {
    "value_type": "CASE WHEN (event_id + {i}) % 3 = 0 THEN 'ST' WHEN (event_id + {i}) % 67 = 0 THEN '' ELSE 'NM' END",
    "observation_id": "CASE WHEN (event_id + {i}) % 43 = 0 THEN '' ELSE " + _pick("(event_id + {i})", "GLU", "HGB", "NA", "K", "WBC") + " END",
    "observation_text": _pick("(event_id + {i})", "Glucose", "Hemoglobin", "Sodium", "Potassium", "White cells"),
    "observation_coding_system": "'LN'",
    "observation_sub_id": "CASE WHEN {i} = 0 THEN '' ELSE CAST({i} AS STRING) END",
    "observation_value": "CASE WHEN event_id % 25 = 3 THEN '<5' WHEN event_id % 25 = 4 THEN '1.2.3' "
    "WHEN event_id % 25 = 5 THEN 'NEG' WHEN event_id % 25 = 6 THEN '' WHEN event_id % 25 = 7 THEN '-3 C' ELSE "
    "CAST(CAST(floor(value) AS BIGINT) + 10 * {i} AS STRING) || " + _pick("event_id", ".0", ".25", ".5", ".75") + " END",
    "units": "CASE WHEN event_id % 9 = 0 THEN '' ELSE 'mg/dL' END",
    "reference_range": _pick("event_id + {i}", "70-110", "<5.5", ">2", "", "-1", "a-b"),
    "abnormal_flags": _pick("(event_id + {i})", "H", "", "L", "N", "HH", "CR", "h", ""),
    "result_status": _pick("(event_id + {i})", "F", "P", "Q"),
    "observation_datetime": "msg_at",
    "producer_id": "'LAB' || CAST(event_id % 3 AS STRING)",
}
DG1 = {
    "diagnosis_coding_method": "'ICD10'",
    "diagnosis_code": "CASE WHEN (event_id + {i}) % 39 = 0 THEN '' ELSE "
    + _pick("(event_id + {i})", "R07.9", "I10", "E11.9", "401.9", "J18.9") + " END",
    "diagnosis_description": _pick("(event_id + {i})", "CHEST PAIN", "HYPERTENSION", "DIABETES", "OLD CODE", ""),
    "diagnosis_coding_system": _pick("(event_id + {i})", "ICD10", "ICD10", "ICD10", "", "ICD10", "ICD9"),
    "diagnosis_datetime": "msg_at",
    "diagnosis_type": _pick("(event_id + {i})", "A", "W", "F"),
    "diagnosis_priority": "CAST(1 + {i} AS STRING)",
}
AL1 = {
    "allergen_type_code": _pick("(event_id + {i})", "DA", "FA"),
    "allergen_type_text": _pick("(event_id + {i})", "Drug", "Food"),
    "allergen_code": f"'AL' || {_str('(event_id + {i}) % 6')}",
    "allergen_description": _pick("(event_id + {i})", "Penicillin", "Peanut", "Latex", "", "Aspirin", "Egg"),
    "severity_code": _pick("(event_id + {i})", "SV", "MO", "MI", "SE", "sv", "", "U"),
    "severity_text": _pick("(event_id + {i})", "Severe", "Moderate", "Mild", "Severe", "Severe", "", "Unknown"),
    "reaction": _pick("(event_id + {i})", "Rash", "Hives", ""),
    "identification_date": "substring(msg_at, 1, 8)",
}
OBR = {
    "placer_order_number": _blank_if("(event_id + {i}) % 4 = 0", f"'ORD' || {_str('event_id')} || '-' || {_str('{i}')}"),
    "filler_order_number": f"'FIL' || {_str('event_id')}",
    "universal_service_id": _pick("event_id + {i}", "CBC", "BMP", "XR"),
    "universal_service_text": _pick("(event_id + {i})", "Blood count", "Metabolic panel", "", "X-ray", "Lipids"),
    "universal_service_coding_system": "'L'",
    "priority": _pick("event_id", "R", "S", "A"),
    "requested_datetime": "msg_at",
    "observation_datetime": "msg_at",
    "observation_end_datetime": "''",
    "ordering_provider_id": "doc",
    "ordering_provider_family": "CASE WHEN event_id % 7 = 0 THEN '' ELSE doc_fam END",
    "ordering_provider_given": "CASE WHEN event_id % 7 = 0 THEN '' ELSE doc_giv END",
    "result_status": _pick("(event_id + {i})", "F", "P", "C", "F"),
}
IN1 = {
    "insurance_plan_id": f"'PL' || {_str('user_id % 9')}",
    "insurance_company_id": f"'CO' || {_str('user_id % 5')}",
    "insurance_company_name": f"'INSURER ' || {_str('user_id % 5')}",
    "group_number": f"'G' || {_str('user_id % 11')}",
    "group_name": "CASE WHEN user_id % 3 = 0 THEN '' ELSE 'GROUP' END",
    "plan_effective_date": "'20230101'",
    "plan_expiration_date": "''",
    "plan_type": _pick("user_id", "HMO", "PPO"),
    "insured_name_family": "fam",
    "insured_name_given": "giv",
    "insured_relationship": _pick("user_id", "SELF", "SPOUSE", "CHILD"),
    "policy_number": f"'POL' || {_str('user_id')}",
}
NK1 = {
    "name_family": "fam",
    "name_given": f"'KIN' || {_str('{i}')}",
    "relationship": _pick("event_id + {i}", "SPO", "PAR", "SIB"),
    "address_street": "street",
    "address_city": "city",
    "address_state": "state",
    "address_zip": "zip",
    "phone_home": "phone",
    "phone_business": "''",
    "contact_role": "'EC'",
}
ORC = {
    "order_control": _pick("event_id", "NW", "CA"),
    "placer_order_number": f"'ORD' || {_str('event_id')}",
    "filler_order_number": f"'FIL' || {_str('event_id')}",
    "placer_group_number": "''",
    "order_status": _pick("event_id", "IP", "CM", ""),
    "response_flag": "''",
    "quantity_timing": "'1^once'",
    "parent_order": "''",
    "transaction_datetime": "msg_at",
    "entered_by": "doc",
    "verified_by": "''",
    "ordering_provider_id": "doc",
    "ordering_provider_family": "doc_fam",
    "ordering_provider_given": "doc_giv",
    "enterer_location": "poc",
    "order_effective_datetime": "msg_at",
}


def _line(kind, fields: dict[int, str]) -> str:
    parts = [fields.get(n, "''") for n in range(1, max(fields) + 1)]
    return f"'{kind}|' || " + " || '|' || ".join(f"({p})" for p in parts)


def _repeated(d, kind, count, fields, most) -> str:
    """Up to ``most`` lines, each ended by CR."""
    return d.lines(f"{_line(kind, fields)} || {CR}", count, most)


def raw_message(d) -> str:
    """The message text as one SQL expression over the feed columns."""
    caret = " || '^' || "
    msh = _line(
        "MSH",
        {1: "'^~' || chr(92) || '&'", 2: "app", 3: "sfac", 4: "'LAB'", 5: "'HUB'", 6: "msg_at",
         8: "mtype || '^' || trig", 9: "ctl", 10: "'P'", 11: "ver"},
    )
    evn = _line("EVN", {1: "trig", 2: "msg_at", 5: "'OP' || " + _str("event_id % 5"), 6: "msg_at"})
    pid = _line(
        "PID",
        {1: "'1'", 2: "'EXT' || " + _str("user_id"),
         3: "pid || '^^^' || auth || '^MR~ALT' || " + _str("user_id") + " || '^^^OTHER'",
         5: "fam || '&VAN^' || giv || '^' || mid || '^JR'", 7: "dob", 8: "sex", 10: "race",
         11: caret.join(["street", "''", "city", "state", "zip", "'USA'"]), 13: "phone",
         15: "'EN'", 16: "marital", 18: "acct", 22: "'H'"},
    )
    pv1 = _line(
        "PV1",
        {1: "'1'", 2: "cls", 3: caret.join(["poc", "room", "bed", "fac"]), 4: "adm",
         7: caret.join(["doc", "doc_fam", "doc_giv"]), 10: "svc", 14: "src", 19: "visit", 20: "fin",
         36: "dispo", 44: "admit", 45: "discharge"},
    )
    o = OBX
    obx = {1: "CAST({i} + 1 AS STRING)", 2: o["value_type"],
           3: caret.join([o["observation_id"], o["observation_text"], "'LN'"]), 4: o["observation_sub_id"],
           5: o["observation_value"], 6: o["units"], 7: o["reference_range"], 8: o["abnormal_flags"],
           11: o["result_status"], 14: o["observation_datetime"], 15: o["producer_id"]}
    g = DG1
    dg1 = {1: "CAST({i} + 1 AS STRING)", 2: g["diagnosis_coding_method"],
           3: caret.join([g["diagnosis_code"], g["diagnosis_description"], g["diagnosis_coding_system"]]),
           5: g["diagnosis_datetime"], 6: g["diagnosis_type"], 15: g["diagnosis_priority"]}
    a = AL1
    al1 = {1: "CAST({i} + 1 AS STRING)", 2: a["allergen_type_code"] + caret + a["allergen_type_text"],
           3: a["allergen_code"] + caret + a["allergen_description"],
           4: a["severity_code"] + caret + a["severity_text"], 5: a["reaction"], 6: a["identification_date"]}
    r = OBR
    obr = {1: "CAST({i} + 1 AS STRING)", 2: r["placer_order_number"], 3: r["filler_order_number"],
           4: caret.join([r["universal_service_id"], r["universal_service_text"], "'L'"]), 5: r["priority"],
           6: r["requested_datetime"], 7: r["observation_datetime"],
           16: caret.join([r["ordering_provider_id"], r["ordering_provider_family"], r["ordering_provider_given"]]),
           25: r["result_status"]}
    n = IN1
    in1 = {1: "'1'", 2: n["insurance_plan_id"], 3: n["insurance_company_id"], 4: n["insurance_company_name"],
           8: n["group_number"], 9: n["group_name"], 12: n["plan_effective_date"], 15: n["plan_type"],
           16: "fam || '^' || giv", 17: n["insured_relationship"], 36: n["policy_number"]}
    k = NK1
    nk1 = {1: "CAST({i} + 1 AS STRING)", 2: "fam || '^' || " + k["name_given"], 3: k["relationship"],
           4: caret.join(["street", "''", "city", "state", "zip"]), 5: "phone", 7: "'EC'"}
    c = ORC
    orc = {1: c["order_control"], 2: c["placer_order_number"], 3: c["filler_order_number"],
           5: c["order_status"], 7: c["quantity_timing"], 9: "msg_at", 10: "doc",
           12: caret.join(["doc", "doc_fam", "doc_giv"]), 13: "poc", 15: "msg_at"}
    once = lambda cond, line: f"CASE WHEN {cond} THEN {line} || {CR} ELSE '' END"
    parts = [
        f"{msh} || {CR}",
        once("NOT oru", evn),
        once("has_pid", pid),
        _repeated(d, "NK1", "n_nk1", nk1, 2),
        once("NOT oru", pv1),
        _repeated(d, "AL1", "n_al1", al1, 2),
        _repeated(d, "DG1", "n_dg1", dg1, 2),
        _repeated(d, "IN1", "n_in1", in1, 1),
        _repeated(d, "ORC", "n_orc", orc, 1),
        _repeated(d, "OBR", "n_obr", obr, 2),
        _repeated(d, "OBX", "n_obx", obx, 3),
        "'ZPI|' || " + _str("event_id % 8") + " || '|x'",
    ]
    return " || ".join(f"({p})" for p in parts)


#: Events of which one task makes the messages, about; a message has some 1000 bytes.
TASK_EVENTS = 50_000


def feed(spark: SparkSession, sf_dir: str, by: Column | None = None) -> DataFrame:
    """Feed values of every event, with the message text.

    Events are dealt to tasks, by the values of ``by`` (kept as ``dealt_by``) if given, before their
    text is made, so that only their few narrow columns are shuffled, however the table is stored.
    """
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_EVENTS))
    df = df.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    df = df.repartition(tasks) if by is None else df.withColumn("dealt_by", by).repartition(tasks, "dealt_by")
    first, *more = (_split_select(layer) for layer in feed_layers(Spark))
    df = df.selectExpr(*first, *([] if by is None else ["dealt_by"]))
    for layer in more:
        df = df.selectExpr(*layer)
    return df.withColumn("raw_message", F.expr(raw_message(Spark)))


def _split_select(layer: str) -> list[str]:
    """A select list cut at its top-level commas."""
    out, depth, start = [], 0, 0
    quoted = False
    for pos, ch in enumerate(layer):
        if ch == "'":
            quoted = not quoted
        elif not quoted and ch in "([":
            depth += 1
        elif not quoted and ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0 and not quoted:
            out.append(layer[start:pos])
            start = pos + 1
    return out + [layer[start:]]


FILE_SIZE = 50


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as file rows of fifty messages, in four layouts.

    Blank lines between messages, back to back with CRLF, framed, and trimmed
    blanks with mixed line ends.
    """
    lf = F.replace("raw_message", F.lit("\r"), F.lit("\n"))
    crlf = F.replace("raw_message", F.lit("\r"), F.lit("\r\n"))
    number = F.floor(F.col("event_id") / FILE_SIZE)
    style = F.col("dealt_by") % 4
    dressed = (
        F.when(style == 0, F.concat(lf, F.lit("\n\n")))
        .when(style == 1, F.concat(crlf, F.lit("\r\n")))
        .when(style == 2, F.concat(F.lit("\x0b"), F.col("raw_message"), F.lit("\x1c\r")))
        .otherwise(F.concat(F.lit("  "), F.replace("raw_message", F.lit("\r"), F.lit(" \t\r")), F.lit(" \n \r\n")))
    )
    pieces = F.array_sort(F.collect_list(F.struct("event_id", dressed.alias("text"))))
    text = F.array_join(F.transform(pieces, lambda p: p["text"]), "")
    files = feed(spark, sf_dir, number).groupBy(F.col("dealt_by").alias("n")).agg(text.alias("raw_content"), F.max("t").alias("m"))
    return files.select(
        F.concat(F.lit("file-"), F.col("n").cast("string")).alias("file_id"),
        "raw_content",
        F.concat(F.lit("feed/"), F.col("n").cast("string"), F.lit(".hl7")).alias("source_file"),
        F.col("m").alias("file_modification_time"),
        F.col("m").alias("ingested_at"),
    )


_LANDED: dict[tuple[str, str, str], str] = {}

def landed(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per session to the shared folder and read back.

    The feed stands for messages that arrived from outside, in many files, so
    building their text is no part of a query.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = new_path(spark, name)
        with compiled_methods(spark):
            build(spark, sf_dir).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message rows of the feed, keyed like split messages."""

    def build(spark, sf_dir):
        return feed(spark, sf_dir).select(F.md5("raw_message").alias("message_id"), "raw_message")

    return landed(spark, sf_dir, "messages", build)


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "files", feed_files)


def _file_writer(folder: str):
    """Writes rows of ``file_id`` and ``value`` as Spark's text writer would, for a folder every task can open.

    Spark's local file system starts a process per file to set its permissions, which takes longer
    than the file. A file appears under its name when it is whole, so a task may be run again.
    """

    def write(rows) -> None:
        for row in rows:
            name = "__HIVE_DEFAULT_PARTITION__" if row["file_id"] is None else row["file_id"]
            place = f"{folder}/file_id={name}"
            os.makedirs(place, exist_ok=True)
            begun = f"{place}/.{uuid.uuid4().hex}"
            with open(begun, "wb") as out:
                out.write((row["value"] or "").encode() + b"\n")
            os.replace(begun, f"{place}/part-00000.txt")

    return write


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text files, one folder per file, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "landing")
    if key not in _LANDED:
        path = new_path(spark, "landing")
        files = landed_files(spark, sf_dir).select("file_id", F.col("raw_content").alias("value"))
        local = re.fullmatch(r"(?:file:/*(?=/))?(/.*)", path)
        if local:
            files.foreachPartition(_file_writer(local[1]))
        else:
            files.write.partitionBy("file_id").text(path)
        _LANDED[key] = path
    return _LANDED[key]


#: Texts of feed files that land as one file of ``landing_drops``: some 1000 messages, 1 MB.
DROP_TEXTS = 20


def landing_drops(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text files of some MB in one folder, for jobs that need no file's name.

    Written once per session. The texts of a file stand one after another, in all four layouts.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "drops")
    if key not in _LANDED:
        path = new_path(spark, "drops")
        texts = landed_files(spark, sf_dir).select(F.col("raw_content").alias("value"))
        texts.write.option("maxRecordsPerFile", DROP_TEXTS).text(path)
        _LANDED[key] = path
    return _LANDED[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
