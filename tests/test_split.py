"""Splitting files into messages, against a plain restatement of the rule."""

import random

import pytest

from pyspark.sql import functions as F

from wardflow.functions.text import split_messages

HEAD = "MSH|^~\\&|APP|FAC|||20240115||ADT^A01|{}|P|2.5"
ONE, TWO, THREE = (HEAD.format(f"MSG00{i}") for i in (1, 2, 3))


def split_all(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    rows = df.select("i", split_messages(F.col("raw")).alias("m")).orderBy("i").collect()
    return [r["m"] for r in rows]


def restated(raw):
    """Message texts, line by line."""
    text = (raw or "").replace("\x0b", "").replace("\x1c\r", "\n").replace("\x1c", "\n")
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    groups = [[]]
    for line in (part.strip() for part in text.split("\n")):
        if not line or line.startswith("MSH|"):
            groups.append([])
        if line:
            groups[-1].append(line)
    joined = ["\r".join(g) for g in groups]
    return [m for m in joined if m.startswith("MSH|")]


CASES = {
    "one": (f"{ONE}\rPID|1||PAT001||DOE^JOHN\rPV1|1|I|ICU^101^A", 1),
    "one with line ends after it": (f"{ONE}\nPID|1||PAT001\n\n\n", 1),
    "blank line": (f"{ONE}\nPID|1||PAT001\n\n{TWO}\nPID|1||PAT002\n", 2),
    "several blank lines": (f"{ONE}\nPID|1||P\n\n\n\n{TWO}\nPID|1||P\n", 2),
    "five": ("\n".join(HEAD.format(i) + f"\nPID|1||PAT{i}\n" for i in range(5)), 5),
    "back to back": (f"{ONE}\nPID|1||PAT001\nPV1|1|I\n{TWO}\nPID|1||PAT002\n", 2),
    "three back to back": (f"{ONE}\nPID|1\n{TWO}\nOBX|1|NM|GLU||95|mg/dL\n{THREE}\nPID|1\n", 3),
    "framed": (f"\x0b{ONE}\rPID|1||PAT001\x1c\r", 1),
    "two framed": (f"\x0b{ONE}\rPID|1\x1c\r\x0b{TWO}\rPID|2\x1c\r", 2),
    "frame end only": (f"\x0b{ONE}\rPID|1\x1c\x0b{TWO}\rPID|2\x1c", 2),
    "carriage returns": (f"{ONE}\rPID|1||PAT001\rPV1|1|I", 1),
    "line feeds": (f"{ONE}\nPID|1||PAT001\nPV1|1|I", 1),
    "both": (f"{ONE}\r\nPID|1||PAT001\r\nPV1|1|I", 1),
    "mixed": (f"{ONE}\r\nPID|1\r\n\r\n{TWO}\rPID|2\r", 2),
    "empty": ("", 0),
    "null": (None, 0),
    "no header": ("PID|1||PAT001||DOE^JOHN\nPV1|1|I", 0),
    "text before": (f"some header text\nanother line\n{ONE}\nPID|1\n", 1),
    "header text inside": (f"{ONE}\nPID|1\nNTE|1||refer to MSH protocol MSH|x\n", 1),
    "blanks around": (f"  {ONE} \n\t PID|1 \t\n \t \n   {TWO}\n\xa0PID|2\u3000\n", 2),
    "cr before frame end": (f"{ONE}\rPID|1\r\x1c\r{TWO}", 2),
}


def test_cases(spark):
    found = split_all(spark, [raw for raw, _ in CASES.values()])
    for (name, (raw, count)), messages in zip(CASES.items(), found):
        assert len(messages) == count, name
        assert messages == restated(raw), name


def test_segment_order_is_kept(spark):
    lines = [ONE, "EVN|A01|20240115", "PID|1||PAT001", "PV1|1|I|ICU^101", "DG1|1|ICD10|R07.9^CHEST PAIN"]
    assert split_all(spark, ["\n".join(lines)]) == [["\r".join(lines)]]


@pytest.mark.parametrize("seed", range(3))
def test_random_text(spark, seed):
    rng = random.Random(seed)
    bits = ["MSH|", "MSH", "|", "PID|1", "a", " ", "\t", "\n", "\r", "\r\n", "\x0b", "\x1c", "\x1c\r"]
    bits += ["\x1d", "\x85", "\u2003", "\u2028", "\f", "\n\n", "x MSH|y"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(1500)]
    assert split_all(spark, texts) == [restated(t) for t in texts]


def test_text_is_cut_at_its_line_ends_in_one_pass(spark):
    made = split_messages(F.col("raw"))._jc.toString()
    assert made.count("replace(") == 1  # that of the frame's start; it took five and a regular expression
    texts = [f"{ONE}\rPID|1{end}NTE|1{end}{TWO}" for end in ("\r\x1c\r", "\r\x1c\r\n", "\x1c\x0b\r", "\x1c\x1c", "\r\r\x1c", "\n\r")]
    assert split_all(spark, texts) == [restated(t) for t in texts]
