"""From file rows to message rows, parsed messages and segment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import (
    first_line,
    let,
    line_field,
    parse_message,
    split_messages,
)
from wardflow.functions.values import hl7_ts

# Segment types with a typed form; others are reported as OTHER.
KNOWN_SEGMENTS = ("MSH", "PID", "PV1", "OBR", "OBX", "DG1", "IN1", "NK1", "EVN", "ORC")


def messages(files: DataFrame) -> DataFrame:
    """One row per message of each file, keyed by the md5 of its text.

    The outer explode keeps Spark from adding a size test on the array, which
    would split every file a second time; files without messages fall out by the
    start-of-message rule.
    """
    found = files.withColumn("messages", split_messages(F.col("raw_content")))
    one = found.select(
        "file_id",
        "source_file",
        F.size("messages").alias("file_message_count"),
        "file_modification_time",
        "ingested_at",
        F.explode_outer("messages").alias("raw_message"),
    ).where(F.col("raw_message").like("MSH|%"))
    return one.select(
        F.md5("raw_message").alias("message_id"),
        "raw_message",
        "file_id",
        "source_file",
        "file_message_count",
        "file_modification_time",
        "ingested_at",
    )


def message_time() -> Column:
    """The header's own timestamp (MSH-7), for replays that must not use the clock."""
    header = F.split(first_line(F.col("raw_message"), "MSH"), r"\|")
    # hl7_ts names its argument many times, and each would cut the header again.
    return let(line_field(header, 7, header=True), hl7_ts)


def stamp(df: DataFrame, parsed_at: Column | None = None) -> DataFrame:
    """Add ``parsed_at``: the clock unless another moment is given."""
    return df.withColumn("parsed_at", F.current_timestamp() if parsed_at is None else parsed_at)


def parse_messages(df: DataFrame, parsed_at: Column | None = None, kinds=None) -> DataFrame:
    """Message rows with the nested ``hl7`` map and ``parsed_at``; ``kinds`` limits the map to these types."""
    return stamp(df.withColumn("hl7", parse_message(F.col("raw_message"), kinds)), parsed_at)


def with_headers(df: DataFrame) -> DataFrame:
    """Message rows with the identifiers every segment table carries along.

    Values come straight from the two lines that hold them; a message without a
    header line is dropped.
    """
    cut = df.withColumns(
        {
            "__msh": F.split(first_line(F.col("raw_message"), "MSH"), r"\|"),
            "__pid": F.split(first_line(F.col("raw_message"), "PID"), r"\|"),
        }
    ).where(F.col("raw_message").like("MSH%") | F.col("raw_message").contains("\rMSH"))
    msh, pid = F.col("__msh"), F.col("__pid")
    return cut.withColumns(
        {
            "message_type": line_field(msh, 9, 1, header=True),
            "trigger_event": line_field(msh, 9, 2, header=True),
            "sending_facility": line_field(msh, 4, header=True),
            "message_control_id": line_field(msh, 10, header=True),
            "patient_id": line_field(pid, 3),
        }
    ).drop("__msh", "__pid")


def explode_segment(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One row per repeat of a segment; the message stays when it has none."""
    return df.withColumn(alias, F.explode_outer(F.col(col)))


def segments(df: DataFrame, text: str = "raw_message") -> DataFrame:
    """Every segment of every message as a row, with its message's header values.

    LF counts as CR and one doubled CR shrinks to one; blank lines are counted
    in ``segment_count`` but give no row. Empty text gives one row with an error.
    """
    raw = F.regexp_replace(F.replace(F.col(text), F.lit("\n"), F.lit("\r")), "\r\r", "\r")
    raw = F.regexp_replace(raw, r"\A\s+|\s+\z", "")
    empty = F.length(F.coalesce(F.col(text), F.lit(""))) == 0
    keep = [c for c in ("message_id",) if c in df.columns]
    lines = df.select(*keep, F.col(text), F.split(raw, "\r").alias("__lines"))
    msh = F.split(F.get(F.filter("__lines", lambda x: x.startswith("MSH")), 0), r"\|")
    head = lines.select(
        *keep,
        F.when(~empty, F.size("__lines")).alias("segment_count"),
        F.get(F.split(F.get(msh, 8), r"\^"), 0).alias("message_type"),
        F.get(msh, 9).alias("message_control_id"),
        F.get(msh, 3).alias("sending_facility"),
        F.when(empty, F.lit("Empty message")).alias("error"),
        F.posexplode(
            F.when(empty, F.array(F.lit(None).cast("string"))).otherwise(F.col("__lines"))
        ).alias("seq", "raw"),
    )
    kind = F.substring("raw", 1, 3)
    return head.where("error IS NOT NULL OR length(trim(raw)) > 0").select(
        *keep,
        "seq",
        F.when(F.col("error").isNull(), F.when(kind.isin(*KNOWN_SEGMENTS), kind).otherwise("OTHER")).alias(
            "segment_type"
        ),
        F.when(F.col("error").isNull(), kind).alias("segment_code"),
        "raw",
        "segment_count",
        "message_type",
        "message_control_id",
        "sending_facility",
        "error",
    )
