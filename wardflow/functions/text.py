"""Splitting feed text into messages and picking fields out of segment lines.

Everything here is a Column expression, so a whole file is split and a message
is taken apart inside the JVM without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points trimmed from both ends of a line (Unicode blanks and
# the control separators). Vertical tab, file separator, carriage return and line
# feed are already gone when it is used.
BLANKS = "".join(
    map(
        chr,
        (
            0x09, 0x0C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
            0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ),
    )
)

def _replaced(text, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


#: A line end: CR, LF, both, or the end of a frame with the CRs around it.
LINE_END = r"[\n\r\x1c](?:(?<=\r)\x1c\r?|(?<=\x1c)\r|(?<=\r)\n)?"


def split_messages(raw) -> Column:
    """Messages in one file, in order, each with its lines joined by CR.

    A message ends at a blank line or before a line starting ``MSH|``; text that
    belongs to no ``MSH|`` line is dropped. NULL or empty text gives no message.
    The text is cut at its line ends in one pass and lines are trimmed. Each line then gets the sign
    before it, CR or, where a message ends, a file separator, which no line has left.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    lines = F.transform(
        F.split(_replaced(raw, ("\x0b", "")), LINE_END), lambda line: F.btrim(line, F.lit(BLANKS))
    )
    border = F.lit("\x1c")
    signed = F.transform(
        lines,
        lambda line: F.concat(F.when((line == "") | line.startswith("MSH|"), border).otherwise(F.lit("\r")), line),
    )
    found = F.filter(F.split(F.array_join(signed, ""), "\x1c"), lambda m: m.startswith("MSH|"))
    return F.coalesce(found, F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it in a lambda.

    A column that is only named in a lambda would be computed for each of its calls.
    """
    return F.get(F.transform(F.array(value), body), 0)


def message_lines(raw) -> Column:
    """Non-empty segment lines of a message."""
    return F.filter(F.split(raw, "\r"), lambda line: F.length(line) > 0)


def line_kind(line) -> Column:
    return F.substring(line, 1, 3)


def _whole(text: Column) -> Column:
    return F.array(F.array(F.array(text)))


def _repetitions(text: Column) -> Column:
    """Repetitions of components of subcomponents."""
    components = lambda rep: F.transform(F.split(rep, r"\^"), lambda c: F.split(c, "&"))
    return F.transform(F.split(text, "~"), components)


def _fields(line: Column) -> Column:
    """Field number -> repetition -> component -> subcomponent, each by position.

    The header counts its separator as field 1 and keeps field 2 (the encoding
    characters) whole; everywhere else the split position is the field number.
    Most fields are empty, which is NULL here, or hold one plain value.
    """
    cut = F.split(line, r"\|")
    whole = lambda text: F.when(text != "", _whole(text))

    def entry(text):
        nested = text.contains("^") | text.contains("~") | text.contains("&")
        return F.when(text == "", F.lit(None)).when(nested, _repetitions(text)).otherwise(_whole(text))

    # Fields are told apart from the header's once per line, not once per field.
    first = F.transform(F.concat(F.array(F.lit("MSH"), F.lit("|")), F.slice(cut, 2, 1)), whole)
    later = F.transform(F.slice(cut, 3, F.greatest(F.size(cut), F.lit(1))), entry)
    return F.when(line.startswith("MSH"), F.concat(first, later)).otherwise(F.transform(cut, entry))


def parse_message(raw, kinds=None) -> Column:
    """A message as ``type -> repeats``; with ``kinds``, only of these types.

    A repeat is ``(index, segment, fields)`` with the index counted from 1. Each
    line is cut up once.
    """
    lines = message_lines(raw)
    if kinds:
        lines = F.filter(lines, lambda line: line_kind(line).isin(*kinds))
    cut = F.transform(lines, lambda line: F.struct(line_kind(line).alias("segment"), _fields(line).alias("fields")))

    def grouped(segments):
        def repeats(kind):
            mine = F.filter(segments, lambda s: s["segment"] == kind)
            return F.transform(
                mine, lambda s, i: F.struct((i + 1).alias("index"), s["segment"].alias("segment"), s["fields"].alias("fields"))
            )

        found = F.array_distinct(F.transform(segments, lambda s: s["segment"]))
        return F.map_from_entries(
            F.transform(found, lambda kind: F.struct(kind.alias("key"), repeats(kind).alias("value")))
        )

    return let(cut, grouped)


def field(segment, number: int, comp: int = 1, sub: int = 1, rep: int = 0) -> Column:
    """Value in a parsed segment struct; NULL when absent or empty."""
    value = F.get(F.get(F.get(F.get(segment["fields"], number), rep), comp - 1), sub - 1)
    return F.nullif(value, F.lit(""))


def first_segment(hl7, kind: str) -> Column:
    return F.get(hl7[kind], 0)


def first_line(raw, kind: str) -> Column:
    """First line of a segment type in a message; NULL when absent."""
    at = F.instr(raw, "\r" + kind)
    later = F.when(at > 0, F.substring_index(F.substr(raw, at + 1), "\r", 1))
    return F.when(raw.startswith(kind), F.substring_index(raw, "\r", 1)).otherwise(later)


def segment_lines(raw, kind: str) -> Column:
    """All lines of a segment type, in order."""
    return F.filter(F.split(raw, "\r"), lambda line: line.startswith(kind))


def line_field(parts, number: int, comp: int = 1, header: bool = False) -> Column:
    """Field of a line already split at ``|``; the text twin of :func:`field`.

    ``comp`` 0 keeps the whole field as written.
    """
    text = F.get(parts, F.lit(number - 1 if header else number))
    if comp:
        text = F.substring_index(text, "~", 1)
        text = (
            F.substring_index(text, "^", 1)
            if comp == 1
            else F.split_part(text, F.lit("^"), F.lit(comp))
        )
        text = F.substring_index(text, "&", 1)
    return F.nullif(text, F.lit(""))
