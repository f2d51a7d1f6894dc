"""Value cleaning: timestamps, numbers, ranges, names, codes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp layouts, longest first.
TS_LAYOUTS = ("yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyyMMdd")

# Code sets used by the value functions.
SEX_TEXT = {
    "M": "Male",
    "F": "Female",
    "U": "Unknown",
    "O": "Other",
    "A": "Ambiguous",
    "N": "Not Applicable",
}
CLASS_TEXT = {
    "I": "Inpatient",
    "O": "Outpatient",
    "E": "Emergency",
    "P": "Preadmit",
    "R": "Recurring Patient",
    "B": "Observation",
    "C": "Commercial Account",
    "N": "Not Applicable",
    "U": "Unknown",
}
GOLD_CLASSES = ("I", "O", "E", "P")
ABNORMAL = ("H", "HH", "L", "LL", "A", "AA", "C")
ABNORMAL_ANY = (*ABNORMAL, "CR")
SEVERE = ("SV", "SE")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def hl7_ts(c) -> Column:
    """Timestamp from 14, 12 or 8 digits, else NULL.

    The digits are set out as ISO text and cast, which costs a tenth of parsing by
    pattern; missing parts of the time are zero.
    """
    c = _col(c)
    full = F.rpad(c, 14, "0")
    at = lambda start, size: F.substring(full, start, size)
    iso = F.concat(
        at(1, 4), F.lit("-"), at(5, 2), F.lit("-"), at(7, 2), F.lit(" "),
        at(9, 2), F.lit(":"), at(11, 2), F.lit(":"), at(13, 2),
    )
    fits = F.length(c).isin(*[len(layout) for layout in TS_LAYOUTS])
    digits = F.translate(c, "0123456789", "") == ""
    return F.when(fits & digits & (c >= "0001"), iso.try_cast("timestamp"))


def hl7_ts_text(c) -> Column:
    """ISO text of the longest leading timestamp; the input when none parses.

    Anything from the first ``+`` or ``-`` on (the zone offset) is cut off.
    """
    c = _col(c)
    stem = F.substring_index(F.substring_index(c, "+", 1), "-", 1)
    parsed = F.coalesce(
        *[
            F.when(
                F.length(stem) >= len(layout),
                F.try_to_timestamp(F.substring(stem, 1, len(layout)), F.lit(layout)),
            )
            for layout in TS_LAYOUTS
        ]
    )
    iso = F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.length(c) > 0, F.coalesce(iso, stem))


def surrogate_key(*cols, nulls: str = "skip") -> Column:
    """md5 of ``|``-joined values; NULLs are left out or count as blank."""
    parts = [_col(c).cast("string") for c in cols]
    if nulls == "blank":
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    elif nulls != "skip":
        raise ValueError(f"nulls must be 'skip' or 'blank', not {nulls!r}")
    return F.md5(F.concat_ws("|", *parts))


def content_id(raw, ts) -> Column:
    """First 32 hex digits of sha256 over text and timestamp text."""
    return F.substring(F.sha2(F.concat(_col(raw), _col(ts)), 256), 1, 32)


def entity_key(*cols) -> Column:
    """md5 of the non-empty values; a random id when all are empty."""
    joined = F.concat_ws("|", *[_blank_to_null(_col(c).cast("string")) for c in cols])
    return F.when(joined != "", F.md5(joined)).otherwise(F.translate(F.uuid(), "-", ""))


def clean_id(c) -> Column:
    """Trimmed upper-case id; NULL when empty."""
    return F.upper(F.trim(_blank_to_null(c)))


def numeric_text(c) -> Column:
    """Number left after dropping all but digits, dots and minus signs."""
    return F.regexp_replace(_col(c), r"[^\d.\-]", "").try_cast("double")


def nm_value(value_type, text) -> Column:
    """Leading number of a numeric (``NM``) observation, else NULL."""
    number = F.regexp_extract(_col(text), r"^-?[\d.]+", 0).try_cast("double")
    return F.when(_col(value_type) == "NM", number)


def reference_range(c) -> Column:
    """Struct ``low, high`` from ``a-b``, ``<x`` or ``>x``."""
    text = F.trim(_col(c))
    span = F.split(text, "-")
    # a minus sign inside (not first) makes it a span, good or bad
    is_span = text.contains("-") & ~text.startswith("-")
    low, high = (F.trim(F.get(span, i)).try_cast("double") for i in (F.lit(0), F.lit(1)))
    two = F.size(span) == 2
    tail = F.trim(F.substring(text, 2, 1 << 30)).try_cast("double")
    return F.struct(
        F.when(is_span, F.when(two, low)).when(text.startswith(">"), tail).alias("low"),
        # a span whose first end is no number yields neither end
        F.when(is_span, F.when(two & low.isNotNull(), high))
        .when(text.startswith("<"), tail)
        .alias("high"),
    )


def age_years(dob, as_of) -> Column:
    """Whole years between two dates; NULL when negative."""
    dob, as_of = _col(dob), _col(as_of)
    early = (F.date_format(as_of, "MMdd") < F.date_format(dob, "MMdd")).cast("int")
    years = F.year(as_of) - F.year(dob) - early
    return F.when(years >= 0, years)


def full_name(family, given, middle=None) -> Column:
    parts = [given, *([middle] if middle is not None else []), family]
    return _blank_to_null(F.concat_ws(" ", *[_blank_to_null(p) for p in parts]))


def full_address(street, city, state, zip_code, country=None) -> Column:
    parts = [_blank_to_null(p) for p in (street, city, state, zip_code)]
    if country is not None:
        parts.append(F.when(F.upper(_col(country)) != "USA", _blank_to_null(country)))
    return _blank_to_null(F.concat_ws(", ", *parts))


def _coded(c, table: dict[str, str]) -> Column:
    """Code text by upper-cased code; unknown codes pass through."""
    value = _blank_to_null(c)
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(lookup[F.upper(value)], value)


def sex_text(c) -> Column:
    return _coded(c, SEX_TEXT)


def class_text(c) -> Column:
    return _coded(c, CLASS_TEXT)


def class_desc(c) -> Column:
    """Class text as the encounter fact shows it: four codes, exact case."""
    c = _col(c)
    out = F
    for code in GOLD_CLASSES:
        out = out.when(c == code, F.lit(CLASS_TEXT[code]))
    return out.otherwise(c)


def is_abnormal(c) -> Column:
    return F.coalesce(_col(c).isin(*ABNORMAL), F.lit(False))


def is_abnormal_any(c) -> Column:
    return F.coalesce(F.upper(_col(c)).isin(*ABNORMAL_ANY), F.lit(False))


def is_severe(c) -> Column:
    return F.coalesce(_col(c).isin(*SEVERE), F.lit(False))


def los_hours(admit, discharge) -> Column:
    """Hours between two timestamps; NULL when either is missing."""
    return (F.unix_timestamp(_col(discharge)) - F.unix_timestamp(_col(admit))) / 3600


def label_blank(c, label: str) -> Column:
    """Trimmed text, or ``label`` when it is NULL or blank."""
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")), F.lit(label))


def when_run(as_of=None) -> Column:
    """The moment a report looks back from; the clock unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def steady_avg(c) -> Column:
    """Mean that does not depend on the order in which tasks finish.

    The sum runs over decimals of ten places, so it is exact for every value with
    as many, and a mean that ends in a 5 always rounds the same way.
    """
    exact = _col(c).cast("decimal(38,10)")
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))
