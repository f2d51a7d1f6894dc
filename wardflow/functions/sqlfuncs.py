"""The value functions under SQL names, for ``spark.sql`` users.

They are SQL functions over built-in expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from wardflow.functions.values import ABNORMAL_ANY, CLASS_TEXT, SEX_TEXT


def _lookup(arg: str, table: dict[str, str]) -> str:
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in table.items())
    return f"CASE WHEN {arg} != '' THEN coalesce(element_at(map({pairs}), upper({arg})), {arg}) END"


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the session's SQL functions; returns their names.

    ``generate_key`` takes an array of any number of values. Empty ones are
    skipped, and with none left it gives a random id.
    """
    joined = "array_join(filter(parts, x -> x != ''), '|')"
    flags = ", ".join(f"'{x}'" for x in ABNORMAL_ANY)
    functions = {
        "generate_key": (
            "parts ARRAY<STRING>",
            "STRING",
            f"CASE WHEN {joined} != '' THEN md5({joined}) ELSE replace(uuid(), '-', '') END",
        ),
        "try_numeric": (
            "value STRING",
            "DOUBLE",
            r"try_cast(regexp_replace(value, '[^0-9.\\-]', '') AS DOUBLE)",
        ),
        "is_abnormal": ("flags STRING", "BOOLEAN", f"coalesce(upper(flags) IN ({flags}), false)"),
        "format_name": (
            "family STRING, given STRING, middle STRING DEFAULT NULL",
            "STRING",
            "nullif(concat_ws(' ', nullif(given, ''), nullif(middle, ''), nullif(family, '')), '')",
        ),
        "standardize_sex": ("sex STRING", "STRING", _lookup("sex", SEX_TEXT)),
        "standardize_patient_class": ("class STRING", "STRING", _lookup("class", CLASS_TEXT)),
    }
    for name, (params, returns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(functions)
