"""Names under which the text functions can be called from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from streamloom.functions import text
from streamloom.functions.arithmetic import calculate


def register(spark: SparkSession) -> None:
    """Make ``calculate``, ``transform_digit``, ``script_tables`` and ``script_overwrites`` callable in SQL."""
    spark.udf.register("calculate", calculate)
    for name, (returns, body) in SQL_BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(input STRING) RETURNS {returns} RETURN {body}")


def _value(char: str, values: dict[str, float]) -> str:
    numbers = ", ".join(f"{v}D" for v in values.values())
    return f"try_element_at(array({numbers}), nullif(instr('{''.join(values)}', {char}), 0))"


SQL_BODIES = {
    "transform_digit": ("STRING", f"""CAST(aggregate(
        regexp_extract_all(input, '{text.SCALED_DIGIT}', 0), 0D,
        (total, part) -> total + {_value('left(part, 1)', text.DIGITS)} * coalesce({_value('right(part, 1)', text.UNITS)}, 1D)
        ) AS STRING)"""),
    "script_tables": ("ARRAY<STRING>", f"regexp_extract_all(input, r'{text.CREATED_OR_OVERWRITTEN}', 1)"),
    "script_overwrites": ("ARRAY<STRING>", f"regexp_extract_all(input, r'{text.OVERWRITTEN}', 1)"),
}
