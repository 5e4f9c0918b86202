"""Column expressions shared by several operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage code generation; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern that takes the line number out of a line name.
LINE_NUMBER_PATTERN = r"(\d+).*"


def line_number(name: Column | str) -> Column:
    """First run of digits in a line name; '' when there is none, null on null."""
    return F.regexp_extract(F.col(name) if isinstance(name, str) else name,
                            LINE_NUMBER_PATTERN, 1)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970-01-01 (floor), for either timestamp type.

    A zoned ``timestamp`` gives true epoch seconds.  A ``timestamp_ntz`` has
    no zone; its wall clock is counted from the NTZ epoch, which does not
    depend on the session time zone (casting it to bigint is refused in
    Spark 4).
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(
            f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(F.col(column))
    return F.col(column).cast("bigint")


def flag(cond: Column) -> Column:
    """1 where ``cond`` holds, else 0 (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
