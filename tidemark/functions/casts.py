"""Lenient casts: a value that does not parse becomes NULL, never an error.

They hold whether ``spark.sql.ansi.enabled`` is on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that is an INT as it stands.
_WHOLE = r"^[+-]?[0-9]{1,9}$"
# Sign, digits and an optional fraction, with at least a digit or a point.
# Spaces and control characters around the number do not matter.
_FRACTIONAL = r"^[\s\p{Cntrl}]*([+-]?)(?=[0-9.])([0-9]*)(\.[0-9]*)?[\s\p{Cntrl}]*$"


def lenient_double(value: Column) -> Column:
    return value.try_cast("double")


def lenient_int(value: Column, dtype: T.DataType) -> Column:
    """INT, truncating a fraction towards zero. Exponents and type suffixes in
    text, and anything out of range, give NULL."""
    if not isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return value.try_cast("int")
    # Spark casts malformed text by throwing and catching for each value, so the
    # patterns let through only text that parses; what is left can still overflow.
    digits = F.concat(
        F.regexp_extract(value, _FRACTIONAL, 1), F.lit("0"), F.regexp_extract(value, _FRACTIONAL, 2)
    )
    return F.when(value.rlike(_WHOLE), value.try_cast("int")).when(
        value.rlike(_FRACTIONAL), digits.try_cast("int")
    )


def lenient_date(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.try_to_date(value)
    return F.to_date(value)


def hour_of(value: Column, dtype: T.DataType) -> Column:
    """Hour of day; text that is not a timestamp gives NULL."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.hour(F.try_to_timestamp(value))
    return F.hour(value)
