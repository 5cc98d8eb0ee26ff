"""Typed coercion of change values: safe casts with null on failure."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Magnitude limits below which all-digit timestamp text means seconds, milliseconds, microseconds.
EPOCH_SECONDS_BELOW = 31_536_000_000
EPOCH_MILLIS_BELOW = 31_536_000_000_000
EPOCH_MICROS_BELOW = 31_536_000_000_000_000

# Fixed value: a number above this in a DATE column is epoch milliseconds, otherwise epoch days.
EPOCH_DAYS_UP_TO = 1_000_000

_MAX_MILLIS = 9_223_372_036_854_775

# Words of a boolean column.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

# A safe cast that fails raises and catches an error inside the engine, which costs far more than a cast that
# works. Text that cannot fit is therefore recognised by its shape first.
_NOT_FINITE = r"(?i)^\s*(nan|[+-]?inf(inity)?)\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DIGITS = r"^\s*[+-]?\d{1,19}\s*$"
_SHORT_DIGITS = r"^[+-]?\d{1,18}$"
_DATE = r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}"
_ZONE_AFTER_MINUTES = r"([T ]\d{1,2}:\d{2})(Z|[+-]\d{2}:?\d{2})\s*$"


def to_number(text: Column, dtype: T.DataType, number_scale: str = "declared") -> Column:
    """Text -> number. Integer types and ``number_scale="zero"`` round half up to a whole number first."""
    if isinstance(dtype, T.DecimalType) and number_scale == "declared":
        return F.when(text.rlike(_NUMBER), text.try_cast(dtype))
    rounded = text.try_cast(T.DecimalType(38, 0)).try_cast(dtype)
    if isinstance(dtype, T.IntegralType):
        return F.when(text.rlike(_SHORT_DIGITS), text.try_cast(dtype)).when(text.rlike(_NUMBER), rounded)
    return F.when(text.rlike(_NUMBER), rounded)


def to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def to_date_mixed(text: Column) -> Column:
    """Date text, epoch days, or epoch milliseconds by magnitude."""
    number = text.try_cast(T.DecimalType(38, 0))
    from_number = F.when(
        F.abs(number) > EPOCH_DAYS_UP_TO,
        F.when(
            F.abs(number) <= _MAX_MILLIS, F.timestamp_millis(number.cast("bigint")).cast("timestamp_ntz").cast("date")
        ),
    ).otherwise(F.date_from_unix_date(number.cast("int")))
    return F.when(text.rlike(_NUMBER), from_number).when(text.rlike(_DATE), text.try_cast("date"))


def to_timestamp_ntz(text: Column) -> Column:
    """Timestamp text with or without zone or seconds, or an all-digit epoch by magnitude. A zone is ignored."""
    number = text.try_cast("bigint")
    micros = (
        F.when(number < -_MAX_MILLIS // 1_000, F.lit(None).cast("bigint"))
        .when(number < EPOCH_SECONDS_BELOW, number * 1_000_000)
        .when(number < EPOCH_MILLIS_BELOW, number * 1_000)
        .when(number < EPOCH_MICROS_BELOW, number)
        .otherwise(F.call_function("div", number, F.lit(1_000)))
    )
    no_zone = F.regexp_replace(text, _ZONE_AFTER_MINUTES, "$1")
    return (
        F.when(text.rlike(_DIGITS), F.timestamp_micros(micros).cast("timestamp_ntz"))
        .when(text.rlike(_ZONE_AFTER_MINUTES), no_zone.try_cast("timestamp_ntz"))
        .when(text.rlike(_DATE), text.try_cast("timestamp_ntz"))
    )


def to_binary(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("hex"))


def variant_text(v: Column) -> Column:
    """Text of a variant: scalars plain, nested values as compact JSON, JSON null as null."""
    return v.cast("string")


def coerce(v: Column, dtype: T.DataType, number_scale: str = "declared", empty_as_null: bool = False) -> Column:
    """One variant value -> the declared type; null when it does not fit.

    ``number_scale="zero"`` rounds every decimal to a whole number, as a safe cast that names no scale does.
    """
    if isinstance(dtype, T.VariantType):
        return v
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.try_variant_get(v, "$", dtype.simpleString())
    text = variant_text(v)
    return coerce_text(F.nullif(text, F.lit("")) if empty_as_null else text, dtype, number_scale)


def coerce_text(text: Column, dtype: T.DataType, number_scale: str = "declared") -> Column:
    """The text branch of ``coerce``."""
    if isinstance(dtype, (T.DecimalType, T.IntegralType)):
        return to_number(text, dtype, number_scale)
    if isinstance(dtype, T.FractionalType):
        # The cast alone would also read a type suffix or a hexadecimal float.
        return F.when(text.rlike(_NUMBER) | text.rlike(_NOT_FINITE), text.try_cast(dtype))
    if isinstance(dtype, T.BooleanType):
        return to_boolean(text)
    if isinstance(dtype, T.DateType):
        return to_date_mixed(text)
    if isinstance(dtype, T.TimestampNTZType):
        return to_timestamp_ntz(text)
    if isinstance(dtype, T.TimestampType):
        return to_timestamp_ntz(text).cast("timestamp")
    if isinstance(dtype, T.TimeType):
        return text.try_cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return to_binary(text)
    return text


def warehouse_type(name: str, time_type: bool = True) -> T.DataType:
    """Declared warehouse type text -> Spark type; unknown names are text.

    The tests run in the order number, float, boolean, date, timestamp, time, binary, semi-structured, text.
    """
    match = re.fullmatch(r"\s*([A-Za-z_ ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", name)
    base = (match.group(1) if match else name).upper()
    if any(word in base for word in ("NUMBER", "DECIMAL", "NUMERIC")):
        precision = int(match.group(2)) if match and match.group(2) else 38
        return T.DecimalType(precision, int(match.group(3)) if match and match.group(3) else 0)
    if "INT" in base:
        return T.LongType() if base in ("BIGINT", "LONG") else T.IntegerType()
    if any(word in base for word in ("FLOAT", "DOUBLE", "REAL")):
        return T.DoubleType()
    if "BOOLEAN" in base:
        return T.BooleanType()
    if base == "DATE":
        return T.DateType()
    if "TIMESTAMP" in base:
        return T.TimestampNTZType()
    if base == "TIME":
        return T.TimeType(6) if time_type else T.StringType()
    if "BINARY" in base:
        return T.BinaryType()
    if any(word in base for word in ("VARIANT", "OBJECT", "ARRAY")):
        return T.VariantType()
    return T.StringType()
