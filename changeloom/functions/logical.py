"""Logical date and time types: numbers that stand for dates, timestamps and times of day."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical type name -> (kind, unit).
LOGICAL_TYPES = {
    "io.debezium.time.Date": ("date", "days"),
    "io.debezium.time.Timestamp": ("timestamp", "millis"),
    "io.debezium.time.MicroTimestamp": ("timestamp", "micros"),
    "io.debezium.time.NanoTimestamp": ("timestamp", "nanos"),
    "io.debezium.time.MicroTime": ("time", "micros"),
    "io.debezium.time.NanoTime": ("time", "nanos"),
    "date": ("date", "days"),
    "timestamp-millis": ("timestamp", "millis"),
    "timestamp-micros": ("timestamp", "micros"),
    "time-millis": ("time", "millis"),
    "time-micros": ("time", "micros"),
}

_MAX_DAYS = 100_000_000
_MAX_MILLIS = 9_223_372_036_854_775
_NANOS_PER_DAY = 86_400_000_000_000
_NANOS_PER_UNIT = {"millis": 1_000_000, "micros": 1_000, "nanos": 1}


def _div(col: Column, by: int) -> Column:
    """Integer division, cut toward zero."""
    return F.call_function("div", col, F.lit(by)) if by != 1 else col


def norm_date(days: Column) -> Column:
    """Epoch days -> date; null outside the supported range."""
    days = days.cast("bigint")
    return F.when(days.between(-_MAX_DAYS, _MAX_DAYS), F.date_from_unix_date(days.cast("int")))


def norm_ts_millis(millis: Column) -> Column:
    """Epoch milliseconds -> timestamp without zone, in UTC."""
    millis = millis.cast("bigint")
    return F.when(millis.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(millis).cast("timestamp_ntz"))


def norm_ts_micros(micros: Column, precision: str = "millis") -> Column:
    """Epoch microseconds -> timestamp without zone, cut toward zero to milliseconds unless ``micros``."""
    micros = micros.cast("bigint")
    if precision == "micros":
        return F.timestamp_micros(micros).cast("timestamp_ntz")
    return norm_ts_millis(_div(micros, 1_000))


def norm_ts_nanos(nanos: Column, precision: str = "millis") -> Column:
    """Epoch nanoseconds -> timestamp without zone, cut toward zero to milliseconds unless ``micros``."""
    nanos = nanos.cast("bigint")
    if precision == "micros":
        return F.timestamp_micros(_div(nanos, 1_000)).cast("timestamp_ntz")
    return norm_ts_millis(_div(nanos, 1_000_000))


def norm_time(amount: Column, unit: str) -> Column:
    """Milli-, micro- or nanoseconds of day -> time of day (microsecond precision); null outside one day."""
    nanos = _nanos_of_day(amount, unit)
    return F.try_to_time(
        F.concat(
            F.lpad(_div(nanos, 3_600_000_000_000).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((_div(nanos, 60_000_000_000) % 60).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((_div(nanos, 1_000_000_000) % 60).cast("string"), 2, "0"),
            F.lit("."),
            F.lpad((_div(nanos, 1_000) % 1_000_000).cast("string"), 6, "0"),
        )
    )


def _nanos_of_day(amount: Column, unit: str) -> Column:
    per = _NANOS_PER_UNIT[unit]
    amount = amount.cast("bigint")
    return F.when(amount.between(0, _NANOS_PER_DAY // per - 1), amount * per)


def iso_ts_text(ts: Column) -> Column:
    """ISO UTC text that leaves out zero seconds and zero fractions, such as ``2024-01-01T03:04Z``."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"(:00\.000000|\.000000|000)$", ""), F.lit("Z"))


def iso_time_text(amount: Column, unit: str) -> Column:
    """ISO time-of-day text that leaves out zero seconds and zero fractions, such as ``03:04``."""
    nanos = _nanos_of_day(amount, unit)
    text = F.concat(
        F.lpad(_div(nanos, 3_600_000_000_000).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((_div(nanos, 60_000_000_000) % 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((_div(nanos, 1_000_000_000) % 60).cast("string"), 2, "0"),
        F.lit("."),
        F.lpad((nanos % 1_000_000_000).cast("string"), 9, "0"),
    )
    return F.regexp_replace(text, r"(:00\.000000000|\.000000000|000000|000)$", "")


def logical_text(number: Column, name: str | Column, precision: str = "millis") -> Column:
    """ISO text of a number under a logical type; null when the type is unknown or the number out of range.

    ``name`` is a string when one type holds for the whole column, or a column when it differs by row.
    """
    if isinstance(name, str):
        return _text_of(number, *LOGICAL_TYPES[name], precision) if name in LOGICAL_TYPES else F.lit(None).cast("string")
    groups: dict[tuple[str, str], list[str]] = {}
    for known, kind in LOGICAL_TYPES.items():
        groups.setdefault(kind, []).append(known)
    out = F.when(name.isNull(), F.lit(None).cast("string"))
    for (kind, unit), names in groups.items():
        out = out.when(name.isin(names), _text_of(number, kind, unit, precision))
    return out


def _text_of(number: Column, kind: str, unit: str, precision: str) -> Column:
    if kind == "date":
        return norm_date(number).cast("string")
    if kind == "time":
        return iso_time_text(number, unit)
    to_ts = {
        "millis": norm_ts_millis,
        "micros": lambda n: norm_ts_micros(n, precision),
        "nanos": lambda n: norm_ts_nanos(n, precision),
    }[unit]
    return iso_ts_text(to_ts(number))


def is_number(v: Column) -> Column:
    """Whether a variant holds a number (a quoted number is text, not a number)."""
    kind = F.schema_of_variant(v)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def is_logical(v: Column, name: Column) -> Column:
    """Whether a value is a number with a known logical type."""
    return F.coalesce(name.isin(list(LOGICAL_TYPES)) & is_number(v), F.lit(False))


def type_of(types: Column, column: Column | str) -> Column:
    """Logical type of a column in ``ARRAY<STRUCT<field, name>>``, or null."""
    return F.get(types["name"], F.array_position(types["field"], column) - 1)


def normalise_fields(fields: Column, types: Column, precision: str = "millis") -> Column:
    """Replace numbers by ISO text in ``MAP<STRING,VARIANT>``, by the row's own column types."""

    def one(key: Column, v: Column) -> Column:
        name = type_of(types, key)
        text = F.when(is_logical(v, name), logical_text(F.try_variant_get(v, "$", "bigint"), name, precision))
        return F.coalesce(text.cast("variant"), v)

    return F.when(types.isNotNull(), F.transform_values(fields, one)).otherwise(fields)


# Metadata keys of a field that carry its logical type, the first that is there counts.
CARRIED = ("connect.name", "logicalType")


def logical_name(metadata: dict) -> str | None:
    """The logical type that a field's metadata carries."""
    return next((metadata[key] for key in CARRIED if metadata.get(key)), None)


def with_logical_types(kind: T.StructType, schema_json: str) -> T.StructType:
    """A decoded struct type whose row images carry the logical types of their Avro schema as metadata of the fields."""
    names = avro_logical_types(schema_json)
    images = [n for n in ("before", "after") if n in kind.names] if "op" in kind.names else []

    def marked(struct: T.StructType, prefix: str) -> T.StructType:
        fields = []
        for f in struct.fields:
            path = prefix + f.name
            inner = marked(f.dataType, path + ".") if isinstance(f.dataType, T.StructType) else f.dataType
            carried = {CARRIED[0]: names[path]} if path in names else {}
            fields.append(T.StructField(f.name, inner, f.nullable, {**f.metadata, **carried}))
        return T.StructType(fields)

    if not images:
        return marked(kind, "")
    return T.StructType(
        [T.StructField(f.name, marked(f.dataType, "") if f.name in images else f.dataType, f.nullable, f.metadata) for f in kind.fields]
    )


def avro_logical_types(schema_json: str) -> dict[str, str]:
    """Column path -> logical type name of the row images in an Avro envelope schema.

    Driver-side walk of the schema text. A nullable union resolves to its first non-null branch; a carried
    ``connect.name`` goes before the Avro ``logicalType``. Paths are relative to ``before``/``after``, or to
    the record itself when it is not an envelope.
    """
    named: dict[str, dict] = {}
    found: dict[str, str] = {}

    def resolve(schema):
        if isinstance(schema, list):
            return resolve(next((s for s in schema if s != "null"), "null"))
        if isinstance(schema, str):
            return named.get(schema.rsplit(".", 1)[-1], {"type": schema})
        if isinstance(schema.get("type"), (dict, list)):
            inner = resolve(schema["type"])
            return {**inner, **{k: v for k, v in schema.items() if k != "type"}}
        if schema.get("type") in ("record", "enum", "fixed") and "name" in schema:
            named[schema["name"].rsplit(".", 1)[-1]] = schema
        return schema

    def walk(record: dict, prefix: str) -> None:
        for field in record.get("fields", []):
            inner = resolve(field["type"])
            path = prefix + field["name"]
            if inner.get("type") == "record":
                walk(inner, path + ".")
                continue
            name = inner.get("connect.name") or inner.get("logicalType")
            if name:
                found[path] = name

    root = resolve(json.loads(schema_json))
    images = [f for f in root.get("fields", []) if f["name"] in ("before", "after")]
    if images and any(f["name"] == "op" for f in root["fields"]):
        for field in images:
            walk(resolve(field["type"]), "")
    else:
        walk(root, "")
    return found
