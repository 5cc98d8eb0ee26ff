"""Payload projection: change records -> operation, time and business fields.

Every operator is a column expression over the whole frame. JSON text is parsed once per row into a variant;
everything after that navigates the variant. ``fields`` is ``MAP<STRING,VARIANT>`` or, for known columns, the variant
itself: it accepts any keys and keeps number against string and exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.logical import LOGICAL_TYPES, iso_ts_text, logical_name, logical_text, normalise_fields

FIELDS = "map<string,variant>"

_ENVELOPE_SCHEMA = "array<struct<field string, fields variant>>"
_ROW_SCHEMA = "array<struct<field string, name string>>"


def _get(v: Column, key: str) -> Column:
    """Value of a key as a variant: SQL null when the key is absent, a variant null when its value is null."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", FIELDS)


def _is_object(v: Column) -> Column:
    """Whether a variant is an object, told without building its map; null or false otherwise."""
    return F.try_variant_get(v, "$", "struct<_:variant>").isNotNull()


def _no_fields(typed: bool = False) -> Column:
    return F.parse_json(F.lit("{}")) if typed else F.from_json(F.lit("{}"), FIELDS)


def _now_millis(now_ms: int | Column | None) -> Column:
    if now_ms is None:
        return F.unix_millis(F.current_timestamp())
    return now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")


def _decode(df: DataFrame, value: str) -> DataFrame:
    """Add ``_root`` (variant) for a text, binary, map or variant value."""
    kind = df.schema[value].dataType
    col = F.col(value)
    if isinstance(kind, T.VariantType):
        root = col
    elif isinstance(kind, T.MapType):
        root = F.when(col.isNotNull(), F.try_parse_json(F.to_json(col)))
    else:
        root = F.try_parse_json(col.cast("string"))
    return df.withColumn("_root", root)


def unwrap_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``payload`` (variant): the inner object of ``{schema, payload}`` when both keys exist, else the root."""
    return _unwrap(_decode(df, value)).drop("_root", "_schema")


def _unwrap(df: DataFrame) -> DataFrame:
    out = df.withColumn("_schema", _get(F.col("_root"), "schema"))
    inner = F.when(F.col("_schema").isNotNull(), _get(F.col("_root"), "payload"))
    return out.withColumn("payload", F.coalesce(inner, F.col("_root")))


def detect_format(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``fmt``: ``envelope``, ``flat``, or null when the value is not usable."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.StructType):
        fmt = F.lit("envelope" if _is_envelope_struct(kind) else "flat")
        return df.withColumn("fmt", F.when(F.col(value).isNotNull(), fmt))
    is_object = _as_map(F.col("_root")).isNotNull()
    fmt = F.when(F.col("_envelope"), F.lit("envelope")).when(is_object, F.lit("flat"))
    return _detect(df, value).withColumn("fmt", fmt).drop(*_DECODED)


_DECODED = ["_root", "_schema", "payload", "_op", "_before", "_after", "_envelope"]


def _detect(df: DataFrame, value: str) -> DataFrame:
    """Add the decoded parts of a JSON value and ``_envelope``: it has ``op`` and ``before`` or ``after``."""
    out = _unwrap(_decode(df, value))
    out = out.withColumns({f"_{key}": _get(F.col("payload"), key) for key in ("op", "before", "after")})
    return out.withColumn(
        "_envelope",
        F.col("_op").isNotNull() & (F.col("_before").isNotNull() | F.col("_after").isNotNull()),
    )


def row_image(op: Column, before: Column, after: Column) -> Column:
    """The row a change carries: ``before`` for deletes, ``after`` for everything else."""
    return F.when(op == "d", before).otherwise(after)


def _message_types(df: DataFrame, when: Column) -> DataFrame:
    """Add ``_types``: ``ARRAY<STRUCT<field, name>>`` of the chosen image in the message's own schema, else null."""
    wanted = F.when(F.col("_op") == "d", F.lit("before")).otherwise(F.lit("after"))
    out = df.withColumn("_images", F.when(when, F.try_variant_get("_schema", "$.fields", _ENVELOPE_SCHEMA)))
    image = F.get(F.col("_images")["fields"], F.array_position(F.col("_images")["field"], wanted) - 1)
    return out.withColumn("_types", F.when(F.col("_images").isNotNull(), F.try_variant_get(image, "$", _ROW_SCHEMA)))


def logical_types(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``types`` (``MAP<STRING,STRING>``): the logical type of each column, as each message's schema states it."""
    out = _detect(df, value).withColumn("_op", F.coalesce(F.col("_op").cast("string"), F.lit("c")))
    out = _message_types(out, F.col("_schema").isNotNull())
    named = F.filter("_types", lambda x: (F.trim(x["field"]) != "") & (F.trim(x["name"]) != ""))
    return out.withColumn("types", F.map_from_entries(named)).drop(*_DECODED, "_images", "_types")


def parse_changes(
    df: DataFrame,
    value: str = "value",
    now_ms: int | Column | None = None,
    logical: dict[str, str] | None = None,
    unwrap_flat: bool = False,
    timestamp_precision: str = "millis",
    message_schemas: bool = True,
    typed: bool = False,
) -> DataFrame:
    """Change records -> parsed changes; the route follows the Spark type of the value column.

    Adds ``fmt, op, ts_ms, fields, missing_image, reject_reason`` and drops the value. ``reject_reason`` is one
    of ``null_value, malformed, not_object, bad_image`` or null; see ``apply_error_policy``.
    ``message_schemas=False`` states that no message carries a schema and saves the look at it.
    ``typed=True`` gives ``fields`` of JSON values as one variant instead of a map of all keys: the route for rows
    whose columns are known, since ``to_ingest`` then reads each column where it lies.
    """
    if isinstance(df.schema[value].dataType, T.StructType):
        return parse_struct(df, value, now_ms, logical, timestamp_precision)
    envelope = F.col("_envelope")
    own = F.col("payload") if unwrap_flat else F.col("_root")
    out = _detect(df, value)
    out = out.withColumns(
        {
            "_op": F.when(envelope, F.coalesce(F.col("_op").cast("string"), F.lit("c"))).otherwise("c"),
            "_ts_ms": F.coalesce(F.when(envelope, F.try_variant_get("payload", "$.ts_ms", "bigint")), _now_millis(now_ms)),
        }
    )
    out = out.withColumn(
        "_image", F.when(envelope, row_image(F.col("_op"), F.col("_before"), F.col("_after"))).otherwise(own)
    )
    out = out.withColumn("_row", F.when(_is_object(F.col("_image")), F.col("_image")) if typed else _as_map(F.col("_image")))
    no_image = F.col("_image").isNull() | F.is_variant_null(F.col("_image"))
    out = out.withColumns(
        {
            "_fmt": F.when(envelope, F.lit("envelope")).when(F.col("_row").isNotNull(), F.lit("flat")),
            "_missing": F.coalesce(envelope & no_image, F.lit(False)),
            "_reason": F.when(F.col(value).isNull(), F.lit("null_value"))
            .when(F.col("_root").isNull(), F.lit("malformed"))
            .when(envelope & ~no_image & F.col("_row").isNull(), F.lit("bad_image"))
            .when(~envelope & F.col("_row").isNull(), F.lit("not_object")),
        }
    )
    if message_schemas:
        out = _message_types(out, envelope & F.col("_schema").isNotNull())
        if typed:
            written = F.to_variant_object(normalise_fields(_as_map(F.col("_row")), F.col("_types"), timestamp_precision))
            row = F.when(F.col("_types").isNotNull(), written).otherwise(F.col("_row"))
        else:
            row = normalise_fields(F.col("_row"), F.col("_types"), timestamp_precision)
        out = out.withColumn("_row", row)
    out = out.withColumn("_row", F.coalesce(F.col("_row"), _no_fields(typed)))
    kept = [c for c in df.columns if c != value]
    return _emit(out, kept, fmt="_fmt", op="_op", ts_ms="_ts_ms", fields="_row", missing_image="_missing", reject_reason="_reason")


def _emit(df: DataFrame, kept: list[str], **parsed: str) -> DataFrame:
    """Select the kept columns and the parsed ones, the latter as a one-row generator.

    Filters on parsed columns stay above a generator, filters on the kept columns still go below it. With a plain
    projection the optimizer would copy the whole parse into every such filter and run it again there.
    """
    row = F.struct(*[F.col(col).alias(name) for name, col in parsed.items()])
    return df.select(*kept, F.inline_outer(F.array(row)))


def parse_flat(
    df: DataFrame, value: str = "value", now_ms: int | Column | None = None, typed: bool = False
) -> DataFrame:
    """Flat payloads only: all top-level keys become fields, the operation is ``c``, the time is now."""
    if isinstance(df.schema[value].dataType, T.StructType):
        return _finish_struct(df, value, F.lit("c"), _now_millis(now_ms), F.col(value), None, "millis", "flat")
    root = F.col("_root")
    out = _decode(df, value).withColumn("_row", F.when(_is_object(root), root) if typed else _as_map(root))
    out = out.withColumns(
        {
            "_fmt": F.when(F.col("_row").isNotNull(), F.lit("flat")),
            "_op": F.lit("c"),
            "_ts_ms": _now_millis(now_ms),
            "_missing": F.lit(False),
            "_reason": F.when(F.col(value).isNull(), F.lit("null_value"))
            .when(F.col("_root").isNull(), F.lit("malformed"))
            .when(F.col("_row").isNull(), F.lit("not_object")),
        }
    ).withColumn("_row", F.coalesce(F.col("_row"), _no_fields(typed)))
    kept = [c for c in df.columns if c != value]
    return _emit(out, kept, fmt="_fmt", op="_op", ts_ms="_ts_ms", fields="_row", missing_image="_missing", reject_reason="_reason")


def parse_envelope(
    df: DataFrame, value: str = "value", now_ms: int | Column | None = None, typed: bool = False
) -> DataFrame:
    """Envelope payloads only; a row of another shape gets the reason ``not_envelope``."""
    out = parse_changes(df, value, now_ms, typed=typed)
    return out.withColumn(
        "reject_reason",
        F.coalesce(F.col("reject_reason"), F.when(F.col("fmt") != "envelope", F.lit("not_envelope"))),
    )


# --- decoded structs -------------------------------------------------------------------------------------------


def _is_envelope_struct(kind: T.StructType) -> bool:
    """A struct is an envelope when it has ``op`` and at least one of ``before``, ``after``."""
    return "op" in kind.names and ("before" in kind.names or "after" in kind.names)


def _normalise_struct(
    col: Column, kind: T.DataType, path: str, plan: dict[str, str], precision: str, carried: str | None = None
) -> Column:
    """Rewrite the logical-typed leaves of a struct as ISO text, recursively; all is settled when the plan is built.

    A column's logical type is the one the job names for its path, else the one its field carries as metadata.
    """
    if isinstance(kind, T.StructType):
        inner = F.struct(
            *[
                _normalise_struct(
                    col[f.name], f.dataType, f"{path}.{f.name}" if path else f.name, plan, precision, logical_name(f.metadata)
                ).alias(f.name)
                for f in kind.fields
            ]
        )
        return F.when(col.isNotNull(), inner)
    name = plan.get(path) or carried
    if isinstance(kind, T.NumericType) and name in LOGICAL_TYPES:
        return F.coalesce(logical_text(col.cast("bigint"), name, precision), col.cast("string"))
    if isinstance(kind, T.TimestampType):
        return iso_ts_text(col if precision == "micros" else F.date_trunc("millisecond", col))
    return col


def struct_to_fields(
    col: Column, kind: T.StructType, logical: dict[str, str] | None = None, timestamp_precision: str = "millis"
) -> Column:
    """Struct column -> ``MAP<STRING,VARIANT>``; nested structs stay nested objects."""
    return _as_map(F.to_variant_object(_normalise_struct(col, kind, "", logical or {}, timestamp_precision)))


def _finish_struct(df, value, op, ts_ms, image, logical, precision, fmt) -> DataFrame:
    """Common tail of the struct routes; ``image`` is a struct column."""
    out = df.withColumns({"_op": op, "_ts": ts_ms}).withColumn("_image", image)
    kind = out.schema["_image"].dataType
    missing = F.col(value).isNotNull() & F.col("_image").isNull()
    out = out.withColumns(
        {
            "_fmt": F.when(F.col(value).isNotNull(), F.lit(fmt)),
            "_row": F.coalesce(struct_to_fields(F.col("_image"), kind, logical, precision), _no_fields()),
            "_missing": missing,
            "_reason": F.when(F.col(value).isNull(), F.lit("null_value")),
        }
    )
    kept = [c for c in df.columns if c != value]
    return _emit(out, kept, fmt="_fmt", op="_op", ts_ms="_ts", fields="_row", missing_image="_missing", reject_reason="_reason")


def parse_struct(
    df: DataFrame,
    value: str = "value",
    now_ms: int | Column | None = None,
    logical: dict[str, str] | None = None,
    timestamp_precision: str = "millis",
) -> DataFrame:
    """Decoded struct values: envelope when the schema has ``op`` and ``before`` or ``after``, else flat."""
    kind = df.schema[value].dataType
    if _is_envelope_struct(kind):
        return parse_struct_envelope(df, value, now_ms, logical, timestamp_precision)
    return _finish_struct(
        df, value, F.lit("c"), _now_millis(now_ms), F.col(value), logical, timestamp_precision, "flat"
    )


def parse_struct_envelope(
    df: DataFrame,
    value: str = "value",
    now_ms: int | Column | None = None,
    logical: dict[str, str] | None = None,
    timestamp_precision: str = "millis",
) -> DataFrame:
    """Decoded envelope structs. ``logical`` maps an image column path to its logical type, known before the job."""
    kind = df.schema[value].dataType
    images = [name for name in ("before", "after") if name in kind.names]
    for name in images:
        if not isinstance(kind[name].dataType, T.StructType):
            raise TypeError(f"{value}.{name} must be a struct, is {kind[name].dataType.simpleString()}")
    op = F.coalesce(F.col(value)["op"].cast("string"), F.lit("c"))
    ts_ms = _now_millis(now_ms)
    if "ts_ms" in kind.names and isinstance(kind["ts_ms"].dataType, T.NumericType):
        ts_ms = F.coalesce(F.col(value)["ts_ms"].cast("bigint"), ts_ms)
    none = F.lit(None).cast(kind[images[0]].dataType)
    before = F.col(value)["before"] if "before" in images else none
    after = F.col(value)["after"] if "after" in images else none
    return _finish_struct(df, value, op, ts_ms, row_image(op, before, after), logical, timestamp_precision, "envelope")


# --- rejects ---------------------------------------------------------------------------------------------------


def before_first_reject(parsed: DataFrame, tombstones: str = "error") -> tuple[DataFrame, DataFrame]:
    """Usable rows before the first bad one of their source partition, and the bad rows.

    Where the first bad row stands is one aggregate over the bad rows, at most one row per source partition.
    """
    reason = F.col("reject_reason")
    if tombstones == "skip":
        parsed = parsed.where(reason.isNull() | (reason != "null_value"))
    bad = parsed.where(reason.isNotNull())
    first = bad.groupBy("topic", "partition").agg(F.min("offset").alias("_first")).alias("f")
    same = (F.col("p.topic") == F.col("f.topic")) & (F.col("p.partition") == F.col("f.partition"))
    good = parsed.where(reason.isNull()).alias("p").join(first, same & (F.col("p.offset") > F.col("f._first")), "left_anti")
    return good.drop("reject_reason"), bad


def apply_error_policy(
    parsed: DataFrame, on_error: str = "fail", tombstones: str = "error"
) -> tuple[DataFrame, DataFrame | None]:
    """Split parsed changes into usable rows and rejects.

    ``fail`` stops the job at the first bad row and returns no reject frame; ``quarantine`` returns both frames.
    ``tombstones="skip"`` drops null values first.
    """
    reason = F.col("reject_reason")
    if tombstones == "skip":
        parsed = parsed.where(reason.isNull() | (reason != "null_value"))
    if on_error == "quarantine":
        return parsed.where(reason.isNull()).drop("reject_reason"), parsed.where(reason.isNotNull())
    if on_error != "fail":
        raise ValueError(f"on_error must be fail or quarantine, not {on_error!r}")
    message = F.concat(
        F.lit("bad change record: "), reason,
        F.lit(" topic="), F.col("topic"), F.lit(" partition="), F.col("partition"), F.lit(" offset="), F.col("offset"),
    )
    checked = F.when(reason.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return parsed.where(checked).drop("reject_reason"), None
