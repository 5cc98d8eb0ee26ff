"""The change log: typed rows, identity and idempotent append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.coerce import coerce, coerce_text, variant_text
from changeloom.functions.logical import norm_ts_millis
from changeloom.plans.schema import BLOCK, DATETIME, LOG_KEY, LOG_META, OFFSET, OP, PARTITION, TOPIC, business_columns
from changeloom.session import delete_path, matching, path_exists


def row_bytes(fields: Column) -> Column:
    """Size estimate of a change: 100 + the lengths of all names and of all value texts."""
    names = F.array_join(F.map_keys(fields), "")
    values = F.array_join(F.transform(F.map_values(fields), variant_text), "")
    return (F.lit(100) + F.length(names) + F.length(values)).cast("bigint")


def log_row_bytes(schema: T.StructType) -> Column:
    """The same estimate of a typed row of the log: 100 + the lengths of all names and of all values as text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    size = F.lit(100)
    for f in schema.fields:
        if f.name in business_columns(schema):
            text = F.to_json(F.struct(f.name)) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")
            size = size + len(f.name) + F.coalesce(F.length(text), F.lit(0))
    return size.cast("bigint")


def meta_columns(block_id: str | Column) -> dict[str, Column]:
    """The six metadata columns of a parsed change."""
    return {
        TOPIC: F.col("topic"),
        PARTITION: F.col("partition").cast("int"),
        OFFSET: F.col("offset").cast("bigint"),
        OP: F.col("op"),
        DATETIME: norm_ts_millis(F.col("ts_ms")),
        BLOCK: block_id if isinstance(block_id, Column) else F.lit(block_id),
    }


def field_of(fields: Column, name: str, keys: str = "ignore_case") -> Column:
    """One business value by column name.

    With ``ignore_case`` the usual spellings are looked up first; only a row that has none of them is searched.
    """
    if keys != "ignore_case":
        return fields[name]
    spellings = dict.fromkeys([name, name.lower(), name.upper()])
    same = F.filter(F.map_keys(fields), lambda key: F.upper(key) == name.upper())
    return F.coalesce(*[fields[spelling] for spelling in spellings], fields[F.get(same, F.lit(0))])


def _at(row: Column, name: str, kind: str) -> Column:
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(row, f"$[{quote}{name}{quote}]", kind)


def _looked_up(parsed: DataFrame, schema: T.StructType, keys: str) -> tuple[DataFrame, dict[str, Column]]:
    """Rows kept as a variant -> the value of each column: text, or a variant where the type is nested.

    Each column is read where it lies. Only a row that lacks one of the names is turned into a map and searched for
    other spellings.
    """
    nested = (T.VariantType, T.StructType, T.ArrayType, T.MapType)
    kinds = {f.name: "variant" if isinstance(f.dataType, nested) else "string" for f in schema.fields}
    held = {name: f"__at_{i}" for i, name in enumerate(kinds)}
    row = F.col("fields")
    out = parsed.withColumns({held[name]: _at(row, name, kind) for name, kind in kinds.items()})
    if keys != "ignore_case" or not kinds:
        return out, {name: F.col(col) for name, col in held.items()}
    absent = reduce(lambda a, b: a | b, [F.col(held[name]).isNull() & _at(row, name, "variant").isNull() for name in kinds])
    out = out.withColumn("__search", F.when(absent, F.try_variant_get(row, "$", "map<string,variant>")))
    search = F.col("__search")
    values = {}
    for name, kind in kinds.items():
        found = F.when(search.isNotNull(), field_of(search, name))
        values[held[name]] = F.coalesce(F.col(held[name]), found if kind == "variant" else variant_text(found))
    return out.withColumns(values), {name: F.col(col) for name, col in held.items()}


def first_record_keys(parsed: DataFrame) -> list[str]:
    """Field names of the first record by partition and offset, as one aggregate; a list of column names."""
    order = F.struct("partition", "offset", "topic")
    row = parsed.agg(F.min_by(F.map_keys("fields"), order).alias("keys")).first()
    return list(row["keys"] or [])


def to_ingest(
    parsed: DataFrame,
    schema: T.StructType,
    block_id: str | Column,
    columns: str | list[str] = "target",
    keys: str = "ignore_case",
    number_scale: str = "declared",
    empty_as_null: bool = False,
) -> DataFrame:
    """Parsed changes -> typed change-log rows.

    ``columns="target"`` loads every known column; ``"first_record"`` loads only those the first record carries
    and leaves the others null; a list names them outright. Metadata overwrites a business field of the same name.
    """
    known = isinstance(parsed.schema["fields"].dataType, T.VariantType)
    if columns == "first_record":
        if known:
            raise ValueError("the columns of the first record need the field map, not typed=True")
        columns = first_record_keys(parsed)
    loaded = None if columns == "target" else {name.upper() for name in columns}
    meta = meta_columns(block_id)
    fields = F.col("fields")
    if known:
        wanted = [f for f in schema.fields if f.name.upper() not in meta and (loaded is None or f.name.upper() in loaded)]
        parsed, values = _looked_up(parsed, T.StructType(wanted), keys)
    out = []
    for f in schema.fields:
        if f.name.upper() in meta:
            out.append(meta[f.name.upper()].alias(f.name))
        elif loaded is not None and f.name.upper() not in loaded:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif known and isinstance(f.dataType, (T.VariantType, T.StructType, T.ArrayType, T.MapType)):
            out.append(coerce(values[f.name], f.dataType, number_scale, empty_as_null).alias(f.name))
        elif known:
            text = F.nullif(values[f.name], F.lit("")) if empty_as_null else values[f.name]
            out.append(coerce_text(text, f.dataType, number_scale).alias(f.name))
        else:
            value = coerce(field_of(fields, f.name, keys), f.dataType, number_scale, empty_as_null)
            out.append(value.alias(f.name))
    return parsed.select(*out)


def cut_blocks(rows: DataFrame, size: Column, max_records: int, max_bytes: int) -> DataFrame:
    """Change rows with the block each belongs to, ``_cut``: at most ``max_records`` rows and ``max_bytes`` bytes of ``size``.

    Blocks follow the offsets of one source partition. Where a row stands in it is a prefix sum, taken in two steps: rows
    and bytes of up to 4096 ranges of offsets, then within a range, so that no task sorts a whole source partition. A block
    is a window of the running counts; the window of bytes is shorter by the largest row, so that the row it begins
    with fits as well. A row that is larger than the limit is a block of its own.
    """
    source = [TOPIC, PARTITION]
    rows = rows.withColumn("_size", size.cast("bigint"))
    fits = F.col("_size") <= max_bytes
    hull = rows.groupBy(*source).agg(
        F.min(OFFSET).alias("_lo"), F.max(OFFSET).alias("_hi"), F.coalesce(F.max(F.when(fits, F.col("_size"))), F.lit(1)).alias("_most")
    )
    width = F.ceil((F.col("_hi") - F.col("_lo") + 1) / 4096).cast("bigint")
    placed = rows.join(hull, source).withColumn("_range", F.call_function("div", F.col(OFFSET) - F.col("_lo"), width))
    sums = placed.groupBy(*source, "_range").agg(
        F.count("*").alias("_n"), F.sum("_size").alias("_b"), F.count_if(~fits).alias("_o")
    )
    earlier = Window.partitionBy(*source).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*source, "_range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("_n", "_b", "_o")])
    within = Window.partitionBy(*source, "_range").orderBy(OFFSET)
    upto, before = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(Window.unboundedPreceding, -1)
    stood = placed.withColumns(
        {
            "_n": F.count("*").over(upto),
            "_b": F.sum("_size").over(upto),
            "_o": F.count_if(~fits).over(before),
        }
    ).join(starts, [*source, "_range"])
    records = F.call_function("div", F.col("_n") + F.col("_n0") - 1, F.lit(max_records))
    volume = F.call_function("div", F.col("_b") + F.col("_b0") - 1, F.lit(max_bytes) - F.col("_most") + 1)
    name = F.concat_ws("-", PARTITION, records, volume, F.col("_o") + F.col("_o0"))
    kept = [c for c in rows.columns if c != "_size"]
    return stood.select(*kept, name.alias("_cut"))


def prune_to_offsets(existing: DataFrame, new: DataFrame, max_partitions: int = 1000) -> DataFrame:
    """Keep only the log rows that can hold an offset of ``new``, so that the scan skips the rest by statistics.

    One aggregate over the new rows gives the offset range of each source partition. With more source partitions
    than ``max_partitions`` a single range is used.
    """
    ranges = new.groupBy(TOPIC, PARTITION).agg(F.min(OFFSET).alias("lo"), F.max(OFFSET).alias("hi"))
    rows = ranges.limit(max_partitions + 1).collect()
    if len(rows) > max_partitions:
        row = new.agg(F.min(OFFSET).alias("lo"), F.max(OFFSET).alias("hi")).first()
        return existing.where(F.col(OFFSET).between(row["lo"], row["hi"]))
    keep = F.lit(False)
    for row in rows:
        inside = F.col(OFFSET).between(row["lo"], row["hi"])
        keep = keep | ((F.col(TOPIC) == row[TOPIC]) & (F.col(PARTITION) == row[PARTITION]) & inside)
    return existing.where(keep)


def dedup_ingest(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per (topic, partition, offset), without those the log already holds."""
    out = new.dropDuplicates(LOG_KEY)
    if existing is None:
        return out
    return out.join(existing.select(*LOG_KEY), LOG_KEY, "left_anti")


def append_ingest(rows: DataFrame, path: str) -> None:
    """Append rows to the log, one folder per block."""
    rows.write.mode("append").partitionBy(BLOCK).parquet(path)


def write_block(rows: DataFrame, path: str, block_id: str) -> bool:
    """Write one block of the log; a block that is already complete is left alone, so a replay adds nothing."""
    folder = f"{path}/{BLOCK}={block_id}"
    if path_exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        return False
    rows.drop(BLOCK).write.mode("overwrite").parquet(folder)
    return True


def write_blocks(rows: DataFrame, path: str, name: str) -> None:
    """Write the blocks of a micro-batch, whose ids begin with ``name``; what an attempt left there before is replaced."""
    spark = rows.sparkSession
    for folder in matching(spark, f"{path}/{BLOCK}={name}-*"):
        delete_path(spark, folder)
    delete_path(spark, f"{path}/{BLOCK}={name}")
    rows.write.mode("append").partitionBy(BLOCK).parquet(path)


def read_written(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """The blocks of a micro-batch, whose ids are ``name`` or begin with it, without listing the others."""
    folders = [*matching(spark, f"{path}/{BLOCK}={name}"), *matching(spark, f"{path}/{BLOCK}={name}-*")]
    return _read(spark, path, schema, folders)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole log; a filter on the block column prunes folders."""
    return spark.read.schema(_with_block_last(schema)).option("basePath", path).parquet(path)


def read_block(spark: SparkSession, path: str, schema: T.StructType, block_id: str) -> DataFrame:
    """One block of the log, without listing the others."""
    return read_blocks(spark, path, schema, [block_id])


def read_blocks(spark: SparkSession, path: str, schema: T.StructType, block_ids: list[str]) -> DataFrame:
    """Some blocks of the log, without listing the others."""
    return _read(spark, path, schema, [f"{path}/{BLOCK}={block_id}" for block_id in block_ids])


def _read(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _with_block_last(schema))
    return spark.read.schema(_with_block_last(schema)).option("basePath", path).parquet(*folders)


def _with_block_last(schema: T.StructType) -> T.StructType:
    """The partition column comes last, as text, so that block ids made of digits stay text."""
    kept = [f for f in schema.fields if f.name != BLOCK]
    return T.StructType(kept + [f for f in LOG_META.fields if f.name == BLOCK])
