"""Landing files: gzip JSON lines, and their typed load into the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeloom.functions.coerce import coerce
from changeloom.plans.schema import BLOCK
from changeloom.session import delete_path
from changeloom.sources.changes import spread_narrow
from changeloom.sources.ingest_log import append_ingest, field_of, meta_columns


def landing_lines(parsed: DataFrame, block_id) -> DataFrame:
    """One JSON text per change: its fields, then the metadata columns, which win over fields of the same name."""
    meta = meta_columns(block_id)
    meta["KFK_DATETIME"] = F.date_format(meta["KFK_DATETIME"], "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    pairs = [part for name, col in meta.items() for part in (F.lit(name), col.cast("variant"))]
    return parsed.select(F.to_json(F.map_concat(F.col("fields"), F.create_map(*pairs))).alias("value"))


def land_json_lines(parsed: DataFrame, path: str, block_id) -> None:
    """Write one block as gzip JSON lines, one file per partition; a replay replaces the block's files."""
    landing_lines(parsed, block_id).write.mode("overwrite").option("compression", "gzip").text(path)


def load_lines(
    lines: DataFrame,
    schema: T.StructType,
    columns: str | list[str] = "target",
    number_scale: str = "declared",
    empty_as_null: bool = False,
) -> DataFrame:
    """Landed JSON text -> typed change-log rows. ``columns`` lists the columns to load; the others stay null."""
    loaded = None if columns == "target" else {name.upper() for name in columns}
    rows = lines.select(F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").alias("fields"))
    out = []
    for f in schema.fields:
        if loaded is not None and f.name.upper() not in loaded and not f.name.upper().startswith("KFK_"):
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(coerce(field_of(F.col("fields"), f.name), f.dataType, number_scale, empty_as_null).alias(f.name))
    return rows.select(*out)


def read_landed(spark: SparkSession, path: str, schema: T.StructType, **load_options) -> DataFrame:
    """Landed files as typed change-log rows."""
    return load_lines(spread_narrow(spark.read.text(path)), schema, **load_options)


def read_landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, purge: bool = True, max_files: int | None = None, **load_options
) -> DataFrame:
    """Landed files as a stream; with ``purge`` the source deletes files once their batch is committed."""
    reader = spark.readStream
    if purge:
        reader = reader.option("cleanSource", "delete")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return load_lines(reader.text(path), schema, **load_options)


def start_copy_into(
    spark: SparkSession,
    path: str,
    log_path: str,
    schema: T.StructType,
    checkpoint: str,
    purge: bool = True,
    max_files: int | None = None,
    available_now: bool = False,
    **load_options,
) -> StreamingQuery:
    """The load as a query of its own, between landing and a log that only it writes.

    The file sink writes every landed row once, whatever is tried again. A landed file goes after the batch that loaded it
    is committed, at the latest when the query is started the next time.
    """
    rows = read_landed_stream(spark, path, schema, purge, max_files, **load_options)
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    writer = rows.writeStream.format("parquet").partitionBy(BLOCK).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(log_path)


def copy_into(
    spark: SparkSession, path: str, log_path: str, schema: T.StructType, purge: bool = True, **load_options
) -> None:
    """Load landed files into the change log, then delete them. Files stay when the load fails."""
    append_ingest(read_landed(spark, path, schema, **load_options), log_path)
    if purge:
        delete_path(spark, path)


