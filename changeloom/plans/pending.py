"""One tick of asynchronous apply as a batch job: take a bounded batch, merge it, trim the log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.apply import ApplyMetrics, winners_of
from changeloom.operators.retention import expire_rows, last_expiry, note_expiry, remove_batch, retention_due
from changeloom.operators.select import has_pending, take_batch
from changeloom.options import ReplicationOptions
from changeloom.plans.schema import BLOCK, ingest_schema
from changeloom.plans.tables import CatalogTarget, RowLevelTarget
from changeloom.session import child_names, delete_path, path_exists
from changeloom.sources.ingest_log import read_log

Target = CatalogTarget | RowLevelTarget


def apply_pending(
    spark: SparkSession,
    log_path: str,
    target: Target,
    options: ReplicationOptions,
    work_path: str,
    now: dt.datetime | None = None,
) -> ApplyMetrics | None:
    """Merge the next batch of the log into the target and remove exactly that batch from the log.

    The batch is written to ``work_path`` first and used from there by both steps, so rows that arrive in between
    are neither merged nor removed. After a crash between the steps, the next call finishes the trim before it
    takes a new batch. Returns what the new batch did, or null when the log was empty; expiry runs either way.
    """
    schema = ingest_schema(target.schema)
    frozen = f"{work_path}/frozen"
    for name in child_names(spark, frozen):
        if path_exists(spark, f"{frozen}/{name}/_SUCCESS"):
            _finish(spark, log_path, target, schema, frozen, name, options)
        else:
            delete_path(spark, f"{frozen}/{name}")
    log = read_log(spark, log_path, schema) if path_exists(spark, log_path) else None
    metrics = None
    if log is not None and has_pending(log):
        name = uuid.uuid4().hex
        take_batch(log, options.merge_batch_size).write.parquet(f"{frozen}/{name}")
        metrics = _finish(spark, log_path, target, schema, frozen, name, options)
    _expire(spark, log_path, schema, options, f"{work_path}/retention", now)
    return metrics


def _expire(
    spark: SparkSession, log_path: str, schema: T.StructType, options: ReplicationOptions, clock: str, now: dt.datetime | None
) -> None:
    """Remove old rows by age, at most once per interval. Rows here are all waiting, so only when asked to."""
    now = now or dt.datetime.now(dt.timezone.utc)
    now_ms = int(now.replace(tzinfo=now.tzinfo or dt.timezone.utc).timestamp() * 1000)
    last_ms = last_expiry(spark, clock)
    if options.only_applied or not retention_due(last_ms, options.retention_interval, now_ms):
        return
    if options.retention_delay > 0 and path_exists(spark, log_path):
        log = read_log(spark, log_path, schema)
        rewrite_blocks(spark, log_path, log, expire_rows(log, options.retention_delay, now))
    note_expiry(spark, clock, now_ms)


def _finish(
    spark: SparkSession,
    log_path: str,
    target: Target,
    schema: T.StructType,
    frozen: str,
    name: str,
    options: ReplicationOptions,
) -> ApplyMetrics | None:
    """Merge and trim a frozen batch; every step may run again without further effect."""
    batch = spark.read.schema(schema).parquet(f"{frozen}/{name}")
    folder = f"{frozen}-winners/{name}"
    winners = winners_of(batch, list(target.pks), target.schema.names)
    winners.write.mode("overwrite").parquet(folder)
    metrics = target.apply_winners(spark.read.schema(winners.schema).parquet(folder), f"batch:{name}", options)
    touched = [row[0] for row in batch.select(BLOCK).distinct().collect()]
    log = read_log(spark, log_path, schema).where(F.col(BLOCK).isin(touched))
    rewrite_blocks(spark, log_path, log, remove_batch(log, batch))
    delete_path(spark, f"{frozen}/{name}")
    delete_path(spark, folder)
    return metrics


def rewrite_blocks(spark: SparkSession, log_path: str, before: DataFrame, after: DataFrame) -> None:
    """Replace the rows of ``before`` by those of ``after``, in the blocks that lost rows.

    One dynamic partition overwrite gives each such block its rows, which are moved in when all are written; blocks
    without any are deleted by their names. A block is written by one writer, once, so that nothing is added to it
    meanwhile; new rows come in blocks of their own, which are left alone.
    """
    counts = (
        before.groupBy(BLOCK)
        .agg(F.count("*").alias("had"))
        .join(after.groupBy(BLOCK).agg(F.count("*").alias("has")), BLOCK, "left_outer")
        .where(F.col("has").isNull() | (F.col("has") < F.col("had")))
    )
    changed = {row[BLOCK]: row["has"] for row in counts.collect()}
    kept = [block for block, has in changed.items() if has]
    if kept:
        rows = after.where(F.col(BLOCK).isin(kept))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK).parquet(log_path)
    for block in changed:
        if not changed[block]:
            delete_path(spark, f"{log_path}/{BLOCK}={block}")
