"""Change-log retention (R1-R4, J5). Each function returns the rows that stay."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.operators.select import BatchBound, older_than
from changeloom.plans.schema import BLOCK, LOG_KEY
from changeloom.session import child_names, delete_path, make_folder, write_line


def _kept_unless(gone: Column) -> Column:
    return ~F.coalesce(gone, F.lit(False))


def remove_batch(log: DataFrame, batch: DataFrame | BatchBound) -> DataFrame:
    """The log without a merged batch.

    A frozen bound is a plain filter and needs no shuffle; a frame of batch rows is matched on the log key.
    """
    if isinstance(batch, BatchBound):
        return log.where(_kept_unless(batch.inside()))
    return log.join(batch.select(*LOG_KEY), LOG_KEY, "left_anti")


def cleanup_block(
    log: DataFrame, block_id: str, delay_seconds: int, now: dt.datetime | Column | None = None
) -> DataFrame:
    """The log without the rows of one block that are at least ``delay_seconds`` old."""
    return log.where(_kept_unless((F.col(BLOCK) == block_id) & older_than(delay_seconds, now)))


def expire_rows(
    log: DataFrame,
    delay_seconds: int,
    now: dt.datetime | Column | None = None,
    applied: Column | None = None,
) -> DataFrame:
    """The log without rows at least ``delay_seconds`` old; a delay of 0 turns expiry off.

    ``applied`` says which rows have reached the target; with it, rows still waiting are never removed. Without it
    age alone decides.
    """
    if delay_seconds <= 0:
        return log
    old = older_than(delay_seconds, now)
    return log.where(_kept_unless(old if applied is None else old & applied))


def retention_due(last_ms: int, interval_seconds: int, now_ms: int) -> bool:
    """Whether expiry runs now: at most once per interval, always with interval 0, always the first time."""
    return interval_seconds <= 0 or now_ms - last_ms >= interval_seconds * 1000


def last_expiry(spark: SparkSession, path: str) -> int:
    """Time of the last expiry in epoch milliseconds, as kept next to the job; 0 before the first.

    The time is the name of a file, so that asking for it is a listing of one folder and no job.
    """
    return max((int(name.removeprefix("at-")) for name in child_names(spark, path) if name.startswith("at-")), default=0)


def note_expiry(spark: SparkSession, path: str, now_ms: int) -> None:
    """Keep the time of an expiry in the place of the one before."""
    make_folder(spark, path)
    write_line(spark, f"{path}/at-{now_ms}", str(now_ms))
    for name in child_names(spark, path):
        if name.startswith("at-") and int(name.removeprefix("at-")) < now_ms:
            delete_path(spark, f"{path}/{name}")
