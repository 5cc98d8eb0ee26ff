"""Choosing changes: block and age filters, latest change per key, bounded batches."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.plans.schema import BLOCK, DATETIME, OFFSET, OP, PARTITION, TOPIC

UPSERT_OPS = ("c", "r")
APPLIED_OPS = ("c", "r", "u", "d")

# Offset buckets per counting pass of ``batch_bound``; bounds what one pass returns to the driver.
_BUCKETS = 4096


def block_inserts(log: DataFrame, block_id: str) -> DataFrame:
    """Create and snapshot changes of one block."""
    return log.where((F.col(BLOCK) == block_id) & F.col(OP).isin(*UPSERT_OPS))


def block_updates(log: DataFrame, block_id: str) -> DataFrame:
    """Update changes of one block."""
    return log.where((F.col(BLOCK) == block_id) & (F.col(OP) == "u"))


def block_deletes(log: DataFrame, block_id: str, pks: list[str]) -> DataFrame:
    """Keys of the delete changes of one block."""
    return log.where((F.col(BLOCK) == block_id) & (F.col(OP) == "d")).select(*pks)


def older_than(delay_seconds: int, now: dt.datetime | Column | None = None) -> Column:
    """Age predicate ``KFK_DATETIME <= now - delay``; both sides are UTC without a zone."""
    if now is None:
        now = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(now, dt.datetime):
        if now.tzinfo is not None:
            now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
        now = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.col(DATETIME) <= now - F.make_dt_interval(secs=F.lit(delay_seconds).cast("decimal(18,6)"))


def has_pending(log: DataFrame) -> bool:
    """Whether the log holds any row; reads at most one."""
    return not log.isEmpty()


def change_order() -> list[Column]:
    """Latest first: offset, then partition, then topic."""
    return [F.col(OFFSET).desc(), F.col(PARTITION).desc(), F.col(TOPIC).desc()]


def latest_per_key(log: DataFrame, keys: list[str]) -> DataFrame:
    """The latest change of each key. Null keys count as one key.

    The rank filter is pushed below the shuffle, so each map task sends at most one row per key and a key that
    holds most of the log does not overload the task that receives it.
    """
    latest = Window.partitionBy(*keys).orderBy(*change_order())
    return log.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


@dataclass(frozen=True)
class BatchBound:
    """Last row of a bounded batch in (partition, offset, topic) order."""

    partition: int
    offset: int
    topic: str

    def inside(self) -> Column:
        """Rows up to and including the bound; plain comparisons, so the scan skips files by statistics."""
        part, off, topic = F.col(PARTITION), F.col(OFFSET), F.col(TOPIC)
        return (part < self.partition) | (
            (part == self.partition) & ((off < self.offset) | ((off == self.offset) & (topic <= self.topic)))
        )


def batch_bound(log: DataFrame, n: int) -> BatchBound | None:
    """Where the first ``n`` rows by (partition, offset, topic) end; null when the log is empty.

    Works by counting: rows per source partition, then rows per offset range inside the one partition the limit
    falls into, narrowing until one offset is left. No row is sorted and no task sees more than its own counts,
    so neither ``n`` nor the log size loads a single task. Log keys are taken to be unique.
    """
    if n < 1:
        raise ValueError("a batch holds at least one row")
    part, off = F.col(PARTITION), F.col(OFFSET)
    counts = (
        log.groupBy(PARTITION).agg(F.count("*").alias("n"), F.min(off).alias("lo"), F.max(off).alias("hi")).collect()
    )
    if not counts:
        return None
    counts.sort(key=lambda row: row[PARTITION])
    left, chosen = n, counts[-1]
    for row in counts:
        chosen = row
        if row["n"] >= left:
            break
        left -= row["n"]
    lo, hi, left = chosen["lo"], chosen["hi"], min(left, chosen["n"])
    rows = log.where(part == chosen[PARTITION])
    while lo < hi:
        width = -(-(hi - lo + 1) // _BUCKETS)
        bucket = F.call_function("div", off - F.lit(lo), F.lit(width)).cast("bigint")
        inside = rows.where(off.between(lo, hi)).groupBy(bucket.alias("bucket")).count().collect()
        for row in sorted(inside, key=lambda r: r["bucket"]):
            if row["count"] >= left:
                lo, hi = lo + row["bucket"] * width, min(lo + (row["bucket"] + 1) * width - 1, hi)
                break
            left -= row["count"]
    topics = rows.where(off == lo).groupBy(TOPIC).count().collect()
    topic = ""
    for row in sorted(topics, key=lambda r: r[TOPIC]):
        topic = row[TOPIC]
        if row["count"] >= left:
            break
        left -= row["count"]
    return BatchBound(chosen[PARTITION], lo, topic)


def take_batch(log: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by partition, offset, topic, as a filter on the log."""
    bound = batch_bound(log, n)
    return log.where(bound.inside()) if bound else log.limit(0)


def key_partition_audit(log: DataFrame, pks: list[str]) -> DataFrame:
    """Keys that occur in more than one source partition: for them, offsets do not order changes."""
    return log.groupBy(*pks).agg(F.count_distinct(PARTITION).alias("n_partitions")).where("n_partitions > 1")
