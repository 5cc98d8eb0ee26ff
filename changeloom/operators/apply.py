"""Applying changes to a target: merge mode and block mode.

Both modes end in one pass over the target. A change set whose size is known to be small joins by broadcast and
leaves the target where it is; otherwise one shuffle join on the key does the work.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changeloom.operators.select import UPSERT_OPS, latest_per_key
from changeloom.plans.schema import OFFSET, OP, PARTITION, TOPIC, business_columns, non_pk_columns

ACTION = "_action"


@dataclass(frozen=True)
class ApplyMetrics:
    """What one change set did to the target. ``dropped`` winners had nothing to act on (merge mode only)."""

    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    dropped: int = 0

    def plus(self, other: ApplyMetrics) -> ApplyMetrics:
        return ApplyMetrics(*(getattr(self, f) + getattr(other, f) for f in self.__dataclass_fields__))


def observed(counts: Observation) -> dict[str, int]:
    """Counts of a finished observation; empty when the optimizer found that no row could pass it.

    Such a plan ends without metrics, whose row is then not one that can be handed over; any other failure is raised.
    """
    try:
        return counts.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


KEPT, INSERTED, UPDATED, DELETED, DROPPED = "kept", "inserted", "updated", "deleted", "dropped"


def pk_match(pks: list[str], left: str, right: str) -> Column:
    """Equality on every key column; a null key never matches."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{pk}") == F.col(f"{right}.{pk}") for pk in pks])


def join_summary(left: DataFrame, summary: DataFrame, pks: list[str], how: str, small: bool = False) -> DataFrame:
    """Join rows ``t``, whose keys may repeat, with a summary ``s`` of one row per key.

    By broadcast when the summary is known to be small. Otherwise the join gets a second key that is always 0 but
    that the optimizer cannot fold: it makes both sides arrive by their own shuffle, which is the shape adaptive
    execution needs to split a hot key of the left side over several tasks. A summary that came straight out of its
    aggregate would leave such a key to a single task.
    """
    if small:
        return left.alias("t").join(F.broadcast(summary).alias("s"), pk_match(pks, "t", "s"), how)
    zero = F.pmod(F.xxhash64(*pks), F.lit(1))
    left, summary = left.withColumn("_zero", zero).alias("t"), summary.withColumn("_zero", zero).alias("s")
    return left.join(summary, pk_match([*pks, "_zero"], "t", "s"), how)


def winners_of(batch: DataFrame, pks: list[str], columns: list[str]) -> DataFrame:
    """Business columns and operation of the latest change per key of one batch."""
    return latest_per_key(batch.select(*columns, OP, OFFSET, PARTITION, TOPIC), pks).select(*columns, OP)


def classify_merge(
    target: DataFrame,
    batch: DataFrame,
    pks: list[str],
    on_missing_update: str = "drop",
    small_batch: bool = False,
    winners: DataFrame | None = None,
) -> DataFrame:
    """Target and batch winners side by side, with what happens to each row in ``_action``.

    ``kept``, ``inserted`` and ``updated`` rows form the new target; ``deleted`` rows leave it; ``dropped``
    winners had nothing to act on. ``small_batch=True`` states that the winners are known to fit a broadcast.
    """
    columns = target.columns
    values = non_pk_columns(columns, pks)
    src = winners_of(batch, pks, columns) if winners is None else winners
    inserts = [*UPSERT_OPS, "u"] if on_missing_update == "insert" else list(UPSERT_OPS)
    op = F.col(f"s.{OP}")
    # With key columns only there is nothing to set, so a matched c/r/u leaves the row as it is.
    hit = F.lit(UPDATED if values else KEPT)
    matched = F.when(op == "d", F.lit(DELETED)).when(op.isin(*UPSERT_OPS, "u"), hit).otherwise(F.lit(KEPT))
    unmatched = F.when(op.isin(*inserts), F.lit(INSERTED)).otherwise(F.lit(DROPPED))
    changed = op.isin(*UPSERT_OPS, "u")

    if not small_batch:
        # Target rows with a null key match nothing: they pass by the join, where they would all meet in one task.
        no_key = reduce(lambda a, b: a | b, [F.col(pk).isNull() for pk in pks])
        both = target.where(~no_key).withColumn("_in_target", F.lit(True)).alias("t").join(
            src.alias("s"), pk_match(pks, "t", "s"), "full_outer"
        )
        in_target, in_source = F.col("t._in_target").isNotNull(), op.isNotNull()
        action = F.when(in_target & in_source, matched).when(in_target, F.lit(KEPT)).otherwise(unmatched)
        out = [
            (
                F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
                if c in pks
                else F.when(~in_target | (in_source & changed), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            ).alias(c)
            for c in columns
        ]
        passed = target.where(no_key).select(*columns, F.lit(KEPT).alias(ACTION))
        return both.select(*out, action.alias(ACTION)).unionByName(passed)

    small = F.broadcast(src)
    old = (
        target.alias("t")
        .join(small.alias("s"), pk_match(pks, "t", "s"), "left_outer")
        .select(
            *[
                (F.col(f"t.{c}") if c in pks else F.when(changed, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))).alias(c)
                for c in columns
            ],
            F.when(op.isNull(), F.lit(KEPT)).otherwise(matched).alias(ACTION),
        )
    )
    # The keys found in the target are at most as many as the winners: the second scan reads key columns only.
    found = target.select(*pks).alias("t").join(small.alias("s"), pk_match(pks, "t", "s"), "left_semi")
    new = (
        src.alias("s")
        .join(F.broadcast(found.distinct()).alias("t"), pk_match(pks, "s", "t"), "left_anti")
        .select(*columns, F.when(F.col(OP).isin(*inserts), F.lit(INSERTED)).otherwise(F.lit(DROPPED)).alias(ACTION))
    )
    return old.unionByName(new)


def applied(classified: DataFrame) -> DataFrame:
    """The new target rows of a classified frame."""
    return classified.where(~F.col(ACTION).isin(DELETED, DROPPED)).drop(ACTION)


def observe_merge(classified: DataFrame, metrics: Observation) -> DataFrame:
    """Count the actions of a classified merge while it is written, without another pass."""
    counts = [F.count_if(F.col(ACTION) == name).alias(name) for name in (INSERTED, UPDATED, DELETED, DROPPED)]
    return classified.observe(metrics, *counts)


def merge_changes(
    target: DataFrame,
    batch: DataFrame,
    pks: list[str],
    on_missing_update: str = "drop",
    small_batch: bool = False,
) -> DataFrame:
    """Merge mode: the latest change per key of one batch, applied to a target with unique keys.

    Matched c/r/u sets every non-key column, nulls included; matched d deletes; unmatched c/r inserts; unmatched
    u and d do nothing (``on_missing_update="insert"`` inserts unmatched u); other operations do nothing.
    """
    return applied(classify_merge(target, batch, pks, on_missing_update, small_batch))


def merge_counts(
    target: DataFrame, batch: DataFrame, pks: list[str], on_missing_update: str = "drop"
) -> DataFrame:
    """Number of winners inserted, updated, deleted and dropped, one row per action; reads only the target's keys."""
    keys = target.select(*pks)
    src = winners_of(batch, pks, pks)
    inserts = [*UPSERT_OPS, "u"] if on_missing_update == "insert" else list(UPSERT_OPS)
    found = F.col("_in_target").isNotNull()
    op = F.col(f"s.{OP}")
    action = (
        F.when(found & (op == "d"), F.lit(DELETED))
        .when(found & op.isin(*UPSERT_OPS, "u"), F.lit(UPDATED if non_pk_columns(target.columns, pks) else KEPT))
        .when(~found & op.isin(*inserts), F.lit(INSERTED))
        .otherwise(F.lit(DROPPED))
    )
    joined = src.alias("s").join(
        keys.withColumn("_in_target", F.lit(True)).alias("t"), pk_match(pks, "s", "t"), "left_outer"
    )
    return joined.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


def _same_key(table: str, pks: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{table}.{pk}") == F.col(f"s.{pk}") for pk in pks])


def merge_into(
    table: str,
    batch: DataFrame,
    columns: list[str],
    pks: list[str],
    on_missing_update: str = "drop",
    winners: DataFrame | None = None,
) -> None:
    """Merge mode through the catalog's own row-level MERGE, for table formats that support it."""
    src = (winners_of(batch, pks, columns) if winners is None else winners).alias("s")
    op = F.col(f"s.{OP}")
    values = non_pk_columns(columns, pks)
    merge = src.mergeInto(table, _same_key(table, pks))
    if values:
        merge = merge.whenMatched(op.isin(*UPSERT_OPS, "u")).update({c: F.col(f"s.{c}") for c in values})
    inserts = [*UPSERT_OPS, "u"] if on_missing_update == "insert" else list(UPSERT_OPS)
    merge = merge.whenNotMatched(op.isin(*inserts)).insert({c: F.col(f"s.{c}") for c in columns})
    merge.whenMatched(op == "d").delete().merge()


def update_rows_of(table: str, block: DataFrame, columns: list[str], pks: list[str]) -> None:
    """The updates of a block through the catalog's row-level MERGE."""
    values = non_pk_columns(columns, pks)
    if values:
        src = winners_of(block.where(F.col(OP) == "u"), pks, columns).alias("s")
        src.mergeInto(table, _same_key(table, pks)).whenMatched().update({c: F.col(f"s.{c}") for c in values}).merge()


def delete_rows_of(table: str, block: DataFrame, pks: list[str]) -> None:
    """The deletes of a block through the catalog's row-level MERGE."""
    src = block.where(F.col(OP) == "d").select(*pks).distinct().alias("s")
    src.mergeInto(table, _same_key(table, pks)).whenMatched().delete().merge()


# --- block mode ------------------------------------------------------------------------------------------------


def insert_block(target: DataFrame, block: DataFrame) -> DataFrame:
    """Append every c/r row of the block: no upsert, no deduplication."""
    return target.unionByName(block.where(F.col(OP).isin(*UPSERT_OPS)).select(*target.columns))


def update_block(target: DataFrame, block: DataFrame, pks: list[str], small_block: bool = False) -> DataFrame:
    """Set the non-key columns of every target row that has an update in the block; the latest update wins."""
    values = non_pk_columns(target.columns, pks)
    if not values:
        return target
    updates = winners_of(block.where(F.col(OP) == "u"), pks, target.columns)
    joined = join_summary(target, updates, pks, "left_outer", small_block)
    hit = F.col(f"s.{OP}").isNotNull()
    return joined.select(
        *[
            (F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def delete_block(target: DataFrame, block: DataFrame, pks: list[str], small_block: bool = False) -> DataFrame:
    """Remove every target row whose key has a delete in the block."""
    deletes = block.where(F.col(OP) == "d").select(*pks).distinct()
    return join_summary(target, deletes, pks, "left_anti", small_block).select(*target.columns)


def block_summary(block: DataFrame, pks: list[str], columns: list[str]) -> DataFrame:
    """One row per key with updates or deletes in the block: the winning update ``_new`` and ``_deleted``."""
    order = F.struct(OFFSET, PARTITION, TOPIC)
    is_update = F.col(OP) == "u"
    changes = block.where(F.col(OP).isin("u", "d"))
    return changes.groupBy(*pks).agg(
        F.max_by(F.struct(*non_pk_columns(columns, pks), F.lit(True).alias("_hit")), F.when(is_update, order)).alias("_new"),
        F.max(F.col(OP) == "d").alias("_deleted"),
    )


def classify_block(target: DataFrame, block: DataFrame, pks: list[str], small_block: bool = False) -> DataFrame:
    """Target rows and block inserts, each with its final values, ``_action`` and whether it was updated.

    Insert, update, delete in that order, whatever the offsets, in one join: a row with a delete is gone, a row
    with an update takes its values, and both apply to the rows the block itself inserts.
    """
    columns = target.columns
    values = non_pk_columns(columns, pks)
    rows = target.withColumn(ACTION, F.lit(KEPT)).unionByName(
        block.where(F.col(OP).isin(*UPSERT_OPS)).select(*columns, F.lit(INSERTED).alias(ACTION))
    )
    summary = block_summary(block, pks, columns)
    joined = join_summary(rows, summary, pks, "left_outer", small_block)
    hit = F.coalesce(F.col("s._new._hit"), F.lit(False)) if values else F.lit(False)
    return joined.select(
        *[
            (F.when(hit, F.col(f"s._new.{c}")).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
            for c in columns
        ],
        F.col(f"t.{ACTION}").alias(ACTION),
        hit.alias("_updated"),
        F.coalesce(F.col("s._deleted"), F.lit(False)).alias("_gone"),
    )


def observe_block(classified: DataFrame, metrics: Observation) -> DataFrame:
    """Count the affected rows of a classified block while it is written, without another pass."""
    return classified.observe(
        metrics,
        F.count_if(F.col(ACTION) == INSERTED).alias(INSERTED),
        F.count_if("_updated").alias(UPDATED),
        F.count_if("_gone").alias(DELETED),
    )


def surviving(classified: DataFrame) -> DataFrame:
    """The new target rows of a classified block."""
    return classified.where(~F.col("_gone")).drop(ACTION, "_updated", "_gone")


def apply_block(target: DataFrame, block: DataFrame, pks: list[str], small_block: bool = False) -> DataFrame:
    """Block mode: insert, update, delete of one block, in that order, as one plan."""
    return surviving(classify_block(target, block, pks, small_block))


def block_counts(target: DataFrame, block: DataFrame, pks: list[str], small_block: bool = False) -> DataFrame:
    """Affected rows per statement of a block, as one row ``inserted, updated, deleted``."""
    out = classify_block(target, block, pks, small_block)
    return out.agg(
        F.count_if(F.col(ACTION) == INSERTED).alias("inserted"),
        F.count_if("_updated").alias("updated"),
        F.count_if("_gone").alias("deleted"),
    )


