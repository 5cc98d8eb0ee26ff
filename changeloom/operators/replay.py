"""Replaying a long log in one pass instead of once per batch or block.

Every change writes whole rows, so the state after any number of merges has a closed form per key: it depends only
on the last batch that created, the last that deleted and the last that wrote the key. A replay is therefore one
rank per (key, batch) and one aggregate per key, whatever the number of batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.apply import join_summary
from changeloom.operators.select import APPLIED_OPS, UPSERT_OPS, latest_per_key
from changeloom.plans.schema import OFFSET, OP, PARTITION, TOPIC, non_pk_columns

_INITIAL, _NEVER = -1, -2


def _any_null(pks: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(pk).isNull() for pk in pks])


def replay_merge(
    log: DataFrame,
    pks: list[str],
    columns: list[str],
    batch: Column,
    initial: DataFrame | None = None,
    on_missing_update: str = "drop",
) -> DataFrame:
    """State after merging the log batch by batch in ascending ``batch`` order (a whole number >= 0).

    Equals repeated ``merge_changes``. ``initial`` is the target before the first batch, with unique keys.
    """
    rows = log.select(*columns, OP, OFFSET, PARTITION, TOPIC, batch.cast("bigint").alias("_batch"))
    won = latest_per_key(rows, [*pks, "_batch"]).where(F.col(OP).isin(*APPLIED_OPS))
    won = won.select(*columns, OP, "_batch")
    created, deleted = F.col(OP).isin(*UPSERT_OPS), F.col(OP) == "d"

    if initial is not None:
        first = initial.select(*columns, F.lit("c").alias(OP), F.lit(_INITIAL).cast("bigint").alias("_batch"))
        won = won.unionByName(first.where(~_any_null(pks)))
    values = non_pk_columns(columns, pks)
    # A null key never matches: each batch whose winner creates it adds a row, and nothing removes it. Such a winner
    # is a group of its own, so that the log is read and ranked once for all keys.
    own = F.when(_any_null(pks), F.col("_batch")).alias("_own")
    state = won.groupBy(*pks, own).agg(
        F.max(F.when(created, F.col("_batch"))).alias("_created"),
        F.max(F.when(deleted, F.col("_batch"))).alias("_deleted"),
        F.max(F.when(~deleted, F.col("_batch"))).alias("_written"),
        F.max_by(F.struct(F.lit(True).alias("_set"), *values), F.when(~deleted, F.col("_batch"))).alias("_row"),
    )
    alive = "_written" if on_missing_update == "insert" else "_created"
    state = state.where(F.col(alive) > F.coalesce(F.col("_deleted"), F.lit(_NEVER)))
    out = state.select(*[F.col(c) if c in pks else F.col(f"_row.{c}").alias(c) for c in columns])
    if initial is not None:
        out = out.unionByName(initial.select(*columns).where(_any_null(pks)))
    return out


def fold_winners(
    log: DataFrame, pks: list[str], columns: list[str], batch: Column, on_missing_update: str = "drop"
) -> DataFrame:
    """What several merges in ascending ``batch`` order do to a target, as the winners of a single merge.

    Per key, only the last create, delete and write of the batches' winners count: a key that is there after the last of
    them comes as ``c`` with its last values, one that is gone as ``d``, and one that was only updated as ``u``. A null key
    matches nothing, so that the winner of each batch that creates it is a row of its own.
    """
    rows = log.select(*columns, OP, OFFSET, PARTITION, TOPIC, batch.cast("bigint").alias("_batch"))
    won = latest_per_key(rows, [*pks, "_batch"]).where(F.col(OP).isin(*APPLIED_OPS))
    created, deleted = F.col(OP).isin(*UPSERT_OPS), F.col(OP) == "d"
    values = non_pk_columns(columns, pks)
    own = F.when(_any_null(pks), F.col("_batch")).alias("_own")
    state = won.groupBy(*pks, own).agg(
        F.max(F.when(created, F.col("_batch"))).alias("_created"),
        F.max(F.when(deleted, F.col("_batch"))).alias("_deleted"),
        F.max(F.when(~deleted, F.col("_batch"))).alias("_written"),
        F.max_by(F.struct(F.lit(True).alias("_set"), *values), F.when(~deleted, F.col("_batch"))).alias("_row"),
    )
    gone = F.coalesce(F.col("_deleted"), F.lit(_NEVER))
    alive = "_written" if on_missing_update == "insert" else "_created"
    op = (
        F.when(F.col(alive) > gone, F.lit("c"))
        .when(F.col("_deleted").isNotNull(), F.lit("d"))
        .otherwise(F.lit("u"))
    )
    return state.select(*[F.col(c) if c in pks else F.col(f"_row.{c}").alias(c) for c in columns], op.alias(OP))


def replay_blocks(
    log: DataFrame, pks: list[str], columns: list[str], block: Column, initial: DataFrame | None = None
) -> DataFrame:
    """State after applying the log block by block in ascending ``block`` order (a whole number >= 0).

    Equals repeated ``apply_block``. A created row survives unless its key is deleted in its own or a later block,
    and takes the values of the key's latest update in its own or a later block.
    """
    rows = log.select(*columns, OP, OFFSET, PARTITION, TOPIC, block.cast("bigint").alias("_block"))
    born = rows.where(F.col(OP).isin(*UPSERT_OPS)).select(*columns, "_block")
    if initial is not None:
        born = born.unionByName(initial.select(*columns, F.lit(_INITIAL).cast("bigint").alias("_block")))
    values = non_pk_columns(columns, pks)
    is_update = F.col(OP) == "u"
    order = F.struct("_block", OFFSET, PARTITION, TOPIC)
    summary = (
        rows.where(F.col(OP).isin("u", "d"))
        .groupBy(*pks)
        .agg(
            F.max(F.when(F.col(OP) == "d", F.col("_block"))).alias("_deleted"),
            F.max_by(F.struct(F.col("_block").alias("_at"), *values), F.when(is_update, order)).alias("_new"),
        )
    )
    joined = join_summary(born, summary, pks, "left_outer")
    at = F.col("t._block")
    lives = at > F.coalesce(F.col("s._deleted"), F.lit(_NEVER))
    newer = F.coalesce(F.col("s._new._at") >= at, F.lit(False))
    return joined.where(lives).select(
        *[
            (F.when(newer, F.col(f"s._new.{c}")).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
            for c in columns
        ]
    )
