"""Targets of a replication job: catalog tables, written through the engine's own writes.

``CatalogTarget`` is for tables of files. The table is partitioned by a bucket of the key; a change set overwrites only
the partitions its keys fall into, by dynamic partition overwrite, and the scan of the target is pruned to them.
``RowLevelTarget`` is for table formats with row-level writes and leaves all that to their MERGE.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.apply import (
    ApplyMetrics,
    applied,
    classify_block,
    classify_merge,
    delete_rows_of,
    insert_block,
    merge_into,
    observe_block,
    observe_merge,
    observed,
    surviving,
    update_rows_of,
)
from changeloom.options import ReplicationOptions
from changeloom.plans.schema import OP, PK_PROPERTY, discover_columns, resolve_pks

# Technical columns of a catalog target: the partition a key falls into, and the change set that wrote the partition.
BUCKET, CHANGE_SET = "_bucket", "_change_set"
BUCKETS_PROPERTY = "replication.buckets"


def change_bytes(rows: DataFrame) -> int:
    """Estimated size of a written change set in bytes, by one aggregate over it."""
    size = F.lit(16)
    for f in rows.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) + 8
        else:
            size = size + 16
    return rows.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class CatalogTarget:
    """A partitioned catalog table as the target of one job. Keys and number of buckets are fixed for its life.

    All rows of a partition are written by one change set and carry its name, so that a change set that was cut off
    between two partitions goes on with the others when it is taken again, and one that is done is skipped.
    """

    spark: SparkSession
    table: str
    schema: T.StructType
    pks: tuple[str, ...]
    buckets: int = 1

    @classmethod
    def create(
        cls, spark: SparkSession, table: str, schema: T.StructType, pks: tuple[str, ...], buckets: int = 1,
        location: str | None = None, source: str = "parquet",
    ) -> CatalogTarget:
        """Make the table unless it is there, and open it."""
        columns = ", ".join(f"{_ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        where = f"LOCATION '{location}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {CHANGE_SET} STRING, {BUCKET} INT) USING {source} "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({BUCKET}) {where} "
            f"TBLPROPERTIES ('{PK_PROPERTY}' = '{','.join(pks)}', '{BUCKETS_PROPERTY}' = '{buckets}')"
        )
        return cls.open(spark, table)

    @classmethod
    def open(cls, spark: SparkSession, table: str, pk_fields: tuple[str, ...] = ()) -> CatalogTarget:
        """The target as the catalog describes it: its columns, its keys (the option first, then the property), its buckets."""
        columns = discover_columns(spark, table)
        schema = T.StructType([f for f in columns.fields if f.name not in (BUCKET, CHANGE_SET)])
        if not {BUCKET, CHANGE_SET} <= set(columns.names):
            raise ValueError(f"{table} lacks the columns {BUCKET} and {CHANGE_SET}: make it with CatalogTarget.create")
        pks = resolve_pks(schema.names, list(pk_fields), spark, table)
        rows = spark.sql(f"SHOW TBLPROPERTIES {table} ('{BUCKETS_PROPERTY}')").collect()
        return cls(spark, table, schema, tuple(pks), int(rows[0]["value"]))

    def refreshed(self) -> CatalogTarget:
        """The target as the catalog describes it by now; columns may have come since, keys and buckets are fixed."""
        now = CatalogTarget.open(self.spark, self.table, self.pks)
        return now if now.schema != self.schema else self

    def bucket_of(self) -> Column:
        """Partition of a row by its key; null keys share one."""
        return F.pmod(F.xxhash64(*self.pks), F.lit(self.buckets)).cast("int")

    def touched(self, changes: DataFrame) -> list[int]:
        """Partitions a change set can alter; at most ``buckets`` numbers."""
        if self.buckets == 1:
            return [0]
        return sorted(row[0] for row in changes.select(self.bucket_of()).distinct().collect())

    def _rows(self, buckets: list[int] | None) -> DataFrame:
        rows = self.spark.table(self.table)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """Current rows, or those of some partitions; others are not scanned."""
        return self._rows(buckets).select(*self.schema.names)

    def written_by(self, change_set: str, buckets: list[int] | None = None) -> list[int]:
        """Partitions whose rows a change set wrote; at most ``buckets`` numbers."""
        rows = self._rows(buckets).where(F.col(CHANGE_SET) == change_set).select(BUCKET).distinct()
        return sorted(row[0] for row in rows.collect())

    def replace(self, rows: DataFrame, change_set: str, buckets: list[int] | None = None) -> None:
        """Overwrite partitions (all, if none are named) with ``rows``, which may be read from this very table."""
        buckets = list(range(self.buckets)) if buckets is None else buckets
        keyed = rows.select(*self.schema.names).withColumns({CHANGE_SET: F.lit(change_set), BUCKET: self.bucket_of()})
        keyed = keyed.select(*self.spark.table(self.table).columns)  # the write goes by position
        if self.buckets > 1:
            # few files per partition; adaptive execution splits one that is too large for one task
            keyed = keyed.hint("rebalance", BUCKET)
        keyed.write.insertInto(self.table, overwrite=True)
        # a partition that lost all its rows has none in the write above, and is emptied by name
        old = self._rows(buckets).where(F.col(CHANGE_SET) != change_set).select(BUCKET).distinct().collect()
        fields = [f for f in self.spark.table(self.table).schema.fields if f.name != BUCKET]
        nulls = ", ".join(f"cast(null as {f.dataType.simpleString()})" for f in fields)
        for row in old:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BUCKET} = {row[0]}) SELECT {nulls} WHERE false")

    def apply(self, changes: DataFrame, change_set: str, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Apply a change set once: ``rule`` maps touched rows and their changes to the new rows. False when it was done."""
        touched = self.touched(changes)
        done = self.written_by(change_set, touched)
        left = [b for b in touched if b not in set(done)]
        if not left:
            return False
        if done:
            changes = changes.where(self.bucket_of().isin(left))
        self.replace(rule(self.read(left), changes), change_set, left)
        return True

    def apply_winners(self, winners: DataFrame, change_set: str, options: ReplicationOptions) -> ApplyMetrics | None:
        """Merge written winners once; null when they already are in the table.

        The join is a broadcast when the measured size of the winners allows it.
        """
        small = change_bytes(winners) <= options.broadcast_bytes
        counts = Observation()

        def rule(rows: DataFrame, changes: DataFrame) -> DataFrame:
            both = classify_merge(rows, changes, list(self.pks), options.on_missing_update, small, changes)
            return applied(observe_merge(both, counts))

        return ApplyMetrics(**observed(counts)) if self.apply(winners, change_set, rule) else None

    def apply_block(self, block: DataFrame, change_set: str, options: ReplicationOptions) -> ApplyMetrics | None:
        """Insert, update, delete of one written block, once; null when it already is in the table."""
        small = change_bytes(block.where(F.col(OP).isin("u", "d"))) <= options.broadcast_bytes
        counts = Observation()

        def rule(rows: DataFrame, changes: DataFrame) -> DataFrame:
            return surviving(observe_block(classify_block(rows, changes, list(self.pks), small), counts))

        return ApplyMetrics(**observed(counts)) if self.apply(block, change_set, rule) else None


@dataclass(frozen=True)
class RowLevelTarget:
    """A catalog table whose format has row-level writes. It is named, keyed and read like any other target.

    A merge taken again changes nothing, since winners have one row per key. Inserts of a block taken again
    would come twice: the format's own transactions have to keep the name of the change set for that.
    """

    spark: SparkSession
    table: str
    schema: T.StructType
    pks: tuple[str, ...]
    done: set[str] = field(default_factory=set, compare=False)

    @classmethod
    def open(cls, spark: SparkSession, table: str, pk_fields: tuple[str, ...] = ()) -> RowLevelTarget:
        schema = discover_columns(spark, table)
        return cls(spark, table, schema, tuple(resolve_pks(schema.names, list(pk_fields), spark, table)))

    def refreshed(self) -> RowLevelTarget:
        return replace(self, schema=discover_columns(self.spark, self.table))

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def apply_winners(self, winners: DataFrame, change_set: str, options: ReplicationOptions) -> ApplyMetrics | None:
        merge_into(self.table, winners, self.schema.names, list(self.pks), options.on_missing_update, winners)
        return ApplyMetrics()

    def apply_block(self, block: DataFrame, change_set: str, options: ReplicationOptions) -> ApplyMetrics | None:
        if change_set in self.done:
            return None
        insert_block(self.read().limit(0), block).writeTo(self.table).append()
        update_rows_of(self.table, block, self.schema.names, list(self.pks))
        delete_rows_of(self.table, block, list(self.pks))
        self.done.add(change_set)
        return ApplyMetrics()
