"""Job options and table metadata."""

import pytest
from pyspark.sql import types as T

from changeloom.options import ReplicationOptions, ingestion_mode
from changeloom.plans import schema as sc


def test_defaults():
    o = ReplicationOptions(table="orders").validate()
    assert (o.mode, o.apply_interval, o.merge_batch_size) == ("block", 30, 10_000)
    assert (o.retention_delay, o.retention_interval) == (86_400, 86_400)
    assert (o.max_records, o.flush_seconds, o.max_bytes) == (10_000, 120, 5_000_000)


def test_from_config():
    o = ReplicationOptions.from_config(
        {
            "warehouse.database": "raw", "warehouse.schema": "shop", "warehouse.table": "orders",
            "ingestion.mode": "stage_copy", "pk.fields": " a, b ,", "job.interval.seconds": "5",
            "merge.batch.size": "7", "ingest.cleanup.delay.seconds": "0", "ingest.cleanup.interval.seconds": "0",
            "buffer.count.records": "1", "buffer.flush.time": "1", "buffer.size.bytes": "1", "tasks.max": "1",
        },
        on_missing_update="insert",
    )
    assert o.table_identifier == "raw.shop.orders"
    assert (o.mode, o.pk_fields, o.apply_interval, o.merge_batch_size) == ("block", ("a", "b"), 5, 7)
    assert o.on_missing_update == "insert"


@pytest.mark.parametrize(
    "bad",
    [
        {"table": " "}, {"apply_interval": 4}, {"merge_batch_size": 0}, {"retention_delay": -1}, {"max_records": 0},
        {"flush_seconds": 0}, {"max_bytes": 0}, {"mode": "other"}, {"on_error": "skip"}, {"broadcast_bytes": -1},
    ],
)
def test_bounds(bad):
    with pytest.raises(ValueError):
        ReplicationOptions(**{"table": "t", **bad}).validate()


def test_ingestion_mode():
    assert [ingestion_mode(n) for n in ("STAGE", "stage_copy", "merge", "streaming")] == ["block", "block", "merge", "merge"]
    with pytest.raises(ValueError):
        ingestion_mode("other")
    assert ingestion_mode("Other", {"other": "merge"}) == "merge"
    assert ReplicationOptions.from_config({"table": "t", "ingestion.mode": "own"}, modes={"own": "merge"}).mode == "merge"


def test_source_options():
    o = ReplicationOptions(table="t", max_records=100, max_bytes=5000, flush_seconds=9)
    assert o.source_options("kafka") == {"maxOffsetsPerTrigger": "100", "minOffsetsPerTrigger": "100", "maxTriggerDelay": "9s"}
    assert o.source_options("kafka", min_partitions=64)["minPartitions"] == "64"
    assert o.source_options("kafka", 500)["maxOffsetsPerTrigger"] == "10"
    assert o.source_options("parquet") == {"maxBytesPerTrigger": "5000"}


def test_ingest_schema():
    target = T.StructType([T.StructField("ID", T.LongType(), False), T.StructField("kfk_op", T.StringType())])
    schema = sc.ingest_schema(target)
    assert schema.names == ["ID", "KFK_TOPIC", "KFK_PARTITION", "KFK_OFFSET", "KFK_OP", "KFK_DATETIME", "KFK_BLOCKID"]
    assert schema["ID"].nullable and not schema["KFK_OP"].nullable
    assert sc.business_columns(schema) == ["ID"]
    assert sc.ingest_table_name("ORDERS") == "ORDERS_INGEST"
    assert sc.column_types(schema).get("NOPE", T.StringType()) == T.StringType()


def test_keys(spark):
    assert sc.resolve_pks(["Id", "Name"], ["ID"]) == ["Id"]
    assert sc.non_pk_columns(["Id", "Name"], ["ID"]) == ["Name"]
    for fields in ([], ["missing"]):
        with pytest.raises(ValueError):
            sc.resolve_pks(["Id"], fields)
    spark.sql("drop table if exists pk_check")
    spark.sql("create table pk_check (id bigint, name string) using parquet")
    assert sc.discover_columns(spark, "pk_check").names == ["id", "name"]
    with pytest.raises(ValueError):
        sc.resolve_pks(["id", "name"], [], spark, "pk_check")
    spark.sql("alter table pk_check set tblproperties ('replication.pk' = 'ID')")
    assert sc.resolve_pks(["id", "name"], [], spark, "pk_check") == ["id"]
    spark.sql("drop table pk_check")


def test_keys_and_modes_are_exact():
    o = ReplicationOptions.from_config({"table": "a", "errors.table": "b", "transforms.schema": "z"})
    assert o.table_identifier == "a"
    for name in ("notastreaming", "merge2", ""):
        with pytest.raises(ValueError):
            ingestion_mode(name)
