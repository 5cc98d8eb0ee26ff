"""Payload projection and the typed change log."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators import parse as ps
from changeloom.plans.schema import ingest_schema
from changeloom.sources import ingest_log as il
from changeloom.sources import landing as ld

NOW = 1_700_000_000_000


def records(spark, *values):
    rows = [("t", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")


def parse(spark, value, **kw):
    row = ps.parse_changes(records(spark, value), now_ms=NOW, **kw)
    return row.withColumn("fields", F.to_json("fields")).first().asDict()


@pytest.mark.parametrize(
    ("value", "fmt", "op", "fields"),
    [
        ('{"op":null,"after":{"K":1}}', "envelope", "c", {"K": 1}),
        ('{"op":"u","after":null}', "envelope", "u", {}),
        ('{"op":"c","K":1}', "flat", "c", {"op": "c", "K": 1}),
        ('{"schema":{},"payload":{"K":1}}', "flat", "c", {"schema": {}, "payload": {"K": 1}}),
        ('{"op":"d","before":{"K":1},"after":{"K":2}}', "envelope", "d", {"K": 1}),
        ('{"op":"u","before":{"K":1},"after":{"K":2}}', "envelope", "u", {"K": 2}),
        ('{"schema":null,"payload":{"op":"r","after":{"K":2}}}', "envelope", "r", {"K": 2}),
        ('{"op":"c","after":{"K":1,"K":2}}', "envelope", "c", {"K": 2}),
        ('{"op":"t","after":{"K":{"a":[1,{"b":null}]}}}', "envelope", "t", {"K": {"a": [1, {"b": None}]}}),
        ("{}", "flat", "c", {}),
    ],
)
def test_json_routes(spark, value, fmt, op, fields):
    row = parse(spark, value)
    assert (row["fmt"], row["op"], json.loads(row["fields"])) == (fmt, op, fields)
    assert row["ts_ms"] == NOW
    assert row["reject_reason"] is None


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        (None, "null_value"),
        ("{bad", "malformed"),
        ("", "malformed"),
        ("[1]", "not_object"),
        ("5", "not_object"),
        ("null", "not_object"),
        ('{"op":"c","after":5}', "bad_image"),
    ],
)
def test_rejects(spark, value, reason):
    assert parse(spark, value)["reject_reason"] == reason
    parsed = ps.parse_changes(records(spark, value, '{"K":1}'), now_ms=NOW)
    good, bad = ps.apply_error_policy(parsed, "quarantine")
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match=reason):
        ps.apply_error_policy(parsed)[0].collect()


def test_tombstones_can_be_skipped(spark):
    parsed = ps.parse_changes(records(spark, None, '{"K":1}'), now_ms=NOW)
    assert ps.apply_error_policy(parsed, tombstones="skip")[0].count() == 1


def test_missing_image_is_flagged(spark):
    assert parse(spark, '{"op":"u","after":null}')["missing_image"] is True
    assert parse(spark, '{"op":"d","after":{"K":1}}')["missing_image"] is True
    assert parse(spark, '{"op":"u","after":{}}')["missing_image"] is False


def test_unwrap_flat(spark):
    assert json.loads(parse(spark, '{"schema":{},"payload":{"K":1}}', unwrap_flat=True)["fields"]) == {"K": 1}


def envelope(fields, row, op="c"):
    schema = {"fields": [{"field": "after", "fields": fields}]}
    return json.dumps({"schema": schema, "payload": {"op": op, "after": row}})


@pytest.mark.parametrize(
    ("name", "value", "want"),
    [
        ("io.debezium.time.Date", 19723, "2024-01-01"),
        ("io.debezium.time.Date", "19723", "19723"),
        ("io.debezium.time.Timestamp", 0, "1970-01-01T00:00Z"),
        ("io.debezium.time.MicroTimestamp", -1500, "1969-12-31T23:59:59.999Z"),
        ("io.debezium.time.NanoTimestamp", 1_500_000, "1970-01-01T00:00:00.001Z"),
        ("io.debezium.time.MicroTime", 60_000_000, "00:01"),
        ("org.example.Other", 5, 5),
        (" ", 5, 5),
    ],
)
def test_message_schema_normalises_numbers(spark, name, value, want):
    row = parse(spark, envelope([{"field": "x", "name": name}, {"field": "y"}], {"x": value, "y": 1}))
    assert json.loads(row["fields"]) == {"x": want, "y": 1}


def test_message_schemas_may_differ_by_row(spark):
    values = [
        envelope([{"field": "x", "name": "io.debezium.time.Date"}], {"x": 1}),
        envelope([{"field": "x", "name": "io.debezium.time.Timestamp"}], {"x": 1}),
        '{"op":"c","after":{"x":1}}',
    ]
    out = ps.parse_changes(records(spark, *values), now_ms=NOW).select(F.col("fields")["x"].cast("string")).collect()
    assert [r[0] for r in out] == ["1970-01-02", "1970-01-01T00:00:00.001Z", "1"]


def test_other_value_kinds(spark):
    base = records(spark, '{"op":"u","after":{"K":1}}')
    as_map = base.withColumn("value", F.from_json("value", "map<string,variant>"))
    as_variant = base.withColumn("value", F.parse_json("value"))
    as_bytes = base.withColumn("value", F.col("value").cast("binary"))
    for df in (as_map, as_variant, as_bytes):
        row = ps.parse_changes(df, now_ms=NOW).select("op", F.to_json("fields").alias("f")).first()
        assert (row["op"], row["f"]) == ("u", '{"K":1}')


STRUCT = "struct<before:struct<K:int,at:bigint>,after:struct<K:int,at:bigint>,op:string,ts_ms:bigint>"


def test_struct_envelope(spark):
    rows = [("t", 0, 0, ((1, 5), (2, 6), "d", 9)), ("t", 0, 1, ((1, 5), (2, 6), None, None)), ("t", 0, 2, (None, None, "u", 9)), ("t", 0, 3, None)]
    df = spark.createDataFrame(rows, f"topic string, partition int, offset bigint, value {STRUCT}")
    out = ps.parse_changes(df, now_ms=NOW, logical={"at": "io.debezium.time.Date"})
    got = out.select("op", "ts_ms", F.to_json("fields").alias("f"), "missing_image", "reject_reason").orderBy("offset").collect()
    assert [tuple(r) for r in got] == [
        ("d", 9, '{"K":1,"at":"1970-01-06"}', False, None),
        ("c", NOW, '{"K":2,"at":"1970-01-07"}', False, None),
        ("u", 9, "{}", True, None),
        ("c", NOW, "{}", False, "null_value"),
    ]


def test_flat_struct_with_op_column_stays_flat(spark):
    df = spark.createDataFrame([("t", 0, 0, ("x", (1,)))], "topic string, partition int, offset bigint, value struct<op:string,n:struct<a:int>>")
    row = ps.parse_changes(df, now_ms=NOW).select("fmt", "op", F.to_json("fields").alias("f")).first()
    assert tuple(row) == ("flat", "c", '{"n":{"a":1},"op":"x"}')


def test_struct_image_must_be_a_struct(spark):
    df = spark.createDataFrame([("t", 0, 0, ("u", 5))], "topic string, partition int, offset bigint, value struct<op:string,after:int>")
    with pytest.raises(TypeError):
        ps.parse_changes(df)


TARGET = T.StructType([T.StructField("ID", T.LongType(), False), T.StructField("NAME", T.StringType())])


def test_to_ingest_matches_names_in_any_case_and_metadata_wins(spark):
    parsed = ps.parse_changes(records(spark, '{"id":1,"Name":"a","KFK_OP":"z","other":2}'), now_ms=NOW)
    row = il.to_ingest(parsed, ingest_schema(TARGET), "b1").first()
    assert row.asDict() == {
        "ID": 1, "NAME": "a", "KFK_TOPIC": "t", "KFK_PARTITION": 0, "KFK_OFFSET": 0, "KFK_OP": "c",
        "KFK_DATETIME": dt.datetime(2023, 11, 14, 22, 13, 20), "KFK_BLOCKID": "b1",
    }
    exact = il.to_ingest(parsed, ingest_schema(TARGET), "b1", keys="exact").first()
    assert (exact["ID"], exact["NAME"]) == (None, None)


def test_first_record_decides_the_columns(spark):
    parsed = ps.parse_changes(records(spark, '{"ID":1}', '{"ID":2,"NAME":"b"}'), now_ms=NOW)
    strict = il.to_ingest(parsed, ingest_schema(TARGET), "b", columns="first_record").orderBy("ID").collect()
    assert [(r["ID"], r["NAME"]) for r in strict] == [(1, None), (2, None)]
    full = il.to_ingest(parsed, ingest_schema(TARGET), "b").orderBy("ID").collect()
    assert [(r["ID"], r["NAME"]) for r in full] == [(1, None), (2, "b")]


def test_row_bytes(spark):
    parsed = ps.parse_changes(records(spark, '{"ab":12,"c":null,"d":"xyz"}'), now_ms=NOW)
    assert parsed.select(il.row_bytes(F.col("fields"))).first()[0] == 100 + 4 + 2 + 3


def test_landing_round_trip(spark, tmp_path):
    schema = ingest_schema(TARGET)
    parsed = ps.parse_changes(records(spark, '{"id":1,"name":"","KFK_OP":"z"}'), now_ms=NOW)
    ld.land_json_lines(parsed, f"{tmp_path}/land", "b1")
    assert any(name.suffix == ".gz" for name in (tmp_path / "land").iterdir())
    direct = il.to_ingest(parsed, schema, "b1").collect()
    assert ld.read_landed(spark, f"{tmp_path}/land", schema).collect() == direct
    assert ld.read_landed(spark, f"{tmp_path}/land", schema, empty_as_null=True).first()["NAME"] is None
    ld.copy_into(spark, f"{tmp_path}/land", f"{tmp_path}/log", schema)
    assert not (tmp_path / "land").exists()
    assert [r.asDict() for r in il.read_log(spark, f"{tmp_path}/log", schema).collect()] == [r.asDict() for r in direct]


def test_landed_stream_deletes_its_files(spark, tmp_path):
    schema = ingest_schema(TARGET)
    for i in range(2):
        parsed = ps.parse_changes(records(spark, f'{{"id":{i}}}'), now_ms=NOW)
        ld.landing_lines(parsed, f"b{i}").write.mode("append").option("compression", "gzip").text(f"{tmp_path}/land")
        stream = ld.read_landed_stream(spark, f"{tmp_path}/land", schema)
        query = (
            stream.writeStream.format("parquet").option("path", f"{tmp_path}/log")
            .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert sorted(r["ID"] for r in spark.read.parquet(f"{tmp_path}/log").collect()) == [0, 1]


def test_dedup(spark, tmp_path):
    schema = ingest_schema(TARGET)
    parsed = ps.parse_changes(records(spark, '{"id":1}', '{"id":2}', '{"id":3}'), now_ms=NOW)
    rows = il.to_ingest(parsed, schema, "b")
    assert il.dedup_ingest(rows.unionByName(rows)).count() == 3
    existing = rows.where("KFK_OFFSET = 1")
    pruned = il.prune_to_offsets(existing, rows.where("KFK_OFFSET = 0"))
    assert pruned.count() == 0
    wide = il.prune_to_offsets(existing, rows, max_partitions=0)
    assert il.dedup_ingest(rows, wide).count() == 2


def test_write_block_once(spark, tmp_path):
    schema = ingest_schema(TARGET)
    rows = il.to_ingest(ps.parse_changes(records(spark, '{"id":1}'), now_ms=NOW), schema, "7")
    assert il.write_block(rows, f"{tmp_path}/log", "7") is True
    assert il.write_block(rows, f"{tmp_path}/log", "7") is False
    block = il.read_block(spark, f"{tmp_path}/log", schema, "7").first()
    assert block["KFK_BLOCKID"] == "7"


def test_typed_route_gives_what_the_map_gives(spark):
    """Exact, lower, upper and mixed spellings, missing and null values, duplicates, exact decimals, nested values."""
    values = [
        '{"op":"c","after":{"Id":1,"amount":12345678901234567890.12,"tag":{"a":[1,2]},"it\'s":"q"}}',
        '{"op":"u","after":{"id":2,"AMOUNT":"7.50","Tag":null}}',
        '{"op":"u","after":{"ID":3,"aMount":0.1,"TAG":"x","tag":"y"}}',
        '{"op":"c","after":{"iD":4,"amount":null,"amount":5}}',
        '{"Id":"5","tag":""}', '{"op":"u","after":null}', '{"op":"u","after":"text"}', "[1]", "{bad", None, "{}",
        '{"schema":{"fields":[{"field":"after","fields":[{"field":"day","name":"io.debezium.time.Date"}]}]},'
        '"payload":{"op":"c","after":{"Id":6,"day":19000}}}',
    ]
    df = records(spark, *values)
    schema = ingest_schema(T.StructType.fromDDL("Id long, amount decimal(30,2), tag string, doc variant, `it's` string, day date"))
    for empty in (False, True):
        made = []
        for typed in (False, True):
            parsed = ps.parse_changes(df, now_ms=0, typed=typed)
            rows = il.to_ingest(parsed, schema, "b", empty_as_null=empty).withColumn("doc", F.col("doc").cast("string"))
            reasons = parsed.select("offset", "fmt", "op", "missing_image", "reject_reason").orderBy("offset").collect()
            made.append((rows.orderBy("KFK_OFFSET").collect(), reasons))
        assert made[0] == made[1]
    assert [row["Id"] for row in made[1][0]][:5] == [1, 2, 3, 4, 5]
    assert str(made[1][0][0]["amount"]) == "12345678901234567890.12"
    assert str(made[1][0][11]["day"]) == "2022-01-08"
