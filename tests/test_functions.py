"""Logical types and coercion, one value at a time."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions import coerce as co
from changeloom.functions import logical as lg


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_norm_date(spark):
    assert one(spark, lg.norm_date(F.lit(-1))) == dt.date(1969, 12, 31)
    assert one(spark, lg.norm_date(F.lit(19723))) == dt.date(2024, 1, 1)
    assert one(spark, lg.norm_date(F.lit(10**12))) is None


def test_norm_timestamps_cut_toward_zero(spark):
    assert one(spark, lg.norm_ts_millis(F.lit(-1))) == ts("1969-12-31 23:59:59.999")
    assert one(spark, lg.norm_ts_micros(F.lit(-1500))) == ts("1969-12-31 23:59:59.999")
    assert one(spark, lg.norm_ts_micros(F.lit(-1500), "micros")) == ts("1969-12-31 23:59:59.998500")
    assert one(spark, lg.norm_ts_nanos(F.lit(-1_999_999))) == ts("1969-12-31 23:59:59.999")
    assert one(spark, lg.norm_ts_nanos(F.lit(1_700_000_000_123_456_789), "micros")) == ts("2023-11-14 22:13:20.123456")


@pytest.mark.parametrize(
    ("millis", "text"),
    [
        (0, "1970-01-01T00:00Z"),
        (5_000, "1970-01-01T00:00:05Z"),
        (5, "1970-01-01T00:00:00.005Z"),
        (1_704_078_240_120, "2024-01-01T03:04:00.120Z"),
    ],
)
def test_iso_timestamp_text(spark, millis, text):
    assert one(spark, lg.iso_ts_text(lg.norm_ts_millis(F.lit(millis)))) == text


@pytest.mark.parametrize(
    ("amount", "unit", "text"),
    [
        (0, "millis", "00:00"),
        (11_045_000, "millis", "03:04:05"),
        (11_045_006, "millis", "03:04:05.006"),
        (11_040_000_001, "micros", "03:04:00.000001"),
        (11_040_000_000_001, "nanos", "03:04:00.000000001"),
        (86_400_000, "millis", None),
        (-1, "micros", None),
    ],
)
def test_iso_time_text(spark, amount, unit, text):
    assert one(spark, lg.iso_time_text(F.lit(amount), unit)) == text


def test_norm_time(spark):
    assert one(spark, lg.norm_time(F.lit(11_045_006_000), "micros")) == dt.time(3, 4, 5, 6000)
    assert one(spark, lg.norm_time(F.lit(-5), "micros")) is None


def test_logical_text_unknown_name_is_null(spark):
    assert one(spark, lg.logical_text(F.lit(5), "org.example.Odd")) is None
    assert one(spark, lg.logical_text(F.lit(5), F.lit("org.example.Odd"))) is None
    assert one(spark, lg.logical_text(F.lit(5), F.lit("io.debezium.time.Date"))) == "1970-01-06"


def test_avro_logical_types():
    row = """{"type":"record","name":"Value","fields":[
        {"name":"id","type":"long"},
        {"name":"d","type":["null",{"type":"int","logicalType":"date","connect.name":"io.debezium.time.Date"}]},
        {"name":"t","type":{"type":"long","logicalType":"timestamp-micros"}},
        {"name":"in","type":{"type":"record","name":"In","fields":[
            {"name":"m","type":{"type":"int","logicalType":"time-millis"}}]}}]}"""
    envelope = (
        '{"type":"record","name":"Envelope","fields":[{"name":"before","type":["null",' + row
        + ']},{"name":"after","type":["null","Value"]},{"name":"op","type":"string"}]}'
    )
    want = {"d": "io.debezium.time.Date", "t": "timestamp-micros", "in.m": "time-millis"}
    assert lg.avro_logical_types(envelope) == want
    assert lg.avro_logical_types(row) == want


def coerced(spark, json_text, ddl, **kw):
    dtype = T._parse_datatype_string(ddl)
    df = spark.createDataFrame([(json_text,)], "j string").select(co.coerce(F.try_parse_json("j"), dtype, **kw).alias("x"))
    return df.first()["x"]


CASES = [
    ("12.5", "decimal(38,0)", Decimal(13)),
    ("-12.5", "decimal(38,0)", Decimal(-13)),
    ("12.5", "decimal(10,2)", Decimal("12.50")),
    ('"12.5"', "bigint", 13),
    ('" 7 "', "int", 7),
    ('"1e3"', "int", 1000),
    ("99999999999", "int", None),
    ('"abc"', "decimal(10,2)", None),
    ("12345678901234567890.10", "decimal(30,2)", Decimal("12345678901234567890.10")),
    ("true", "decimal(10,2)", None),
    ("1.25", "double", 1.25),
    ('"x"', "double", None),
    ('"On"', "boolean", True),
    ('"off"', "boolean", False),
    ("true", "boolean", True),
    ("1", "boolean", True),
    ("5", "boolean", None),
    ('"2024-01-02"', "date", dt.date(2024, 1, 2)),
    ('"2024-01-02T03:04Z"', "date", dt.date(2024, 1, 2)),
    ("19723", "date", dt.date(2024, 1, 1)),
    ('"19723"', "date", dt.date(2024, 1, 1)),
    ("1000001", "date", dt.date(1970, 1, 1)),
    ("-1000001", "date", dt.date(1969, 12, 31)),
    ("-1", "date", dt.date(1969, 12, 31)),
    ('"2024-01"', "date", None),
    ('"2024-13-01"', "date", None),
    ("99999999999999999999", "date", None),
    ('"2024-01-02T03:04Z"', "timestamp_ntz", ts("2024-01-02 03:04:00")),
    ('"2024-01-02T03:04"', "timestamp_ntz", ts("2024-01-02 03:04:00")),
    ('"2024-01-02T03:04:05.006Z"', "timestamp_ntz", ts("2024-01-02 03:04:05.006")),
    ('"2024-01-02 03:04:05+02:00"', "timestamp_ntz", ts("2024-01-02 03:04:05")),
    ('"2024-01-02"', "timestamp_ntz", ts("2024-01-02 00:00:00")),
    ("1700000000", "timestamp_ntz", ts("2023-11-14 22:13:20")),
    ("1700000000123", "timestamp_ntz", ts("2023-11-14 22:13:20.123")),
    ("1700000000123456", "timestamp_ntz", ts("2023-11-14 22:13:20.123456")),
    ("1700000000123456789", "timestamp_ntz", ts("2023-11-14 22:13:20.123456")),
    ("-1", "timestamp_ntz", ts("1969-12-31 23:59:59")),
    ('"soon"', "timestamp_ntz", None),
    ('"03:04"', "time(6)", dt.time(3, 4)),
    ('"25:04"', "time(6)", None),
    ('"4a4B"', "binary", bytearray(b"JK")),
    ('"zz"', "binary", None),
    ('{"b": 1.10, "a": [1, 2]}', "string", '{"a":[1,2],"b":1.1}'),
    ("null", "string", None),
    ('[1, 2]', "array<int>", [1, 2]),
    ('{"k": 1}', "map<string,int>", {"k": 1}),
]


def test_coerce(spark):
    """All cases in one job: one row per text, one column per case."""
    rows = spark.createDataFrame([tuple(case[0] for case in CASES)], [f"j{i}" for i in range(len(CASES))])
    cols = [
        co.coerce(F.try_parse_json(f"j{i}"), T._parse_datatype_string(ddl)).alias(f"x{i}")
        for i, (_, ddl, _) in enumerate(CASES)
    ]
    got = rows.select(*cols).first()
    assert {CASES[i][:2]: v for i, v in enumerate(got)} == {case[:2]: case[2] for case in CASES}


def test_number_scale_zero_and_empty_as_null(spark):
    assert coerced(spark, "12.5", "decimal(10,2)", number_scale="zero") == Decimal("13.00")
    assert coerced(spark, '""', "string") == ""
    assert coerced(spark, '""', "string", empty_as_null=True) is None


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("NUMBER(5,0)", T.DecimalType(5, 0)),
        ("number", T.DecimalType(38, 0)),
        ("DECIMAL(10, 2)", T.DecimalType(10, 2)),
        ("BIGINT", T.LongType()),
        ("INT", T.IntegerType()),
        ("FLOAT", T.DoubleType()),
        ("DOUBLE PRECISION", T.DoubleType()),
        ("BOOLEAN", T.BooleanType()),
        ("DATE", T.DateType()),
        ("TIMESTAMP_NTZ(9)", T.TimestampNTZType()),
        ("TIMESTAMP_LTZ", T.TimestampNTZType()),
        ("TIME", T.TimeType(6)),
        ("VARBINARY", T.BinaryType()),
        ("VARIANT", T.VariantType()),
        ("OBJECT", T.VariantType()),
        ("VARCHAR(255)", T.StringType()),
        ("GEOGRAPHY", T.StringType()),
    ],
)
def test_warehouse_type(name, want):
    assert co.warehouse_type(name) == want


def test_float_text_is_a_plain_number(spark):
    from changeloom.functions.coerce import coerce_text

    rows = [("1d",), ("1.5f",), ("0x1p3",), ("2.5",), ("-1e3",), ("NaN",), ("-Infinity",), (" 7 ",), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(coerce_text(F.col("s"), T.DoubleType())).collect()]
    assert got[:3] == [None] * 3 and got[3:5] == [2.5, -1000.0] and got[5] != got[5]
    assert got[6:] == [float("-inf"), 7.0, None, None]
