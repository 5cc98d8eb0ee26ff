"""Change records from a topic or from files, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions.logical import with_logical_types

CHANGE_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)


# Tasks one input task may be split into before parsing.
_SPREAD = 16


def spread_narrow(df: DataFrame) -> DataFrame:
    """Spread a scan over the cores when it has too few tasks to use them.

    Parsing costs far more than reading. A file that cannot be split, such as one gzip file or one row group, would
    leave the whole parse to one core. A scan with enough tasks is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.rdd.getNumPartitions()
    if tasks == 0 or tasks * 2 > cores:
        return df
    return df.repartition(min(cores, tasks * _SPREAD))


def spread_rows(df: DataFrame) -> DataFrame:
    """Spread the rows of a micro-batch over the cores when a few of its tasks hold them.

    The number of tasks does not tell: files without rows, and files that cannot be split, leave the whole parse to the
    others. A batch none of whose tasks has more than twice its share is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]  # a number per task
    if not held or max(held) * cores <= 2 * sum(held):
        return df
    return df.repartition(min(cores, sum(held)))


def read_changes(
    spark: SparkSession,
    source: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    streaming: bool = True,
    schema: T.StructType = CHANGE_RECORD,
    avro_schema: str | None = None,
) -> DataFrame:
    """Change records ``topic, partition, offset, timestamp, value``.

    ``source`` is ``kafka`` or a file format (``parquet``, ``json``, ``orc``) holding the same columns. Kafka values
    are text unless ``avro_schema`` decodes them; both need the connector package of the Spark distribution.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(source).options(**(options or {}))
    if source != "kafka":
        records = reader.schema(schema).load(path)
        return records if streaming else spread_narrow(records)
    return decode_value(reader.load().select("topic", "partition", "offset", "timestamp", "value"), avro_schema)


def decode_value(records: DataFrame, avro_schema: str | None = None) -> DataFrame:
    """Binary values -> JSON text, or a struct when an Avro schema is given."""
    if avro_schema is None:
        return records.withColumn("value", F.col("value").cast("string"))
    from pyspark.sql.avro.functions import from_avro

    return carry_logical_types(records.withColumn("value", from_avro(F.col("value"), avro_schema, {"mode": "FAILFAST"})), avro_schema)


def carry_logical_types(records: DataFrame, avro_schema: str) -> DataFrame:
    """Decoded records whose value's fields carry the logical types of the Avro schema, for every plan built on them."""
    kind = with_logical_types(records.schema["value"].dataType, avro_schema)
    return records.withColumn("value", F.col("value").cast(kind))
