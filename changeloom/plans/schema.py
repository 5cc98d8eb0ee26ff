"""Table metadata: columns, primary keys, change-log schema and names."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Metadata columns of the change log.
TOPIC, PARTITION, OFFSET = "KFK_TOPIC", "KFK_PARTITION", "KFK_OFFSET"
OP, DATETIME, BLOCK = "KFK_OP", "KFK_DATETIME", "KFK_BLOCKID"
LOG_KEY = [TOPIC, PARTITION, OFFSET]

LOG_META = T.StructType(
    [
        T.StructField(TOPIC, T.StringType(), False),
        T.StructField(PARTITION, T.IntegerType(), False),
        T.StructField(OFFSET, T.LongType(), False),
        T.StructField(OP, T.StringType(), False),
        T.StructField(DATETIME, T.TimestampNTZType(), False),
        T.StructField(BLOCK, T.StringType(), False),
    ]
)

PK_PROPERTY = "replication.pk"


def ingest_table_name(table: str) -> str:
    return f"{table}_INGEST"


def ingest_schema(target: T.StructType) -> T.StructType:
    """Change-log schema of a target: its columns, nullable, and the six required metadata columns."""
    meta = set(LOG_META.names)
    business = [T.StructField(f.name, f.dataType, True) for f in target.fields if f.name.upper() not in meta]
    return T.StructType(business + LOG_META.fields)


def business_columns(schema: T.StructType) -> list[str]:
    """Columns of a table or change log without the metadata columns, in order."""
    meta = set(LOG_META.names)
    return [name for name in schema.names if name.upper() not in meta]


def discover_columns(spark: SparkSession, table: str) -> T.StructType:
    """Columns of a catalog table, in order; an error when there are none."""
    schema = spark.table(table).schema
    if not schema.names:
        raise ValueError(f"table {table} has no columns")
    return schema


def resolve_pks(
    columns: list[str], pk_fields: list[str] | None = None, spark: SparkSession | None = None, table: str | None = None
) -> list[str]:
    """Key columns in the table's own spelling: the option first, then the table property, else an error."""
    wanted = list(pk_fields or [])
    if not wanted and spark is not None and table is not None:
        rows = spark.sql(f"SHOW TBLPROPERTIES {table} ('{PK_PROPERTY}')").collect()
        if rows and "does not have property" not in rows[0]["value"]:
            wanted = [name.strip() for name in rows[0]["value"].split(",") if name.strip()]
    if not wanted:
        raise ValueError(f"no primary key: set pk_fields or the table property {PK_PROPERTY}")
    spelling = {name.upper(): name for name in columns}
    unknown = [name for name in wanted if name.upper() not in spelling]
    if unknown:
        raise ValueError(f"primary key columns not in the table: {unknown}")
    return [spelling[name.upper()] for name in wanted]


def non_pk_columns(columns: list[str], pks: list[str]) -> list[str]:
    """Columns that are not keys, ignoring case on both sides."""
    keys = {name.upper() for name in pks}
    return [name for name in columns if name.upper() not in keys]


def column_types(schema: T.StructType) -> dict[str, T.DataType]:
    """Upper-cased column name -> type; look up with ``.get(name, StringType())`` for unknown columns."""
    return {f.name.upper(): f.dataType for f in schema.fields}
