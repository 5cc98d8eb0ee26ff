"""Session settings and shared folders the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes.
#   timeZone            change times are UTC without a zone
#   timeType            TIME columns
#   allowDuplicateKeys  a repeated JSON key keeps its last value
#   mapKeyDedupPolicy   metadata columns override business fields of the same name
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

_local_base: str | None = None


def configure_session(spark: SparkSession) -> SparkSession:
    """Set the runtime options of ``SESSION_CONF`` and return the session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is used when the session names one. Only a local master may fall back to a
    temporary folder: on a cluster such a folder would not be visible to the executors.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        _local_base = _local_base or tempfile.mkdtemp(prefix="run-")
        base = _local_base
    return f"{base.rstrip('/')}/changeloom/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, through the Hadoop file system of its scheme."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> set[str]:
    """Names directly below a folder, by one listing; empty when the folder does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return set()
    return {status.getPath().getName() for status in fs.listStatus(hadoop_path)}


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return sorted(status.getPath().toString() for status in found or [])


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a path and everything below it, through the Hadoop file system of its scheme."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it; one that is there is left alone."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """Write one line as a file that is whole as soon as it can be seen; a file that is there is left alone."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop_path):
        return
    part = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(line.encode() + b"\n"))
    finally:
        out.close()
    if not fs.rename(part, hadoop_path):
        fs.delete(part, False)
