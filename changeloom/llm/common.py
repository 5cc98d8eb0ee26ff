"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.session import delete_path, shared_dir

# Words are runs of anything but the six ASCII white-space characters, which is also what bytes.split() separates.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str, **options) -> DataFrame:
    """Write a result to a new folder of the shared checkpoint folder and read it back, which cuts its lineage."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the files of stored results that are not read again."""
    for df in frames:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            delete_path(df.sparkSession, folder)


def small_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Bound what a Python worker holds of long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % n


def is_bucket(doc_id: Column, n: int, value: int) -> Column:
    """Whether the id falls into the bucket; false for a null id."""
    return F.coalesce(id_bucket(doc_id, n) == value, F.lit(False))


def not_bucket(doc_id: Column, n: int, value: int) -> Column:
    """Whether the id falls into another bucket; false for a null id, which is never learned from."""
    return F.coalesce(id_bucket(doc_id, n) != value, F.lit(False))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: str):
    """``mapInArrow`` of a function on one batch."""

    def run(batches):
        for batch in batches:
            out = fn(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of a column; null as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, component), the smallest reachable node.

    Alternates the large-star and the small-star step. Both are a minimum per node (combined before the shuffle) and
    a join on the node, so that no task ever holds the neighbours of one node. Rounds grow with the logarithm of the
    largest component; each is written to the shared checkpoint folder. Nodes without an edge have no row.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # pairs hold u > v once; large-star looks at both directions, small-star at the smaller neighbours only
        both = pairs.union(pairs.select("v", "u")) if large else pairs
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(low, "u")
        if large:
            joined = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            joined = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return joined.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    state = None
    for _ in range(max_rounds):
        after = stored(star(star(now, True), False), "cc")
        forget(now)
        now = after
        # stable once every u has one parent and no parent is itself a child
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor, shift, multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
