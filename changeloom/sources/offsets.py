"""Which offsets of a topic the log holds, as intervals.

Per source partition the offsets that were written form runs without a gap. The runs are kept merged, next to the job, as
one small table per micro-batch; a new micro-batch is compared with them and the log itself is never read. An interval
holds exactly the offsets that were written, so a change that was delivered before is told from one that comes late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.plans.schema import OFFSET, PARTITION, TOPIC
from changeloom.session import child_names, delete_path, path_exists

INTERVALS = T.StructType(
    [
        T.StructField(TOPIC, T.StringType()),
        T.StructField(PARTITION, T.IntegerType()),
        T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()),
    ]
)
SOURCE = [TOPIC, PARTITION]

# Offsets whose runs one task finds, and cells an offset range is cut into for the comparison.
_RANGE = 1 << 16
_CELLS = 4096


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap or touch become one, per source partition."""
    order = Window.partitionBy(*SOURCE).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = intervals.withColumn("_new", F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1)))
    numbered = opened.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*SOURCE, "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run")


def offset_intervals(rows: DataFrame) -> DataFrame:
    """The runs of offsets of some change rows: topic, partition, lo, hi.

    Runs are found within fixed ranges of offsets, so that no task sorts a whole source partition, and then joined.
    """
    keys = rows.select(*SOURCE, F.col(OFFSET).alias("lo")).distinct()
    area = F.call_function("shiftright", F.col("lo"), F.lit(_RANGE.bit_length() - 1))
    within = Window.partitionBy(*SOURCE, "_area").orderBy("lo")
    runs = keys.withColumn("_area", area).withColumn("_run", F.col("lo") - F.row_number().over(within))
    found = runs.groupBy(*SOURCE, "_area", "_run").agg(F.min("lo").alias("lo"), F.max("lo").alias("hi"))
    return merge_intervals(found.select(*SOURCE, "lo", "hi"))


def without_known(rows: DataFrame, known: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """The change rows whose offset lies in none of the known intervals.

    The offset range of each source partition is cut into a fixed number of cells; an interval meets the rows of the cells
    it covers. Intervals outside the range of the new rows are put aside first, and where none is left no row moves.
    ``positions`` has the same log keys as ``rows``, where those cost less to read.
    """
    hull = (rows if positions is None else positions).groupBy(*SOURCE).agg(F.min(OFFSET).alias("_from"), F.max(OFFSET).alias("_to"))
    near = known.join(hull, SOURCE).where((F.col("hi") >= F.col("_from")) & (F.col("lo") <= F.col("_to")))
    if near.isEmpty():
        return rows

    def cell(offset):
        width = F.ceil((F.col("_to") - F.col("_from") + 1) / _CELLS).cast("bigint")
        return F.call_function("div", offset - F.col("_from"), width)

    cells = F.sequence(cell(F.greatest("lo", "_from")), cell(F.least("hi", "_to")))
    spread = near.select(*SOURCE, "lo", "hi", F.explode(cells).alias("_cell")).alias("k")
    placed = rows.join(hull, SOURCE).withColumn("_cell", cell(F.col(OFFSET))).alias("r")
    same = [F.col(f"r.{c}") == F.col(f"k.{c}") for c in (*SOURCE, "_cell")]
    inside = F.col(f"r.{OFFSET}").between(F.col("k.lo"), F.col("k.hi"))
    return placed.join(spread, [*same, inside], "left_anti").select(*rows.columns)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete tables, the newest first."""
    numbers = [int(name.removeprefix("batch=")) for name in child_names(spark, path) if name.startswith("batch=")]
    return [n for n in sorted(numbers, reverse=True) if path_exists(spark, f"{path}/batch={n}/_SUCCESS")]


def known_offsets(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The intervals of the newest table with a number below ``before``; null when there is none."""
    done = [n for n in _versions(spark, path) if n < before]
    return spark.read.schema(INTERVALS).parquet(f"{path}/batch={done[0]}") if done else None


def note_offsets(spark: SparkSession, path: str, number: int, rows: DataFrame, keep: int = 3) -> None:
    """Keep what was written, merged with the newest table below ``number``; of the tables the newest ``keep`` stay."""
    known, new = known_offsets(spark, path, number), offset_intervals(rows)
    both = new if known is None else merge_intervals(known.unionByName(new))
    both.write.mode("overwrite").parquet(f"{path}/batch={number}")
    for old in _versions(spark, path)[keep:]:
        delete_path(spark, f"{path}/batch={old}")
