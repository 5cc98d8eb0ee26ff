"""Headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` local cores; prints one JSON line.

Each query is planned and run from scratch: one warm-up, then the median of ``$BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from changeloom.operators import apply as ap  # noqa: E402
from changeloom.operators import retention as rt  # noqa: E402
from changeloom.options import ReplicationOptions  # noqa: E402
from changeloom.plans import queries as q  # noqa: E402
from changeloom.session import shared_dir  # noqa: E402

HEADLINE = [
    "parse_flat",
    "parse_envelope",
    "parse_envelope_schema",
    "parse_struct_envelope",
    "parse_lineitem",
    "ingest_rows",
    "dedup_ingest",
    "latest_per_key",
    "latest_per_key_orders",
    "take_batch",
    "merge_single",
    "merge_counts",
    "block_apply",
    "replay_merge",
    "replay_merge_initial",
    "replay_blocks",
    "replay_blocks_initial",
    "remove_batch",
    "expire_rows",
]
STREAMS = ["stream_merge", "stream_blocks"]


def merge_share(percent: int):
    """Merge with changes for a share of the orders, told apart by order date."""

    def run(spark, sf_dir):
        log = q.log_o(spark, sf_dir)
        if percent < 100:
            edge = log.agg(F.percentile_approx(q.DATETIME, percent / 100)).first()[0]
            log = log.where(F.col(q.DATETIME) <= F.lit(edge))
        target = q.target_o(spark, sf_dir)
        winners = ap.winners_of(log, q.O_PK, target.columns)
        small = False
        if percent < 100:  # as a tick does it: written, measured, and broadcast only below the limit
            folder = shared_dir(spark, "winners")
            winners.write.parquet(folder)
            size = sum(os.path.getsize(f.removeprefix("file:")) for f in spark.read.parquet(folder).inputFiles())
            winners, small = spark.read.schema(winners.schema).parquet(folder), size <= ReplicationOptions("orders").broadcast_bytes
        return ap.applied(ap.classify_merge(target, log, q.O_PK, small_batch=small, winners=winners))

    return run


def retention_lineitem(spark, sf_dir):
    log = q.table(spark, sf_dir, "lineitem").select("*", F.col("l_shipdate").alias(q.DATETIME))
    return rt.expire_rows(log, 365 * 86_400, q.dt.datetime(2000, 1, 1))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("changeloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: q.all_queries()[name] for name in HEADLINE}
    chosen.update({f"merge_{p}_percent": merge_share(p) for p in (1, 10, 100)})
    chosen["retention_lineitem"] = retention_lineitem
    chosen.update({name: q.all_queries()[name] for name in STREAMS})
    times: dict[str, float] = {}
    for name, query in chosen.items():
        took = []
        for _ in range(2 if name in STREAMS else runs + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
