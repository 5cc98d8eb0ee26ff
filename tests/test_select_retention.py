"""Batch selection, filters, audit and retention."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import retention as rt
from changeloom.operators import select as se

DDL = "KFK_TOPIC string, KFK_PARTITION int, KFK_OFFSET bigint, KFK_OP string, KFK_DATETIME timestamp_ntz, KFK_BLOCKID string, k int"


def make(spark, positions):
    rows = [(t, p, o, "c", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), str(i % 3), i) for i, (t, p, o) in enumerate(positions)]
    return spark.createDataFrame(rows, DDL)


def positions(rows):
    return sorted((r["KFK_PARTITION"], r["KFK_OFFSET"], r["KFK_TOPIC"]) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 7, 50, 199, 200, 5000])
def test_take_batch_is_the_sorted_prefix(spark, n):
    rng = random.Random(n)
    rows = rng.sample([("a" if o % 2 else "b", p, o * 10**9) for p in range(5) for o in range(100)], 200)
    log = make(spark, rows)
    want = sorted((p, o, t) for t, p, o in rows)[:n]
    assert positions(se.take_batch(log, n).collect()) == want
    left = rt.remove_batch(log, se.batch_bound(log, n)).collect()
    assert positions(left) == sorted((p, o, t) for t, p, o in rows)[n:]


def test_take_batch_breaks_ties_by_topic(spark):
    log = make(spark, [("b", 0, 5), ("a", 0, 5), ("c", 0, 5), ("a", 1, 0)])
    assert positions(se.take_batch(log, 2).collect()) == [(0, 5, "a"), (0, 5, "b")]


def test_take_batch_of_an_empty_log(spark):
    log = make(spark, [("a", 0, 0)]).limit(0)
    assert se.batch_bound(log, 5) is None
    assert se.take_batch(log, 5).count() == 0
    assert se.has_pending(log) is False
    with pytest.raises(ValueError):
        se.batch_bound(log, 0)


def test_remove_batch_by_key(spark):
    log = make(spark, [("a", 0, i) for i in range(5)])
    assert positions(rt.remove_batch(log, log.where("KFK_OFFSET < 3")).collect()) == [(0, 3, "a"), (0, 4, "a")]


NOW = dt.datetime(2024, 1, 1, 4)


def test_expiry(spark):
    log = make(spark, [("a", 0, i) for i in range(6)])
    offsets = lambda df: sorted(r["KFK_OFFSET"] for r in df.collect())
    assert offsets(rt.expire_rows(log, 7200, NOW)) == [3, 4, 5]
    assert offsets(rt.expire_rows(log, 0, NOW)) == [0, 1, 2, 3, 4, 5]
    assert offsets(rt.expire_rows(log, 7200, NOW, F.col("KFK_OFFSET") < 2)) == [2, 3, 4, 5]
    assert offsets(rt.cleanup_block(log, "0", 7200, NOW)) == [1, 2, 3, 4, 5]
    assert offsets(rt.cleanup_block(log, "0", 0, NOW)) == [1, 2, 4, 5]
    aware = NOW.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=5)))
    assert offsets(rt.expire_rows(log, 7200, aware)) == [3, 4, 5]
    assert offsets(rt.expire_rows(log, 7200)) == []


def test_retention_due():
    assert rt.retention_due(0, 86_400, 1_700_000_000_000)
    assert not rt.retention_due(1_000_000, 10, 1_009_999)
    assert rt.retention_due(1_000_000, 10, 1_010_000)
    assert rt.retention_due(1_000_000, 0, 1_000_000)


def test_audit_finds_keys_in_several_partitions(spark):
    log = make(spark, [("a", 0, 0), ("a", 1, 1)]).withColumn("k", F.lit(1)).unionByName(make(spark, [("a", 0, 2)]).withColumn("k", F.lit(2)))
    assert [tuple(r) for r in se.key_partition_audit(log, ["k"]).collect()] == [(1, 2)]
