"""Physical plans: what must hold for the operators at any data size."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from changeloom.operators import apply as ap
from changeloom.operators import parse as ps
from changeloom.operators import replay as rp
from changeloom.operators import select as se
from changeloom.plans import queries as q
from changeloom.sources import ingest_log as il

SF_DIR = "/root/testdata/sf0.001"
# Queries whose last step is one row for the whole table; everything else must stay partitioned.
ONE_ROW = {"block_counts", "has_pending"}
JOBS = {"stream_merge", "stream_blocks", "stream_dedup", "apply_pending", "copy_into", "merge_broadcast"}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(q.all_queries()) - JOBS))
def test_no_python_and_no_single_partition(spark, no_auto_broadcast, name):
    text = plan(q.all_queries()[name](spark, SF_DIR))
    assert not re.search(r"Python|ArrowEval|Pandas|CartesianProduct|BroadcastNestedLoop", text)
    if name not in ONE_ROW:
        assert "SinglePartition" not in text


def test_latest_per_key_limits_before_the_shuffle(spark):
    text = plan(se.latest_per_key(q.log_e(spark, SF_DIR), q.E_PK))
    order = [m for m in re.findall(r"\(\d+\) (WindowGroupLimit|Exchange|Window)\b", text)]
    assert order == ["WindowGroupLimit", "Exchange", "WindowGroupLimit", "Window"]


def test_merge_by_broadcast_leaves_the_target_in_place(spark, no_auto_broadcast):
    target = q.target_o(spark, SF_DIR)
    winners = ap.winners_of(q.log_o(spark, SF_DIR), q.O_PK, q.O_COLUMNS)
    text = plan(ap.applied(ap.classify_merge(target, q.log_o(spark, SF_DIR), q.O_PK, small_batch=True, winners=winners)))
    assert "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin LeftOuter") >= 1
    # The lookup of existing keys reads the key column and the filter column only.
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_merge_by_shuffle_moves_each_side_once(spark, no_auto_broadcast):
    text = plan(ap.merge_changes(q.target_o(spark, SF_DIR), q.log_o(spark, SF_DIR), q.O_PK))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert text.count("SortMergeJoin FullOuter") == 1


def test_block_is_one_join(spark, no_auto_broadcast):
    text = plan(ap.apply_block(q.target_o(spark, SF_DIR), q.log_o(spark, SF_DIR), q.O_PK))
    assert text.count("SortMergeJoin LeftOuter") == 1
    # The target, the block's partial summary, and the finished summary: the last is one row per changed key.
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 3


def test_replay_merge_shuffles_twice_whatever_the_number_of_batches(spark, no_auto_broadcast):
    text = plan(rp.replay_merge(q.log_e(spark, SF_DIR), q.E_PK, q.E_COLUMNS, q.block_number()))
    assert "Join" not in text
    # One scan; each shuffle follows a step that leaves one row per group and task.
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1


def test_scan_gets_filters_and_columns(spark, tmp_path):
    il.append_ingest(q.log_e(spark, SF_DIR), f"{tmp_path}/log")
    log = il.read_log(spark, f"{tmp_path}/log", q.ingest_schema(q.E_SCHEMA))
    text = plan(se.block_inserts(log, "1").select("user_id"))
    assert "PartitionFilters: [isnotnull(KFK_BLOCKID" in text
    assert "PushedFilters: [In(KFK_OP, [c,r])]" in text
    assert "ReadSchema: struct<user_id:bigint,KFK_OP:string>" in text
    bound = se.BatchBound(1, 50, "cdc.events")
    assert "PushedFilters: [Or(LessThan(KFK_PARTITION,1)" in plan(log.where(bound.inside()))


def test_filters_on_parsed_columns_do_not_repeat_the_parse(spark):
    parsed = ps.parse_changes(q.records_o(spark, SF_DIR), now_ms=1).where((F.col("op") == "u") & F.col("reject_reason").isNull())
    text = plan(parsed.select("op", "offset"))
    assert text.count("parseJson") == 1
    assert plan(ps.parse_changes(q.records_o(spark, SF_DIR), now_ms=1).where("partition = 3")).count("parseJson") == 1


def test_skewed_key_is_split_by_the_adaptive_join(spark, no_auto_broadcast):
    """A key that holds a third of the created rows is spread over several tasks of the block replay's join."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        log = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_id"),
            F.col("id").cast("double").alias("value"),
            F.lit("x").alias("props"),
            F.lit("t").alias("KFK_TOPIC"),
            F.lit(0).alias("KFK_PARTITION"),
            F.col("id").alias("KFK_OFFSET"),
            F.when(F.col("id") == 59_999, "u").otherwise("c").alias("KFK_OP"),
        )
        out = rp.replay_blocks(log, q.E_PK, q.E_COLUMNS, F.expr("KFK_OFFSET div 1000"))
        assert out.where("user_id = 7").count() == 20_001
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_null_keys_of_a_merge_pass_by_the_join(spark):
    """Target rows without a key stay and are not shuffled; winners without one are inserted and meet nothing."""
    from pyspark.sql import functions as F

    from changeloom.operators.apply import classify_merge
    from changeloom.plans.schema import OP

    target = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    winners = spark.createDataFrame([(2, 20, "u"), (None, 7, "c"), (None, 8, "d"), (9001, 9, "c")], f"k long, v long, {OP} string")
    classified = classify_merge(target, winners, ["k"], winners=winners)
    rows = classified.groupBy("_action").count().collect()
    assert {r[0]: r[1] for r in rows} == {"kept": 3999, "updated": 1, "inserted": 2, "dropped": 1}
    assert classified.where("k is null").count() == 2002
