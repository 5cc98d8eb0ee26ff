"""Merge mode, block mode and replays against the sequential model."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import model as m
from changeloom.operators import apply as ap
from changeloom.operators import replay as rp

SEEDS = [1, 2, 3]


def frames(spark, seed):
    log, target = m.random_log(seed), m.random_target(seed)
    return log, target, spark.createDataFrame(log, m.LOG_DDL), spark.createDataFrame(target, m.TARGET_SCHEMA)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("missing", ["drop", "insert"])
def test_merge(spark, seed, small, missing):
    log, target, log_df, target_df = frames(spark, seed)
    got = ap.merge_changes(target_df, log_df, m.KEYS, missing, small).collect()
    assert m.as_rows(got) == m.as_rows(m.merge(target, log, missing))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("small", [False, True])
def test_block(spark, seed, small):
    log, target, log_df, target_df = frames(spark, seed)
    want = m.as_rows(m.block(target, log))
    assert m.as_rows(ap.apply_block(target_df, log_df, m.KEYS, small).collect()) == want
    step = ap.insert_block(target_df, log_df)
    step = ap.delete_block(ap.update_block(step, log_df, m.KEYS, small), log_df, m.KEYS, small)
    assert m.as_rows(step.collect()) == want


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("missing", ["drop", "insert"])
@pytest.mark.parametrize("with_initial", [False, True])
def test_replay_merge_equals_batches(spark, seed, missing, with_initial):
    log, target, log_df, target_df = frames(spark, seed)
    state = target if with_initial else []
    for b in range(4):
        state = m.merge(state, [r for r in log if r["KFK_BLOCKID"] == str(b)], missing)
    initial = target_df if with_initial else None
    got = rp.replay_merge(log_df, m.KEYS, m.COLUMNS, F.col("KFK_BLOCKID").cast("bigint"), initial, missing)
    assert m.as_rows(got.collect()) == m.as_rows(state)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("with_initial", [False, True])
def test_replay_blocks_equals_blocks(spark, seed, with_initial):
    log, target, log_df, target_df = frames(spark, seed)
    state = target if with_initial else []
    for b in range(4):
        state = m.block(state, [r for r in log if r["KFK_BLOCKID"] == str(b)])
    initial = target_df if with_initial else None
    got = rp.replay_blocks(log_df, m.KEYS, m.COLUMNS, F.col("KFK_BLOCKID").cast("bigint"), initial)
    assert m.as_rows(got.collect()) == m.as_rows(state)


@pytest.mark.parametrize("seed", SEEDS)
def test_counts(spark, seed):
    log, target, log_df, target_df = frames(spark, seed)
    win = m.winners(log)
    hit = [any(m.matches(t, w) for t in target) for w in win]
    want = {"inserted": 0, "updated": 0, "deleted": 0, "dropped": 0}
    for w, h in zip(win, hit):
        op = w["KFK_OP"]
        if h and op in "crud":
            want["deleted" if op == "d" else "updated"] += 1
        elif not h and op in "cr":
            want["inserted"] += 1
        else:
            want["dropped"] += 1
    got = {r["action"]: r["n"] for r in ap.merge_counts(target_df, log_df, m.KEYS).collect()}
    assert got == {k: v for k, v in want.items() if v}
    base = target + [r for r in log if r["KFK_OP"] in "cr"]
    row = ap.block_counts(target_df, log_df, m.KEYS).first()
    assert row["inserted"] == len(base) - len(target)
    for name, op in (("updated", "u"), ("deleted", "d")):
        src = [r for r in log if r["KFK_OP"] == op]
        assert row[name] == sum(any(m.matches(t, s) for s in src) for t in base)


def change(k, op, offset, v=None, partition=0, block="0"):
    return {"k": k, "k2": "a", "v": v, "w": None, "KFK_TOPIC": "t", "KFK_PARTITION": partition, "KFK_OFFSET": offset,
            "KFK_OP": op, "KFK_DATETIME": None, "KFK_BLOCKID": block}


def run(spark, rule, target, log):
    target_df = spark.createDataFrame([(k, "a", v, "x") for k, v in target], m.TARGET_SCHEMA)
    out = rule(target_df, spark.createDataFrame(log, m.LOG_DDL), m.KEYS)
    return sorted((r["k"], r["v"], r["w"]) for r in out.collect())


@pytest.mark.parametrize(
    ("rule", "target", "log", "want"),
    [
        # create then update of a new key in one batch: never inserted
        (ap.merge_changes, [], [change(1, "c", 0, 1), change(1, "u", 1, 2)], []),
        # delete then create of an existing key in one batch: updated
        (ap.merge_changes, [(1, 5)], [change(1, "d", 0), change(1, "c", 1, 7)], [(1, 7, None)]),
        # a null value overwrites
        (ap.merge_changes, [(1, 5)], [change(1, "u", 0)], [(1, None, None)]),
        # other operations change nothing but hide earlier ones
        (ap.merge_changes, [(1, 5)], [change(1, "d", 0), change(1, "t", 1, 9)], [(1, 5, "x")]),
        # equal offsets: the higher partition wins
        (ap.merge_changes, [(1, 5)], [change(1, "u", 0, 8, 1), change(1, "u", 0, 9, 0)], [(1, 8, None)]),
        # delete then create in one block: ends deleted
        (ap.apply_block, [(1, 5)], [change(1, "d", 0), change(1, "c", 1, 7)], []),
        # two creates in one block: two rows
        (ap.apply_block, [], [change(1, "c", 0, 1), change(1, "c", 1, 2)], [(1, 1, None), (1, 2, None)]),
        # the latest of several updates wins
        (ap.apply_block, [(1, 5)], [change(1, "u", 1, 8), change(1, "u", 0, 7)], [(1, 8, None)]),
        # an update without a row does nothing
        (ap.apply_block, [], [change(1, "u", 1, 8)], []),
    ],
)
def test_rules(spark, rule, target, log, want):
    assert run(spark, rule, target, log) == want


def test_null_keys_insert_once_per_batch(spark):
    log = [change(None, "c", 0, 1, block="0"), change(None, "c", 1, 2, block="0"), change(None, "r", 2, 3, block="1")]
    out = rp.replay_merge(spark.createDataFrame(log, m.LOG_DDL), m.KEYS, m.COLUMNS, F.col("KFK_BLOCKID").cast("int"))
    assert sorted(r["v"] for r in out.collect()) == [2, 3]


@pytest.mark.parametrize("small", [False, True])
def test_key_only_table(spark, small):
    schema = T.StructType(m.TARGET_SCHEMA.fields[:2])
    target = spark.createDataFrame([(1, "a"), (2, "a")], schema)
    log = spark.createDataFrame([change(1, "u", 0), change(2, "d", 1), change(3, "c", 2)], m.LOG_DDL)
    assert sorted(r["k"] for r in ap.merge_changes(target, log, m.KEYS, small_batch=small).collect()) == [1, 3]
    assert sorted(r["k"] for r in ap.apply_block(target, log, m.KEYS, small).collect()) == [1, 3]
    assert ap.update_block(target, log, m.KEYS).count() == 2


def test_catalog_merge_needs_row_level_writes(spark):
    spark.sql("drop table if exists merge_into_check")
    spark.createDataFrame([(1, "a", 1, "x")], m.TARGET_SCHEMA).write.saveAsTable("merge_into_check")
    log = spark.createDataFrame([change(1, "u", 0)], m.LOG_DDL)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        ap.merge_into("merge_into_check", log, m.COLUMNS, m.KEYS)
    spark.sql("drop table merge_into_check")
