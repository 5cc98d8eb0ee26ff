"""Catalog target: partitions, replay, pruning; batch ticks over a written log."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import model as m
from changeloom.operators.apply import merge_changes, winners_of
from changeloom.options import ReplicationOptions
from changeloom.plans import pending as pe
from changeloom.plans.schema import ingest_schema
from changeloom.plans.tables import BUCKET, CHANGE_SET, CatalogTarget, RowLevelTarget, change_bytes
from changeloom.sources import ingest_log as il


def table(spark, path, buckets=4):
    name = f"t_{uuid.uuid4().hex}"
    return CatalogTarget.create(spark, name, m.TARGET_SCHEMA, tuple(m.KEYS), buckets, f"{path}/{name}")


def df(spark, rows):
    return spark.createDataFrame(rows, m.TARGET_SCHEMA)


def change(spark, k, v, op="u"):
    return spark.createDataFrame([(k, "a", v, "y", "t", 0, k, op, None, "0")], m.LOG_DDL)


def merged(rows, changes):
    return merge_changes(rows, changes, m.KEYS)


def test_replace_and_read(spark, tmp_path):
    target = table(spark, tmp_path)
    assert target.read().count() == 0
    rows = m.random_target(1)
    target.replace(df(spark, rows), "first")
    assert m.as_rows(target.read().collect()) == m.as_rows(rows)
    assert target.written_by("first") and not target.written_by("second")
    target.replace(df(spark, []), "second")
    assert target.read().count() == 0


def test_only_touched_partitions_are_scanned_and_rewritten(spark, tmp_path):
    target = table(spark, tmp_path, buckets=8)
    rows = [{"k": k, "k2": "a", "v": 0, "w": "x"} for k in range(40)]
    target.replace(df(spark, rows), "first")
    one = change(spark, 3, 9)
    (touched,) = target.touched(one)
    plan = target.read([touched])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert BUCKET in filters and f"= {touched}" in filters
    files = {f for f in spark.table(target.table).inputFiles() if f"{BUCKET}={touched}/" not in f}
    assert target.apply(one, "one", merged) is True
    assert files == {f for f in spark.table(target.table).inputFiles() if f"{BUCKET}={touched}/" not in f}
    assert target.written_by("one") == [touched]
    rows[3].update(v=9, w="y")
    assert m.as_rows(target.read().collect()) == m.as_rows(rows)


def test_a_partition_that_loses_all_its_rows_is_emptied(spark, tmp_path):
    target = table(spark, tmp_path, buckets=16)
    rows = [{"k": k, "k2": "a", "v": 0, "w": "x"} for k in range(6)]
    target.replace(df(spark, rows), "first")
    for k in range(6):
        assert target.apply(change(spark, k, 0, "d"), f"d{k}", merged) is True
        rows.pop(0)
        assert m.as_rows(target.read().collect()) == m.as_rows(rows)


def test_apply_is_done_once(spark, tmp_path):
    target = table(spark, tmp_path)
    rows = df(spark, m.random_target(1, nulls=False))
    assert target.apply(rows, "a", lambda t, c: t.unionByName(c)) is True
    assert target.apply(rows, "a", lambda t, c: t.unionByName(c)) is False
    assert target.read().count() == rows.count()


def test_a_change_set_that_was_cut_off_goes_on_with_the_other_partitions(spark, tmp_path):
    target = table(spark, tmp_path, buckets=8)
    rows = df(spark, [{"k": k, "k2": "a", "v": 0, "w": "x"} for k in range(40)])
    touched = target.touched(rows)
    # as a crash between two partitions leaves it
    half = rows.where(target.bucket_of().isin(touched[:3]))
    target.replace(half, "a", touched[:3])
    assert target.apply(rows, "a", lambda t, c: t.unionByName(c)) is True
    assert m.as_rows(target.read().collect()) == m.as_rows(rows.collect())
    assert target.written_by("a") == touched


def test_a_target_is_opened_from_the_catalog(spark, tmp_path):
    target = table(spark, tmp_path, buckets=5)
    again = CatalogTarget.open(spark, target.table)
    assert (again.schema, again.pks, again.buckets) == (m.TARGET_SCHEMA, tuple(m.KEYS), 5)
    assert CatalogTarget.open(spark, target.table, ("K",)).pks == ("k",)
    with pytest.raises(ValueError, match="not in the table"):
        CatalogTarget.open(spark, target.table, ("nope",))
    plain = f"p_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {plain} (k INT) USING parquet LOCATION '{tmp_path}/{plain}' TBLPROPERTIES ('replication.pk' = 'k')")
    with pytest.raises(ValueError, match=CHANGE_SET):
        CatalogTarget.open(spark, plain)
    # a format without row-level writes takes no MERGE; the route up to there is the same as for one that has them
    rows = RowLevelTarget.open(spark, plain)
    winners = winners_of(change(spark, 1, 1), ["k"], ["k"])
    with pytest.raises(Exception, match="(?i)merge"):
        rows.apply_winners(winners, "a", ReplicationOptions(table=plain))


def test_sizes_are_in_bytes(spark):
    rows = spark.createDataFrame([("é" * 100,)], "a string")
    assert change_bytes(rows) == 16 + 200 + 8


OPTIONS = ReplicationOptions(table="t", mode="merge", merge_batch_size=50)


def pending_setup(spark, tmp_path, seed=5):
    log = m.random_log(seed)
    schema = ingest_schema(m.TARGET_SCHEMA)
    log_path = f"{tmp_path}/log"
    il.append_ingest(spark.createDataFrame(log, m.LOG_DDL), log_path)
    batches = sorted(log, key=lambda r: (r["KFK_PARTITION"], r["KFK_OFFSET"]))
    return log_path, schema, [batches[i : i + 50] for i in range(0, len(batches), 50)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_ticks_equal_sequential_merges(spark, tmp_path, broadcast_bytes):
    log_path, schema, batches = pending_setup(spark, tmp_path)
    target = table(spark, tmp_path)
    options = OPTIONS.with_(broadcast_bytes=broadcast_bytes)
    state, left = [], sum(len(b) for b in batches)
    for batch in batches:
        metrics = pe.apply_pending(spark, log_path, target, options, f"{tmp_path}/work")
        before, state = len(state), m.merge(state, batch)
        assert before + metrics.inserted - metrics.deleted == len(state)
        assert sum((metrics.inserted, metrics.updated, metrics.deleted, metrics.dropped)) <= len(m.winners(batch))
        left -= len(batch)
        assert m.as_rows(target.read().collect()) == m.as_rows(state)
        assert il.read_log(spark, log_path, schema).count() == left if left else True
    assert pe.apply_pending(spark, log_path, target, options, f"{tmp_path}/work") is None


def test_waiting_rows_expire_by_age_only_when_asked(spark, tmp_path):
    log_path, schema = f"{tmp_path}/log", ingest_schema(m.TARGET_SCHEMA)
    now = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    log = [{**r, "KFK_DATETIME": dt.datetime(2024, 1, 1, r["KFK_OFFSET"] % 24)} for r in m.random_log(6, 48)]
    il.append_ingest(spark.createDataFrame(log, m.LOG_DDL), log_path)
    options = OPTIONS.with_(merge_batch_size=1, retention_delay=12 * 3600)
    target, work = table(spark, tmp_path), f"{tmp_path}/work"
    pe.apply_pending(spark, log_path, target, options, work, now)
    assert il.read_log(spark, log_path, schema).count() == 47
    pe.apply_pending(spark, log_path, target, options.with_(only_applied=False), work, now)
    # Two ticks took the first two positions, then the rows of the first twelve hours went.
    waiting = sorted(log, key=lambda r: (r["KFK_PARTITION"], r["KFK_OFFSET"]))[2:]
    left = sum(r["KFK_DATETIME"].hour > 12 for r in waiting)
    assert il.read_log(spark, log_path, schema).count() == left
    pe.apply_pending(spark, log_path, target, options.with_(only_applied=False, retention_delay=1), work, now)
    assert il.read_log(spark, log_path, schema).count() == left - 1


def test_rows_that_come_during_the_trim_stay(spark, tmp_path, monkeypatch):
    log_path, schema, batches = pending_setup(spark, tmp_path)
    target, late = table(spark, tmp_path), []
    listed = pe.remove_batch

    def append_late(log, batch):
        left = listed(log, batch)
        if not late:
            late.extend({**r, "KFK_OFFSET": r["KFK_OFFSET"] + 10_000, "KFK_BLOCKID": "late"} for r in batches[0][:5])
            il.append_ingest(spark.createDataFrame(late, m.LOG_DDL), log_path)
        return left

    monkeypatch.setattr(pe, "remove_batch", append_late)
    pe.apply_pending(spark, log_path, target, OPTIONS, f"{tmp_path}/work")
    found = {(r["KFK_PARTITION"], r["KFK_OFFSET"]) for r in il.read_log(spark, log_path, schema).collect()}
    assert found == {(r["KFK_PARTITION"], r["KFK_OFFSET"]) for r in [*batches[1], *batches[2], *late]}


def test_crash_while_old_blocks_are_deleted(spark, tmp_path, monkeypatch):
    log_path, schema, batches = pending_setup(spark, tmp_path)
    target, calls = table(spark, tmp_path), []
    delete = pe.delete_path

    def once(spark, path):
        if "/log/" in path:
            calls.append(path)
            if len(calls) == 1:
                raise RuntimeError("lost")
        delete(spark, path)

    monkeypatch.setattr(pe, "delete_path", once)
    options = OPTIONS.with_(merge_batch_size=100)
    with pytest.raises(RuntimeError):
        for _ in range(3):
            pe.apply_pending(spark, log_path, target, options, f"{tmp_path}/work")
    monkeypatch.setattr(pe, "delete_path", delete)
    while pe.apply_pending(spark, log_path, target, options, f"{tmp_path}/work"):
        pass
    state = m.merge(m.merge([], batches[0] + batches[1]), batches[2])
    assert m.as_rows(target.read().collect()) == m.as_rows(state)
    assert not list((tmp_path / "log").glob("KFK_BLOCKID=*"))


def test_crash_between_merge_and_trim(spark, tmp_path, monkeypatch):
    log_path, schema, batches = pending_setup(spark, tmp_path)
    target = table(spark, tmp_path)
    trim = pe.rewrite_blocks

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(pe, "rewrite_blocks", crash)
    with pytest.raises(RuntimeError):
        pe.apply_pending(spark, log_path, target, OPTIONS, f"{tmp_path}/work")
    monkeypatch.setattr(pe, "rewrite_blocks", trim)
    pe.apply_pending(spark, log_path, target, OPTIONS, f"{tmp_path}/work")
    state = m.merge(m.merge([], batches[0]), batches[1])
    assert m.as_rows(target.read().collect()) == m.as_rows(state)
    assert il.read_log(spark, log_path, schema).count() == len(batches[2])
