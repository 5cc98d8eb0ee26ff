"""Streaming jobs: restart, replay, rejects, retries and expiry."""

import datetime as dt
import json
import random
import threading
import time
import uuid

import pytest
from pyspark.errors import StreamingQueryException

import model as m
from changeloom.operators import apply as ap
from changeloom.operators import parse as ps
from changeloom.operators import replay as rp
from changeloom.options import ReplicationOptions
from changeloom.plans.schema import ingest_schema
from changeloom.plans.tables import CatalogTarget
from changeloom.sources import ingest_log as il
from changeloom.sources import landing as ld
from changeloom.sources import offsets as of
from changeloom.sources.changes import CHANGE_RECORD, decode_value, read_changes
from changeloom.streaming import replication as sr

OPTIONS = ReplicationOptions(table="t", retention_delay=3_000_000_000)


def payload(row):
    image = json.dumps({c: row[c] for c in m.COLUMNS})
    return f'{{"before":{image},"after":{image},"op":"{row["KFK_OP"]}","ts_ms":1}}'


class Job:
    def __init__(self, spark, path, mode, **options):
        self.spark, self.root = spark, f"{path}/job"
        self.topic = f"{path}/topic"
        self.options = OPTIONS.with_(mode=mode, **options)
        name = f"t_{uuid.uuid4().hex}"
        self.target = CatalogTarget.create(spark, name, m.TARGET_SCHEMA, tuple(m.KEYS), 3, f"{path}/{name}")
        self.paths = sr.Paths(self.root)

    def deliver(self, rows):
        data = [("t", r["KFK_PARTITION"], r["KFK_OFFSET"], None, r.get("value", payload(r))) for r in rows]
        self.spark.createDataFrame(data, CHANGE_RECORD).coalesce(1).write.mode("append").parquet(self.topic)

    def changes(self):
        return read_changes(self.spark, "parquet", path=self.topic)

    def run(self):
        self.metrics = []
        sr.start_replication(
            self.changes(), self.target, self.options, self.root, available_now=True,
            on_metrics=lambda *report: self.metrics.append(report),
        ).await_termination()

    def ingest(self):
        sr.start_ingest(self.changes(), self.target, self.options, self.root, available_now=True).awaitTermination()

    def apply(self, **more):
        return sr.start_apply(self.target, self.options, self.root, available_now=True, **more)

    def state(self):
        return m.as_rows(self.target.read().collect())

    def log(self):
        return il.read_log(self.spark, self.paths.log, ingest_schema(m.TARGET_SCHEMA))


def parts_of(rows, n=3):
    return [rows[i::n] for i in range(n)]


@pytest.mark.parametrize("mode", ["block", "merge"])
def test_restart_between_batches(spark, tmp_path, mode):
    job = Job(spark, tmp_path, mode)
    rule = m.block if mode == "block" else m.merge
    state = []
    for part in parts_of(m.random_log(7, 90)):
        job.deliver(part)
        job.run()
        state = rule(state, part)
        assert job.state() == m.as_rows(state)
        arrived = [a for _, a, _ in job.metrics if a]
        changed = [c for _, _, c in job.metrics if c]
        assert [a.changes for a in arrived] == [len(part)]
        assert [a.other_ops for a in arrived] == [sum(r["KFK_OP"] == "t" for r in part)]
        assert len(changed) == 1
    job.run()
    assert job.metrics == []
    assert job.state() == m.as_rows(state)
    assert job.log().count() == 90


def test_redelivered_changes_are_dropped(spark, tmp_path):
    job = Job(spark, tmp_path, "block")
    first, second, _ = parts_of(m.random_log(8, 60))
    job.deliver(first + first)
    job.run()
    job.deliver(first + second)
    job.run()
    assert job.state() == m.as_rows(m.block(m.block([], first), second))
    assert job.log().count() == len(first) + len(second)


def test_files_of_a_crashed_attempt_do_not_hide_changes(spark, tmp_path):
    job = Job(spark, tmp_path, "block")
    rows = m.random_log(16, 20)
    block_id = sr.block_id_of(job.paths.checkpoint("block"), 0)
    left_over = spark.createDataFrame(rows[:5], m.LOG_DDL).drop("KFK_BLOCKID")
    left_over.write.parquet(f"{job.paths.log}/KFK_BLOCKID={block_id}")
    (tmp_path / f"job/log/KFK_BLOCKID={block_id}/_SUCCESS").unlink()
    job.deliver(rows)
    job.run()
    assert job.log().count() == 20
    assert job.state() == m.as_rows(m.block([], rows))


@pytest.mark.parametrize("mode", ["block", "merge"])
def test_failure_after_the_target_was_written(spark, tmp_path, mode, monkeypatch):
    """The micro-batch runs again after a restart and must not apply twice; null keys would show it."""
    job = Job(spark, tmp_path, mode)
    rows = m.random_log(9, 60)
    job.deliver(rows)
    expire = sr.expire_blocks

    def crash(*_args):
        raise RuntimeError("lost")

    monkeypatch.setattr(sr, "expire_blocks", crash)
    with pytest.raises(StreamingQueryException):
        if mode == "block":
            job.run()
        else:
            job.ingest()
            job.apply().awaitTermination()
    monkeypatch.setattr(sr, "expire_blocks", expire)
    job.run()
    assert job.state() == m.as_rows((m.block if mode == "block" else m.merge)([], rows))


def test_apply_query_is_retried(spark, tmp_path, monkeypatch):
    job = Job(spark, tmp_path, "merge")
    rows = m.random_log(10, 40)
    job.deliver(rows)
    sr.start_ingest(job.changes(), job.target, job.options, job.root, available_now=True).awaitTermination()
    tick, failures = CatalogTarget.apply_winners, []

    def flaky(*args):
        if not failures:
            raise RuntimeError("busy")
        return tick(*args)

    monkeypatch.setattr(CatalogTarget, "apply_winners", flaky)
    start = lambda: sr.start_apply(job.target, job.options, job.root, True, on_failure=failures.append)
    sr.with_restarts(start, wait_seconds=0, max_restarts=1)
    assert len(failures) == 1
    assert job.state() == m.as_rows(m.merge([], rows))


def test_a_failed_apply_is_restarted_by_the_job(spark, tmp_path, monkeypatch):
    job = Job(spark, tmp_path, "merge", apply_interval=5)
    rows = m.random_log(17, 30)
    job.deliver(rows)
    tick, failures = CatalogTarget.apply_winners, []

    def flaky(*args):
        if not failures:
            raise RuntimeError("busy")
        return tick(*args)

    monkeypatch.setattr(CatalogTarget, "apply_winners", flaky)
    sr.start_replication(
        job.changes(), job.target, job.options, job.root, available_now=True, on_failure=failures.append
    ).await_termination()
    assert len(failures) == 1
    assert job.state() == m.as_rows(m.merge([], rows))


def test_a_failed_ingest_stops_apply(spark, tmp_path):
    job = Job(spark, tmp_path, "merge", flush_seconds=1, apply_interval=5)
    job.deliver([{**m.random_log(1, 1)[0], "value": "{bad"}])
    running = sr.start_replication(job.changes(), job.target, job.options, job.root)
    with pytest.raises(StreamingQueryException, match="malformed"):
        running.await_termination()
    assert not any(query.isActive for query in running.queries)


def test_blocks_are_merged_whole_and_in_the_order_of_ingest(spark, tmp_path):
    """Later blocks hold older offsets: arrival wins, as one merge of all or as a fold of several portions."""
    for limit in (1, 25, 10_000):
        job = Job(spark, tmp_path / str(limit), "merge", merge_batch_size=limit)
        rows = m.random_log(18, 60)
        parts = [rows[40:], rows[20:40], rows[:20]]
        for part in parts:
            job.deliver(part)
            job.ingest()
        job.metrics = []
        job.apply(on_metrics=lambda *report, job=job: job.metrics.append(report)).awaitTermination()
        state = []
        for part in parts if limit < 60 else [rows]:
            state = m.merge(state, part)
        assert len(job.metrics) == 1
        assert job.state() == m.as_rows(state)


def test_half_a_block_is_not_seen(spark, tmp_path):
    job = Job(spark, tmp_path, "merge")
    rows = m.random_log(19, 20)
    job.deliver(rows)
    job.ingest()
    half = spark.createDataFrame([{**r, "KFK_OFFSET": r["KFK_OFFSET"] + 100, "KFK_OP": "c"} for r in rows[:5]], m.LOG_DDL)
    half.drop("KFK_BLOCKID").write.parquet(f"{job.paths.log}/KFK_BLOCKID=half")
    job.apply().awaitTermination()
    assert job.state() == m.as_rows(m.merge([], rows))


def test_bad_record_stops_the_job_or_is_set_aside(spark, tmp_path):
    bad = {**m.random_log(1, 1)[0], "KFK_OFFSET": 999, "value": "{bad"}
    rows = m.random_log(11, 20)
    strict = Job(spark, tmp_path / "a", "block")
    strict.deliver([*rows, bad])
    with pytest.raises(StreamingQueryException, match="malformed"):
        strict.run()
    assert strict.target.read().count() == 0
    lenient = Job(spark, tmp_path / "b", "block", on_error="quarantine", null_keys="quarantine")
    lenient.deliver([*rows, bad])
    lenient.run()
    assert spark.read.parquet(lenient.paths.rejects).select("reject_reason", "offset").collect() == [("malformed", 999)]
    nulls = [r for r in rows if r["k"] is None]
    assert spark.read.parquet(lenient.paths.null_keys).count() == len(nulls)
    assert lenient.state() == m.as_rows(m.block([], [r for r in rows if r["k"] is not None]))


def test_first_record_columns_in_a_stream(spark, tmp_path):
    job = Job(spark, tmp_path, "block", columns="first_record")
    row = m.random_log(1, 1)[0]
    job.deliver([{**row, "KFK_OFFSET": 0, "value": '{"k":1,"k2":"a"}'}, {**row, "KFK_OFFSET": 1, "value": '{"k":2,"k2":"a","v":5}'}])
    job.run()
    assert job.state() == m.as_rows([{"k": 1, "k2": "a", "v": None, "w": None}, {"k": 2, "k2": "a", "v": None, "w": None}])


def test_delay_zero_drops_the_block_at_once(spark, tmp_path):
    job = Job(spark, tmp_path, "block", retention_delay=0)
    rows = m.random_log(12, 20)
    job.deliver(rows)
    job.run()
    assert job.state() == m.as_rows(m.block([], rows))
    assert not list((tmp_path / "job/log").glob("KFK_BLOCKID=*"))


NOW = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_only_applied_blocks_expire(spark, tmp_path):
    job = Job(spark, tmp_path, "merge")
    for part in parts_of(m.random_log(13, 30), 2):
        job.deliver(part)
        sr.start_ingest(job.changes(), job.target, job.options, job.root, available_now=True).awaitTermination()
    options = job.options.with_(retention_delay=60, retention_interval=100)
    assert sr.expire_blocks(spark, job.target, options, job.paths, NOW) == 0
    sr.start_apply(job.target, job.options, job.root, available_now=True).awaitTermination()
    # The clock was stored by the call above; the stored time is in the future of the apply query's own check.
    later = dt.datetime.now(dt.timezone.utc)
    assert sr.expire_blocks(spark, job.target, options, job.paths, later) == 0
    assert sr.expire_blocks(spark, job.target, options, job.paths, later + dt.timedelta(seconds=101)) == 2


def test_by_age_only_when_asked(spark, tmp_path):
    job = Job(spark, tmp_path, "merge", only_applied=False)
    job.deliver(m.random_log(14, 10))
    sr.start_ingest(job.changes(), job.target, job.options, job.root, available_now=True).awaitTermination()
    options = job.options.with_(retention_delay=60)
    assert sr.expire_blocks(spark, job.target, options, job.paths, NOW) == 1
    assert sr.expire_blocks(spark, job.target, options, job.paths, NOW) == 0


@pytest.mark.parametrize("mode", ["block", "merge"])
def test_continuous_job_drains_on_stop(spark, tmp_path, mode):
    job = Job(spark, tmp_path, mode, flush_seconds=1, apply_interval=5)
    rows = m.random_log(15, 30)
    job.deliver(rows)
    running = sr.start_replication(job.changes(), job.target, job.options, job.root)
    assert running.stop(drain=True, timeout=300)
    assert job.state() == m.as_rows((m.block if mode == "block" else m.merge)([], rows))
    assert not any(query.isActive for query in running.queries)


def test_offsets_that_the_log_has_had_are_known_without_it(spark, tmp_path):
    job = Job(spark, tmp_path, "block", retention_delay=0)
    first, second, third = parts_of(m.random_log(20, 60))
    job.deliver(first)
    job.run()
    assert not list((tmp_path / "job/log").glob("KFK_BLOCKID=*"))
    job.deliver(first + second)
    job.run()
    job.deliver(third)
    job.run()
    state = m.block(m.block(m.block([], first), second), third)
    assert job.state() == m.as_rows(state)
    assert len(list((tmp_path / "job/offsets").glob("batch=*"))) <= 3


def test_a_batch_without_overlap_is_not_compared_row_by_row(spark, tmp_path):
    rows = spark.createDataFrame([("t", 0, k) for k in range(100, 200)], "KFK_TOPIC string, KFK_PARTITION int, KFK_OFFSET long")
    known = spark.createDataFrame([("t", 0, 0, 99), ("t", 1, 100, 150), ("u", 0, 100, 150)], of.INTERVALS)
    assert of.without_known(rows, known) is rows
    assert of.without_known(rows, spark.createDataFrame([("t", 0, 0, 100)], of.INTERVALS)).count() == 99


@pytest.mark.parametrize("seed", range(3))
def test_intervals_hold_exactly_the_offsets_written(spark, seed):
    rnd = random.Random(seed)
    far = [rnd.randrange(10**14) for _ in range(20)]
    spans = [range(a, a + rnd.randint(1, 90_000)) for a in (0, 65_530, 200_000)]
    had = {("t", p, o) for p in (0, 1) for span in spans for o in rnd.sample(span, k=len(span) // (50 if p else 1))} | {("t", 2, o) for o in far}
    ddl = "KFK_TOPIC string, KFK_PARTITION int, KFK_OFFSET long"
    known = of.offset_intervals(spark.createDataFrame(sorted(had), ddl))
    runs = known.collect()
    assert sum(r["hi"] - r["lo"] + 1 for r in runs) == len(had)
    assert all((r["KFK_TOPIC"], r["KFK_PARTITION"], r["hi"] + 1) not in had for r in runs)
    new = sorted({(t, p, o + d) for t, p, o in rnd.sample(sorted(had), 500) for d in (-1, 0, 1)} | {("u", 0, 5), ("t", 2, 10**15)})
    left = of.without_known(spark.createDataFrame(new, ddl), known).collect()
    assert {tuple(r) for r in left} == {k for k in new if k not in had}
    both = of.merge_intervals(known.unionByName(of.offset_intervals(spark.createDataFrame(new, ddl))))
    assert sum(r["hi"] - r["lo"] + 1 for r in both.collect()) == len(had | set(new))


@pytest.mark.parametrize("mode", ["block", "merge"])
def test_a_micro_batch_is_cut_into_blocks_within_the_limits(spark, tmp_path, mode):
    job = Job(spark, tmp_path, mode, cut_blocks=True, max_records=7, max_bytes=700, merge_batch_size=1)
    rows = m.random_log(21, 80)
    rows[5]["w"] = "long" * 300
    job.deliver(rows)
    job.run()
    size = il.log_row_bytes(ingest_schema(m.TARGET_SCHEMA))
    blocks = job.log().withColumn("size", size).groupBy("KFK_BLOCKID").agg({"size": "sum", "KFK_OFFSET": "count"}).collect()
    assert len(blocks) > 10 and all(b["count(KFK_OFFSET)"] <= 7 for b in blocks)
    assert [b["count(KFK_OFFSET)"] for b in blocks if b["sum(size)"] > 700] == [1]
    # blocks of a source partition are applied one after the other, in the order of their offsets
    held = sorted(((r["KFK_PARTITION"], r["KFK_OFFSET"], r["KFK_BLOCKID"]) for r in job.log().collect()))
    by_offset = {(r["KFK_PARTITION"], r["KFK_OFFSET"]): r for r in rows}
    state = []
    for name in dict.fromkeys(b for _, _, b in held):
        part = [by_offset[p, o] for p, o, b in held if b == name]
        state = (m.block if mode == "block" else m.merge)(state, part)
    assert job.state() == m.as_rows(state)


@pytest.mark.parametrize("mode", ["block", "merge"])
def test_changes_before_a_bad_record_stay_and_come_once(spark, tmp_path, mode):
    job = Job(spark, tmp_path, mode, on_error="prefix")
    rows = sorted(m.random_log(22, 40), key=m.order)
    at = [r for r in rows if r["KFK_PARTITION"] == rows[-1]["KFK_PARTITION"]][2]
    bad = {**at, "value": "{bad"}
    job.deliver([r for r in rows if r is not at] + [bad])
    kept = [r for r in rows if r["KFK_PARTITION"] != at["KFK_PARTITION"] or r["KFK_OFFSET"] < at["KFK_OFFSET"]]
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="malformed"):
            job.run()
        if mode == "merge":
            job.apply().awaitTermination()
        assert job.log().count() == len(kept)
        assert job.state() == m.as_rows((m.block if mode == "block" else m.merge)([], kept))


def test_several_portions_are_one_write_of_the_target(spark, tmp_path):
    job = Job(spark, tmp_path, "merge", merge_batch_size=1, drop_merged=True)
    parts, state = parts_of(m.random_log(23, 80), 4), []
    for part in parts:
        job.deliver(part)
        job.ingest()
        state = m.merge(state, part)
    writes = []
    job.apply(on_metrics=lambda *report: writes.append(report)).awaitTermination()
    assert len(writes) == 1
    assert job.state() == m.as_rows(state)
    assert not list((tmp_path / "job/log").glob("KFK_BLOCKID=*"))


@pytest.mark.parametrize("missing", ["drop", "insert"])
@pytest.mark.parametrize("seed", range(3))
def test_folded_portions_equal_merges_in_turn(spark, seed, missing):
    log = m.random_log(seed + 30, 120)
    start = m.random_target(seed)
    numbered = [{**r, "n": i % 5} for i, r in enumerate(log)]
    state = start
    for n in range(5):
        state = m.merge(state, [r for r in numbered if r["n"] == n], missing)
    rows = spark.createDataFrame(numbered, m.LOG_DDL + ", n int")
    winners = rp.fold_winners(rows, m.KEYS, m.COLUMNS, rows["n"], missing)
    target = spark.createDataFrame(start, m.TARGET_SCHEMA)
    got = ap.applied(ap.classify_merge(target, winners, m.KEYS, missing, winners=winners))
    assert m.as_rows(got.collect()) == m.as_rows(state)


def test_a_block_that_is_partly_old_keeps_its_young_rows(spark, tmp_path):
    job = Job(spark, tmp_path, "block")
    rows = m.random_log(24, 30)
    for i, r in enumerate(rows):
        r["value"] = payload(r).replace('"ts_ms":1}', f'"ts_ms":{i * 1000}}}')
    job.deliver(rows)
    job.run()
    options = job.options.with_(retention_delay=60)
    at = dt.datetime.fromtimestamp(60 + 9, dt.timezone.utc)
    # the job itself has noted an expiry at the current time
    options = options.with_(retention_interval=0)
    assert sr.expire_blocks(spark, job.target, options, job.paths, at) == 1
    assert job.log().count() == 20
    assert sr.expire_blocks(spark, job.target, options, job.paths, at) == 0
    assert sr.expire_blocks(spark, job.target, options, job.paths, at + dt.timedelta(seconds=100)) == 1
    assert job.log().count() == 0


def test_columns_that_come_while_the_job_runs(spark, tmp_path):
    job = Job(spark, tmp_path, "merge", apply_interval=5, flush_seconds=1)
    row = m.random_log(1, 1)[0]
    job.deliver([{**row, "KFK_OFFSET": 0, "value": '{"k":1,"k2":"a","v":5,"extra":"x"}'}])
    options = job.options.with_(table=job.target.table)
    running = sr.start_replication(job.changes(), None, options, job.root)
    running.drain()
    spark.sql(f"ALTER TABLE {job.target.table} ADD COLUMNS (extra STRING)")
    job.deliver([{**row, "KFK_OFFSET": 1, "value": '{"k":2,"k2":"a","v":6,"extra":"y"}'}])
    assert running.stop(drain=True, timeout=300)
    found = sr.open_target(spark, options).read().orderBy("k").collect()
    assert [(r["k"], r["v"], r["extra"]) for r in found] == [(1, 5, None), (2, 6, "y")]


def test_a_failed_apply_is_started_again_while_nobody_waits(spark, tmp_path, monkeypatch):
    job = Job(spark, tmp_path, "merge", flush_seconds=1, apply_interval=5)
    rows = m.random_log(25, 20)
    job.deliver(rows)
    tick, failures = CatalogTarget.apply_winners, []

    def flaky(*args):
        if not failures:
            raise RuntimeError("busy")
        return tick(*args)

    monkeypatch.setattr(CatalogTarget, "apply_winners", flaky)
    running = sr.start_replication(job.changes(), job.target, job.options, job.root, on_failure=failures.append)
    end = time.monotonic() + 90
    while time.monotonic() < end and not job.state():
        time.sleep(1)
    assert len(failures) == 1 and job.state() == m.as_rows(m.merge([], rows))
    assert sum(running.watcher.rows.values()) > 0
    running.stop(drain=False)


def test_a_drain_ends_at_its_deadline(spark, tmp_path, monkeypatch):
    job = Job(spark, tmp_path, "merge", flush_seconds=1, apply_interval=5)
    rows = m.random_log(26, 20)
    job.deliver(rows)
    tick = CatalogTarget.apply_winners
    release = threading.Event()

    def slow(*args):
        release.wait(120)
        return tick(*args)

    monkeypatch.setattr(CatalogTarget, "apply_winners", slow)
    running = sr.start_replication(job.changes(), job.target, job.options, job.root)
    begin = time.monotonic()
    assert running.drain(timeout=8) is False and time.monotonic() - begin < 20
    release.set()
    assert running.stop(drain=True, timeout=120) is True
    assert job.state() == m.as_rows(m.merge([], rows))


def test_landed_files_go_after_their_batch_and_none_is_lost(spark, tmp_path):
    schema = ingest_schema(m.TARGET_SCHEMA)
    rows = m.random_log(27, 30)
    start = lambda log: ld.start_copy_into(spark, f"{tmp_path}/landing/*", log, schema, f"{tmp_path}/cp", max_files=1, available_now=True)
    for i, part in enumerate(parts_of(rows)):
        data = [("t", r["KFK_PARTITION"], r["KFK_OFFSET"], None, payload(r)) for r in part]
        parsed, _ = ps.apply_error_policy(ps.parse_changes(spark.createDataFrame(data, CHANGE_RECORD).coalesce(1)))
        ld.land_json_lines(parsed, f"{tmp_path}/landing/part-{i}", f"part-{i}")
    # a run that fails while it writes: the log's place is taken by a file
    (tmp_path / "taken").write_text("x")
    with pytest.raises(Exception):
        start(f"{tmp_path}/taken").awaitTermination()
    left = list((tmp_path / "landing").glob("*/*.gz"))
    assert len(left) == 3
    for _ in range(2):
        start(f"{tmp_path}/log").awaitTermination()
    found = il.read_log(spark, f"{tmp_path}/log", schema)
    assert sorted((r["KFK_PARTITION"], r["KFK_OFFSET"], r["KFK_BLOCKID"]) for r in found.collect()) == sorted(
        (r["KFK_PARTITION"], r["KFK_OFFSET"], f"part-{i}") for i, part in enumerate(parts_of(rows)) for r in part
    )
    assert len(list((tmp_path / "landing").glob("*/*.gz"))) < 3


def test_a_source_is_read_at_the_rate_of_the_options(spark, tmp_path):
    job = Job(spark, tmp_path, "block")
    assert sr.observed_row_bytes(spark, job.root) is None
    rows = m.random_log(28, 40)
    for part in parts_of(rows, 4):
        job.deliver(part)
    limited = job.options.with_(max_bytes=1)
    changes = sr.open_changes(spark, "parquet", limited, job.root, path=job.topic)
    sr.start_replication(changes, job.target, limited, job.root, available_now=True).await_termination()
    # a file a micro-batch, the least that a source of files gives
    assert len(list((tmp_path / "job/commits").glob("*.json"))) == 4
    assert job.log().count() == 40
    seen = sr.observed_row_bytes(spark, job.root)
    assert 100 < seen < 130 and limited.with_(max_bytes=seen * 7).source_options("kafka", seen)["maxOffsetsPerTrigger"] == "7"


def test_block_ids_repeat_after_restart():
    assert sr.block_id_of("cp", 3) == sr.block_id_of("cp", 3)
    assert sr.block_id_of("cp", 3) != sr.block_id_of("cp", 4)
    assert len(sr.block_id_of("cp", 3)) <= 40


def test_connector_sources_need_their_packages(spark):
    for call in (
        lambda: read_changes(spark, "kafka", {"kafka.bootstrap.servers": "x:1", "subscribe": "t"}),
        lambda: read_changes(spark, "kafka", {"kafka.bootstrap.servers": "x:1", "subscribe": "t"}, streaming=False),
    ):
        try:
            call()
        except Exception as error:
            assert "kafka" in str(error).lower()
            continue
        pytest.skip("the Kafka package is installed; needs a broker")


def test_binary_values_become_text(spark):
    df = spark.createDataFrame([(bytearray(b"{}"),)], "value binary")
    assert decode_value(df).first()["value"] == "{}"


def test_a_micro_batch_that_few_tasks_hold_is_spread_before_it_is_parsed(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from changeloom.options import ReplicationOptions
    from changeloom.sources.changes import spread_rows
    from changeloom.streaming import replication

    class Parsed(Exception):
        pass

    def parse(batch, **options):
        raise Parsed(batch)

    monkeypatch.setattr(replication, "parse_changes", parse)
    target = SimpleNamespace(schema=spark.range(1).schema, pks=("id",))
    batch = spark.range(0, 16_000, 1, 16).where("id < 900 or id = 9000")  # two of sixteen tasks hold rows
    with pytest.raises(Parsed) as found:
        replication.ingest_batch(batch, "b", 0, target, ReplicationOptions(table="t"), replication.Paths(str(tmp_path)), land=True)
    spread = found.value.args[0]
    held = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 901 and max(held) * spark.sparkContext.defaultParallelism <= 2 * sum(held)
    assert sorted(r.id for r in spread.collect()) == [*range(900), 9000]
    even = spark.range(0, 16_000, 1, 16)
    assert spread_rows(even) is even and spread_rows(even.limit(0)).count() == 0
