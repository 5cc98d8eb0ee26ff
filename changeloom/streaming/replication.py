"""Replication as Structured Streaming queries, in block mode or in merge mode.

Block mode: one query; each micro-batch is landed, loaded, applied and cleaned before its offsets commit.
Merge mode: an ingest query appends typed changes to the log and an apply query merges them into the target.

Both are at-least-once deliveries made exact: block ids depend only on the checkpoint and the batch number, a
complete block is never written twice, and a change set that is already in the target is skipped. Offsets the log has had
are kept as intervals, so that ingest never reads the log. There is no watermark: a change that arrives in a later batch
overwrites, whatever its offset.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from changeloom.operators.apply import ApplyMetrics, observed, winners_of
from changeloom.operators.parse import apply_error_policy, before_first_reject, parse_changes
from changeloom.operators.replay import fold_winners
from changeloom.operators.retention import expire_rows, last_expiry, note_expiry, retention_due
from changeloom.operators.select import APPLIED_OPS
from changeloom.options import ReplicationOptions
from changeloom.plans.schema import BLOCK, DATETIME, LOG_KEY, OFFSET, PARTITION, TOPIC, ingest_schema
from changeloom.plans.tables import CatalogTarget, RowLevelTarget
from changeloom.session import child_names, delete_path, make_folder, matching, path_exists, write_line
from changeloom.sources.changes import read_changes, spread_rows
from changeloom.sources.ingest_log import (
    cut_blocks,
    dedup_ingest,
    first_record_keys,
    log_row_bytes,
    read_blocks,
    read_written,
    to_ingest,
    write_blocks,
)
from changeloom.sources.landing import land_json_lines, read_landed
from changeloom.sources.offsets import known_offsets, note_offsets, without_known

Target = CatalogTarget | RowLevelTarget

# Announcements one tick of the apply query takes; the others wait for the next.
ANNOUNCED = 1000
APPLIED = f"{BLOCK} string, n long, apply string"
NOTE = "block string, seq long, part int, n long, bytes long, lo long, hi long"


def block_id_of(checkpoint: str, batch_id: int) -> str:
    """Block id of a micro-batch: the same after a restart from the same checkpoint."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}#{batch_id}"))


@dataclass(frozen=True)
class IngestMetrics:
    """What one micro-batch brought: usable changes, those without a row image, and operations never applied."""

    changes: int = 0
    missing_images: int = 0
    other_ops: int = 0


MetricsListener = Callable[[str, IngestMetrics | None, ApplyMetrics | None], None]
Clock = Callable[[], dt.datetime]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _report(listener: MetricsListener | None, name: str, arrived, changed) -> None:
    if listener is not None:
        listener(name, arrived, changed)


# How long a stopping job waits for what has arrived.
DRAIN_SECONDS = 30.0


def _all_available(query: StreamingQuery, failures: list[Exception]) -> None:
    try:
        query.processAllAvailable()
    except Exception as error:
        failures.append(error)


class Watcher(StreamingQueryListener):
    """Keeps a running job to its rules of failure, whoever waits for it.

    An apply query that fails is started again after the interval; when ingest fails, apply is stopped. Rows read per
    query are added up as the queries report them.
    """

    def __init__(self, spark: SparkSession, job: Replication):
        self.spark, self.job, self.rows = spark, job, {}
        self.ids = [str(query.id) for query in job.queries]
        self.closed = False

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        name = str(event.progress.id)
        if name in self.ids:
            self.rows[name] = self.rows.get(name, 0) + (event.progress.numInputRows or 0)

    def onQueryTerminated(self, event) -> None:
        if self.closed or event.exception is None or str(event.id) not in self.ids:
            return
        if self.ids.index(str(event.id)) == 0:
            for query in self.job.queries[1:]:
                threading.Thread(target=query.stop, daemon=True).start()
        elif self.job.restart_apply is not None:
            timer = threading.Timer(self.job.wait_seconds, self._restart)
            timer.daemon = True
            timer.start()

    def _restart(self) -> None:
        # the id of a query is that of its checkpoint, so that the new one goes by the same
        if not self.closed and self.job.queries[0].isActive and not self.job.queries[1].isActive:
            self.job.queries[1] = self.job.restart_apply()


@dataclass
class Replication:
    """The running queries of one replication job; in merge mode ingest first, then apply."""

    queries: list[StreamingQuery] = field(default_factory=list)
    restart_apply: Callable[[], StreamingQuery] | None = None
    wait_seconds: float = 0
    #: Removes old rows of the log when it is time to; a job without new changes has no micro-batch that does it.
    expire: Callable[[], int] | None = None
    expire_seconds: float = 0
    watcher: Watcher | None = None

    def watched(self, spark: SparkSession) -> Replication:
        """The job with a listener that restarts apply and stops after a failed ingest, also while nobody waits."""
        self.watcher = Watcher(spark, self)
        spark.streams.addListener(self.watcher)
        return self

    def drain(self, timeout: float | None = None) -> bool:
        """Wait until everything that has arrived is applied, ingest first, then apply; false when time is up before."""
        end = None if timeout is None else time.monotonic() + timeout
        for query in self.queries:
            if end is None:
                query.processAllAvailable()
                continue
            failures: list[Exception] = []
            waiter = threading.Thread(target=_all_available, args=(query, failures), daemon=True)
            waiter.start()
            waiter.join(max(0.0, end - time.monotonic()))
            if waiter.is_alive():
                return False
            if failures:
                raise failures[0]
        return True

    def stop(self, drain: bool = True, timeout: float | None = DRAIN_SECONDS) -> bool:
        """Stop the queries, after a drain that takes at most ``timeout`` seconds; tells whether all was applied.

        What a drain that was cut off has not applied stays in the log or at the source, and the next start goes on with it.
        """
        drained = self.drain(timeout) if drain else False
        if self.watcher is not None:
            self.watcher.close()
        for query in self.queries:
            query.stop()
        return drained

    def await_termination(self, poll_seconds: float = 1) -> None:
        """Wait for triggers that end by themselves, and keep the job to its rules of failure and retention meanwhile.

        A failed apply query is started again after the interval and takes the failed batch again; a failure of any
        other query stops the whole job and is raised.
        """
        due = time.monotonic() + self.expire_seconds
        while any(query.isActive for query in self.queries) or any(query.exception() for query in self.queries):
            for i, query in enumerate(self.queries):
                try:
                    query.awaitTermination(poll_seconds)
                except StreamingQueryException:
                    if i and self.watcher is not None and self.queries[0].isActive:
                        continue  # the watcher starts it again
                    if i == 0 or self.restart_apply is None:
                        self.stop(drain=False)
                        raise
                    # ingest is watched while apply waits
                    self.queries[0].awaitTermination(self.wait_seconds)
                    self.queries[i] = self.restart_apply()
            if self.expire is not None and time.monotonic() >= due:
                self.expire()
                due = time.monotonic() + max(poll_seconds, self.expire_seconds)
        if self.expire is not None:
            self.expire()


@dataclass(frozen=True)
class Paths:
    """Folders of one job below a shared root."""

    root: str

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def commits(self) -> str:
        return f"{self.root}/commits"

    @property
    def offsets(self) -> str:
        return f"{self.root}/offsets"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def null_keys(self) -> str:
        return f"{self.root}/rejects-null-keys"

    @property
    def applied(self) -> str:
        return f"{self.root}/applied"

    @property
    def retention(self) -> str:
        return f"{self.root}/retention"

    @property
    def target(self) -> str:
        return f"{self.root}/target"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoint-{name}"


def _without_null_keys(rows: DataFrame, options: ReplicationOptions, paths: Paths, pks, block_id: str) -> DataFrame:
    if options.null_keys != "quarantine":
        return rows
    null_key = reduce(lambda a, b: a | b, [F.col(pk).isNull() for pk in pks])
    rows.where(null_key).drop(BLOCK).write.mode("overwrite").parquet(f"{paths.null_keys}/{BLOCK}={block_id}")
    return rows.where(~null_key)


class RejectedRecord(ValueError):
    """A bad record; the changes before it are in the log, announced under ``name``."""

    def __init__(self, row, name: str):
        super().__init__(f"bad change record: {row['reject_reason']} topic={row['topic']} partition={row['partition']} offset={row['offset']}")
        self.name = name


# Versions of the known offsets that one micro-batch may leave: one for each attempt that a bad record ends, and the last.
_ATTEMPTS = 10_000


def ingest_batch(
    batch: DataFrame,
    block_id: str,
    seq: int,
    target: Target,
    options: ReplicationOptions,
    paths: Paths,
    logical: dict[str, str] | None = None,
    land: bool = False,
) -> IngestMetrics | None:
    """Parse micro-batch number ``seq``, write its new changes to the log, and announce the blocks.

    The micro-batch is one block, or with ``cut_blocks`` several, each within the limits of records and bytes. With
    ``on_error="prefix"`` the changes before the first bad one of each source partition are written and announced before
    the bad one is raised; their offsets are known then, so that the next attempt goes on behind them. Null when the
    micro-batch is announced already.
    """
    spark = batch.sparkSession
    schema = ingest_schema(target.schema)
    last = (seq + 1) * _ATTEMPTS - 1
    if path_exists(spark, f"{paths.commits}/{block_id}.json"):
        if not path_exists(spark, f"{paths.offsets}/batch={last}/_SUCCESS"):
            note_offsets(spark, paths.offsets, last, read_written(spark, paths.log, schema, block_id).select(*LOG_KEY))
        return None
    attempt = _finish_attempts(spark, paths, schema, block_id, seq) if options.on_error == "prefix" else 0
    # Landing files carry every key, and the first record names its columns: both need the map of all fields.
    typed = not land and options.columns == "target"
    parsed = parse_changes(spread_rows(batch), logical=logical, timestamp_precision=options.timestamp_precision, typed=typed)
    # Several passes over the same parse: keep it for the length of this micro-batch.
    several = options.on_error != "fail" or options.columns == "first_record" or options.null_keys == "quarantine"
    if several:
        parsed = parsed.persist()
    first_bad, name = None, block_id
    try:
        if options.on_error == "prefix":
            good, bad = before_first_reject(parsed, options.tombstones)
            first_bad = bad.orderBy("partition", "offset", "topic").first()
        else:
            good, bad = apply_error_policy(parsed, options.on_error, options.tombstones)
        if first_bad is not None:
            name = f"{block_id}-before{attempt}"
        elif options.on_error == "quarantine":
            bad.write.mode("overwrite").parquet(f"{paths.rejects}/{BLOCK}={block_id}")
        counts = Observation()
        columns = first_record_keys(good) if options.columns == "first_record" else "target"
        good = good.observe(
            counts,
            F.count("*").alias("changes"),
            F.count_if("missing_image").alias("missing_images"),
            F.count_if(~F.col("op").isin(*APPLIED_OPS)).alias("other_ops"),
        )
        load = {"columns": columns, "number_scale": options.number_scale, "empty_as_null": options.empty_as_null}
        folder = f"{paths.landing}/{name}"
        if land:
            land_json_lines(good, folder, name)
            rows = read_landed(spark, folder, schema, **load)
        else:
            rows = to_ingest(good, schema, name, **load)
        rows = _without_null_keys(rows, options, paths, target.pks, name)
        number = last if first_bad is None else seq * _ATTEMPTS + attempt
        known = known_offsets(spark, paths.offsets, number)
        if known is not None:
            # the position columns of the source show whether any interval is met, without parsing
            arrived = [F.col(c).alias(k) for c, k in (("topic", TOPIC), ("partition", PARTITION), ("offset", OFFSET))]
            rows = without_known(rows, known, batch.select(*arrived))
        _write(dedup_ingest(rows), name, schema, options, paths)
        written = read_written(spark, paths.log, schema, name)
        announce(spark, paths, name, seq, written)
        note_offsets(spark, paths.offsets, number, written.select(*LOG_KEY))
        if land:
            delete_path(spark, folder)
        if first_bad is not None:
            raise RejectedRecord(first_bad, name)
        return IngestMetrics(**observed(counts))
    finally:
        if several:
            parsed.unpersist()


def _finish_attempts(spark: SparkSession, paths: Paths, schema, block_id: str, seq: int) -> int:
    """How many attempts at a micro-batch a bad record has ended; what the last of them announced is known from here on."""
    done = len(matching(spark, f"{paths.commits}/{block_id}-before*.json"))
    number = seq * _ATTEMPTS + done - 1
    if done and not path_exists(spark, f"{paths.offsets}/batch={number}/_SUCCESS"):
        written = read_written(spark, paths.log, schema, f"{block_id}-before{done - 1}")
        note_offsets(spark, paths.offsets, number, written.select(*LOG_KEY))
    return done


def _write(rows: DataFrame, name: str, schema, options: ReplicationOptions, paths: Paths) -> None:
    """Write the changes of a micro-batch as one block, or cut into blocks within the limits."""
    if not options.cut_blocks:
        write_blocks(rows.withColumn(BLOCK, F.lit(name)), paths.log, name)
        return
    # cutting reads the rows several times: they are parsed and written once before
    folder = f"{paths.root}/uncut/{name}"
    rows.write.mode("overwrite").parquet(folder)
    whole = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    cut = cut_blocks(whole, log_row_bytes(schema), options.max_records, options.max_bytes)
    write_blocks(cut.withColumn(BLOCK, F.concat_ws("-", F.lit(name), "_cut")).drop("_cut"), paths.log, name)
    delete_path(rows.sparkSession, folder)


def announce(spark: SparkSession, paths: Paths, name: str, seq: int, written: DataFrame) -> None:
    """Announce the complete blocks of a micro-batch: id, place in the job, rows, bytes, and the range of their change times.

    Blocks of one source partition stand in the order of their offsets.
    Written after the blocks, in one piece and under the micro-batch's name, so that each block is announced whole and once.
    """
    millis = F.unix_millis(F.col(DATETIME).cast("timestamp"))
    first = F.min(F.struct(PARTITION, OFFSET)).alias("first")
    size = F.sum(log_row_bytes(written.schema)).alias("bytes")
    found = written.groupBy(BLOCK).agg(F.count("*").alias("n"), size, F.min(millis).alias("lo"), F.max(millis).alias("hi"), first).collect()
    order = sorted(found, key=lambda r: r["first"])
    lines = [{"block": r[BLOCK], "seq": seq, "part": i, "n": r["n"], "bytes": r["bytes"], "lo": r["lo"], "hi": r["hi"]} for i, r in enumerate(order)]
    lines = lines or [{"block": name, "seq": seq, "part": 0, "n": 0, "bytes": 0, "lo": None, "hi": None}]
    write_line(spark, f"{paths.commits}/{name}.json", "\n".join(map(json.dumps, lines)))


def announced(spark: SparkSession, paths: Paths, name: str) -> list:
    """The blocks of a micro-batch in their order."""
    return spark.read.schema(NOTE).json(f"{paths.commits}/{name}.json").orderBy("seq", "part").collect()


def apply_blocks(name: str, target: Target, options: ReplicationOptions, paths: Paths) -> ApplyMetrics | None:
    """Apply the announced blocks of a micro-batch in their order, each once; null when all of them already were."""
    spark, total = target.spark, None
    for row in announced(spark, paths, name):
        if not path_exists(spark, f"{paths.log}/{BLOCK}={row['block']}"):
            continue  # without rows, or applied and deleted before
        block = read_blocks(spark, paths.log, ingest_schema(target.schema), [row["block"]])
        done = target.apply_block(block, f"block:{row['block']}", options)
        if done is not None:
            total = done if total is None else total.plus(done)
        if options.retention_delay == 0:
            drop_blocks(spark, paths, [row["block"]])
    return total


def _mark_applied(spark: SparkSession, blocks: list, paths: Paths, apply_id: str) -> None:
    """Rows per block a merge has consumed; one folder per merge, so a replay rewrites the same folder."""
    counts = spark.createDataFrame([(row["block"], row["n"]) for row in blocks], f"{BLOCK} string, n long")
    counts.coalesce(1).write.mode("overwrite").parquet(f"{paths.applied}/apply={apply_id}")


def portions(blocks: list, limit: int) -> list[int]:
    """The portion each announced block belongs to: whole blocks in the order of their ingest, at most ``limit`` rows each.

    A block that is larger is a portion of its own.
    """
    numbers, rows = [], 0
    for row in blocks:
        if not numbers or rows + row["n"] > limit:
            numbers.append(numbers[-1] + 1 if numbers else 0)
            rows = row["n"]
        else:
            numbers.append(numbers[-1])
            rows += row["n"]
    return numbers


def drop_blocks(spark: SparkSession, paths: Paths, names: list[str]) -> None:
    """Delete blocks of the log by their names."""
    for name in names:
        delete_path(spark, f"{paths.log}/{BLOCK}={name}")


def expire_blocks(
    spark: SparkSession, target: Target, options: ReplicationOptions, paths: Paths, now: dt.datetime | None = None
) -> int:
    """Remove rows of the log that are older than the delay and, unless told otherwise, applied; returns the blocks touched.

    Runs at most once per retention interval; the time of the last run is kept next to the job. The announcements say
    which times a block covers: a block that is wholly old is deleted by its name, one that is partly old is
    overwritten with the rows that stay, and no other is read. Ingest does not read the log and apply only reads blocks
    that wait, so that neither meets a file that goes.
    """
    now = now or utc_now()
    now = now.replace(tzinfo=now.tzinfo or dt.timezone.utc)
    now_ms = int(now.timestamp() * 1000)
    if not retention_due(last_expiry(spark, paths.retention), options.retention_interval, now_ms):
        return 0
    touched = 0
    if options.retention_delay > 0 and path_exists(spark, paths.commits):
        cutoff_ms = now_ms - options.retention_delay * 1000
        _forget_applied(spark, paths)
        blocks = spark.read.schema(NOTE).json(paths.commits).where((F.col("n") > 0) & (F.col("lo") <= cutoff_ms))
        if options.mode == "merge" and options.only_applied:
            if path_exists(spark, paths.applied):
                done = spark.read.schema(APPLIED).parquet(paths.applied).select(F.col(BLOCK).alias("block")).distinct()
                blocks = blocks.join(done, "block", "left_semi")
            else:
                blocks = blocks.limit(0)
        for row in blocks.toLocalIterator():
            folder = f"{paths.log}/{BLOCK}={row['block']}"
            if not path_exists(spark, folder):
                continue
            if row["hi"] <= cutoff_ms:
                delete_path(spark, folder)
            elif not _trimmed(spark, target, paths, row["block"], options.retention_delay, now):
                continue
            touched += 1
    note_expiry(spark, paths.retention, now_ms)
    return touched


def _trimmed(spark: SparkSession, target: Target, paths: Paths, block: str, delay: int, now: dt.datetime) -> bool:
    """Overwrite a block with its rows that are not old yet; false when it had none that are."""
    rows = read_blocks(spark, paths.log, ingest_schema(target.schema), [block])
    left = expire_rows(rows, delay, now)
    if rows.count() == left.count():
        return False
    left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK).parquet(paths.log)
    return True


def _forget_applied(spark: SparkSession, paths: Paths) -> None:
    """Delete the notes of merges all of whose blocks are gone since an earlier expiry.

    Those of blocks that go now stay, for the tick that is running may be taken again.
    """
    if not path_exists(spark, paths.applied):
        return
    there = child_names(spark, paths.log)
    notes = spark.read.schema(APPLIED).parquet(paths.applied).groupBy("apply").agg(F.collect_set(BLOCK).alias("blocks"))
    for row in notes.toLocalIterator():
        if not any(f"{BLOCK}={name}" in there for name in row["blocks"]):
            delete_path(spark, f"{paths.applied}/apply={row['apply']}")


def _trigger(seconds: int, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}


def start_block_mode(
    changes: DataFrame,
    target: Target,
    options: ReplicationOptions,
    root: str,
    logical: dict[str, str] | None = None,
    land: bool = True,
    available_now: bool = False,
    on_metrics: MetricsListener | None = None,
    clock: Clock = utc_now,
) -> Replication:
    """One query: land, load, apply and clean each micro-batch."""
    paths = Paths(root)
    checkpoint = paths.checkpoint("block")

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        block_id, now = block_id_of(checkpoint, batch_id), target.refreshed()
        try:
            arrived = ingest_batch(batch, block_id, batch_id, now, options, paths, logical, land)
        except RejectedRecord as bad:
            apply_blocks(bad.name, now, options, paths)
            raise
        changed = apply_blocks(block_id, now, options, paths)
        _report(on_metrics, block_id, arrived, changed)
        expire_blocks(target.spark, now, options, paths, clock())

    query = (
        changes.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(options.flush_seconds, available_now))
        .start()
    )

    def expire() -> int:
        return expire_blocks(target.spark, target.refreshed(), options, paths, clock())

    return Replication([query], expire=expire, expire_seconds=options.retention_interval)


def start_ingest(
    changes: DataFrame,
    target: Target,
    options: ReplicationOptions,
    root: str,
    logical: dict[str, str] | None = None,
    available_now: bool = False,
    on_metrics: MetricsListener | None = None,
) -> StreamingQuery:
    """Merge mode, first query: append typed changes to the log. A failure stops the query."""
    paths = Paths(root)
    checkpoint = paths.checkpoint("ingest")

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            block_id = block_id_of(checkpoint, batch_id)
            arrived = ingest_batch(batch, block_id, batch_id, target.refreshed(), options, paths, logical)
            _report(on_metrics, block_id, arrived, None)

    return (
        changes.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(options.flush_seconds, available_now))
        .start()
    )


def start_apply(
    target: Target,
    options: ReplicationOptions,
    root: str,
    available_now: bool = False,
    on_failure: Callable[[Exception], None] | None = None,
    on_metrics: MetricsListener | None = None,
    clock: Clock = utc_now,
) -> StreamingQuery:
    """Merge mode, second query: merge the blocks that were announced since the last tick, in one write of the target.

    Only whole blocks are seen, in the order of their ingest, of at most ``ANNOUNCED`` micro-batches a tick. They form
    portions of whole blocks up to ``merge_batch_size`` rows, at least one; what merging one portion after the other would
    do is folded into a single merge. The checkpoint marks what is pending, and a merge that is marked as done is skipped
    when a tick is taken again. A failed tick is reported to ``on_failure`` and ends the query; the next start takes it
    again.
    """
    paths = Paths(root)
    checkpoint = paths.checkpoint("apply")
    make_folder(target.spark, paths.commits)

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_id = block_id_of(checkpoint, batch_id)
        # one short line per block of this tick
        blocks = batch.orderBy("seq", "part", "block").collect()
        now = target.refreshed()
        if blocks and not path_exists(target.spark, f"{paths.applied}/apply={apply_id}/_SUCCESS"):
            _report(on_metrics, apply_id, None, merge_blocks(blocks, apply_id, now, options, paths))
        expire_blocks(target.spark, now, options, paths, clock())

    def guarded(batch: DataFrame, batch_id: int) -> None:
        try:
            run(batch, batch_id)
        except Exception as error:
            if on_failure is not None:
                on_failure(error)
            raise

    return (
        target.spark.readStream.schema(NOTE).option("maxFilesPerTrigger", ANNOUNCED).json(paths.commits)
        .writeStream.foreachBatch(guarded)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(options.apply_interval, available_now))
        .start()
    )


def with_restarts(start: Callable[[], StreamingQuery], wait_seconds: float, max_restarts: int | None = None) -> None:
    """Run a query to its end and start it again after a failure; each restart takes the failed batch again.

    For the apply query of merge mode: a failed tick is retried after the apply interval. ``max_restarts`` bounds the
    retries; the last failure is raised. The ingest query is not restarted, its failure ends the job.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return
        except StreamingQueryException:
            if max_restarts is not None and restarts >= max_restarts:
                raise
            restarts += 1
            time.sleep(wait_seconds)


def merge_blocks(
    blocks: list, apply_id: str, target: Target, options: ReplicationOptions, paths: Paths
) -> ApplyMetrics | None:
    """Merge whole blocks of the log, given in their order: their winners are written once and used from there."""
    spark, done = target.spark, None
    full = [row for row in blocks if row["n"]]
    if not options.only_applied or options.drop_merged:
        # expiry by age alone, or this tick cut off before, may have removed a block that was still waiting
        full = [row for row in full if path_exists(spark, f"{paths.log}/{BLOCK}={row['block']}")]
    if full:
        folder = f"{paths.root}/winners/{apply_id}"
        pks, columns = list(target.pks), target.schema.names
        batch = read_blocks(spark, paths.log, ingest_schema(target.schema), [row["block"] for row in full])
        numbers = portions(full, options.merge_batch_size)
        if numbers[-1] == 0:
            winners = winners_of(batch, pks, columns)
        else:
            names = spark.createDataFrame([(row["block"], n) for row, n in zip(full, numbers)], f"{BLOCK} string, _portion int")
            numbered = batch.join(F.broadcast(names), BLOCK)  # a line per block of the tick
            winners = fold_winners(numbered, pks, columns, F.col("_portion"), options.on_missing_update)
        winners.write.mode("overwrite").parquet(folder)
        done = target.apply_winners(spark.read.schema(winners.schema).parquet(folder), f"merge:{apply_id}", options)
        delete_path(spark, folder)
    _mark_applied(spark, blocks, paths, apply_id)
    if options.drop_merged:
        drop_blocks(spark, paths, [row["block"] for row in blocks])
    return done


def observed_row_bytes(spark: SparkSession, root: str) -> int | None:
    """Average size of a change of this job, from what it announced; null before its first block."""
    paths = Paths(root)
    if not path_exists(spark, paths.commits):
        return None
    seen = spark.read.schema(NOTE).json(paths.commits).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    return max(1, seen["bytes"] // seen["n"]) if seen["n"] else None


def open_changes(
    spark: SparkSession, source: str, options: ReplicationOptions, root: str, reader: dict[str, str] | None = None, **read
) -> DataFrame:
    """The changes of a job, read at the rate its options set; ``reader`` holds the source's own options.

    A source without a limit of bytes is held to them by the size of the changes that the job has seen before.
    """
    rate = options.source_options(source, observed_row_bytes(spark, root))
    return read_changes(spark, source, {**rate, **(reader or {})}, **read)


def open_target(spark: SparkSession, options: ReplicationOptions) -> CatalogTarget:
    """The target that the options name, as the catalog describes it: columns, types, keys and buckets."""
    return CatalogTarget.open(spark, options.table_identifier, options.pk_fields)


def start_replication(
    changes: DataFrame,
    target: Target | None,
    options: ReplicationOptions,
    root: str,
    logical: dict[str, str] | None = None,
    available_now: bool = False,
    on_metrics: MetricsListener | None = None,
    on_failure: Callable[[Exception], None] | None = None,
    clock: Clock = utc_now,
) -> Replication:
    """Start the queries of the configured mode. One job per target; nothing coordinates several.

    Without a ``target`` the table is the one that ``options`` name. Columns that are added to it while the job runs are
    taken over by the next micro-batch; older blocks have nulls there. ``await_termination`` of the result restarts a
    failed apply query after the apply interval, ``on_failure`` hears of it.
    """
    target = open_target(changes.sparkSession, options) if target is None else target
    if options.mode == "block":
        return start_block_mode(
            changes, target, options, root, logical, available_now=available_now, on_metrics=on_metrics, clock=clock
        )
    ingest = start_ingest(changes, target, options, root, logical, available_now, on_metrics)
    if available_now:
        ingest.awaitTermination()

    def apply() -> StreamingQuery:
        return start_apply(target, options, root, available_now, on_failure, on_metrics, clock)

    def expire() -> int:
        return expire_blocks(target.spark, target.refreshed(), options, Paths(root), clock())

    job = Replication([ingest, apply()], apply, options.apply_interval, expire, options.retention_interval)
    # a job that ends by itself is kept to its rules by ``await_termination``
    return job if available_now else job.watched(target.spark)
