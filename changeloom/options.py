"""Replication job options, their defaults and their bounds (2.10)."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

# Option key (after any dotted product prefix) -> field.
OPTION_KEYS = {
    "database": "database",
    "schema": "schema",
    "table": "table",
    "ingestion.mode": "mode",
    "pk.fields": "pk_fields",
    "job.interval.seconds": "apply_interval",
    "merge.batch.size": "merge_batch_size",
    "ingest.cleanup.delay.seconds": "retention_delay",
    "ingest.cleanup.interval.seconds": "retention_interval",
    "buffer.count.records": "max_records",
    "buffer.flush.time": "flush_seconds",
    "buffer.size.bytes": "max_bytes",
}

# Lower bounds.
LOWER_BOUNDS = {
    "apply_interval": 5,
    "merge_batch_size": 1,
    "retention_delay": 0,
    "retention_interval": 0,
    "max_records": 1,
    "flush_seconds": 1,
    "max_bytes": 1,
    "broadcast_bytes": 0,
}

_CHOICES = {
    "mode": ("block", "merge"),
    "on_error": ("fail", "quarantine", "prefix"),
    "tombstones": ("error", "skip"),
    "null_keys": ("insert", "quarantine"),
    "on_missing_update": ("drop", "insert"),
    "number_scale": ("declared", "zero"),
    "timestamp_precision": ("millis", "micros"),
    "columns": ("target", "first_record"),
}


@dataclass(frozen=True)
class ReplicationOptions:
    """Options of one replication job; ``validate`` checks them before anything starts."""

    table: str
    database: str = ""
    schema: str = ""
    mode: str = "block"
    pk_fields: tuple[str, ...] = ()
    apply_interval: int = 30
    merge_batch_size: int = 10_000
    retention_delay: int = 86_400
    retention_interval: int = 86_400
    max_records: int = 10_000
    flush_seconds: int = 120
    max_bytes: int = 5_000_000
    # Choices where the engine offers more than one rule.
    on_error: str = "fail"
    tombstones: str = "error"
    null_keys: str = "insert"
    on_missing_update: str = "drop"
    number_scale: str = "declared"
    timestamp_precision: str = "millis"
    columns: str = "target"
    empty_as_null: bool = False
    only_applied: bool = True
    # Whether a micro-batch is cut into blocks of at most ``max_records`` and ``max_bytes``, and merged blocks go at once.
    cut_blocks: bool = False
    drop_merged: bool = False
    # Largest change set joined by broadcast.
    broadcast_bytes: int = 64 * 1024 * 1024

    @classmethod
    def from_config(
        cls, config: dict[str, str], prefix: str = "warehouse.", modes: dict[str, str] | None = None, **extra
    ) -> ReplicationOptions:
        """Options from string settings. Keys are exactly the known ones, which may carry ``prefix``; others are ignored.

        ``modes`` names further values of the ingestion mode.
        """
        types = {f.name: f.type for f in fields(cls)}
        values: dict = {}
        for key, raw in config.items():
            name = OPTION_KEYS.get(key.removeprefix(prefix))
            if name is None:
                continue
            if name == "mode":
                values[name] = ingestion_mode(raw, modes)
            elif name == "pk_fields":
                values[name] = tuple(part.strip() for part in raw.split(",") if part.strip())
            elif types[name] == "int":
                values[name] = int(raw)
            else:
                values[name] = raw
        return cls(**{**values, **extra}).validate()

    def validate(self) -> ReplicationOptions:
        if not self.table.strip():
            raise ValueError("table is required")
        for name, low in LOWER_BOUNDS.items():
            if getattr(self, name) < low:
                raise ValueError(f"{name} must be at least {low}, is {getattr(self, name)}")
        for name, choices in _CHOICES.items():
            if getattr(self, name) not in choices:
                raise ValueError(f"{name} must be one of {choices}, is {getattr(self, name)!r}")
        return self

    def with_(self, **changes) -> ReplicationOptions:
        return replace(self, **changes).validate()

    @property
    def table_identifier(self) -> str:
        return ".".join(part for part in (self.database, self.schema, self.table) if part)

    def source_options(
        self, source: str, average_row_bytes: int | None = None, min_partitions: int | None = None
    ) -> dict[str, str]:
        """Rate options of a streaming source, so that a micro-batch ends at the record, byte or time limit.

        Kafka has no byte limit: with the average row size given, the record limit is lowered to stay inside it.
        ``min_partitions`` splits topic partitions over more tasks than the topic has partitions.
        """
        if source == "kafka":
            records = self.max_records
            if average_row_bytes:
                records = max(1, min(records, self.max_bytes // average_row_bytes))
            limits = {
                "maxOffsetsPerTrigger": str(records),
                "minOffsetsPerTrigger": str(records),
                "maxTriggerDelay": f"{self.flush_seconds}s",
            }
            return {**limits, "minPartitions": str(min_partitions)} if min_partitions else limits
        return {"maxBytesPerTrigger": str(self.max_bytes)}


# Names of the modes.
MODES = {
    "BLOCK": "block",
    "STAGE": "block",
    "STAGE_COPY": "block",
    "MERGE": "merge",
    "STREAMING": "merge",
}


def ingestion_mode(raw: str, names: dict[str, str] | None = None) -> str:
    """Configured ingestion mode -> ``block`` or ``merge``; ``names`` adds further names of either."""
    known = MODES | {name.upper(): mode for name, mode in (names or {}).items()}
    try:
        return known[raw.strip().upper()]
    except KeyError:
        raise ValueError(f"unknown ingestion mode {raw!r}, known are {sorted(known)}") from None
