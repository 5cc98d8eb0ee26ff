"""Sequential model: the rules of merge and block mode, one batch at a time, on plain rows."""

import random

from pyspark.sql import types as T

KEYS, VALUES = ["k", "k2"], ["v", "w"]
COLUMNS = KEYS + VALUES
TARGET_SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("k2", T.StringType()),
        T.StructField("v", T.IntegerType()),
        T.StructField("w", T.StringType()),
    ]
)
LOG_DDL = (
    "k int, k2 string, v int, w string, KFK_TOPIC string, KFK_PARTITION int, KFK_OFFSET bigint, KFK_OP string, "
    "KFK_DATETIME timestamp_ntz, KFK_BLOCKID string"
)


def order(row):
    return (row["KFK_OFFSET"], row["KFK_PARTITION"], row["KFK_TOPIC"])


def key_of(row):
    return (row["k"], row["k2"])


def matches(a, b):
    return None not in key_of(a) and key_of(a) == key_of(b)


def image(row):
    return {c: row[c] for c in COLUMNS}


def winners(rows):
    latest = {}
    for row in rows:
        if key_of(row) not in latest or order(row) > order(latest[key_of(row)]):
            latest[key_of(row)] = row
    return list(latest.values())


def merge(target, batch, on_missing_update="drop"):
    target = [dict(r) for r in target]
    for src in winners(batch):
        hits = [r for r in target if matches(r, src)]
        if src["KFK_OP"] == "d":
            target = [r for r in target if not matches(r, src)]
        elif src["KFK_OP"] in "cru" and hits:
            for r in hits:
                r.update(image(src))
        elif src["KFK_OP"] in ("cru" if on_missing_update == "insert" else "cr"):
            target.append(image(src))
    return target


def block(target, rows):
    target = [dict(r) for r in target] + [image(r) for r in rows if r["KFK_OP"] in "cr"]
    for src in sorted((r for r in rows if r["KFK_OP"] == "u"), key=order):
        for r in target:
            if matches(r, src):
                r.update(image(src))
    gone = [r for r in rows if r["KFK_OP"] == "d"]
    return [r for r in target if not any(matches(r, d) for d in gone)]


def random_log(seed, n=120, n_batches=4, nulls=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(
            {
                "k": None if nulls and rng.random() < 0.05 else rng.randrange(8),
                "k2": rng.choice("ab"),
                "v": rng.choice([None, rng.randrange(100)]),
                "w": rng.choice([None, f"w{i}"]),
                "KFK_TOPIC": "t",
                "KFK_PARTITION": rng.randrange(3),
                "KFK_OFFSET": i,
                "KFK_OP": rng.choices("crudt", [3, 2, 4, 3, 1])[0],
                "KFK_DATETIME": None,
                "KFK_BLOCKID": str(rng.randrange(n_batches)),
            }
        )
    return rows


def random_target(seed, nulls=True):
    rng = random.Random(seed + 1000)
    rows = [{"k": k, "k2": k2, "v": rng.randrange(100), "w": "old"} for k in range(8) for k2 in "ab" if rng.random() < 0.5]
    if nulls:
        rows.append({"k": None, "k2": "a", "v": 1, "w": "null key"})
    return rows


def as_rows(rows):
    """Order-free form of a list of rows or dicts."""
    return sorted(([r[c] for c in COLUMNS] for r in rows), key=str)
