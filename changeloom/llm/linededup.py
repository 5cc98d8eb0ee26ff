"""Line dedup by a sharded minimal perfect hash: lines found in many documents go from all of them.

A line's key is the line without white space at its ends and with A-Z lower-cased; 128 bits of its hash stand for it.
Tasks count in how many documents of a chunk each key is, and one aggregate adds the chunks up. The distinct hashes are
dealt into shards of about ``SHARD`` keys. For each shard a task builds a minimal perfect hash: on every level the keys
that are alone in their place set a bit, the others go on to the next level, and a key's index is the number of bits
before its own. It indexes two compact arrays, a fingerprint and a count of documents. Chunks then probe the arrays of
the shards their keys lie in; lines are never joined. A key meets a shard once a chunk, however many lines have it.

Defined results: a null or empty text is one empty line; rows that repeat are documents of their own; a key shorter than
``min_chars`` code points never goes; a document all of whose lines go has an empty text; an empty table gives an empty
result; other columns are never read. A foreign key that meets another's index differs in the fingerprint but for
one in 2^32; keys of the corpus itself always have an index of their own.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.chunks import CHUNK, chunked, met, unpacked
from changeloom.llm.common import mix64, stored, texts

SHARD = 1 << 13
LEVELS = 96
SPACE = b" \t\n\x0b\x0c\r"


def keys_of(text: bytes) -> list[bytes]:
    """The key of every line of a text."""
    return [line.strip(SPACE) for line in text.lower().split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars)


def digests(keys) -> np.ndarray:
    """128-bit hashes of keys: one row of two 64-bit numbers each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)


class PerfectHash:
    """A minimal perfect hash over distinct 128-bit keys with the arrays it indexes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, gamma: float = 2.0):
        self.bits: list[np.ndarray] = []  # of each level, 64 places a word
        self.before: list[np.ndarray] = []  # bits set in all earlier words of all levels
        rest, total = keys, 0
        while len(rest):
            if len(self.bits) == LEVELS:
                raise ValueError("keys are not distinct")
            words = max(1, int(gamma * len(rest)) // 64 + 1)
            place = self._place(rest, len(self.bits), words)
            alone = np.bincount(place, minlength=words * 64) == 1
            level = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(level).astype(np.int64)
            self.bits.append(level)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
            rest = rest[~alone[place]]
        self.marks = np.zeros(len(keys), np.uint32)
        self.counts = np.zeros(len(keys), np.uint32)
        index = self.index(keys)
        self.marks[index] = self._mark(keys)
        self.counts[index] = np.minimum(counts, np.iinfo(np.uint32).max)

    @staticmethod
    def _place(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        mixed = mix64(keys[:, 0] ^ mix64(keys[:, 1] + np.uint64(level + 1)))
        return (mixed % np.uint64(words * 64)).astype(np.int64)

    @staticmethod
    def _mark(keys: np.ndarray) -> np.ndarray:
        return (keys[:, 1] >> np.uint64(32)).astype(np.uint32)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Each key's index; -1 for a key that no level has a bit for, which is not one of those built over."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            if not len(left):
                break
            place = self._place(keys[left], level, len(bits))
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[here]] = (before[word] + np.bitwise_count(below))[here]
            left = left[~here]
        return out

    def documents(self, keys: np.ndarray) -> np.ndarray:
        """In how many documents each key is; 0 for a key that is not one of those built over."""
        if not len(self.counts):
            return np.zeros(len(keys), np.uint32)
        index = self.index(keys)
        known = (index >= 0) & (self.marks[index] == self._mark(keys))
        return np.where(known, self.counts[index], 0)


def _distinct(rows: pa.Table, min_chars: int) -> Counter:
    """In how many documents of a chunk each key is."""
    found: Counter = Counter()
    for text in texts(rows.column(1)):
        found.update(set(keys_of(text)))
    for key in [key for key in found if not long_enough(key, min_chars)]:
        del found[key]
    return found


def counted(chunks: DataFrame, min_chars: int) -> DataFrame:
    """Distinct keys: hi, lo, and in how many documents they are."""

    def run(batches):
        for batch in batches:
            for body in batch.column(0).to_pylist():
                found = _distinct(unpacked(body), min_chars)
                at = digests(found).view(np.int64)
                n = np.fromiter(found.values(), np.int64, len(found))
                yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(n)], ["hi", "lo", "n"])

    each = chunks.select("body").mapInArrow(run, "hi long, lo long, n long")
    return each.groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def arrays(keys: DataFrame, shards: int) -> DataFrame:
    """The perfect hash and arrays of every shard: shard, body."""

    def run(batches):
        shard, held = None, []

        def out():
            rows = np.concatenate(held)
            body = pickle.dumps(PerfectHash(rows[:, :2].astype(np.int64).view(np.uint64), rows[:, 2]), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([body], pa.binary())], ["shard", "body"])

        for batch in batches:
            at = batch.column(0).to_numpy()
            rows = np.stack([batch.column(i).to_numpy() for i in (1, 2, 3)], axis=1)
            for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
                if len(part) and at[part[0]] != shard:
                    if held:
                        yield out()
                    shard, held = int(at[part[0]]), []
                held.append(rows[part])
        if held:
            yield out()

    dealt = keys.select(F.pmod("hi", F.lit(shards)).cast("int").alias("shard"), "hi", "lo", "n")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, body binary")


def _asked(chunks: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """The distinct keys of every chunk by shard: shard, chunk, body."""

    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = digests(_distinct(unpacked(body), min_chars))
                shard = at[:, 0].view(np.int64) % shards
                order = np.argsort(shard, kind="stable")
                names, start = np.unique(shard[order], return_index=True)
                bodies = [part.tobytes() for part in np.split(at[order], start[1:])] if len(names) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), pa.array([chunk] * len(names), pa.int64()), pa.array(bodies, pa.binary())], ["shard", "chunk", "body"]
                )

    return chunks.select("chunk", "body").mapInArrow(run, "shard int, chunk long, body binary")


def probed(asked: DataFrame, built: DataFrame, min_docs: int) -> DataFrame:
    """The asked keys found in ``min_docs`` documents or more, from the arrays: chunk, body."""

    def run(batches):
        there, at = None, None
        for batch in batches:
            chunks, found = [], []
            for shard, part, body, chunk in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if part == 0:
                    there, at = pickle.loads(body), shard
                    continue
                if at != shard:
                    raise ValueError(f"shard {shard} has no arrays")
                keys = np.frombuffer(body, "<u8").reshape(-1, 2)
                keys = keys[there.documents(keys) >= min_docs]
                if len(keys):
                    chunks.append(chunk)
                    found.append(keys.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(found, pa.binary())], ["chunk", "body"])

    return met(asked, built, run, "chunk long, body binary", key="shard")


def dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, chunk: int = CHUNK) -> DataFrame:
    """One row per document: its id, n_lines, n_dropped, and the text of the lines that stay."""
    chunks = chunked(docs.select(F.col(id_col), F.col(text_col)), "line-chunks", size=chunk)
    keys = stored(counted(chunks, min_chars), "line-keys")
    shards = max(1, -(-keys.count() // shard))
    built = stored(arrays(keys, shards), "line-arrays")
    answers = probed(_asked(chunks, shards, min_chars), built, min_docs)

    def run(batches):
        chunk, gone = None, set()
        for batch in batches:
            for at, part, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at != chunk:
                    chunk, gone = at, set()
                if part == 0:
                    gone.update(body[i : i + 16] for i in range(0, len(body), 16))
                    continue
                rows = unpacked(body)
                lines, dropped, kept = [], [], []
                known: dict[bytes, bool] = {}
                for text in texts(rows.column(1)):
                    keys = keys_of(text)
                    for key in set(keys).difference(known):
                        known[key] = long_enough(key, min_chars) and xxhash.xxh3_128_digest(key) in gone
                    stay = [line for line, key in zip(text.split(b"\n"), keys) if not known[key]]
                    lines.append(len(keys))
                    dropped.append(len(keys) - len(stay))
                    kept.append(b"\n".join(stay))
                ids = rows.column(0).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], [id_col, "n_lines", "n_dropped", text_col]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return met(chunks, answers, run, f"`{id_col}` {kind}, n_lines long, n_dropped long, `{text_col}` string")
