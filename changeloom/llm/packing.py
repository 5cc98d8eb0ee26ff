"""Best-fit packing of token sequences by length patterns.

Documents are tokenised where they lie and cut into pieces of at most ``room`` ids. What leaves the executors is the
histogram of piece lengths, at most ``room`` numbers. On it the driver enumerates patterns of few lengths that fill a
sequence, fits how often to repeat each by non-negative least squares, rounds the repeats down to what the histogram
holds, and packs the residual lengths best fit first, group by group of equal lengths. The plan is a list of
(pattern, repeats) whose size depends on ``room`` alone; each piece finds its place from its length and its rank among
the pieces of that length, counted over hashed parts so that one frequent length is ranked by many tasks.

Defined results: null text is empty and gives the closing id alone; rows that repeat are documents of their own and may
swap places; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import defaultdict
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import small_batches, stored, texts

ROOM = 2048
PLACES = 1024  # hashed parts in which the pieces of one length are ranked
CACHED_BYTES = 24 << 20  # of words and ids that a task remembers, about
STEP = 1 << 19  # bytes of text whose words are looked up at a time

# A fixed value of the tokenizer's file: how it cuts lower-cased text into the parts that its model sees one by one.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for words of visible ASCII and of the letters of U+00C0 to U+00FF, on which every Unicode version agrees.
_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\x01|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9\x01]+").findall
LONGEST = 256  # bytes of a word that is encoded by ranks


def word_ranks(path: str) -> dict[bytes, int] | None:
    """The ids of a tokenizer of the known rules by the bytes of their tokens, a 0 byte for the end of a part; else None.

    Merging the pair whose bytes have the lowest id does what the merges do if each merge makes one token, in the order of
    the ids, and the bytes of every token are merged to that token.
    """
    from tokenizers import Tokenizer

    rules = json.loads(Tokenizer.from_file(path).to_str())
    model, pre = rules["model"], rules["pre_tokenizer"] or {}
    cut, *then = pre.get("pretokenizers") or [{}]
    steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers") or []]
    known = (
        model["type"] == "BPE" and steps == ["NFC", "Replace", "Lowercase"] and model["end_of_word_suffix"]
        and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and cut.get("pattern") == {"Regex": SPLIT} and [t["type"] for t in then] == ["ByteLevel"]
        and all(t["content"].startswith("<|") for t in rules["added_tokens"])
    )
    if not known:
        return None
    # the model reads bytes as characters: those that are visible as themselves, the others from U+0100 on
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(0x100)) - set(seen)))}
    end = model["end_of_word_suffix"]

    def spelled(name: str) -> bytes:
        last = len(name) > len(end) and name.endswith(end)
        return bytes(byte[c] for c in (name.removesuffix(end) if last else name)) + b"\0" * last

    ranks = {spelled(name): i for name, i in model["vocab"].items() if not name.startswith("<|")}
    single = [bytes([b]) for b in range(256)]
    pairs = {}
    for k, merge in enumerate(model["merges"]):
        a, b = map(spelled, merge)
        if 0 in a or 0 in b[:-1] or b == b"\0" or ranks.get(a + b) != 512 + k:
            return None
        pairs[a, b] = k
    if {ranks.get(b, 512) >> 8 for b in single} != {0} or {ranks.get(b + b"\0", 0) >> 8 for b in single} != {1} or len(ranks) != 512 + len(pairs):
        return None
    return ranks if all(_merged(token, pairs) == [token] for token in ranks if len(token) > 2) else None


def _merged(token: bytes, pairs: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The tokens that the merges make of a part."""
    parts = [bytes([b]) for b in token.removesuffix(b"\0")]
    parts[-1] += b"\0" * token.endswith(b"\0")
    while len(parts) > 1:
        rank, i = min((pairs.get((a, b), len(pairs)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(pairs):
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Words:
    """Little-endian ids of the UTF-8 words that a task has met; starts anew when it is full, and goes with the task.

    Plain words not met before are cut into their parts here and encoded by ranks, many at a time. All others, and all
    words of a tokenizer with other rules, go through the whole tokenizer.
    """

    def __init__(self, path: str, ranks: dict[bytes, int] | None = None):
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = path
        self.ranks = word_ranks(path) if ranks is None else ranks
        self.known = bool(self.ranks)
        self.ranked = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=self.ranks, special_tokens={}) if self.known else None
        self.ids: dict[bytes, bytes] = {}
        self.held = 0

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, found: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]

    def by_rank(self, plain: list[str]) -> list[bytes]:
        """Ids of plain words: a part of its own after each word tells them apart."""
        parts = _PARTS("\x01".join([*plain, ""]).lower())
        ids = np.array(self.ranked.encode_ordinary("\0".join([*parts, ""])), "<u4")
        ends = (np.flatnonzero(ids == self.ranks[b"\x01\0"]) * 4).tolist()
        body = ids.tobytes()
        return [body[begin:end] for begin, end in zip([0, *[end + 4 for end in ends]], ends)]

    def learn(self, new: list[bytes]) -> None:
        """Remembers words that are not known yet."""
        plain, other = ([], []), ([], [])
        for word, text in zip(new, b"\n".join(new).decode("utf-8", "replace").split("\n")):
            words, found = plain if len(word) <= LONGEST and _PLAIN(text) and "<|" not in text else other
            words.append(word)
            found.append(text)
        for (words, found), ids_of in ((plain, self.by_rank), (other, self.whole)):
            if words:
                ids = ids_of(found)
                self.ids.update(zip(words, ids))
                # with what both objects and their places take
                self.held += sum(map(len, words)) + sum(map(len, ids)) + 200 * len(words)


def token_bytes(found: list[bytes], words: Words) -> list[bytes]:
    """Little-endian 32-bit ids of whole UTF-8 texts.

    A tokenizer of the known rules drops white space and never joins across it, so that a text's ids are those of its words
    in turn, and a word that came before needs no second look. Any other tokenizer is given whole texts.
    """
    if not words.known:
        return words.whole([text.decode("utf-8", "replace") for text in found])
    out, begin, size = [], 0, 0
    for i, text in enumerate(found):
        size += len(text)
        if size < STEP and i + 1 < len(found):
            continue
        if words.held > CACHED_BYTES:
            words.ids.clear()
            words.held = 0
        split = [text.split() for text in found[begin : i + 1]]
        words.learn([word for word in set(chain.from_iterable(split)) if word not in words.ids])
        out.extend(b"".join(map(words.ids.__getitem__, each)) for each in split)
        begin, size = i + 1, 0
    return out


def pieces(docs: DataFrame, tokenizer_path: str, room: int = ROOM, closing_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, the ids as little-endian 32-bit bytes."""
    small_batches(docs.sparkSession, rows=500, mb=4)
    end = np.array([closing_id], "<u4").tobytes()
    ranks = word_ranks(tokenizer_path) or {}

    def run(batches):
        words = Words(tokenizer_path, ranks)
        for batch in batches:
            rows, index = [], []
            for i, ids in enumerate(token_bytes(texts(batch.column(1)), words)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * room)):
                    part = ids[at : at + 4 * room]
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                    index.append(i)
            columns = list(zip(*rows)) or [[]] * 5
            arrays = [batch.column(0).take(pa.array(index, pa.int64())), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:4]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(columns[4], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ddl)


def patterns(lengths: np.ndarray, room: int, waste: int = 1, steps: int = 20) -> list[tuple[int, ...]]:
    """Patterns of one to four of the (ascending) lengths that leave at most ``waste`` of the room.

    The last length of a pattern is the largest one that fits. The first is any length, those between are any of
    ``steps`` lengths spread over the range, so that their number is bounded by ``lengths * steps ** 2``.
    """
    out = {(int(n),) for n in lengths if n >= room - waste}
    grid = [int(n) for n in lengths[np.unique(np.linspace(0, len(lengths) - 1, steps).astype(int))]] if len(lengths) else []
    low = np.searchsorted(lengths, np.arange(room + 1), side="right") - 1  # the largest length that fits into a space

    def close(first: tuple[int, ...]) -> None:
        left = room - sum(first)
        if left >= 0 and low[left] >= 0 and left - lengths[low[left]] <= waste:
            out.add(tuple(sorted((*first, int(lengths[low[left]])), reverse=True)))

    for a in map(int, lengths):
        close((a,))
        for b in grid:
            if a + b < room:
                close((a, b))
                for c in grid:
                    if c <= b and a + b + c < room:
                        close((a, b, c))
    return sorted(out, reverse=True)


def fit_repeats(found: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = 30) -> np.ndarray:
    """Non-negative least squares of the histogram on the patterns, by projected gradient steps with momentum.

    A step is scaled per pattern by its curvature bound, so that patterns of frequent and of rare lengths settle alike.
    """
    if not found:
        return np.zeros(0)
    width = max(map(len, found))
    at = np.array([p + (0,) * (width - len(p)) for p in found])
    there = (at > 0).astype(float)
    use = np.zeros(len(histogram))
    np.add.at(use, at.ravel(), there.ravel())
    bound = (use[at] * there).sum(axis=1) + 1e-9
    x = np.zeros(len(found))
    y, t = x, 1.0
    for _ in range(sweeps):
        made = np.bincount(at.ravel(), (there * y[:, None]).ravel(), minlength=len(histogram))
        slope = ((histogram - made)[at] * there).sum(axis=1)
        after = np.maximum(0, y + slope / bound)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = after + (t - 1) / t2 * (after - x), after, t2
    return x


def plan(histogram: np.ndarray, room: int = ROOM) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeats that hold every length of the histogram (index: length) exactly as often as it occurs."""
    left = histogram.astype(np.int64).copy()
    lengths = np.flatnonzero(left)
    found = patterns(lengths, room)
    x = fit_repeats(found, left.astype(float))
    out = []
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        parts, need = np.unique(found[i], return_counts=True)
        n = int(min(np.floor(x[i]), (left[parts] // need).min()))
        if n > 0:
            left[parts] -= need * n
            out.append((found[i], n))
    return out + best_fit(left, room)


def best_fit(left: np.ndarray, room: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of counted lengths: equal sequences are one group, so that work follows the lengths."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # space -> groups of equal sequences
    done = []
    for length in map(int, np.flatnonzero(left)[::-1]):
        n = int(left[length])
        for space in sorted(s for s in list(open_) if s >= length):
            while n and open_[space]:
                pattern, count = open_[space].pop()
                fits = space // length  # as many as fit, since the next one would find this sequence again
                whole = min(count, n // fits)
                if whole:
                    _put(open_, done, pattern + (length,) * fits, whole, space - fits * length)
                    n -= whole * fits
                if count > whole and n:
                    few = min(fits, n)
                    _put(open_, done, pattern + (length,) * few, 1, space - few * length)
                    n -= few
                    whole += 1
                if count > whole:
                    open_[space].append((pattern, count - whole))
            if not n:
                break
        fits = room // length
        if n // fits:
            _put(open_, done, (length,) * fits, n // fits, room - fits * length)
        if n % fits:
            _put(open_, done, (length,) * (n % fits), 1, room - n % fits * length)
    return done + [group for groups in open_.values() for group in groups]


def _put(open_, done, pattern, count, space) -> None:
    (open_[space] if space else done).append((pattern, count))


class Places:
    """The plan by length: which ranks of a length go to which sequences, and where in them."""

    def __init__(self, made: list[tuple[tuple[int, ...], int]]):
        runs, first = defaultdict(list), 0
        for pattern, n in made:
            at = 0
            for length in pattern:
                runs[length].append((n, first, at))
                at += length
            first += n
        self.sequences = first
        self.by_length = {}
        for length, found in runs.items():
            n, begin, at = (np.array(c, np.int64) for c in zip(*found))
            self.by_length[length] = (np.concatenate(([0], np.cumsum(n)[:-1])), begin, at)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            low, begin, at = self.by_length[int(n)]
            run = np.searchsorted(low, rank[rows], side="right") - 1
            sequence[rows] = begin[run] + rank[rows] - low[run]
            offset[rows] = at[run]
        return sequence, offset


def pack(docs: DataFrame, tokenizer_path: str, room: int = ROOM, closing_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with the sequence they go to and their offset in it; ``with_ids`` keeps the ids themselves."""
    cut = stored(pieces(docs, tokenizer_path, room, closing_id, id_col, text_col, with_ids), "pieces")
    histogram = np.zeros(room + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # at most ``room`` rows
        histogram[r["length"]] = r["count"]
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(histogram, room)))

    placed = cut.withColumn("_place", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PLACES)))
    parts = placed.groupBy("length", "_place").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("length", "_place", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    within = Window.partitionBy("length", "_place").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = placed.withColumn("_rank", F.row_number().over(within) - 1).join(begins, ["length", "_place"])
    columns = cut.columns
    rows = ranked.select(*columns, (F.col("_rank") + F.col("_begin")).cast("long").alias("_rank"))

    def run(batches):
        for batch in batches:
            *kept, rank = batch.columns
            sequence, offset = places.value.find(np.asarray(batch.column(columns.index("length"))), np.asarray(rank))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return rows.mapInArrow(run, f"{ddl}, sequence_id long, offset long")
