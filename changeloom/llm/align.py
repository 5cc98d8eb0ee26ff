"""Alignment of two tokenizers' ids over the same text, by the places where tokens of both end.

Tokenizer A is a byte-level BPE, B a sentence-piece BPE; both see a space and the text. The bytes where tokens of one end
are a hash set, and those of the other that are in it, the intersection, cut both id lists into the groups that no token of
either crosses. Within a group every pair of tokens whose byte ranges overlap is a link: all pairs where one side has a
single token, else those that both sides' ends in one order find.

Documents are encoded and cut once and kept as ids and cuts in written chunks, a row for each run of documents, with the
distinct linked pairs of ids of each chunk in its first row. The counts of all chunks are added up, and a chunk is told those of its own pairs, which it adds per document.
The table of pairs is joined by its key and grows with what the corpus links; nothing is broadcast.

A text of characters that every Unicode version sorts alike is encoded by ranks, which gives the same ids as the
tokenizer's merges; any other text goes through the tokenizer itself.

Defined results: a text that is null or empty, or whose ids of A or of B do not spell the space and the text, has no
tokens: all numbers are 0 and the groups are an empty text. Strings of special tokens are plain text. Rows that repeat are
documents of their own; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.chunks import CHUNK, chunked, met, unpacked
from changeloom.llm.common import stored

SPACE = "\u2581"  # a fixed value: how pieces of B write a space
STEP = 1 << 18  # characters encoded and cut at a time

# A fixed value: how A cuts a text into the parts that its merges see one by one.
PARTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters beyond ASCII, Latin letters and common punctuation, and controls that not every library counts as white space.
_UNSURE = re.compile("[^\t-\r -~\u00c0-\u017f\u2010-\u2026\u20ac]").search


class ByteLevel:
    """Tokenizer A: the bytes of its tokens, and the ids of texts."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        # the byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = {i for i, token in self.model.get_added_tokens_decoder().items() if token.special}
        names = self.model.get_vocab(with_added_tokens=True)
        self.token = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.token[i] = name.encode() if i in added else bytes(byte[c] for c in name)
        ranks = {self.token[i]: i for i in names.values() if i not in added}
        self.ranked = None
        if self.model.normalizer is None and self._cuts_as_known() and len(ranks) == len(names) - len(added):
            self.ranked = tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def _cuts_as_known(self) -> bool:
        """Whether the tokenizer cuts by ``PARTS``; the space is U+0120 and the line end U+010A in the byte-level alphabet."""
        seen = [part for part, _ in self.model.pre_tokenizer.pre_tokenize_str("a  b's c1\n\n d\ne!  ")]
        return seen == ["a", "\u0120", "\u0120b", "'s", "\u0120c", "1", "\u010a\u010a", "\u0120d", "\u010a", "e", "!", "\u0120\u0120"]

    def whole(self, full: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(full, add_special_tokens=False)]

    def ids(self, full: list[str]) -> list[tuple[list[int], bool]]:
        """Ids of every text, and whether they are sure to spell it, as ids by ranks always do."""
        ranked = [self.ranked is not None and not _UNSURE(text) for text in full]
        return [(self.ranked.encode_ordinary(text) if sure else self.whole([text])[0], sure) for text, sure in zip(full, ranked)]


class Pieces:
    """Tokenizer B: the bytes of its pieces, and the ids of texts, to which it adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.token = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]

    def ids(self, full: list[str]) -> list[list[int]]:
        return self.model.encode([text[1:] for text in full], num_threads=1)


def encoded(a: ByteLevel, b: Pieces, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
    """Ids of A and of B of every text; none of either where they do not spell the space and the text."""
    full = [" " + text if text else " " for text in texts]
    ids_a, ids_b = [], []
    for text, (x, sure), y in zip(full, a.ids(full), b.ids(full)):
        want = text.encode()
        ok = len(want) > 1 and b"".join(map(b.token.__getitem__, y)) == want
        ok = ok and (sure or b"".join(map(a.token.__getitem__, x)) == want)
        ids_a.append(x if ok else [])
        ids_b.append(y if ok else [])
    return ids_a, ids_b


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B lie before each place where both have a token end."""
    shorter, longer = sorted((np.asarray(ends_a), np.asarray(ends_b)), key=len)
    # ends ascend, so that those which the hash set of the others has come out in order
    common = np.fromiter(filter(set(shorter.tolist()).__contains__, longer.tolist()), np.int64)
    return np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")


def links(cut_a: np.ndarray, cut_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and of B whose bytes overlap, group by group."""
    from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    n_a, n_b = cut_a - from_a, cut_b - from_b
    both = (n_a == 1) & (n_b == 1)
    # one token on either side: linked with all of the other side
    one = ((n_a == 1) | (n_b == 1)) & ~both
    many = n_a[one] * n_b[one]
    step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    out_a = [from_a[both], np.repeat(from_a[one], many) + np.where(np.repeat(n_a[one] > 1, many), step, 0)]
    out_b = [from_b[both], np.repeat(from_b[one], many) + np.where(np.repeat(n_b[one] > 1, many), step, 0)]
    # several on both sides: each end, of either, ends a link of the first tokens of A and of B that reach it
    rest = ~one & ~both
    in_a, in_b = (np.arange(n[rest].sum()) + np.repeat(start[rest] - np.cumsum(n[rest]) + n[rest], n[rest]) for start, n in ((from_a, n_a), (from_b, n_b)))
    ends = np.union1d(ends_a[in_a], ends_b[in_b])
    out_a.append(in_a[np.searchsorted(ends_a[in_a], ends)])
    out_b.append(in_b[np.searchsorted(ends_b[in_b], ends)])
    return np.concatenate(out_a), np.concatenate(out_b)


def group_texts(run: Run, names: pa.Array) -> pa.Array:
    """The ids of the groups of every document: ``a1,a2|b1;a3|b2,b3``."""

    def lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)

    sides = [pc.binary_join(lists(cut, names.take(pa.array(ids))), ",") for cut, ids in ((run.cut_a, run.a), (run.cut_b, run.b))]
    groups = pc.binary_join_element_wise(*sides, "|")
    return pc.binary_join(lists(np.cumsum(run.n_groups), groups), ";")


class Run:
    """Documents that lie together, their ids one after the other, and the groups and links of all of them.

    The bytes of a document's ids of A and of B are the same, so that each document ends at a cut.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sizes: Sizes, marks: np.ndarray | None = None):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends_a, ends_b = np.cumsum(sizes.a[a]), np.cumsum(sizes.b[b])
        if marks is None:
            self.cut_a, self.cut_b = cuts(ends_a, ends_b)
        else:
            ends = np.flatnonzero(marks) + 1
            self.cut_a, self.cut_b = ends[ends <= len(a)], ends[ends > len(a)] - len(a)
        at_a, at_b = links(self.cut_a, self.cut_b, ends_a, ends_b)
        self.pairs = a[at_a].astype(np.int64) << 32 | b[at_b].astype(np.int64)
        # which document a token of A, and with it a group and a link, belongs to
        owner = np.repeat(np.arange(len(n_a)), n_a)
        self.link_owner = owner[at_a]
        self.n_groups = np.bincount(owner[self.cut_a - 1], minlength=len(n_a))
        self.n_links = np.bincount(self.link_owner, minlength=len(n_a))

    def marks(self) -> np.ndarray:
        """A flag per token of A and then of B: whether a group ends with it."""
        out = np.zeros(len(self.a) + len(self.b), bool)
        out[self.cut_a - 1] = True
        out[len(self.a) + self.cut_b - 1] = True
        return out


class Sizes:
    """Bytes of every token of A and of B, and the narrowest type that holds their ids."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = (np.array([len(t) for t in m.token], np.int64) for m in (a, b))
        self.kind = np.uint16 if max(len(self.a), len(self.b)) <= 1 << 16 else np.uint32


def _steps(texts: list[str | None]) -> Iterator[slice]:
    """Slices of texts of about ``STEP`` characters together."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text or "") > STEP:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text or "")
    if begin < len(texts):
        yield slice(begin, len(texts))


def _made(ids: pa.Array, texts: list[str | None], a: ByteLevel, b: Pieces, sizes: Sizes) -> list[list[pa.Table | None]]:
    """What a chunk keeps: runs of documents with their ids and cuts, and with the first run the chunk's distinct linked pairs
    with their counts."""
    rows, found, counts = [], [], []
    for part in _steps(texts):
        ids_a, ids_b = encoded(a, b, texts[part])
        n_a, n_b = (np.array([len(x) for x in each], np.int64) for each in (ids_a, ids_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(each), sizes.kind, n.sum()) for each, n in ((ids_a, n_a), (ids_b, n_b)))
        run = Run(flat_a, flat_b, n_a, n_b, sizes)
        body = (flat_a.tobytes(), flat_b.tobytes(), n_a.tobytes(), n_b.tobytes(), np.packbits(run.marks()).tobytes())
        rows.append([pa.table([ids[part]], ["id"]), pa.table([pa.array([c]) for c in body], ["a", "b", "n_a", "n_b", "marks"]), None])
        each = pc.value_counts(pa.array(run.pairs))
        found.append(each.field(0).to_numpy())
        counts.append(each.field(1).to_numpy())
    pair, inverse = np.unique(np.concatenate(found), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(counts), len(pair)).astype(np.int64)
    rows[0][2] = pa.table([pa.array(pair), pa.array(n)], ["pair", "n"])
    return rows


def _kept_run(body: bytes, sizes: Sizes) -> Run:
    """A run as it was kept."""
    row = unpacked(body).to_pylist()[0]
    a, b = (np.frombuffer(row[c], sizes.kind) for c in ("a", "b"))
    n_a, n_b = (np.frombuffer(row[c], np.int64) for c in ("n_a", "n_b"))
    marks = np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=len(a) + len(b))
    return Run(a, b, n_a, n_b, sizes, marks)


def _asked(chunks: DataFrame) -> DataFrame:
    """The distinct linked pairs of every chunk, in order: chunk, pos, a, b, n."""

    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = unpacked(body)
                pair, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
                for at in range(0, len(pair), 10_000):
                    part = pair[at : at + 10_000]
                    columns = [np.full(len(part), chunk), np.arange(at, at + len(part), dtype=np.int32), (part >> 32).astype(np.int32), part.astype(np.int32), n[at : at + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "pos", "a", "b", "n"])

    return chunks.where("pairs is not null").select("chunk", "pairs").mapInArrow(run, "chunk long, pos int, a int, b int, n long")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, and the groups as text.

    The count of a pair of ids is the number of links of the corpus that hold it. ``n_best`` of a document's links have the
    highest count of their id of B; ``count_sum`` adds the counts of all its links.
    """
    first, second = ByteLevel(path_a), Pieces(path_b)
    sizes, n_names = Sizes(first, second), max(len(first.token), len(second.token))

    def make():
        a, b = ByteLevel(path_a), Pieces(path_b)
        return lambda rows: _made(rows.column(0).combine_chunks(), rows.column(1).to_pylist(), a, b, sizes)

    chunks = chunked(docs.select(F.col(id_col), F.col(text_col)), "align-chunks", make, chunk, ("ids", "body", "pairs"), step="pos")
    asked = _asked(chunks)
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # an id of B has at most as many pairs as A has ids
    counts = stored(counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b"))), "align-pairs")
    answers = asked.join(counts, ["a", "b"]).select("chunk", "pos", "count", "best")

    def run(batches):
        names = pa.array(map(str, range(n_names)), pa.string())
        at, count, best, pair, known = None, [], [], None, None
        for batch in batches:
            chunk_of = batch.column(0).to_numpy()
            for rows in np.split(np.arange(len(chunk_of)), np.flatnonzero(np.diff(chunk_of)) + 1):
                if not len(rows):
                    continue
                if chunk_of[rows[0]] != at:
                    at, count, best, pair, known = chunk_of[rows[0]], [], [], None, None
                here = batch.slice(rows[0], len(rows))
                told = here.filter(pc.equal(here.column(1), 0))
                if told.num_rows:
                    count.append(told.column(3).to_numpy())
                    best.append(told.column(4).to_numpy(zero_copy_only=False))
                kept = here.filter(pc.equal(here.column(1), 1))
                for row in range(kept.num_rows):
                    ids, body, pairs = (kept.column(i)[row].as_buffer() for i in (5, 6, 7))
                    if pairs is not None:
                        pair = unpacked(pairs).column(0).to_numpy()
                        known = np.concatenate(count or [[]]).astype(np.int64), np.concatenate(best or [[]]).astype(bool)
                        if len(pair) != len(known[0]):
                            raise ValueError("a chunk has not the counts of its pairs")
                    yield finished(unpacked(ids).column(0).combine_chunks(), body, pair, *known, names)

    def finished(ids, body, pair, count, best, names):
        each = _kept_run(body, sizes)
        n = len(each.n_a)
        pos = np.searchsorted(pair, each.pairs)
        n_best = np.bincount(each.link_owner[best[pos]], minlength=n)
        total = np.zeros(n, np.int64)
        np.add.at(total, each.link_owner, count[pos])
        numbers = [pa.array(c, pa.int64()) for c in (each.n_a, each.n_b, each.n_groups, each.n_links, n_best, total)]
        return pa.RecordBatch.from_arrays([ids, *numbers, group_texts(each, names)], [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    kind = docs.schema[id_col].dataType.simpleString()
    return met(chunks, answers, run, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
