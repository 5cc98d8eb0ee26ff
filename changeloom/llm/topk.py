"""Exact top-k search by integer inner product over an impact-ordered index, score at a time.

The index is cut into blocks of at most ``BLOCK`` vectors; each block is built where its rows lie and written. In a block
every dimension has its vectors in the order of their quantised component: segments of equal impact. A query takes the
segments of all dimensions by descending contribution, and adds what each is at least worth to its vectors. What is not
yet processed bounds what any vector can still gain. Processing stops only when that bound proves all but a few vectors
out of the block's best ``k``, or when nothing is left; the possible members are then scored exactly.

The queries are a stated set, cut into blocks as well. Index blocks are dealt into shards of a few, every query block goes
to every shard of its vector length, and a task holds the index blocks of one shard while the query blocks stream by. The
number of shards follows from the number of blocks; nothing is broadcast. A shard gives at most ``k`` rows of a block for a
query, and the best ``k`` of all are kept.

Bounds are sums of whole numbers that doubles hold exactly: components below ``LIMIT`` in size, at most 4096 of them.
A vector or query beyond that is scored beside the index in whole numbers of any size, and a score that no long can hold is
an error.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without an id;
vectors are compared with vectors of their own length alone; an empty vector scores 0; rows that repeat an id are
candidates of their own, and a query is asked once, with the smallest of its vectors that take part; equal scores go to the
smaller id; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.chunks import met
from changeloom.llm.common import small_batches, stored

BLOCK = 8192
QUERY_BLOCK = 256
SCALE = 1024
LEVELS = 64
LIMIT = 1 << 20
WIDEST = 4096
HELD = 4  # index blocks a task holds at a time
TIERS = (0.1, 0.25, 0.45, 0.7, 1.0)  # shares of a query's postings after which the bound is tried


class Index:
    """Impact-ordered postings of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        reach = int(np.abs(x).max(initial=0))
        self.shift = max(0, (2 * reach // LEVELS).bit_length())
        level = x >> self.shift
        self.low = level.min(axis=0)  # least level of a dimension
        up = level - self.low
        self.top = up.max(axis=0)
        # postings of a dimension from the highest level down, and how many stand at each level or above
        self.order = np.argsort(-up, axis=0, kind="stable").T.astype(np.int32)
        self.level = np.take_along_axis(up, self.order.T, axis=0).T.astype(np.int32)
        self.above = np.stack([np.bincount(up[:, d], minlength=int(self.top.max(initial=0)) + 1)[::-1].cumsum()[::-1] for d in range(x.shape[1])]) if x.shape[1] else np.zeros((0, 1), int)

    def top_k(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best k vectors but those with the query's id."""
        n, d = self.x.shape
        used = np.flatnonzero(q)
        possible = np.arange(n)
        if n > 4 * k and len(used):
            possible = self._possible(q, k + int((self.ids == own).sum()), used)
        possible = possible[self.ids[possible] != own]
        scores = self.x[possible] @ q
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][best], scores[best]

    def _possible(self, q: np.ndarray, k: int, used: np.ndarray) -> np.ndarray:
        """Vectors that may be among the best k, from contributions above each dimension's smallest."""
        n = len(self.ids)
        step = np.abs(q) << self.shift  # what a level is worth
        width = step[used].sum()  # what all components can be worth beyond the start of their level
        acc = np.zeros(n)
        # a positive weight takes levels from the top, a negative one from the bottom
        rises = q > 0
        done = np.zeros(len(used), np.int64)
        most = (self.top[used] * step[used]).max()
        total = n * len(used)
        for share in TIERS:
            # the contribution above which about this share of the postings stands
            floor_ = most * (1 - share)
            need = np.ceil(floor_ / step[used]).astype(np.int64) if share < 1 else np.zeros(len(used), np.int64)
            upto = np.zeros(len(used), np.int64)
            index, worth = [], []
            rest = 0
            for i, dim in enumerate(used):
                top = int(self.top[dim])
                steps = int(need[i])
                if steps <= top:
                    if rises[dim]:
                        upto[i] = self.above[dim, steps]
                    else:
                        upto[i] = n - (self.above[dim, top - steps + 1] if top - steps + 1 < self.above.shape[1] else 0)
                if upto[i] > done[i]:
                    part = slice(done[i], upto[i]) if rises[dim] else slice(n - upto[i], n - done[i])
                    index.append(self.order[dim, part])
                    gain = self.level[dim, part] if rises[dim] else top - self.level[dim, part]
                    worth.append(gain * step[dim])
                if upto[i] < n:
                    rest += min(steps - 1, top) * step[dim]  # the most that a vector not yet met here can gain
            if index:
                acc += np.bincount(np.concatenate(index), np.concatenate(worth), n)
            done = upto
            bar = np.partition(acc, n - k)[n - k] if n > k else -1.0
            possible = np.flatnonzero(acc + rest + width >= bar)
            if len(possible) <= 16 * k or done.sum() == total:
                break
        return possible


class Wide:
    """Vectors with components of any size, scored one by one in whole numbers."""

    def __init__(self, ids: np.ndarray, x: list[list[int]]):
        self.ids, self.x = ids, x

    def top_k(self, q: list[int], k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((-sum(a * b for a, b in zip(q, x)), int(i)) for i, x in zip(self.ids, self.x) if i != own)[:k]
        return np.array([i for _, i in found], np.int64), np.array([as_long(-score) for score, _ in found], np.int64)


def as_long(score: int) -> int:
    if not -(1 << 63) <= score < 1 << 63:
        raise OverflowError(f"the score {score} does not fit a long")
    return score


def whole(body: Index | Wide) -> Wide:
    """The vectors of an index or of wide ones, for a query that only whole numbers of any size can score."""
    return body if isinstance(body, Wide) else Wide(body.ids, body.x.tolist())


def _integers(column: pa.Array, ids: pa.Array) -> Iterator[tuple[int, bool, int, np.ndarray | list[int]]]:
    """Length, whether it is wide, id and integer vector of the rows that take part."""
    for i, v in zip(ids.to_pylist(), column.to_pylist()):
        if i is None or v is None or None in v:
            continue
        given = np.array(v, np.float64)
        if not np.isfinite(given).all():
            continue
        with np.errstate(over="ignore"):
            x = np.floor(SCALE * given)
        wide = len(x) > WIDEST or bool((np.abs(x) >= LIMIT).any())
        yield len(x), wide, i, [math.floor(c) for c in x.tolist()] if wide else x.astype(np.int64)


def _made(rows: list[tuple[int, list[int]]], wide: bool):
    """An index of vectors of one length, or the vectors as they are where they are wide."""
    ids = np.array([i for i, _ in rows], np.int64)
    x = [v for _, v in rows]
    return Wide(ids, x) if wide else Index(ids, np.array(x, np.int64).reshape(len(rows), -1))


def _blocks(rows: DataFrame, id_col: str, vector_col: str, size: int, make) -> DataFrame:
    """Blocks of up to ``size`` vectors of one length, made where the rows lie: width, body."""

    def run(batches):
        held: dict[tuple[int, bool], list] = {}
        for batch in batches:
            for width, wide, i, x in _integers(batch.column(1), batch.column(0)):
                part = held.setdefault((width, wide), [])
                part.append((i, x))
                if len(part) == size:
                    yield out(width, make(held.pop((width, wide)), wide))
        for (width, wide), part in held.items():
            yield out(width, make(part, wide))

    def out(width, made):
        return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([pickle.dumps(made, protocol=5)], pa.binary())], ["width", "body"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, "width int, body binary")


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers that are finite."""
    value = lambda c: c.cast("double")
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(value(c)) & (F.abs(value(c)) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, held: int = HELD) -> DataFrame:
    """The best ``k`` rows of every query: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    small_batches(spark, rows=4096)
    index = stored(_blocks(vectors, id_col, vector_col, block, _made), "topk-index")
    asked = vectors.where(is_query & takes_part(F.col(vector_col))).groupBy(F.col(id_col).alias("id")).agg(F.min(vector_col).alias("v"))
    queries = stored(_blocks(asked, "id", "v", QUERY_BLOCK, lambda rows, wide: (wide, rows)), "topk-queries")
    shards = index.groupBy("width").agg(F.ceil(F.count("*") / held).cast("int").alias("shards"))
    name = F.concat_ws("-", "width", "shard").alias("shard")
    dealt = index.join(shards, "width").withColumn("shard", F.pmod(F.xxhash64("body"), F.col("shards"))).select(name, "body")
    every = queries.join(shards, "width").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(name, "body")

    def run(batches):
        shard, there = None, []
        for batch in batches:
            for at, part, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at != shard:
                    shard, there = at, []
                if part == 0:
                    there.append(pickle.loads(body))
                    continue
                if not there:  # no index block was dealt to this shard
                    continue
                wide, rows = pickle.loads(body)
                for i, q in rows:
                    found = [whole(one).top_k(list(map(int, q)), k, i) if wide or isinstance(one, Wide) else one.top_k(q, k, i) for one in there]
                    ids, scores = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                    best = np.lexsort((ids, -scores))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), i, np.int64)), pa.array(ids[best]), pa.array(scores[best])], ["query_id", "vec_id", "score"])

    answers = met(every, dealt, run, "query_id long, vec_id long, score long", key="shard")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
