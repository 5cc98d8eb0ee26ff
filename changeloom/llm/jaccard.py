"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct word shingles, each a 64-bit hash, in one global order: rare shingles by hash, then
frequent ones by hash. Which shingles count as frequent only steers the work; every choice gives the same links.

Two sets that link share at least ``t`` shingles, with ``t = ceil(threshold * size)`` of either. So

* if they share a rare shingle, they share one among the first ``size - t + 1`` of each: rare shingles there are indexed
  one by one;
* else all they share is frequent. That takes at least ``t`` frequent shingles in each, so only documents of little else
  go on. Their frequent shingles form ``g`` classes by hash, and their prefix is extended until it must hold ``g + 1``
  shared ones: two of these fall into one class, so pairs of one class are indexed as combinations. ``g`` grows with the
  size band of the document (a pair of neighbouring bands meets in the lower one), which keeps the combinations of a
  document to about half its size.

Sets that are equal are one node throughout. A node is first verified against one partner, the least node of the buckets
they share most of. After that, of the pairs that share a rare shingle only those are verified that these links left in
different components, and whose prefixes do not differ by more than a link allows. Documents that meet in combinations
are compared block by block, each pair of blocks in a task.

Defined results: null text, empty text and text without a word have an empty set, size 0, and are linked with nothing; a
document of fewer words than a shingle has its whole sequence as the one shingle; rows that repeat a doc_id are documents
of their own; a component of null ids alone has a null id; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import components, forget, mix64, small_batches, stored, texts

FREQUENT = 48  # documents that share a shingle beyond which it is frequent
CROWDED = 16  # times as many documents as make a shingle frequent, in a bucket of one that no task met often enough
MOST_FREQUENT = 1 << 20  # bound on the frequent shingles sent to every task
COUNTED = 6_000_000  # shingles a task counts at a time
FILTER_BITS = 24
BLOCK = 256  # nodes in a block of the comparison by blocks
BASE = 1 << 63


def shingle_sets(found: list[bytes], words: int) -> list[np.ndarray]:
    """Distinct shingle hashes of whole UTF-8 texts, ascending."""
    split = [t.lower().split() for t in found]
    vocabulary = {w: i for i, w in enumerate(set().union(*split))} if split else {}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    out = []
    for tokens in split:
        n = len(tokens)
        h = hashes[np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, n)]
        if n >= words:
            s = h[: n - words + 1].copy()
            for k in range(1, words):
                s = s * np.uint64(0x9E3779B97F4A7C15) + h[k : n - words + 1 + k]
            out.append(np.unique(mix64(s)))
        else:
            s = np.uint64(n)
            for x in h:
                s = np.uint64((int(s) * 0x9E3779B97F4A7C15 + int(x)) % (1 << 64))
            out.append(mix64(np.array([s])) if n else h)
    return out


def node_of(s: np.ndarray) -> int | None:
    """A number for a set; None for an empty one."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - BASE if len(s) else None


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


class Rule:
    """Thresholds in whole numbers: percent of the union that an intersection must reach."""

    def __init__(self, percent: int):
        self.percent = percent

    def least(self, size: int) -> int:
        """Shared shingles that a set of this size needs with any partner."""
        return -(-self.percent * size // 100)

    def links(self, both, a, b):
        return 100 * both >= self.percent * (a + b - both)


def signatures(s: np.ndarray, frequent: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set: single rare shingles, and combinations of frequent ones."""
    n = len(s)
    t = rule.least(n)
    none = np.zeros(0, np.uint64)
    if n < 2:
        return none, none  # links with equal sets only
    at = np.searchsorted(frequent, s)
    often = frequent[np.minimum(at, len(frequent) - 1)] == s if len(frequent) else np.zeros(n, bool)
    rare = s[~often]
    singles = rare[: n - t + 1]
    if len(rare) > n - t:
        return singles, none
    common = s[often]
    made = []
    band = n.bit_length() - 1
    for b in (band, band - 1) if t < 1 << band else (band,):
        g = max(1, (1 << b) >> 4)
        prefix = common[: max(0, len(common) - t + g + 1)]
        group = prefix % np.uint64(g)
        order = np.argsort(group, kind="stable")
        prefix, group = prefix[order], group[order]
        ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1
        for begin, end in zip(np.concatenate(([0], ends[:-1])), ends):
            i, j = np.triu_indices(end - begin, 1)
            part = prefix[begin:end]
            made.append(mix64(part[i] * np.uint64(0xD6E8FEB86659FD93) + part[j] + np.uint64(b)))
    return singles, np.concatenate(made) if made else none


def _described(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: a document (its id, node, size and the hash of its text), and a shingle with how often a task met it."""

    def batch(ids, kind, k, n, t):
        return pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(n), kind, np.int32)), k, pa.array(np.asarray(n, np.int64)), t], ["doc_id", "kind", "k", "n", "t"])

    def run(batches):
        held, size, seen = [], 0, set()

        def counts():
            if held:
                every = np.concatenate(held)
                held.clear()
                seen.clear()
                every.sort()
                # where a run of equal shingles that is longer than one begins and ends
                same = np.concatenate(([False], every[1:] == every[:-1], [False]))
                begin, end = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
                yield batch(pa.nulls(len(begin), kind_of_id), 1, pa.array(signed(every[begin])), end - begin + 1, pa.nulls(len(begin), pa.int64()))

        kind_of_id = pa.int64()
        for got in batches:
            kind_of_id = got.column(0).type
            sets = shingle_sets(texts(got.column(1)), words)
            nodes = [node_of(s) for s in sets]
            yield batch(got.column(0), 0, pa.array(nodes, pa.int64()), [len(s) for s in sets], got.column(2))
            for node, s in zip(nodes, sets):
                if node is not None and node not in seen:
                    seen.add(node)
                    held.append(s)
                    size += len(s)
            if size > COUNTED:
                yield from counts()
                size = 0
        yield from counts()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.withColumn("t", F.xxhash64("text")).mapInArrow(run, f"doc_id {kind}, kind int, k long, n long, t long")


def _index(docs: DataFrame, words: int, rule: Rule, frequent: np.ndarray) -> DataFrame:
    """Signatures of all nodes: sig, node, n (its size), m (its rare prefix), pos (in it), own. A task gives a node once.

    ``own`` is the node for a combination, null for a rare shingle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        seen: set[int] = set()
        for got in batches:
            rows = []
            for s in shingle_sets(texts(got.column(0)), words):
                node = node_of(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                singles, combos = signatures(s, shared.value, rule)
                for sigs, combo in ((singles, False), (combos, True)):
                    if len(sigs):
                        rows.append((sigs, node, len(s), len(singles), combo))
            if len(seen) > 1 << 20:
                seen.clear()
            if rows:
                sizes = [len(r[0]) for r in rows]
                spread = lambda i, kind: pa.array(np.repeat(np.array([r[i] for r in rows], kind), sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate([r[0] for r in rows]))), spread(1, np.int64), spread(2, np.int32), spread(3, np.int32),
                        pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])),
                        pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), sizes), mask=np.repeat(np.array([not r[4] for r in rows]), sizes)),
                    ],
                    ["sig", "node", "n", "m", "pos", "own"],
                )

    return docs.select("text").mapInArrow(run, "sig long, node long, n int, m int, pos int, own long")


def _sets(docs: DataFrame, words: int, nodes: DataFrame, described: DataFrame) -> DataFrame:
    """Sets (node, s) of the wanted nodes, once each.

    A text of each node gives its set; a bit field of fixed size over the hashes of these texts keeps most others from
    being shingled, and their sets from being shuffled.
    """
    one = described.where("kind = 0").groupBy("k").agg(F.min("t").alias("t")).join(nodes, F.col("k") == F.col("node"), "left_semi")
    bit = F.pmod("t", F.lit(1 << FILTER_BITS))
    field = one.select(F.floor(bit / 64).cast("long").alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("bits"))
    got = field.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2 ** 18 rows
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen: set[int] = set()
        for got in batches:
            at = got.column(1).to_numpy() & ((1 << FILTER_BITS) - 1)
            wanted = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            rows = []
            for s in shingle_sets(texts(got.column(0).filter(pa.array(wanted.astype(bool)))), words):
                node = node_of(s)
                if node is not None and node not in seen:
                    seen.add(node)
                    rows.append((node, s.tobytes()))
            if len(seen) > 1 << 20:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["node", "s"])

    # copies of a node from several tasks carry the same bytes; what only the bit field let pass meets no pair
    made = docs.select("text", F.xxhash64("text").alias("t")).mapInArrow(run, "node long, s binary")
    return made.groupBy("node").agg(F.first("s").alias("s"))


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def run(batches):
        for got in batches:
            a, b, sa, sb = (c.to_pylist() for c in got.columns)
            keep = []
            for x, y in zip(sa, sb):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                keep.append(bool(rule.links(int((both[1:] == both[:-1]).sum()), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([got.column(0).filter(pa.array(keep, pa.bool_())), got.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    first = pairs.join(sets.withColumnsRenamed({"node": "a", "s": "sa"}), "a")
    return first.join(sets.withColumnsRenamed({"node": "b", "s": "sb"}), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def block_links(a: list[np.ndarray], b: list[np.ndarray] | None, rule: Rule, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link, between two lists of sets or (``b`` None) within one."""
    whole = a if b is None else a + b
    sizes = np.array([len(s) for s in whole])
    tokens, inverse, counts = np.unique(np.concatenate(whole), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(whole)), sizes)
    # shingles of one set alone add nothing to an intersection
    kept = counts[inverse] > 1
    rank = np.cumsum(counts > 1) - 1
    token, owner = rank[inverse[kept]], owner[kept]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    both = np.zeros((len(a), len(whole) - (0 if b is None else len(a))), np.float32)
    for begin in range(0, int((counts > 1).sum()), columns):
        lo, hi = np.searchsorted(token, (begin, begin + columns))
        m = np.zeros((len(whole), columns), np.float32)
        m[owner[lo:hi], token[lo:hi] - begin] = 1
        both += m[: len(a)] @ (m if b is None else m[len(a) :]).T
    na, nb = sizes[: len(a)], sizes if b is None else sizes[len(a) :]
    i, j = np.nonzero(rule.links(both.astype(np.int64), na[:, None], nb[None, :]))
    return (i[i < j], j[i < j]) if b is None else (i, j)


def _placed(combos: DataFrame) -> DataFrame:
    """Nodes that meet in combinations: the group they form, its number of blocks and the node's own."""
    low = combos.groupBy("sig").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b < c").select("sig", "b")
    edges = combos.join(low, "sig").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    groups = components(edges)
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return groups.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _links_by_blocks(placed: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links among nodes that meet in combinations: each group is compared block by block, in a task for each pair."""
    dealt = placed.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "s")

    def run(table: pa.Table) -> pa.Table:
        own, node = table.column("own").to_numpy(), table.column("node").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("s").to_pylist()]
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        first, second = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        if lo == hi:
            i, j = block_links([sets[k] for k in first], None, rule)
            a, b = node[first][i], node[first][j]
        elif len(first) and len(second):
            i, j = block_links([sets[k] for k in first], [sets[k] for k in second], rule)
            a, b = node[first][i], node[second][j]
        else:
            a = b = np.zeros(0, np.int64)
        return pa.table({"a": forest(a, b)[0], "b": forest(a, b)[1]})

    return dealt.groupBy("component", "lo", "hi").applyInArrow(run, "a long, b long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A part of the links that joins the same nodes."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return a[kept], b[kept]


def join(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    small_batches(spark, rows=500, mb=4)
    rule = Rule(percent)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    described = stored(_described(docs, words), "join-docs")
    rows = described.where("kind = 0").select("doc_id", F.col("k").alias("node"), F.col("n").alias("n_shingles"))

    counted = described.where("kind = 1").groupBy("k").agg(F.sum("n").alias("n"))
    total = described.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counted.where(F.col("n") > max(FREQUENT, total // MOST_FREQUENT)).select("k").toArrow().column(0).to_numpy()
    frequent = np.sort(often.view(np.uint64))
    crowded = CROWDED * max(FREQUENT, total // MOST_FREQUENT)
    while True:
        # Rare shingles: what shares a bucket, and the bucket's least node. The others, most of them, are never written;
        # each combination has a bucket of its own here, and stays.
        bucket = Window.partitionBy("sig", "own")
        single = F.struct("node", "n", "m")
        index = _index(docs, words, rule, frequent).withColumn("lo", F.min(single).over(bucket)).withColumn("hi", F.max("node").over(bucket))
        index = index.where("own is not null or lo.node < hi").select("sig", "node", "n", "m", "pos", "own", "lo")
        index = stored(index.distinct(), "join-index")
        shared = index.where("own is null").drop("own")
        # A shingle spread over so many tasks that none met it twice is counted here, exactly, and is frequent from now on.
        missed = shared.groupBy("sig").count().where(F.col("count") > crowded).select("sig").toArrow().column(0).to_numpy()
        if not len(missed):
            break
        frequent = np.union1d(frequent, missed.view(np.uint64))
        forget(index)
    placed = stored(_placed(index.where("own is not null").select("sig", "node")), "join-blocks")

    # First links: each node with the partner it shares most of its prefix with, where that is half or more of it.
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    star = shared.where((F.col("node") != F.col("lo.node")) & fits("n", "lo.n")).groupBy("node", "lo", "m").agg(F.count("*").alias("c"))
    star = star.where(2 * F.col("c") >= F.least("m", "lo.m")).groupBy("node").agg(F.max_by("lo.node", F.struct("c", "lo.node")).alias("b"))
    star = stored(star.select(F.col("node").alias("a"), "b"), "join-star")
    nodes = lambda pairs: pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = stored(_sets(docs, words, nodes(star).union(placed.select("node")).distinct(), described), "join-sets")
    links = stored(_verified(star, sets, rule).union(_links_by_blocks(placed, sets, rule)), "join-links")
    forget(sets)

    # Pairs of a bucket that these links left in different components.
    known = components(links)
    named = shared.join(known, "node", "left").select("sig", "node", "n", "m", "pos", F.coalesce("component", "node").alias("comp"))
    open_ = named.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("sig")
    left = stored(named.join(open_, "sig"), "join-open")
    x, y = (left.select("sig", F.col("node").alias(k), *[F.col(c).alias(c + k) for c in ("n", "m", "pos", "comp")]) for k in "ab")
    met = x.join(y, "sig").where((F.col("a") < F.col("b")) & (F.col("compa") != F.col("compb")) & fits("na", "nb"))
    met = met.groupBy("a", "b", "na", "nb", "ma", "mb").agg(F.count("*").alias("c"), F.max("posa").alias("i"), F.max("posb").alias("j"))
    # Up to their last common shingle both prefixes are whole, and after it the one that ends first has none in common:
    # what differs there must not be more than a pair that links may differ by.
    both = F.col("na") + F.col("nb")
    apart = both - 2 * F.ceil(percent * both / F.lit(100 + percent) - F.lit(1e-9))
    rest = met.where(F.col("i") + F.col("j") + 2 - 2 * F.col("c") + F.least(F.col("ma") - F.col("i"), F.col("mb") - F.col("j")) - 1 <= apart)
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(rest.select("a", "b").join(tried, ["a", "b"], "left_anti"), "join-rest")
    sets = stored(_sets(docs, words, nodes(rest).distinct(), described), "join-sets")
    final = components(stored(links.union(_verified(rest, sets, rule)), "join-links"))
    forget(sets, index, left)
    smallest = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    at = smallest.join(final, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    ids = at.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = at.join(ids, "component").select("node", "component_id")
    return rows.join(found, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("node").isNull(), F.col("doc_id"))).alias("component_id"))
