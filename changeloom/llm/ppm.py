"""Language-model scoring by prediction by partial matching over bytes, beside a smoothed word model.

The model is a byte-context trie of depth ``DEPTH``, learned from every training text. A text's bytes and a closing byte
are predicted in turn: from the longest context that was seen, with the share ``q / (n + q)`` left to escape to the next
shorter one (``n`` occurrences of ``q`` different symbols), and with the symbols of longer contexts excluded from the
shorter ones. All counts are exact, in a written table that grows with the corpus: a row is a place, that is a context of
``DEPTH`` bytes and a symbol. Its key starts with the bytes next to the symbol, so that places of one shorter context lie
together: dealt by their last three bytes of context, a task has all it needs beside the counts of depth two (at most
``2 ** 24`` whatever the corpus) to give each place its probability. The ``HEAVY`` places met most at most are sent to
every task; the others of a text meet their probabilities in a join.

The word model counts words exactly. Words with at least one in ``HEAVY`` tokens, at most ``HEAVY`` of them, are sent to
every task; the others of a text meet their counts in a join. Words are told apart by a 64-bit hash.

Defined results: null text counts as empty: the closing token and byte alone; a null id is not held out and not learned
from; rows that repeat (doc_id, text) give the same row again; without training texts every byte has probability 1/256
and the word model is what its formula gives for N = V = 0; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import small_batches, stored, texts

HEAVY = 1_000_000
END = 0xFF  # never part of UTF-8: closes a text and stands before its first byte
WORD, PLACE, WHOLE = 0, 1, 2  # kinds of rows: a word, a symbol after DEPTH bytes, a document
DEPTH = 5  # bytes of context; a place takes 8 * (DEPTH + 1) bits of a long
BLOCK = 1 << 20  # places that are given probabilities at a time, and more where three bytes of context have more
SMOOTH = 0.1


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


CLOSING = word_hash(b"")  # no word is empty: the hash of the closing token


def stream(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (three bytes) and symbols of all predicted places of texts laid end to end, and each text's first place."""
    gap = bytes([END] * 3)
    raw = np.frombuffer(gap + gap.join(found) + gap, np.uint8)
    sizes = np.array([len(t) for t in found], np.int64)
    begins = 3 + np.concatenate(([0], np.cumsum(sizes + 3)[:-1])) if len(found) else np.zeros(0, np.int64)
    use = np.ones(len(raw), bool)
    use[:3] = False
    for k in (1, 2):  # the first byte of a gap closes a text, the others are not predicted
        use[begins + sizes + k] = False
    use = use[3:]
    wide = raw.astype(np.uint32)
    context = (wide[:-3] << np.uint32(16) | wide[1:-2] << np.uint32(8) | wide[2:-1])[use]
    return context, raw[3:][use], np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(found) else np.zeros(0, np.int64)


def places(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all predicted places of texts laid end to end, and each text's first place.

    From the top, a key has the context from its last byte to its first, and then the symbol.
    """
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = bytes([END] * DEPTH)
    raw = np.frombuffer(gap + gap.join(found) + gap, np.uint8).astype(np.int64)
    sizes = np.array([len(t) for t in found], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + DEPTH)[:-1]))
    n = len(raw) - DEPTH
    key = raw[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        key |= raw[DEPTH - k : DEPTH - k + n] << (8 * (DEPTH + 1 - k))
    use = np.ones(n, bool)
    for k in range(1, DEPTH):  # the first byte of a gap closes a text, the others are not predicted
        use[begins + sizes + k] = False
    return key[use], np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))


class Low:
    """Exact counts after two bytes, one and none, from sorted keys (last byte, the one before, symbol)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, counts = keys, counts.astype(np.float64)
        self.counts = [None, None, counts]
        context, symbol = keys >> 8, keys & 255
        self.counts[1] = np.bincount((keys >> 16) << 8 | symbol, counts, 1 << 16)
        self.counts[0] = np.bincount(symbol, counts, 1 << 8)
        one = np.flatnonzero(self.counts[1])
        self.n = [self.counts[0].sum(keepdims=True), np.bincount(one >> 8, self.counts[1][one], 1 << 8), np.bincount(context, counts, 1 << 16)]
        self.q = [np.array([(self.counts[0] > 0).sum()]), np.bincount(one >> 8, minlength=1 << 8), np.bincount(context, minlength=1 << 16)]
        # what the symbols of a context count in the next shorter one
        self.m = [None, np.bincount(one >> 8, self.counts[0][one & 255], 1 << 8), np.bincount(context, self.counts[1][(keys >> 16) << 8 | symbol], 1 << 16)]

    def count(self, depth: int, entry: np.ndarray) -> np.ndarray:
        if depth < 2:
            return self.counts[depth][entry]
        if not len(self.keys):
            return np.zeros(len(entry))
        at = np.minimum(np.searchsorted(self.keys, entry), len(self.keys) - 1)
        return np.where(self.keys[at] == entry, self.counts[2][at], 0.0)


def log_probabilities(key: np.ndarray, n: np.ndarray, low: Low) -> np.ndarray:
    """log10 probability of places, ascending and once each, with their counts in the training texts.

    All training places that share the last three bytes of context with one of them must be among them. What was seen
    after a context was also seen after each shorter one, so the symbols to exclude are those of the next longer context.
    """
    symbol = key & 255
    deep = {}
    for depth in range(DEPTH, 2, -1):
        entry, of = np.unique(key >> 8 * (DEPTH - depth + 1) << 8 | symbol, return_inverse=True)
        _, context = np.unique(entry >> 8, return_inverse=True)
        deep[depth] = entry, of, context, np.bincount(of, n, len(entry))
    out, done = np.zeros(len(key)), np.zeros(len(key), bool)
    longer_q = longer_m = 0
    for depth in range(DEPTH, -1, -1):
        if depth > 2:
            entry, of, context, counts = deep[depth]
            shorter = entry >> 16 << 8 | entry & 255
            above = low.count(2, shorter) if depth == 3 else deep[depth - 1][3][np.searchsorted(deep[depth - 1][0], shorter)]
            sums = (np.bincount(context, w)[context[of]] for w in (counts, counts > 0, np.where(counts > 0, above, 0)))
            count, (total, q, m) = counts[of], sums
        else:
            at = key >> 8 * (DEPTH - depth + 1)
            count, total, q = low.count(depth, at << 8 | symbol), low.n[depth][at], low.q[depth][at]
            m = low.m[depth][at] if depth else None
        left, kinds = total - longer_m, q - longer_q
        escape = np.where(q == 256, 0, kinds)
        hit = ~done & (count > 0)
        out[hit] += np.log10(count[hit] / (left + escape)[hit])
        done |= hit
        miss = ~done & (kinds > 0)
        out[miss] += np.log10(escape[miss] / (left + escape)[miss])
        longer_q, longer_m = q, m
    out[~done] -= np.log10(256 - longer_q[~done])
    return out


def slot(context: np.ndarray) -> np.ndarray:
    """Key of a context of three bytes: itself."""
    return context


class Trie:
    """The rule of prediction for three bytes in one process, a context at a time, as a measure for the table of places.

    Counts by sorted key; distributions are made once per context and kept until the worker's table is full.
    """

    KEPT = 1 << 15

    def __init__(self, pair: tuple[np.ndarray, np.ndarray], triple: tuple[np.ndarray, np.ndarray]):
        self.pair, self.triple = pair, triple
        last = np.zeros((256, 256))
        np.add.at(last, ((pair[0] >> 8) & 255, pair[0] & 255), pair[1])
        self.one, self.zero = last, last.sum(axis=0)
        self.rows = self.where = None

    def __getstate__(self):
        return self.__dict__ | {"rows": None, "where": None}

    @staticmethod
    def _counts(table: tuple[np.ndarray, np.ndarray], context: int) -> np.ndarray:
        keys, n = table
        a, b = np.searchsorted(keys, (context << 8, (context + 1) << 8))
        out = np.zeros(256)
        out[keys[a:b] & 255] = n[a:b]
        return out

    def distribution(self, context: int) -> np.ndarray:
        """log10 probability of every symbol after three bytes."""
        p, seen, left = np.zeros(256), np.zeros(256, bool), 1.0
        orders = (
            lambda: self._counts(self.triple, int(slot(np.array([context], np.uint32))[0])), lambda: self._counts(self.pair, context & 0xFFFF),
            lambda: self.one[context & 0xFF], lambda: self.zero,
        )
        for counts in orders:
            c = np.where(seen, 0.0, counts())
            here = c > 0
            q, n = here.sum(), c.sum()
            if not q:
                continue
            escape = 0 if q + seen.sum() == 256 else q
            p[here] = left * c[here] / (n + escape)
            left *= escape / (n + escape)
            seen |= here
        if not seen.all():
            p[~seen] = left / (~seen).sum()
        return np.log10(p)

    def score(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability at every place."""
        if self.rows is None:
            self.rows, self.where, self.kept = np.zeros((self.KEPT, 256), np.float32), np.full(1 << 24, -1, np.int32), 0
        at = self.where[context]
        if (at < 0).any():
            new = np.unique(context[at < 0])
            if self.kept + len(new) > self.KEPT:
                self.where[:] = -1
                self.kept = 0
                new = np.unique(context)
            if len(new) > self.KEPT:  # more contexts in one call than the table holds: in two parts
                half = len(context) // 2
                return np.concatenate((self.score(context[:half], symbol[:half]), self.score(context[half:], symbol[half:])))
            for c in new:
                self.rows[self.kept] = self.distribution(int(c))
                self.where[c] = self.kept
                self.kept += 1
            at = self.where[context]
        return self.rows[at, symbol].astype(np.float64)


def _unique(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    found, inverse = np.unique(k, return_inverse=True)
    return found, np.bincount(inverse, n, len(found)).astype(np.int64)


def counted(docs: DataFrame, learned: F.Column, text_col: str = "text", words_kept: int = 300_000) -> DataFrame:
    """Counts of words and places: kind, k, n (in training texts), m (in all). A word of other texts alone has no row.

    A task adds up what it can hold before the counts are shuffled.
    """
    small_batches(docs.sparkSession)

    def out(kind, k, n, m):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(k), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (k, n, m))], ["kind", "k", "n", "m"]
        )

    def spill(words):
        n = np.fromiter(words.values(), np.int64, len(words))
        yield out(WORD, np.fromiter(map(word_hash, words), np.int64, len(words)), n, n)
        words.clear()

    def run(batches):
        words: Counter = Counter()
        keys, counts = [], []

        def met(k, n):  # the lowest bit tells training texts
            return out(PLACE, k >> 1, n * (k & 1), n)

        for batch in batches:
            found = texts(batch.column(0))
            trains = batch.column(1).to_pylist()
            training = [t for t, yes in zip(found, trains) if yes]
            if training:
                words.update(b"\n".join(training).lower().split())
                words[b""] += len(training)
            if len(words) > words_kept:
                yield from spill(words)
            for part, bit in ((training, 1), ([t for t, yes in zip(found, trains) if not yes], 0)):
                if part:
                    k, n = np.unique(places(part)[0], return_counts=True)
                    keys.append(k << 1 | bit)
                    counts.append(n)
            if sum(map(len, keys)) > 1 << 21:
                k, n = _unique(keys, counts)
                keys, counts = [k], [n]
                if len(k) > 1 << 20:
                    yield met(k, n)
                    keys, counts = [], []
        yield from spill(words)
        if keys:
            yield met(*_unique(keys, counts))

    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    return rows.mapInArrow(run, "kind int, k long, n long, m long").groupBy("kind", "k").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def scored_places(counts: DataFrame) -> DataFrame:
    """Every place with its occurrences and log10 probability: k, m, v."""
    spark = counts.sparkSession
    met = counts.where(F.col("kind") == PLACE)
    pair = F.shiftright("k", 8 * (DEPTH - 2)).bitwiseAND(0xFFFF00).bitwiseOR(F.col("k").bitwiseAND(255))
    got = met.where("n > 0").groupBy(pair.alias("k")).agg(F.sum("n").alias("n")).toArrow()  # at most 2 ** 24 rows
    k, n = got.column(0).to_numpy(), got.column(1).to_numpy()
    order = np.argsort(k)
    shared = spark.sparkContext.broadcast(Low(k[order], n[order]))
    near = 8 * (DEPTH - 2)

    def run(batches):
        def out(k, n, m):
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(m), pa.array(log_probabilities(k, n, shared.value))], ["k", "m", "v"])

        held, size = [], 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size > BLOCK:
                k, n, m = (np.concatenate(x) for x in zip(*held))
                end = np.searchsorted(k, k[-1] >> near << near)  # the last three bytes may go on
                if end:
                    yield out(k[:end], n[:end], m[:end])
                held, size = [[k[end:], n[end:], m[end:]]], len(k) - end
        if size:
            yield out(*(np.concatenate(x) for x in zip(*held)))

    dealt = met.select("k", "n", "m").repartition(F.shiftright("k", near)).sortWithinPartitions("k")
    return dealt.mapInArrow(run, "k long, m long, v double")


def most_met(places: DataFrame, bound: int) -> DataFrame:
    """The places met most, at most ``bound`` of them: those of the highest classes of occurrences that fit whole."""
    level = F.floor(8 * F.log2("m"))
    sizes, least, taken = places.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect(), None, 0
    for r in sizes:
        taken += r["count"]
        if taken > bound:
            break
        least = r.level
    return places.withColumn("heavy", level >= (least if least is not None else 1 << 20))


def score(docs: DataFrame, learned: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score of the word model and score of the places.

    ``learned`` tells which rows are training texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    counts = stored(counted(docs, learned, text_col), "ppm-counts")
    words = counts.where(F.col("kind") == WORD)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    norm = total + SMOOTH * (distinct + 1)
    heavy = words.where(F.col("n") * HEAVY >= total).select("k", "n").toArrow()
    heavy_k, heavy_n = heavy.column(0).to_numpy(), heavy.column(1).to_numpy()
    order = np.argsort(heavy_k)
    scored = most_met(stored(scored_places(counts), "ppm-places"), HEAVY)
    often = scored.where("heavy").select("k", "v").toArrow()
    often_k, often_v = often.column(0).to_numpy(), often.column(1).to_numpy()
    by_key = np.argsort(often_k)
    shared = spark.sparkContext.broadcast((often_k[by_key], often_v[by_key], heavy_k[order], heavy_n[order]))
    kind_of_id = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind_of_id}, tkey long, kind int, h long, n long, known long, base double, score double"
    names = [f.split()[0] for f in schema.split(", ")]

    def batch_rows(ids, found, pk, pv, hk, hn):
        split = [t.lower().split() for t in found]
        vocabulary = {w: i for i, w in enumerate(set().union(*split))}
        hashes = np.fromiter(map(word_hash, vocabulary), np.int64, len(vocabulary))
        hashes = np.append(hashes, CLOSING)
        at = np.searchsorted(hk, hashes)
        here = np.zeros(len(hashes), bool)
        if len(hk):
            here = hk[np.minimum(at, len(hk) - 1)] == hashes
        logs = np.zeros(len(hashes))
        logs[here] = np.log10((hn[at[here]] + SMOOTH) / norm)
        sizes = np.array([len(w) for w in split], np.int64) + 1
        closing = len(vocabulary)
        tokens = np.fromiter((i for w in split for i in (*map(vocabulary.__getitem__, w), closing)), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(split)), sizes)
        known = here[tokens]
        base = np.bincount(doc, np.where(known, logs[tokens], 0.0), len(split))
        n_known = np.bincount(doc, known, len(split)).astype(np.int64)
        pairs, times = np.unique(doc[~known] * (closing + 1) + tokens[~known], return_counts=True)
        rare_doc, rare_token = np.divmod(pairs, closing + 1)
        key, begins = places(found)
        each, back = np.unique(key, return_inverse=True)
        here = np.zeros(len(each), bool)
        logs = np.zeros(len(each))
        if len(pk):
            at = np.minimum(np.searchsorted(pk, each), len(pk) - 1)
            here = pk[at] == each
            logs[here] = pv[at[here]]
        ppm = np.add.reduceat(logs[back], begins)
        doc = np.repeat(np.arange(len(found)), np.diff(np.append(begins, len(key))))
        far = ~here[back]
        pairs, met = np.unique(doc[far] * len(each) + back[far], return_counts=True)
        far_doc, far_place = np.divmod(pairs, len(each))
        keys = np.fromiter((xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in found), np.int64, len(found))
        n, r = len(found), len(rare_doc) + len(far_doc)
        take = np.concatenate((np.arange(n), rare_doc, far_doc))
        kind = np.repeat(np.array([WHOLE, WORD, PLACE], np.int32), (n, len(rare_doc), len(far_doc)))
        filled = lambda a, kind: pa.array(np.concatenate((a, np.zeros(r, a.dtype))), kind, mask=np.arange(n + r) >= n)
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(take)), pa.array(keys[take]), pa.array(kind),
                pa.array(np.concatenate((keys, hashes[rare_token], each[far_place]))), pa.array(np.concatenate((sizes, times, met)).astype(np.int64)),
                filled(n_known, pa.int64()), filled(base, pa.float64()), filled(ppm, pa.float64()),
            ], names,
        )

    def run(batches):
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                yield batch_rows(batch.column(0), texts(batch.column(1)), *model)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    # Rare words and places meet what is known of them; a document's own row is spread by its key and meets none.
    rare = words.where(F.col("n") * HEAVY < total).select(F.lit(WORD).alias("kind"), F.col("k").alias("h"), F.log10((F.col("n") + SMOOTH) / F.lit(norm)).alias("v"))
    rare = rare.union(scored.where("not heavy").select(F.lit(PLACE), "k", "v"))
    met = rows.join(rare, ["kind", "h"], "left")
    whole, word = F.col("kind") == WHOLE, F.col("kind") == WORD
    summed = met.groupBy("doc_id", "tkey").agg(
        F.count_if(whole).alias("copies"), F.sum(F.when(whole, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(whole, F.col("known")).when(word & F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(whole, F.col("base")).when(word, F.col("n") * F.coalesce("v", F.log10(F.lit(SMOOTH / norm)))).otherwise(0.0)).alias("base_score"),
        F.max("score").alias("score"), F.sum(F.when(F.col("kind") == PLACE, F.col("n") * F.col("v")).otherwise(0.0)).alias("far"),
    )
    each = summed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        "doc_id", (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"), (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") + F.col("far") / F.col("copies")).alias("score"),
    )
