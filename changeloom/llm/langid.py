"""Language ID by hierarchical discrimination: first the family, then the language within it.

A text is lower-cased and its letters are kept; byte pairs and triples of the UTF-8 form are hashed to counts, whose
square roots are scaled to length one. Linear support vector machines, one versus one, vote on the family; within a
family those of its languages vote. Families are a parameter; where none are given they are learned: languages whose
mean vectors are alike are joined until the stated number of families is left.

The machines are fitted on the driver from a bounded sample (about ``TRAIN_PER_LANG`` texts a language and ``TRAIN_ROWS``
in all, whole texts, chosen by a hash of the id). Where the languages have more, each gets the same quota, and those with
fewer texts than the quota give all of them, whatever the size of the others. Scoring is one pass over all documents without a shuffle.

Defined results: null text, empty text and text without a letter are ``und`` with score 0; without any labelled text
every text is ``und``; with one language every text with a letter gets it with score 1; repeated rows get equal
results; a null id or null lang is never learned from; other columns pass through.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import small_batches

DIM = 4096
TRAIN_PER_LANG = 800
TRAIN_ROWS = 4000
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Bytes that are letters or part of one: a-z and everything beyond ASCII.
KEPT = np.array([chr(b) in "abcdefghijklmnopqrstuvwxyz" or b >= 0x80 for b in range(256)])


def vector(text: str | None) -> np.ndarray | None:
    """Hashed byte pairs and triples of a whole text, or None where it has no letter."""
    if not text or not LETTER.search(text):
        return None
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    keep = KEPT[raw]
    # every run of other characters becomes one space, and the text stands between spaces
    first = keep.copy()
    first[1:] |= keep[:-1]
    a = np.concatenate(([32], np.where(keep, raw, 32)[first], [32])).astype(np.uint32)
    pair = a[:-1] << np.uint32(8) | a[1:]
    triple = pair[:-1] << np.uint32(8) | a[2:]
    counts = np.bincount((pair * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=DIM)
    counts += np.bincount((triple * np.uint32(0x85EBCA6B)) >> np.uint32(20), minlength=DIM)
    out = np.sqrt(counts, dtype=np.float32)
    return out / np.linalg.norm(out)


def _svm(x: np.ndarray, y: np.ndarray, lam: float = 1e-4, epochs: int = 12, batch: int = 64) -> tuple[np.ndarray, float]:
    """Linear machine by mini-batch subgradient steps on the hinge loss, classes weighed equally; the average iterate."""
    rng = np.random.default_rng(0)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    mean_w, mean_b, steps = np.zeros_like(w), 0.0, 0
    share = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)).astype(np.float32)
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            steps += 1
            rate = 1.0 / (lam * (steps + 100))
            margin = y[rows] * (x[rows] @ w + b)
            push = (margin < 1) * y[rows] * share[rows] / len(rows)
            w = (1 - rate * lam) * w + rate * 0.05 * (push @ x[rows])
            b += rate * 0.05 * 0.01 * float(push.sum())
            if epoch >= epochs // 2:
                mean_w += w
                mean_b += b
    n = max(1, steps - steps * (epochs // 2) // epochs)
    return mean_w / n, mean_b / n


class Votes:
    """One-versus-one machines over groups of classes; a softmax of the summed margins gives each group's share."""

    def __init__(self, x: np.ndarray, y: np.ndarray, names: list):
        self.names = names
        self.pairs = list(combinations(range(len(names)), 2))
        fits = []
        for i, j in self.pairs:
            rows = (y == i) | (y == j)
            fits.append(_svm(x[rows], np.where(y[rows] == i, 1.0, -1.0).astype(np.float32)))
        self.w = np.stack([w for w, _ in fits]) if fits else np.zeros((0, x.shape[1]), np.float32)
        self.b = np.array([b for _, b in fits], np.float32)

    def shares(self, x: np.ndarray) -> np.ndarray:
        margins = np.clip(x @ self.w.T + self.b, -1.5, 1.5)
        sums = np.zeros((len(x), len(self.names)))
        for k, (i, j) in enumerate(self.pairs):
            sums[:, i] += margins[:, k]
            sums[:, j] -= margins[:, k]
        e = np.exp(3 * (sums - sums.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)


def learned_families(means: dict[str, np.ndarray], n: int) -> list[list[str]]:
    """Languages joined by the likeness of their mean vectors (average linkage) until ``n`` families are left."""
    groups = [[k] for k in sorted(means)]
    like = lambda a, b: np.mean([means[i] @ means[j] for i in a for j in b])
    while len(groups) > n:
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: like(groups[p[0]], groups[p[1]]))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


class Model:
    """Families, the machines between them, and the machines within each."""

    def __init__(self, x: np.ndarray, langs: list[str], families: list[list[str]] | None = None):
        known = sorted(set(langs))
        langs = np.array(langs, dtype=object)
        if families is None:
            means = {k: x[langs == k].mean(axis=0) for k in known}
            centre = np.mean(list(means.values()), axis=0) if means else 0
            families = learned_families({k: (v - centre) / (np.linalg.norm(v - centre) + 1e-12) for k, v in means.items()}, max(1, round(len(known) ** 0.5)))
        else:
            listed = {k for f in families for k in f}
            families = [[k for k in f if k in known] for f in families] + [[k] for k in known if k not in listed]
            families = [f for f in families if f]
        self.families = families
        of = {k: i for i, f in enumerate(families) for k in f}
        y = np.array([of[k] for k in langs], dtype=int)
        self.outer = Votes(x, y, families)
        self.inner = []
        for i, family in enumerate(families):
            rows = y == i
            self.inner.append(Votes(x[rows], np.array([family.index(k) for k in langs[rows]], dtype=int), family))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        outer = self.outer.shares(x)
        best = outer.argmax(axis=1)
        names, score = np.empty(len(x), dtype=object), outer.max(axis=1)
        for i, votes in enumerate(self.inner):
            rows = np.flatnonzero(best == i)
            if len(rows):
                shares = votes.shares(x[rows])
                names[rows] = np.array(votes.names, dtype=object)[shares.argmax(axis=1)]
                score[rows] *= shares.max(axis=1)
        return list(names), score


def quota(counts: list[int], per_lang: int, rows: int) -> float:
    """Texts a language gives at most: ``per_lang``, or what makes ``rows`` in all where languages with fewer give theirs."""
    left = rows
    for i, n in enumerate(sorted(counts)):
        share = left / (len(counts) - i)
        if n > share:
            return min(per_lang, share)
        left -= n
    return per_lang


def fit(labelled: DataFrame, families: list[list[str]] | None = None, id_col="doc_id", text_col="text", lang_col="lang",
        per_lang: int = TRAIN_PER_LANG, rows: int = TRAIN_ROWS) -> Model:
    """Learn from a bounded sample of ``labelled``; its vectors are made on the executors."""
    small_batches(labelled.sparkSession)
    data = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    chance = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) / (1 << 30)
    # a language is thinned to about its quota by a hash, so that no language is gathered anywhere
    counts = {r[0]: r[1] for r in data.groupBy("lang").count().orderBy(F.desc("count")).limit(max(1, rows)).collect()}
    if not counts:
        return Model(np.zeros((0, DIM), np.float32), [])
    most = quota(list(counts.values()), per_lang, rows)
    rate = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, most / n))])[F.col("lang")]
    # languages that give all their texts come first; what is over the limit goes from the others evenly
    sample = data.where(chance < rate).orderBy(rate < 1, chance / rate, "id").limit(rows).select("lang", "text")

    def vectors(batches):
        for batch in batches:
            kept = [(lang, v) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (v := vector(text)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in kept], pa.string()), pa.array([v.astype(np.float16).tobytes() for _, v in kept], pa.binary())], ["lang", "v"]
            )

    got = sample.mapInArrow(vectors, "lang string, v binary").collect()
    x = np.zeros((len(got), DIM), np.float32)
    for i, r in enumerate(got):
        x[i] = np.frombuffer(r.v, np.float16)
    return Model(x, [r.lang for r in got], families)


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted language and a score from 0 to 1; columns of these names go."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (lang_out, score_out)]
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    source = docs.select(*[F.col(c) for c in kept], F.col(text_col).alias("__text"))

    def run(batches):
        m = shared.value
        for batch in batches:
            found = batch.column(batch.num_columns - 1).to_pylist()
            names, scores = [UNKNOWN] * len(found), np.zeros(len(found))
            for at in range(0, len(found), 256):
                vectors = [(i, v) for i in range(at, min(at + 256, len(found))) if (v := vector(found[i])) is not None]
                if vectors:
                    langs, s = m.predict(np.stack([v for _, v in vectors]))
                    for (i, _), lang, score in zip(vectors, langs, s):
                        names[i], scores[i] = lang, score
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [f.name for f in schema])

    return source.mapInArrow(run, schema)
