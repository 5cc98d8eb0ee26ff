"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: its distinct words hashed to ``WORDS`` indexes with damped counts, and statistics of its
structure (shares of bytes by kind, repetition, word and line lengths, length of the text) and of its metadata (the number
of characters that its row states, and how far that is from the text's own), each as a step among ``STEPS`` levels, so that
pairs of features can interact. The score is

    w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2),

the sum-of-squares form of all pairwise interactions, linear in the number of features of a text.

The machine is fitted on the driver by mini-batch steps from a bounded sample (``TRAIN_ROWS`` labelled documents, whole
texts, chosen by a hash of the id); only their vectors leave the executors. Scoring is one pass over all documents without
a shuffle.

Defined results: null text counts as empty and both are scored; a number of characters that is null, or a column that is
not there, is a level of its own; without labels every score is 0.5; repeated rows get
equal scores; a null id or null label is never learned from; other columns pass by.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import small_batches, texts

WORDS = 1 << 16
STEPS = 24
RANK = 8
TRAIN_ROWS = 6000

_KIND = np.zeros(256, np.int64)  # 0 other controls, 1 space, 2 line end, 3 digit, 4 upper, 5 lower, 6 punctuation, 7 symbol, 8 beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 8 if _b >= 128 else 1 if _c in " \t" else 2 if _c in "\r\n" else 3 if _c.isdigit() else 4 if _c.isupper() else 5 if _c.islower() else 6 if _c in ".,;:'\"-()?" else 7 if _b > 32 else 0

STATS = (
    "space", "line", "digit", "upper", "punctuation", "symbol", "beyond", "distinct", "top_word", "top_pair", "word_length",
    "long_words", "symbol_words", "upper_words", "same_lines", "line_length", "words", "bytes", "first_letter",
    "stated", "stated_apart",
)
DIM = WORDS + STEPS * len(STATS)


def features(text: bytes, stated: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a whole UTF-8 text, and of the number of characters that its row states."""
    words = text.lower().split()
    n, size = len(words), len(text)
    counts = Counter(words)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=9) if size else np.zeros(9, int)
    share = kinds / max(size, 1)
    lines = text.split(b"\n")
    sample = text.split()
    pairs = Counter(zip(words[::2], words[1::2]))
    stats = (
        share[1], share[2] * 20, share[3] * 5, share[4], share[6] * 4, share[7] * 4, share[8],
        len(counts) / max(n, 1), max(counts.values(), default=0) / max(n, 1) * 2, max(pairs.values(), default=0) / max(len(words) // 2, 1) * 4,
        sum(map(len, words)) / max(n, 1) / 20, sum(len(w) > 12 for w in words) / max(n, 1) * 2,
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in sample) / max(n, 1), sum(w.isupper() for w in sample) / max(n, 1),
        1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)) / 10, np.log1p(n) / 10, np.log1p(size) / 14,
        float(text[:1].isupper()),
        # level 0 is kept for rows that state nothing
        0.0 if stated is None else 0.05 + np.log1p(max(stated, 0)) / 15,
        0.0 if stated is None else 0.05 + abs(stated - len(text.decode("utf-8", "replace"))) / (abs(stated) + size + 1),
    )
    level = np.clip((np.array(stats) * STEPS).astype(int), 0, STEPS - 1)
    hashed = np.fromiter((zlib.crc32(w) & (WORDS - 1) for w in counts), np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    values /= max(np.linalg.norm(values), 1e-9)
    at = np.concatenate((hashed, WORDS + STEPS * np.arange(len(STATS)) + level))
    return at, np.concatenate((values, np.full(len(STATS), 1 / np.sqrt(len(STATS)))))


class Machine:
    """Weights of the factorisation machine."""

    def __init__(self, prior: float = 0.0):
        rng = np.random.default_rng(1)
        self.w0, self.w, self.v = prior, np.zeros(DIM), rng.normal(0, 0.02, (DIM, RANK))

    def raw(self, at: np.ndarray, x: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic of texts laid end to end, and the sums per factor that their gradient needs."""
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, begins)
        squares = np.add.reduceat((vx * vx).sum(axis=1), begins)
        return self.w0 + np.add.reduceat(self.w[at] * x, begins) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, at: np.ndarray, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(at, x, begins)[0], -40, 40)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.15, decay: float = 1e-4) -> Machine:
    """Logistic loss by mini-batch steps scaled per weight; both labels weigh as they occur."""
    if not len(labels):
        m = Machine()
        m.v[:] = 0
        return m
    p = np.clip(labels.mean(), 0.01, 0.99)
    m = Machine(float(np.log(p / (1 - p))))
    gw, gv, g0 = np.full(DIM, 1e-6), np.full((DIM, RANK), 1e-6), 1e-6
    rng = np.random.default_rng(2)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            at = np.concatenate([rows[i][0] for i in part])
            x = np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            raw, sums = m.raw(at, x, begins)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[part]) / len(part)
            e = np.repeat(error, sizes)
            used, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, e * x, len(used)) + decay * m.w[used]
            per = (e * x)[:, None] * (np.repeat(sums, sizes, axis=0) - m.v[at] * x[:, None])
            dv = np.stack([np.bincount(inverse, per[:, f], len(used)) for f in range(RANK)], axis=1) + decay * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            g0 += error.sum() ** 2
            m.w[used] -= rate * dw / np.sqrt(gw[used])
            m.v[used] -= rate * 0.5 * dv / np.sqrt(gv[used])
            m.w0 -= rate * error.sum() / np.sqrt(g0)
    return m


def _read(docs: DataFrame, id_col: str, text_col: str, chars_col: str, *more) -> DataFrame:
    stated = F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), stated.alias("stated"), *more)


def fit(labelled: DataFrame, id_col="doc_id", text_col="text", label_col="quality", rows: int = TRAIN_ROWS, chars_col="n_chars") -> Machine:
    """Learn from the ``rows`` rows of ``labelled`` with the smallest hash of their id; features are made on the executors.

    The hash below which they lie is found from the ids alone, so that no text moves.
    """
    small_batches(labelled.sparkSession)
    order = F.xxhash64(F.lit(5), id_col)
    data = _read(labelled, id_col, text_col, chars_col, F.col(label_col).cast("double").alias("label"), order.alias("h")).where("label is not null")
    last = data.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    sample = data.where(F.col("h") <= (last if last is not None else 0)).select("label", "text", "stated", "h")

    def made(batches):
        for batch in batches:
            found = [features(t, n) for t, n in zip(texts(batch.column(1)), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()), pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary()), batch.column(3)],
                ["label", "at", "x", "h"],
            )

    # rows that repeat an id share its hash: the limit holds for them as well
    got = sorted(sample.mapInArrow(made, "label double, at binary, x binary, h long").limit(rows).collect(), key=lambda r: (r.h, r.label, bytes(r["at"])))
    return train(
        [(np.frombuffer(r["at"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(np.float64)) for r in got],
        np.array([r.label for r in got], float),
    )


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """Per document: doc_id and its score from 0 to 1."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = shared.value
        for batch in batches:
            found = [features(t, n) for t, n in zip(texts(batch.column(1)), batch.column(2).to_pylist())]
            scores = np.zeros(0)
            if found:
                begins = np.concatenate(([0], np.cumsum([len(a) for a, _ in found])[:-1]))
                scores = m.score(np.concatenate([a for a, _ in found]), np.concatenate([x for _, x in found]), begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _read(docs, id_col, text_col, chars_col).mapInArrow(run, f"doc_id {kind}, score double")
