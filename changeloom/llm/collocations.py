"""Phrase collocations by SON partitioning: phrases of two to four words that come together more often than apart.

The corpus is cut into shards of whole documents, each a written chunk of word numbers. A shard is mined completely in one
task, language by language, at a support lowered in proportion to its bytes: a phrase whose count times the bytes of all
shards reaches the support times the bytes of this shard is locally frequent. Whatever is frequent in the corpus is so in
some shard. The union of the locally frequent phrases is then counted in all shards exactly, and those below the support
go.

Lengths are mined one after the other, and a shard looks only at phrases whose two parts, without the last and without the
first word, can be frequent in the corpus. A phrase can be if what the shards reported of it, and the local support less
one of every shard that did not report it, add up to the support. The phrases that can be reach the tasks as a bit table of
their hashes, of a size that is bounded however many they are. A phrase that only shares its bits with a candidate is
looked at as well, and counted exactly at the end, where it cannot reach the support. So no join is needed, and neither the
table's size nor the number of shards ever changes a result. With more shards than the support, every phrase of a shard is
locally frequent: the support of thirty is a number of occurrences, whatever the size of the corpus.

Defined results: null text is empty, a null language is ``und``; texts without words give nothing; rows that repeat are
documents of their own; languages with no phrase that often have no row; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.chunks import chunked, unpacked
from changeloom.llm.common import forget, mix64, stored, texts

LONGEST = 4
SHARD = 4 << 20  # bytes of text after which a shard ends
TABLE = 1 << 26  # bits of the candidates' table, at most
EMIT = 10_000

# What ends a piece, and how pieces are split into words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAKS = bytes.maketrans(ENDS + b"\t", b"." * len(ENDS) + b" ")


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, with a full stop for each end of a piece."""
    return [word for word in text.lower().translate(_BREAKS).replace(b".", b" . ").split(b" ") if word]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the number of each given value among them, and how often each comes."""
    order = np.argsort(values)
    values = values[order]
    first = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    numbers = np.empty(len(values), np.int32)
    numbers[order] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    begin = np.flatnonzero(first)
    return values[begin], numbers, np.diff(np.append(begin, len(values)))


class Shard:
    """Documents of one language as word numbers; the end of a piece is number 0."""

    def __init__(self, words: list[bytes], ids: np.ndarray):
        self.words, self.ids = words, ids
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def levels(self, upto: int, keep) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each length up to ``upto``: the word numbers of the phrases kept, how often they occur, and their hashes.

        ``keep(length, counts, hashes)`` tells which phrases stay. A phrase is looked at only if both its parts stayed.
        """
        start = np.flatnonzero(self.ids).astype(np.int32)  # where phrases of this length begin
        code = self.ids[start]  # which phrase of this length
        n, hashes = np.bincount(code, minlength=len(self.words)), self.hashes
        phrases = np.arange(len(self.words), dtype=np.int32)[:, None]
        stay = (n > 0) & keep(1, n, hashes)
        phrases, n, hashes = phrases[stay], n[stay], hashes[stay]
        for length in range(1, upto + 1):
            yield phrases, n, hashes
            if length == upto or not len(phrases):
                return
            renamed = np.cumsum(stay, dtype=np.int32) - np.int32(1)
            here = stay[code]
            start, code = start[here], renamed[code[here]]
            # a phrase and the one that begins a word later make one that is a word longer
            follows = np.flatnonzero(np.diff(start) == 1)
            pair = code[follows].astype(np.int64) * len(phrases) + code[follows + 1]
            start = start[follows]
            pair, code, n = _numbered(pair)
            left, last = (pair // len(phrases)).astype(np.int32), phrases[(pair % len(phrases)).astype(np.int32), -1]
            with np.errstate(over="ignore"):
                hashes = mix64(hashes[left] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[last])
            stay = keep(length + 1, n, hashes)
            phrases = np.concatenate([phrases[left[stay]], last[stay][:, None]], axis=1)
            n, hashes = n[stay], hashes[stay]

    def texts(self, phrases: np.ndarray) -> list[bytes]:
        words = self.words
        return [b" ".join([words[i] for i in row]) for row in phrases.tolist()]


def _numbers(rows: pa.Table) -> list[pa.Table]:
    """What a shard keeps of each language: its words, the documents as word numbers, and the bytes of the whole shard."""
    langs, kept = rows.column(0), []
    size = pc.sum(pc.binary_length(rows.column(1))).as_py()
    for lang in pc.unique(langs).to_pylist():
        number = count(1)
        known: dict[bytes, int] = {b".": 0}
        held = []
        for text in texts(rows.filter(pc.equal(langs, lang)).column(1)):
            held.append(np.array([known[w] if w in known else known.setdefault(w, next(number)) for w in tokens(text)] + [0], np.int32))
        kept.append((lang, b" ".join(known), np.concatenate(held).tobytes(), size))
    names = ["lang", "words", "ids", "bytes"]
    return [pa.table([pa.array(c) for c in zip(*kept)], names)]


def _languages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, Shard]]:
    """Of each shard and language: the bytes of the shard, the language, and its documents."""
    for batch in batches:
        for body in batch.column(0).to_pylist():
            for row in unpacked(body).to_pylist():
                yield row["bytes"], row["lang"], Shard(row["words"].split(b" "), np.frombuffer(row["ids"], np.int32))


def _local_support(support: int, here: int, total: int) -> int:
    """The least whole count whose part of the support is that of the shard's bytes."""
    return max(1, -(-support * here // max(1, total)))


def _unreported(shards: DataFrame, total: int, support: int) -> int:
    """How often a phrase can be in the corpus that no shard reports: the local supports less one, added up."""

    def run(batches):
        for batch in batches:
            sizes = [unpacked(body).column(3)[0].as_py() for body in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_local_support(support, size, total) - 1 for size in sizes], pa.int64())], ["n"])

    return shards.select("body").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def of_language(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Hashes of phrases of a language."""
    with np.errstate(over="ignore"):
        return mix64(hashes + np.uint64(xxhash.xxh3_64_intdigest(lang)))


def there(tables: list[np.ndarray], lang: str, length: int, hashes: np.ndarray) -> np.ndarray:
    """Which phrases of a length have their bits in its table."""
    bits = tables[length - 1]
    place = table_place(of_language(lang, hashes), len(bits) * 64)
    return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def candidates(shards: DataFrame, total: int, support: int, tables: list[np.ndarray]) -> DataFrame:
    """Hashes of the phrases, a word longer than those in ``tables``, that can be frequent in the corpus: hash."""
    length = len(tables) + 1
    shared = shards.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for size, lang, shard in _languages(batches):
            # in whole numbers: count / support >= bytes of the shard / bytes of all
            least = _local_support(support, size, total)

            def keep(k, n, hashes, lang=lang, least=least):
                return n >= least if k == length else there(shared.value, lang, k, hashes)

            found = list(shard.levels(length, keep))
            if len(found) == length:
                own, n = of_language(lang, found[-1][2]).view(np.int64), found[-1][1] - (least - 1)
                for at in range(0, len(own), EMIT):
                    yield pa.RecordBatch.from_arrays([pa.array(own[at : at + EMIT]), pa.array(n[at : at + EMIT])], ["hash", "beyond"])

    # reported counts, less what a shard that does not report the phrase can have at most
    found = shards.select("body").mapInArrow(run, "hash long, beyond long").groupBy("hash").agg(F.sum("beyond").alias("beyond"))
    return found.where(F.col("beyond") >= support - _unreported(shards, total, support)).select("hash")


def table_place(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes & np.uint64(bits - 1)).astype(np.int64)


def candidate_table(found: DataFrame, most: int = TABLE) -> np.ndarray:
    """One bit per candidate's hash, as words of 64 bits; at most ``most`` bits, about sixteen per candidate below that."""
    n = found.count()
    bits = min(most, max(1 << 12, 1 << (16 * n).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = found.select(F.call_function("shiftright", place, F.lit(6)).cast("int").alias("word"), one.alias("value"))
    # the driver gets the words of the table, at most an eighth of ``most`` bytes
    words = words.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return table


def counted(shards: DataFrame, tables: list[np.ndarray]) -> DataFrame:
    """Exact counts of all that is in the tables: lang, phrase, words, f; and a row without a phrase for all words."""
    shared = shards.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for _, lang, shard in _languages(batches):

            def keep(k, n, hashes, lang=lang):
                return there(shared.value, lang, k, hashes)

            yield made(lang, [None], 0, [int(np.count_nonzero(shard.ids))])
            for phrases, n, _ in shard.levels(LONGEST, keep):
                for at in range(0, len(n), EMIT):
                    yield made(lang, shard.texts(phrases[at : at + EMIT]), phrases.shape[1], n[at : at + EMIT])

    def made(lang, phrases, length, n):
        columns = [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array([length] * len(phrases), pa.int32()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "f"])

    each = shards.select("body").mapInArrow(run, "lang string, phrase string, words int, f long")
    return each.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def frequencies(docs: DataFrame, support: int = 30, text_col: str = "text", lang_col: str = "lang", shard: int = SHARD, table: int = TABLE) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words found ``support`` times or more (lang, phrase, words, f), and lang, n of all words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = chunked(rows, "phrase-shards", lambda: _numbers, shard)
    tables: list[np.ndarray] = []
    for _ in range(LONGEST):
        found = stored(candidates(shards, total, support, tables), "phrase-candidates")
        tables = [*tables, candidate_table(found, table)]
        forget(found)
    all_counts = stored(counted(shards, tables).where(F.col("phrase").isNull() | (F.col("f") >= support)), "phrase-counts")
    forget(shards)
    return all_counts.where(F.col("phrase").isNotNull()), all_counts.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))


def mine(docs: DataFrame, support: int = 30, top: int = 2000, text_col: str = "text", lang_col: str = "lang", shard: int = SHARD, table: int = TABLE) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    known, totals = frequencies(docs, support, text_col, lang_col, shard, table)
    whole = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cut = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # whole numbers of up to 38 digits
    wide = "decimal(20,0)"
    score = F.expr(f"(cast(2000000 as {wide}) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))").cast("long")
    scored = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    scored = lowest.select("lang", "phrase", "a", "at.l", "at.r", "at.score")

    # what lies inside a longer phrase that comes nearly as often
    inside = whole.where("words > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)))
    inside = inside.groupBy("lang", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    held = scored.join(inside, ["lang", "phrase"], "left")
    held = held.where(F.expr(f"longer is null or cast(100 as {wide}) * cast(longer as {wide}) < cast(80 as {wide}) * cast(a as {wide})"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
