"""Mixing sources to target weights, from DataFrame functions only.

The words of a source, in the order of its placed documents, are packed into blocks of a fixed length. The output is cut
into shards of so many slots; every slot draws a source against the cumulative targets by a hash of the seed and its
place, so that the source counts of a shard are a multinomial draw. The counts of a source, summed over the shards, stray
from its target; they are stretched along that running sum so that the total is met to a block, and no source runs over
its cap. Draw ``j`` of a source takes the block that stands at ``j mod B`` in pass ``j div B``, a pseudorandom permutation
of its ``B`` blocks for every pass; blocks and draws meet in a join on the block index.

Defined results: null text has size 0 and is taken 0 times; null is a source of its own and the last one; rows that
repeat a doc_id are documents of their own; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import WORD, stored

PLACES = 1024  # parts into which the documents of one source are dealt for the running sum, for every PER_PLACES rows
PER_PLACES = 1 << 26
CELLS = 1024  # parts of the cumulative targets in which a draw looks for its source
GROUP = 64  # shards whose draws one task makes, and over which running sums go in one step
DRAWS = 1 << 18  # draws a task makes, about
ROUNDS = 4  # of an index permutation
TOLD_BYTES = 1 << 20  # of sources' rows that are broadcast to the draws; larger ones meet them in a merge join


def _source_key(source: Column) -> Column:
    """Text that tells null from every other source and keeps code point order, null last."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("f"), source.cast("string")))


def _rounds(x: Column, n: Column, salt: Column) -> Column:
    """A permutation of the numbers below ``rows * columns``, the least such product of near equals from ``n`` on."""
    rows = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    columns = F.ceil(n / rows).cast("long")
    left, right = F.call_function("div", x, columns), x % columns
    for k in range(ROUNDS):
        if k % 2:
            left = (left + F.pmod(F.xxhash64(salt, F.lit(k), right), rows)) % rows
        else:
            right = (right + F.pmod(F.xxhash64(salt, F.lit(k), left), columns)) % columns
    return left * columns + right


def _permuted(j: Column, n: Column, salt: Column) -> Column:
    """Index j of n after the permutation chosen by the salt.

    A number that the rounds send to ``n`` or beyond goes through them again, until it comes back below; fewer than
    ``sqrt(n) + 1`` numbers lie there, and where so many steps are too many to take, not to come back is an error.
    """
    first = _rounds(j, n, salt)
    lost = F.raise_error(F.lit("a permuted index did not come back")).cast("long")
    back = F.aggregate(
        F.sequence(F.lit(1), F.lit(256)), first, lambda x, _: F.when(x < n, x).otherwise(_rounds(x, n, salt)),
        lambda x: F.when(x < n, x).otherwise(lost),
    )
    return F.when(first < n, first).otherwise(back)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Targets of ``sizes`` (source, source_size), one row per source.

    Sources weigh ``weights`` in turn by code point, null last, and share the sum of all sizes; a target stops at
    ``cap`` times its source's size and the excess is shared again by weight. This is the water level at which the
    shares sum to the total: a source is capped when the shares at its own cap do not use up the total. The windows
    without a partition see one row per source.
    """
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    turn = (F.row_number().over(Window.orderBy("sk")) - 1) % len(weights)
    ranked = (
        sizes.withColumn("sk", _source_key(F.col("source")))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("most", cap * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
    )
    filled = F.sum("most").over(by_ratio) + F.col("ratio") * (
        F.sum("weight").over(everything) - F.sum("weight").over(by_ratio)
    )
    judged = ranked.withColumn("capped", filled <= F.col("total"))
    rest = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    used = F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(everything), F.lit(0.0))
    level = (F.col("total") - used) / rest
    return judged.withColumn("level", level).select(
        "source", "sk", "source_size", "weight",
        F.when(F.col("capped"), F.col("most")).otherwise(F.col("level") * F.col("weight")).alias("target"),
    )


def _planned(docs: DataFrame, block_words: int, weights, cap, id_col, text_col, source_col, with_text: bool = False):
    """Documents placed in their sources' word streams, and the sources with blocks and slots.

    Sizes are counted once and written, since the sums per part, the sums per source and the offsets all need them. Rows
    of one id, source and size are one row with a number of copies, unless their texts are wanted.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("sk", _source_key(F.col("source")))
    kept = stored(sized if with_text else sized.drop("text"), "mix")
    placed = kept.withColumn("copies", F.lit(1).cast("long"))
    if not with_text:
        placed = kept.groupBy("doc_id", "source", "sk", "size").agg(F.count("*").alias("copies"))
    # A hash deals a source over many parts: sums of parts, then a running sum within each part.
    places = PLACES * max(1, -(-kept.count() // PER_PLACES))
    placed = placed.withColumn("place", F.pmod(F.xxhash64("doc_id", "size"), F.lit(places)))
    parts = placed.groupBy("sk", "place").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("copies")).alias("part_size"))
    # what is asked again and again is written: sums of parts, and the row of each source
    parts = stored(parts, "mix-parts")
    earlier = Window.partitionBy("sk").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("sk", "place", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("begin"))
    targets = source_targets(
        parts.groupBy("sk").agg(F.first("source").alias("source"), F.sum("part_size").alias("source_size")).drop("sk"),
        weights, cap,
    )
    # Small sources get shorter blocks, so that whole blocks still come near their target.
    sources = (
        targets.withColumn("block_len", F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(F.col("source_size") / 64))).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_len")).cast("long"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("slot_end", F.sum("slots").over(Window.orderBy("sk").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("slot_begin", F.col("slot_end") - F.col("slots"))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
    )
    return placed, begins, stored(sources, "mix-sources")


def _offsets(placed: DataFrame, begins: DataFrame) -> DataFrame:
    """First word of every document in its source's stream."""
    before = Window.partitionBy("sk", "place").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(before), F.lit(0)))
    found = within.join(begins.hint("merge"), ["sk", "place"]).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    offset = F.col("within") + F.col("begin") + F.col("_copy") * F.col("size")
    return found.withColumn("offset", offset).drop("within", "begin", "place", "copies", "_copy")


def _told(draws: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``draws`` joined with ``rows`` of the sources. What an explode made is planned with the size of what it was made
    from, so that the draws, which grow with the corpus, would be taken for the smaller side and be broadcast."""
    size = rows.agg(F.sum(F.octet_length("sk") + 40)).first()[0] or 0
    return draws.join(F.broadcast(rows) if size <= TOLD_BYTES else rows.hint("merge"), key)


def _tasks(sources: DataFrame) -> int:
    """Tasks that make all draws."""
    first = sources.agg(F.max("all_slots")).first()[0] or 0
    return max(sources.sparkSession.sparkContext.defaultParallelism, -(-first // DRAWS))


def shard_counts(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """How many slots of each output shard draw each source: shard, sk, n, a multinomial draw per shard.

    A slot's number among the slots of all sources is a hash of the seed, its shard and its place there. The cumulative
    slots are cut into cells, and a draw looks for its source among those of its cell only.
    """
    total = F.col("all_slots")
    cell = lambda u: F.floor(u.cast("double") * CELLS / total.cast("double")).cast("int")
    drawn = sources.where("slots > 0")
    # a cell more at either end, whatever the rounding of large numbers does
    reach = F.sequence(F.greatest(cell(F.col("slot_begin")) - 1, F.lit(0)), cell(F.col("slot_end") - 1) + 1)
    guide = drawn.select("sk", "slot_begin", "slot_end", F.explode(reach).alias("cell"))
    shards = F.ceil(total / shard_slots).cast("long")
    groups = drawn.select("all_slots").distinct().withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((shards - 1) / GROUP))))
    first = F.col("group") * GROUP
    every = groups.repartition(_tasks(sources), "group").withColumn("shard", F.explode(F.sequence(first, F.least(first + GROUP, shards) - 1)))
    left = F.least(F.lit(shard_slots).cast("long"), total - F.col("shard") * shard_slots)
    slots = every.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), left - 1)))
    draws = slots.select("shard", F.pmod(F.xxhash64(F.lit(seed), "shard", "slot"), total).alias("u"), "all_slots")
    met = _told(draws.withColumn("cell", cell(F.col("u"))), guide, "cell").where("u >= slot_begin and u < slot_end")
    return met.groupBy("shard", "sk").agg(F.count("*").alias("n"))


def _stretched(counts: DataFrame, sources: DataFrame, shard_slots: int) -> DataFrame:
    """The counts with totals that meet the sources' slots: shard, sk, and the draws ``begin`` to ``end`` of the source.

    The running sum over the shards is scaled by what the source should have had in all; it is taken over groups of shards
    first and then within a group. A source that no slot drew has all its draws in one shard.
    """
    grouped = counts.withColumn("group", F.floor(F.col("shard") / GROUP))
    sums = grouped.groupBy("sk", "group").agg(F.sum("n").alias("g"))
    earlier = Window.partitionBy("sk").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("sk", "group", F.coalesce(F.sum("g").over(earlier), F.lit(0)).alias("start"), F.sum("g").over(Window.partitionBy("sk")).alias("drawn"))
    within = Window.partitionBy("sk", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ran = grouped.withColumn("upto", F.sum("n").over(within)).join(starts.hint("merge"), ["sk", "group"]).withColumn("upto", F.col("upto") + F.col("start"))
    wanted = sources.where("slots > 0").select("sk", "slots", "all_slots")
    scaled = lambda x: f"cast({x} as decimal(19,0)) * cast(slots as decimal(19,0)) div cast(drawn as decimal(19,0))"
    met = ran.join(wanted, "sk").select("shard", "sk", F.expr(scaled("(upto - n)")).alias("begin"), F.expr(scaled("upto")).alias("end"))
    never = wanted.join(sums.select("sk").distinct(), "sk", "left_anti")
    alone = F.pmod(F.xxhash64("sk"), F.ceil(F.col("all_slots") / shard_slots).cast("long"))
    return met.union(never.select(alone.alias("shard"), "sk", F.lit(0).cast("long"), "slots")).where("begin < end")


def _slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """One row per output slot: shard, slot in it, source key, the pass over the source, and the block it takes."""
    drawn = stored(_stretched(stored(shard_counts(sources, shard_slots, seed), "mix-counts"), sources, shard_slots), "mix-draws")
    inside, upto = Window.partitionBy("shard"), Window.partitionBy("shard").orderBy("sk").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("end") - F.col("begin")
    placed = drawn.withColumn("first", F.coalesce(F.sum(size).over(upto), F.lit(0))).withColumn("all", F.sum(size).over(inside))
    draws = placed.repartition(_tasks(sources), "shard", "sk").withColumn("j", F.explode(F.sequence(F.col("begin"), F.col("end") - 1)))
    draws = _told(draws, sources.select("sk", "blocks"), "sk")
    turn = F.call_function("div", F.col("j"), F.col("blocks"))
    slot = _permuted(F.col("first") + F.col("j") - F.col("begin"), F.col("all"), F.xxhash64(F.lit(seed), F.col("shard")))
    block = _permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("sk"), turn))
    return draws.select("shard", slot.alias("slot"), "sk", turn.alias("turn"), block.alias("block"))


def _pieces(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: the words from ``lo`` to ``hi`` of the source's stream."""
    end = F.col("offset") + F.col("size")
    inside = docs.where("size > 0").join(sources.select("sk", "block_len"), "sk")
    cut = inside.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("offset") / F.col("block_len")).cast("long"), F.floor((end - 1) / F.col("block_len")).cast("long")))
    )
    return cut.withColumn("lo", F.greatest("offset", F.col("block") * F.col("block_len"))).withColumn(
        "hi", F.least(end, (F.col("block") + 1) * F.col("block_len"))
    )


def mix(
    docs: DataFrame, block_words: int = 128, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
    shard_slots: int = 4096, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target of its source, and the words the mix takes of it."""
    placed, begins, sources = _planned(docs, block_words, weights, cap, id_col, text_col, source_col)
    where = _offsets(placed, begins)
    times = _slots(sources, shard_slots, seed).groupBy("sk", "block").agg(F.count("*").alias("times"))
    taken = (
        _pieces(where, sources).join(times.hint("merge"), ["sk", "block"])
        .groupBy("sk", "offset").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
    )
    # An empty document shares its offset with the next one and takes no part in the join.
    key = [F.when(F.col("size") > 0, F.col("offset")).alias("offset")]
    rows = where.select("doc_id", "source", "sk", "size", *key).join(sources.select("sk", "source_size", "target"), "sk")
    return rows.join(taken.hint("merge"), ["sk", "offset"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_texts(
    docs: DataFrame, block_words: int = 128, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
    shard_slots: int = 4096, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: shard, slot, source, place in the slot, doc_id and the words taken there, joined by a space."""
    placed, begins, sources = _planned(docs, block_words, weights, cap, id_col, text_col, source_col, with_text=True)
    pieces = _pieces(_offsets(placed, begins), sources)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.slice(words, (F.col("lo") - F.col("offset") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
    return _slots(sources, shard_slots, seed).join(pieces.hint("merge"), ["sk", "block"]).select(
        "shard", "slot", "source", (F.col("lo") - F.col("block") * F.col("block_len")).alias("place"), "doc_id",
        F.array_join(cut, " ").alias("text"),
    )


def mixed_documents(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """Whole documents at the rate of the mix, with their columns: ``taken / size`` copies of each.

    The fraction is settled by a hash of the document, so that reruns agree and the expected words of a source are
    its words in the mix. Documents without words stay once: they cost the mix nothing.
    """
    id_col, text_col, source_col = (options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    rates = mix(docs, seed=seed, **options).groupBy("doc_id", "source", "size").agg(F.avg("taken").alias("taken"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rate = F.col("_r.taken") / F.col("_r.size")
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(f"_d.{id_col}"), F.col("_size")), F.lit(1 << 30)) / (1 << 30)
    copies = F.when(F.col("_r.size") > 0, F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).otherwise(1)
    rows = docs.select(F.struct("*").alias("_d"), size.alias("_size"))
    joined = rows.join(
        rates.hint("merge").alias("_r"),
        F.col(f"_d.{id_col}").eqNullSafe(F.col("_r.doc_id")) & F.col(f"_d.{source_col}").eqNullSafe(F.col("_r.source")) & (F.col("_size") == F.col("_r.size")),
    )
    return joined.select("_d", F.explode(F.when(copies >= 1, F.sequence(F.lit(1), copies.cast("int"))))).select("_d.*")
