"""Secret scan with multipart linking, from DataFrame functions only.

Strong parts (an assigned secret, an access identifier, a long hexadecimal run) are always reported. Weak parts (an
account name, a run of key-like characters, an endpoint) mean nothing alone: they are reported only when complementary
parts stand within the same scope. A scope is a distance in characters within one document. Weak parts and all parts
are cut into scope-sized bins and joined on document and bin with a distance test, an interval join in which no part
meets more than what fits into three bins.

Positions come from the texts between the matches: ``split`` gives the gaps, ``regexp_extract_all`` the matches, and a
running sum over a document's matches gives where each starts. Positions are code points, ends are exclusive.

Defined results: null and empty texts have no spans; rows that repeat (doc_id, text) give the same row again; a null
doc_id is kept; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import stored

# The patterns of the scan, in the order in which kinds are listed.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
IDENT = r"""(?:[uU][sS][eE][rR](?:[nN][aA][mM][eE])?|[lL][oO][gG][iI][nN]|[aA][cC][cC][oO][uU][nN][tT]|[cC][lL][iI][eE][nN][tT]_?[iI][dD])["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,64}"""
KEY = r"[A-Za-z0-9+/]{20,}"
ENDPOINT = r"""[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]{4,}"""

KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
STRONG = ("assign", "access", "hex")
# What a kind is to the others: an identifier, a secret, or a place where both are used.
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "ident": "id", "key": "secret", "endpoint": "place"}
SCOPE = 200


def _matches(text: Column, kind: str, pattern: str, when: Column, keeps) -> Column:
    """Array of (kind, pos, gap, length, ok) for the leftmost non-overlapping matches; empty when none can be."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.length(m).alias("length"), keeps(m).alias("ok")))
    rows = F.transform(
        found, lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("pos"), F.get(gaps, i).alias("gap"), m["length"].alias("length"), m["ok"].alias("ok")
        )
    )
    return F.when(when, rows)


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every part of every document: ``key`` of the document, kind number, start, end."""
    text = F.col(text_col)
    always = F.lit(True)
    found = F.flatten(F.array_compact(F.array(
        _matches(text, "assign", ASSIGN, text.rlike(ASSIGN), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
        _matches(text, "access", ACCESS, F.contains(text, F.lit("AKIA")), lambda m: F.length(m) >= 16),
        _matches(text, "hex", HEX, text.rlike(HEX), lambda m: always),
        _matches(text, "ident", IDENT, text.rlike(IDENT), lambda m: always),
        _matches(text, "key", KEY, text.rlike(KEY), lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")),
        _matches(text, "endpoint", ENDPOINT, F.contains(text, F.lit("://")), lambda m: always),
    )))
    rows = docs.select(document_key(id_col, text_col).alias("key"), F.explode(found).alias("p")).select("key", "p.*")
    rows = rows.dropDuplicates(["key", "kind", "pos"])  # rows that repeat a document
    upto = Window.partitionBy("key", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(upto).cast("int")
    return rows.select("key", "kind", (end - F.col("length")).alias("start"), end.alias("end"), "ok").where("ok").drop("ok")


def document_key(id_col: str, text_col: str) -> Column:
    """A key of a document row, two hashes of 64 bits: rows with the same id and text share it."""
    doc, text = F.col(id_col).cast("string"), F.col(text_col)
    return F.struct(F.xxhash64(doc, F.length(text), text).alias("a"), F.xxhash64(F.lit(1), text, doc).alias("b"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong parts, and the weak parts that complementary parts within ``scope`` characters support.

    A key-like run needs an identifier, an account name needs a secret, an endpoint needs both. A key-like run that
    lies within a strong part is that part and not reported again.
    """
    strong = found.where(F.col("kind") < len(STRONG))
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k in KINDS]), F.col("kind") + 1)
    bin_of = F.floor(F.col("start") / scope).cast("int")
    # a part can reach into later bins; a weak part looks one bin to either side of what it covers
    there = found.select(
        "key", F.explode(F.sequence(bin_of, F.floor((F.col("end") - 1) / scope).cast("int"))).alias("bin"),
        role.alias("other"), F.col("kind").alias("k2"), F.col("start").alias("s2"), F.col("end").alias("e2"),
    )
    weak = found.where(F.col("kind") >= len(STRONG)).withColumn(
        "bin", F.explode(F.sequence(bin_of - 1, F.floor((F.col("end") - 1) / scope).cast("int") + 1))
    )
    near = weak.join(there, ["key", "bin"]).where(f"s2 < end + {scope} and e2 > start - {scope} and not (k2 = kind and s2 = start)")
    seen = near.groupBy("key", "kind", "start", "end").agg(
        F.bool_or(F.col("other") == "id").alias("has_id"), F.bool_or(F.col("other") == "secret").alias("has_secret"),
        F.bool_or((F.col("k2") < len(STRONG)) & (F.col("s2") < F.col("end")) & (F.col("e2") > F.col("start"))).alias("covered"),
    )
    kind = {k: F.col("kind") == KINDS.index(k) for k in KINDS}
    supported = (
        (kind["key"] & F.col("has_id") & ~F.col("covered")) | (kind["ident"] & F.col("has_secret"))
        | (kind["endpoint"] & F.col("has_id") & F.col("has_secret"))
    )
    return strong.union(seen.where(supported).select("key", "kind", "start", "end"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document with spans: key and ``spans``, an array of (start, kind number, end) in that order."""
    # few rows, which the three sides of the interval join read instead of the texts
    found = parts(docs, id_col, text_col)
    # a file for each core at most, since a file takes Hadoop's local file system several processes started by the executor
    found = stored(found.coalesce(docs.sparkSession.sparkContext.defaultParallelism), "secret-parts")
    return linked(found, scope).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )


def _written(array: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document: its id, counts of the strong kinds, a digest of the strong spans, and all spans written out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), document_key(id_col, text_col).alias("key"))
    all_spans = F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)"))
    joined = rows.join(spans(docs, id_col, text_col, scope), "key", "left").select("doc_id", all_spans.alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    strong = F.filter("spans", lambda s: s["kind"] < len(STRONG))
    return joined.select(
        "doc_id", *[count(k) for k in STRONG], F.sha2(_written(strong), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        *[count(k) for k in KINDS[len(STRONG):]],
    )


def redacted(docs: DataFrame, mark: str = "[REDACTED]", id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", scope: int = SCOPE) -> DataFrame:
    """Documents with every span replaced by ``mark``; their other columns as they are, ``chars_col`` counted anew.

    Spans may overlap: a span starts anew where the ones before it end, and what is already covered adds nothing.
    """
    found = spans(docs, id_col, text_col, scope).select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    keyed = docs.select(F.struct("*").alias("_d"), document_key(id_col, text_col).alias("_key"))
    text = F.col(f"_d.{text_col}")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        new = s["start"] >= acc["at"]
        piece = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(new, F.concat(acc["out"], F.array(piece, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate("_spans", start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    joined = keyed.join(found, "_key", "left").withColumn("_text", F.coalesce(done, text))
    columns = [
        F.col("_text").alias(c) if c == text_col else
        F.when(F.col("_spans").isNull(), F.col(f"_d.{c}")).otherwise(F.length("_text").cast(docs.schema[c].dataType)).alias(c) if c == chars_col else
        F.col(f"_d.{c}").alias(c)
        for c in docs.columns
    ]
    return joined.select(*columns)
