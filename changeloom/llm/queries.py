"""One query per operator of this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import align, collocations, embedding_dedup, jaccard, langid, linededup, mixing, packing, ppm, quality, secrets, topk, warc
from changeloom.llm.common import is_bucket, not_bucket
from changeloom.session import configure_session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").where(not_bucket(F.col("doc_id"), 4, 2) & F.col("quality").isNotNull())
    # the ids to learn from are bounded before the texts are looked at
    chosen = labels.select("doc_id", "quality").orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(quality.TRAIN_ROWS)
    machine = quality.fit(docs.join(F.broadcast(chosen), "doc_id"))
    held_out = is_bucket(F.col("doc_id"), 4, 2).alias("held_out")
    return quality.score(docs, machine).select("doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(not_bucket(F.col("doc_id"), 4, 2)))
    held_out = is_bucket(F.col("doc_id"), 4, 2).alias("held_out")
    return langid.predict(docs, model, keep=["doc_id"]).select("doc_id", held_out, "lang_pred", "score")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ppm.score(docs, not_bucket(F.col("doc_id"), 10, 0))
    held_out = is_bucket(F.col("doc_id"), 10, 0).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = align.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op6_ngram_join": r"""
        with recursive d as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[ \t\n\x0B\x0C\r]+'), lambda x: x <> '') as w
            from documents
        ), s as (
            select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
            from d
        ), g as (
            select doc_id, len(s) as n, unnest(s) as shingle from s
        ), links as (
            select a.doc_id as a, b.doc_id as b from g a join g b on a.shingle = b.shingle and a.doc_id < b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), edges as (
            select a as x, b as y from links union all select b, a from links
        ), reach(doc_id, low) as (
            select doc_id, doc_id from s
            union select y, low from reach join edges on x = doc_id where low < y
        )
        select s.doc_id, len(s.s) as n_shingles, (select min(low) from reach r where r.doc_id = s.doc_id) as component_id from s
    """,
    "op9_topk": """
        with e as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, e.vec_id as vec_id, list_dot_product(q.v, e.v)::bigint as score
            from e q join e on q.vec_id <> e.vec_id
            where q.vec_id % 100 = 0
        ), r as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s
        )
        select query_id, rank::int as rank, vec_id, score from r where rank <= 10
    """,
    "op11_collocations": r"""
        with d as (
            select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents
        ), p as (
            select lang, unnest(string_split_regex(t, '[.,;:!?\n\x0B\x0C\r]')) as piece from d
        ), w as (
            select lang, list_filter(string_split_regex(piece, '[ \t]'), lambda x: x <> '') as w from p
        ), g as (
            select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
            from w, (values (1), (2), (3), (4)) as lengths(m)
            where len(w) >= m
        ), totals as (
            select lang, count(*) as n from g where m = 1 group by lang
        ), f as (
            select lang, m, phrase, count(*) as f from g group by lang, m, phrase having count(*) >= 30
        ), c as (
            select lang, m, phrase, f as a, string_split(phrase, ' ') as w from f where m > 1
        ), cut as (
            select c.lang, c.phrase, c.a, k, array_to_string(c.w[1:k], ' ') as first_part, array_to_string(c.w[k + 1:m], ' ') as rest
            from c, (values (1), (2), (3)) as cuts(k)
            where k < m
        ), s as (
            select cut.lang, cut.phrase, cut.a, cut.k, x.f as l, y.f as r, (2000000::hugeint * cut.a) // (x.f + y.f) as score
            from cut join f x on x.lang = cut.lang and x.phrase = cut.first_part join f y on y.lang = cut.lang and y.phrase = cut.rest
            qualify row_number() over (partition by cut.lang, cut.phrase order by score, cut.k) = 1
        ), inside as (
            select lang, array_to_string(w[i:i + len_ - 1], ' ') as phrase, max(a) as longer
            from c, (values (2), (3)) as lengths(len_), (values (1), (2), (3)) as starts(i)
            where len_ < m and i + len_ - 1 <= m
            group by all
        ), kept as (
            select s.* from s left join inside using (lang, phrase)
            where longer is null or 100::hugeint * longer < 80::hugeint * a
        ), ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
        )
        select lang, rank::bigint as rank, phrase, a, l, r, n, score::bigint as score
        from ranked join totals using (lang) where rank <= 2000
    """,
    "op13_line_dedup": r"""
        with d as (
            select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), l as (
            select row, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from d
        ), k as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from l
        ), gone as (
            select key from k where length(key) >= 1 group by key having count(distinct row) >= 10
        )
        select k.doc_id, count(*) as n_lines, count(gone.key) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (gone.key is null), '')) as kept_sha256
        from k left join gone on gone.key = k.key
        group by k.row, k.doc_id
    """,
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()}
