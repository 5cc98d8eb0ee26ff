"""A training-data pipeline over ``documents``: stages that each apply one operator to what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import jaccard, langid, mixing, packing, secrets
from changeloom.llm.common import not_bucket, stored
from changeloom.session import configure_session


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or that no language claims with a score of a half, go."""
    model = langid.fit(docs.where(not_bucket(F.col("doc_id"), 4, 2)))
    # names no table has, so that a column of that name passes through
    found = langid.predict(docs, model, lang_out="__lang_pred", score_out="__lang_score")
    return found.where((F.col("__lang_pred") != langid.UNKNOWN) & (F.col("__lang_score") >= 0.5)).select(*docs.columns)


def with_row_key(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own: the hash of their file's path, and their place in it.

    Rows that are read from files have this key already, and no copy of their texts is made. Others, and rows that share
    such a key, are written with a number first, so that each has the same one whenever it is read.
    """
    # names no table has, so that a column of that name passes through
    try:
        place = docs.metadataColumn("_metadata")
        keyed = docs.select("*", F.xxhash64(place["file_path"]).alias("__file"), place["row_index"].alias("__row"))
        if keyed.groupBy("__file", "__row").count().where("count > 1").isEmpty():
            return keyed
    except AnalysisException:
        pass  # not read from files
    return stored(docs.select("*", F.lit(0).cast("long").alias("__file"), F.monotonically_increasing_id().alias("__row")), "pipeline-rows")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: five words, similarity of 0.8 or more; of each group one row stays, that of the smallest doc_id.

    Rows are told apart by a key of their own, which also decides among rows of one doc_id; a null doc_id stays only where
    its group has no other. Documents without words link with nothing and stay as they are.
    """
    keyed = with_row_key(docs)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row"))
    found = jaccard.join(keyed.withColumn("__rank", rank), words=5, percent=80, id_col="__rank")
    other = (F.col("doc_id.file") != F.col("component_id.file")) | (F.col("doc_id.row") != F.col("component_id.row"))
    gone = found.where(other).select(F.col("doc_id.file").alias("__file"), F.col("doc_id.row").alias("__row"))
    return keyed.join(gone, ["__file", "__row"], "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span that the scan reports is replaced by a mark, and n_chars counted anew."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents repeat or go at the rate of their words in the mix."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", packed),
]

#: Learned models and hashed permutations have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet to the shared folder and read by the next."""
    docs = configure_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
