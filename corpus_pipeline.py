"""Corpus pipeline: language ID, quality, near-duplicates, mixing and BPE, each over all that the stage before kept.

Every stage takes documents with nulls in any column, empty and long texts, repeated rows and columns beside those of
documents, whatever their names, which it leaves out; an empty table gives an empty one.  What a stage does with such
rows is in its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, jaccard, langid, mixing, quality
from tickforge.llm.storage import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language is less sure than this is rejected (0 in no learned language), as is one without a letter.
LEAST_SURE = 0.25
LEAST_QUALITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognised language.

    Null texts and texts without a letter go; a null language only teaches nothing.  Repeated rows stay or go together.
    Texts in no learned language go too, where enough rows teach.  Where no language can be learnt, no document stays.
    """
    found = langid.predict(docs.select(*COLUMNS), langid.train(docs), "text", tuple(COLUMNS))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SURE)).select(*COLUMNS)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality network takes for good.

    Null and empty texts have the score of a text without a chunk; without labels the network is untrained and nothing
    is rejected.  Repeated rows stay or go together.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.trained:
        return docs.select(*COLUMNS)
    return quality.score(docs.select(*COLUMNS), model, "text", tuple(COLUMNS)).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates, once.

    Null ids are in no group, nor are null and blank texts: all of them stay.  Of rows with the same id and text one
    stays.  Rows with the same id and different texts are documents of their own; in a group, the digest of the text
    decides between those of one id.
    """
    docs = docs.select(*COLUMNS)
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        groups, _ = jaccard.jaccard_join(docs)
        gone = jaccard.small(groups.where("doc_id <> component_id").select("doc_id").distinct())
        return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    keyed = settle(rows.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    groups, _ = jaccard.jaccard_join(keyed, "_key")
    names = keyed.select(F.struct("doc_id", F.sha2("text", 256).alias("digest"), "_key").alias("name"), "_key").join(groups.select("_key", "component_id"), "_key")
    first = names.groupBy("component_id").agg(F.min("name").alias("first"))
    gone = jaccard.small(names.join(first, "component_id").where("_key <> first._key").select("_key"))
    return keyed.join(gone, "_key", "left_anti").select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources asks for.

    A null source is a source, last in order.  Null and blank texts have no words and are not taken.  Repeated rows are
    documents of their own.
    """
    return mixing.copies(mixing.mix(docs.select(*COLUMNS)), COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every text; a null text counts as empty, repeated rows give a row each."""
    return bpe.bpe_digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language", language), ("quality", good), ("near-duplicates", distinct), ("mixture", mixture), ("tokens", tokens)]

#: Trained classifiers are not expressible in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
