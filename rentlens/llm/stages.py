"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of documents. ``docs`` is the written result of the stage before. An empty input
gives an empty result in every stage; the operators' docstrings define the other cases.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import bagminhash, bpe, langid, line_dedup, mixing
from rentlens.llm.common import prepare

SOURCE_WEIGHTS = (5, 2, 1)


def stage(fn):
    @functools.wraps(fn)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, docs, sf_dir)

    return call


@stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language's centroids for their length, go; ``lang`` becomes the prediction.

    The model learns from the labelled documents that are not held out.
    """
    model = langid.train_model(docs.filter(~langid.held_out()))
    found = langid.predict(docs, model, prefix="__lang_").filter(~F.col("__lang_rejected"))
    return found.withColumn("lang", F.col("__lang_lang_pred")).select(*docs.columns)


@stage
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go from all documents but the largest id; a document keeps its place even if nothing is left."""
    return line_dedup.drop_repeated_lines(docs, prefix="__line_").withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@stage
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return bagminhash.drop_near_duplicates(docs)


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it, from not at all to three times."""
    copies = mixing.mix(docs, SOURCE_WEIGHTS)
    return mixing.repeat(docs, copies).select(*docs.columns)


@stage
def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit), ``ids_sha256`` and whether decoding gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = bpe.round_trip(docs, path, ids_col="__bpe_ids", decoded_col="__bpe_text").withColumn("ids", F.col("__bpe_ids"))
    same = F.col("__bpe_text") == F.coalesce("text", F.lit(""))
    return done.select("doc_id", bpe.token_count().alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), same.alias("round_trip"))
