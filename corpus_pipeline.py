"""The corpus pipeline: five stages from raw documents to token ids, each one of the operators in ``rentlens.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentlens.llm.stages import bpe_stage, language_stage, line_dedup_stage, mixing_stage, near_dedup_stage
from rentlens.session import materialise

STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]
#: Stages that SQL cannot express (nearest centroids, sketches, merge rounds) decide on the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
