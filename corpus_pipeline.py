"""The corpus pipeline: four filtering and cleaning stages over documents, then packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and hands its
result on as Parquet. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stargrain.llm import line_dedup, near_dedup, packing, paragraph_dedup, quality_model
from stargrain.session import shared_folder


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_model.keep_good(docs, quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from the texts, whatever their length; every document stays."""
    return line_dedup.drop_lines(docs, line_dedup.EVERY).select(*_columns(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return near_dedup.drop_near_copies(docs)


def paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that stand elsewhere before go from the texts; every document stays."""
    return paragraph_dedup.drop_paragraphs(docs).select(*_columns(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_copies),
    ("substring dedup", paragraphs),
    ("packing", packed),
]

#: a fitted model decides which rows stay, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
