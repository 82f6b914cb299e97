"""The corpus pipeline: documents in, packed training sequences out.

Each stage reads what the one before it wrote and applies its operator's decisions to all of it. All but the last return
the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockyard.llm import exact_dedup, line_dedup, ngram_join, packing, quality_rules
from stockyard.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines are cut from the rest."""
    return quality_rules.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.kept_documents(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut out; every document stays."""
    return line_dedup.kept_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("substring dedup", passages),
    ("best-fit packing", packed),
]
#: Tokens and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
