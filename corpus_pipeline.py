"""The corpus pipeline: quality, rules, near-duplicates, mixing and packing, one table of documents after another.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns
the documents that it keeps, with the columns of `documents`; the last returns packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint_dir, fresh, removed, table
from tidemark.llm.mixing import mixed
from tidemark.llm.packing import packed
from tidemark.llm.quality import THRESHOLD, with_quality
from tidemark.llm.rules import good_documents
from tidemark.llm.simhash import near_duplicates_removed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above."""
    score = fresh("_quality", docs.columns)
    scored = with_quality(docs, table(spark, sf_dir, "labels"), score_column=score)
    return scored.where(F.col(score) >= THRESHOLD).drop(score)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language's references."""
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates."""
    return near_duplicates_removed(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, in sequences."""
    return packed(docs)


STAGES = [("quality", quality), ("rules", rules), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: SQL cannot express the classifier, the fingerprints or the packing; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep: bool = False) -> DataFrame:
    """All stages over `documents`, each written to the shared checkpoint folder and read again as the next one's input.

    Once a stage is written, its input is removed, unless `keep`; the result stays, for the caller to read and remove.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for i, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
        if before and not keep:
            removed(spark, before)
        before = written
    return docs
