"""A corpus pipeline: reject low quality, drop exact copies, keep one of each group of near copies, pack the rest.

Defined results: a null text counts as empty and is scored, compared and packed like one; rows with a null id, or with
one id and different texts, stay apart and each goes on; repeated rows are exact copies, of which one stays; of tied
rows one stays, the one with the smallest id; without labels every score is 0.5, so all documents stay; an empty table
gives an empty result; further columns of documents are carried to the last stage, which returns pieces only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import ship
from gridloom.llm.exact_dedup import DigestIndex, first_of_group
from gridloom.llm.near_text import first_of_similar
from gridloom.llm.packing import pack_documents
from gridloom.llm.quality import score_column, train
from gridloom.llm.queries import vocabulary_path
from gridloom.llm.shared import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more."""
    ship(spark)
    field = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(score_column(field) >= F.lit(0.3))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each text."""
    return first_of_group(docs, DigestIndex(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    ship(spark)
    return first_of_similar(docs, similarity=0.8, words=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    ship(spark)
    return pack_documents(docs, vocabulary_path(), end_id=0, seq_len=2048)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: SQL cannot express the stages; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again as the next one's input."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
