"""The documents of a corpus through language, copy, leak and encoding stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import decontaminate, exact_dedup, jaccard_join, language, sentencepiece
from leafmill.llm.catalog import learnable
from leafmill.llm.common import read
from leafmill.session import work_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any letter go; all others have a language."""
    return language.keep_known(docs, language.learn(docs.filter(learnable())))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, 0.8 or more) the row with the smallest id stays."""
    return jaccard_join.drop_near_copies(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids behind each document, and whether they decode to its text."""
    model = sentencepiece.Model.load()
    both = sentencepiece.decode(sentencepiece.encode(docs, model), model)
    return both.withColumn("round_trip", both["text"].eqNullSafe(both["decoded"])).drop("decoded")


STAGES = [
    ("language", known_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pieces", encode),
]

# Learned filters, near copies and segmentations are beyond SQL; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
