"""From raw documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    from seqloom.llm.queries import toxicity_model
    from seqloom.llm.toxicity import score_documents

    scored = score_documents(docs, toxicity_model(spark, sf_dir), keep=docs.columns)
    return scored.filter(F.col("_score") < 0.5).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    from seqloom.llm.stream_dedup import keep_first_copies

    return keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by near-duplicate texts, the one with the smallest id."""
    from seqloom.llm.odd_sketch import keep_one_of_each

    return keep_one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    from seqloom.llm.common import table
    from seqloom.llm.decontaminate import drop_leaks

    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    from seqloom.llm.packing import pack_documents

    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packing),
]

#: The first and the last stage have no SQL form; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the scratch folder and read again."""
    from seqloom.llm.common import Scratch, table

    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
