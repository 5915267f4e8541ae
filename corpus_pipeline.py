"""The corpus pipeline: language, near copies, repeated passages, benchmark passages, mixture.

Each stage takes the documents its predecessor kept and returns documents; ``run`` writes every stage as Parquet to
the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import decontaminate, langid, mixing, ngram_join, repeats
from seriesmill.llm.registry import table
from seriesmill.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter go; ``lang`` is the predicted one."""
    return langid.with_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has too are cut out; documents of which nothing is left go."""
    return repeats.without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and layouts meet their target shares."""
    return mixing.sampled(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", mixture),
]

#: No stage before the last two can be put in SQL; tests hold the rows against a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
