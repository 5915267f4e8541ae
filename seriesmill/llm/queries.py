"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import conversations, decontaminate, langid, lm, mixing, ngram_join, pii, quality, repeats, search, spelling, urls, vectors
from seriesmill.llm.registry import ORACLES, QUERIES, query, table


@query()
def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, folder, "documents"))


@query()
def op5_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.report(table(spark, folder, "documents"))


@query()
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op8_marginal_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"))


@query()
def op2_url_template_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.report(table(spark, folder, "pages"))


@query(conversations.SQL)
def op7_snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.rendered(table(spark, folder, "conversations"))


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.report(table(spark, folder, "documents"))


@query()
def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.linked(table(spark, folder, "embeddings"))


@query()
def op4_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_ngram_trie_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query(search.SQL)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))
