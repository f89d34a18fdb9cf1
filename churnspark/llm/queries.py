"""Registered queries of the text operators: ``opN_<name>(spark, sf_dir)``.

Each applies its operator, with production parameters, to its whole table and
derives the columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm import (decontaminate, hard_negatives, html_extract, language_id, line_dedup, mixing, near_dedup, ppm,
                            quality_classifier, quality_rules, spelling, toxicity, url_filter)
from churnspark.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages, url_filter.blocked_list(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def op6_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), percent=85)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return clean.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                        F.sha2("clean_text", 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(table(spark, sf_dir, "documents")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
