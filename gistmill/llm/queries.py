"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair,
    decontamination,
    license_scan,
    lm_scoring,
    mixing,
    near_duplicates,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    substring,
    suffix_array,
    url_filter,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every URL by rule, else by trees trained on the URLs that rules decide."""
    judged = url_filter.judge_urls(_table(spark, folder, "pages").select("page_id", "url"))
    return judged.select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"), F.col("url_score").alias("score"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-entropy difference of every document: documents labelled 1 against the whole corpus."""
    good = _table(spark, folder, "labels").where("quality = 1")
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return lm_scoring.cross_entropy_difference(lm_scoring.with_membership(docs, good), F.col("in_target"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices of every document."""
    return license_scan.scan(_table(spark, folder, "documents")).drop("spans")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document under limits of its language and source."""
    return quality_rules.quality_report(_table(spark, folder, "documents"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The bin and place of every piece of every document."""
    return packing.best_fit(_table(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that a smaller document already has in a passage of 50 words."""
    return substring.removal_report(_table(spark, folder, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that lie in a string of 400 bytes found elsewhere."""
    return suffix_array.removal_report(_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that every document holds."""
    return decontamination.contamination_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every document under links of similarity 0.85."""
    return near_duplicates.duplicate_groups(_table(spark, folder, "documents"), similarity=0.85)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which get a periodic tail."""
    return periodic_runs.run_report(_table(spark, folder, "documents"), tails=True)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and repaired digest of every conversation after planted damage."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_report(turns, conversation_repair.damaged(turns))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix of all sources takes of every document."""
    return mixing.mix_report(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_lm_scoring, op3_license_scan, op4_quality_rules, op5_quality_classifier, op6_best_fit_packing,
    op7_substring_dedup, op8_suffix_array_dedup, op9_decontamination, op10_near_duplicates,
    op11_periodic_runs, op12_conversation_repair, op13_mixing,
)}
