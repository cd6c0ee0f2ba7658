"""Documents to packed training sequences: five stages, each written as Parquet and read again by the next.

All stages but the last return the columns of the documents, whatever their names.  A
null or empty text has no words, which the rules reject first.  Rows without an id
are judged by their text and come after all others.  Very long texts are worked
on whole.  An empty table passes through all stages as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gistmill.llm import decontamination, near_duplicates, packing, quality_rules, substring
from gistmill.llm.stages import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source; a value at its limit stays, repeated rows are judged one by one."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near duplicates; of rows equal in id and text one stays."""
    return near_duplicates.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; a text may become empty, its row stays."""
    return substring.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; items without an id or a text are held by none."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin and place of every piece of every document left; a text without words has no piece."""
    return packing.best_fit(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: The stages use hashes, sketches and sequential packing, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
