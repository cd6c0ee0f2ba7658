"""Corpus readers and the loader projection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.exprs import once
from ..schemas import RAW


FULL_SPLIT_BYTES = 128 << 20
# Sentences by term of a bucket take about 100 times its bytes while they are sorted; a bucket is sorted in one task.
BUCKET_BYTES = 4 << 20


def id_below(root: str) -> Column:
    """The path of a row's file below ``root``."""
    return F.element_at(F.split(F.col("_metadata.file_path"), F.concat(F.lit("\\Q"), F.lit(root), F.lit("/\\E"))), -1)


def read_article_files(spark: SparkSession, path: str, root: str, labels: DataFrame | None = None) -> DataFrame:
    """Articles stored one per file; the id is the path below ``root``.

    ``labels`` may give (raw_id, labels array<string>).  Columns: raw_id, labels, article.
    """
    files = (
        spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        .select(
            id_below(root).alias("raw_id"),
            F.col("value").alias("article"),
        )
    )
    if labels is None:
        return files.withColumn("labels", F.array().cast("array<string>"))
    return files.join(labels, "raw_id", "left")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents table in the shape of a corpus: raw_id, labels, article."""
    split = F.when(F.col("doc_id") % 10 < 7, "training").otherwise("test")
    return spark.read.parquet(path).select(
        F.concat_ws("/", split, F.col("doc_id").cast("string")).alias("raw_id"),
        F.array("source").alias("labels"),
        F.col("text").alias("article"),
    )


def ingest(
    articles: DataFrame, decode: bool = True, partitions: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Loader projection: title and body, flat id, split, first label.

    ``decode=False`` leaves character references alone, for corpora known to
    hold none; the whole projection then runs inside the JVM.  ``partitions``
    hashes the articles on their id first: the one shuffle of the package, done
    while rows are smallest, which also spreads an input of few large files.
    Columns of ``keep`` stay behind the others.
    """
    keyed = articles.select(
        tx.flat_id(F.col("raw_id")).alias("doc_id"),
        tx.split_of(F.col("raw_id")).alias("split"),
        tx.first_label(F.col("labels")).alias("category"),
        "article", *keep,
    )
    if partitions:
        keyed = keyed.repartition(partitions, "doc_id")

    def decoded(text: Column) -> Column:
        return tx.decode_entities(text) if decode else text

    cut = keyed.select(
        "doc_id", "split", "category",
        decoded(tx.first_line(F.col("article"))).alias("title"),
        decoded(tx.after_first_line(F.col("article"))).alias("text"), *keep,
    )
    title = tx.title_case(tx.strip_space(F.col("title")))
    text = tx.collapse_space(F.col("text"))
    return once(cut, title=tx.blank_to_null(title), text=tx.blank_to_null(text))


def check_unique(table: DataFrame, key: str = "doc_id") -> None:
    """Raise if a key occurs twice; free of a shuffle on a table bucketed by the key."""
    repeated = table.groupBy(key).count().filter("count > 1").first()
    if repeated is not None:
        raise ValueError(f"{key} must be unique; {repeated[key]!r} occurs {repeated['count']} times")


def input_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df``; for a plain file scan the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the bytes of ``df``: at least one per core, at most what the session allows."""
    spark = df.sparkSession
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(input_bytes(df) / bucket_bytes))
    return min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores; a large one is returned as it is.

    Files of one row group cannot be split, and text functions are heavy enough
    to keep one core busy while the others wait.  An input that fills every core
    with a split of full size is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if input_bytes(df) < cores * FULL_SPLIT_BYTES else df


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; all columns are strings.

    A file with quoted line breaks cannot be split, so keep large corpora in
    many files, as ``write_raw_csv`` does.
    """
    return spark.read.schema(RAW).csv(path, header=True, multiLine=True, escape='"')


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
