"""Articles that arrive as files, and label rows that arrive at another time.

Three streams, each of which can be stopped and continued.  The first loads the
articles and appends them (file sink, exactly once); texts are never held in state.  The second
joins the ids of arrived articles to label rows that come within ``delay`` of
them, earlier or later; an article whose labels did not come by then gets the
category of an article without labels.  Its state is one id an article and one row of
labels for as long as the delay lasts.  A table read (``labelled``) then puts both together, with
the shuffle by document that the raw stage needs in any case.

Times of arrival are the files' modification times, or a column of the rows.  The file source
takes a file once: a file written again under its name is not read again, and an empty file has no article.
An article without any file of labels waits; it comes out when later files move the watermark on.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..sources import corpus

ARTICLES = "raw_id string, article string, arrived timestamp"
LABELS = "raw_id string, labels array<string>, arrived timestamp"
LOADED = "doc_id string, split string, title string, text string, arrived timestamp"
CATEGORIES = "doc_id string, category string"
PARTITIONS = "spark.sql.shuffle.partitions"
DELAY = "1 day"


def article_files(spark: SparkSession, path: str, root: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of ``ARTICLES`` from one file per article; the id is the path below ``root``."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        corpus.id_below(root).alias("raw_id"), F.col("value").alias("article"),
        F.col("_metadata.file_modification_time").alias("arrived"))


def arriving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of ``ARTICLES`` or ``LABELS`` rows from Parquet files of many rows each."""
    return spark.readStream.schema(schema).parquet(path)


@dataclass
class ArrivingCorpus:
    """Below ``folder``: loaded articles, their categories, and the checkpoints of both streams.

    ``partitions`` is the number of parts of the join's state when the corpus begins; it stays.
    """

    spark: SparkSession
    folder: str
    delay: str = DELAY
    partitions: int | None = None

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def load(self, articles: DataFrame, decode: bool = True) -> StreamingQuery:
        """Append the articles that have arrived."""
        rows = articles.withColumn("labels", F.array().cast("array<string>"))
        loaded = corpus.ingest(rows, decode=decode, keep=("arrived",)).drop("category")
        return self._append(loaded, "articles")

    def categorise(self, labels: DataFrame) -> StreamingQuery:
        """Append the category of the articles whose labels have arrived or are overdue; run ``load`` first."""
        ids = self.spark.readStream.schema(LOADED).parquet(self.path("articles")).select("doc_id", "arrived")
        ids = ids.withWatermark("arrived", self.delay)
        rows = labels.select(
            tx.flat_id(F.col("raw_id")).alias("of"), F.col("labels"), F.col("arrived").alias("labelled")
        ).withWatermark("labelled", self.delay)
        wait = F.expr(f"INTERVAL {self.delay}")
        near = (F.col("labelled") >= F.col("arrived") - wait) & (F.col("labelled") <= F.col("arrived") + wait)
        joined = ids.join(rows, (F.col("doc_id") == F.col("of")) & near, "left_outer")
        with self._state_partitions():
            return self._append(joined.select("doc_id", tx.first_label(F.col("labels")).alias("category")), "categories")

    def run(self, articles: DataFrame, labels: DataFrame) -> None:
        """Both streams over what has arrived, then stop; the next run continues."""
        self.load(articles).awaitTermination()
        self.categorise(labels).awaitTermination()

    def labelled(self, partitions: int | None = None) -> DataFrame:
        """The loaded articles whose category is known, in the columns of the raw table.

        ``partitions`` hashes both sides on doc_id, as bucketed writing needs it: the one shuffle of texts.
        """
        articles = self.spark.read.schema(LOADED).parquet(self.path("articles")).drop("arrived")
        categories = self.spark.read.schema(CATEGORIES).parquet(self.path("categories"))
        if partitions:
            articles, categories = (t.repartition(partitions, "doc_id") for t in (articles, categories))
        return articles.join(categories.hint("shuffle_hash"), "doc_id").select("doc_id", "split", "category", "title", "text")

    def waiting(self) -> DataFrame:
        """(doc_id, arrived) of the articles without a category so far."""
        articles = self.spark.read.schema(LOADED).parquet(self.path("articles")).select("doc_id", "arrived")
        return articles.join(self.spark.read.schema(CATEGORIES).parquet(self.path("categories")), "doc_id", "left_anti")

    def _append(self, rows: DataFrame, name: str) -> StreamingQuery:
        return (
            rows.writeStream.format("parquet").outputMode("append").option("path", self.path(name))
            .option("checkpointLocation", self.path(f"checkpoint_{name}")).trigger(availableNow=True).start()
        )

    @contextmanager
    def _state_partitions(self):
        """A stream keeps the number of state partitions it began with."""
        before = self.spark.conf.get(PARTITIONS)
        self.spark.conf.set(PARTITIONS, self.partitions or self.spark.sparkContext.defaultParallelism)
        try:
            yield
        finally:
            self.spark.conf.set(PARTITIONS, before)
