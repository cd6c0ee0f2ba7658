"""Supervised sentence picker: headline labels, features, boosted trees."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import tokens as tk
from ..functions.exprs import once
from ..session import shared_folder
from .sentences import pick_top, summary_from


#: Sentences in a task while trees are grown: each pass starts all tasks again, so small buckets are brought together.
TASK_ROWS = 250_000


def is_training(doc_id: Column) -> Column:
    return doc_id.startswith("training")


def sentence_features(
    docs: DataFrame, scores: DataFrame, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS
) -> DataFrame:
    """Label and features of every sentence; the sentence text itself is not carried along.

    A document's scores are packed into one array, so texts and scores meet in a
    join on doc_id alone, which bucketed tables do in place.
    """
    packed = scores.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("sent_idx", "tfidf_norm"))).alias("scored")
    )
    titled = once(
        docs.select("doc_id", "n_sentences", "title", "sentences"),
        title_terms=tk.content_terms(F.col("title"), stop_words),
    )
    # the scores are the hashed side, so the texts are not sorted
    rows = titled.join(packed.hint("shuffle_hash"), "doc_id").select(
        "doc_id", "n_sentences", "title_terms", F.inline(F.arrays_zip("sentences", "scored"))
    )
    sentence = F.col("sentences")
    rows = once(rows, words=F.split(sentence, " "))
    measured = once(
        rows,
        overlap=F.size(F.array_intersect(tk.content_terms(sentence, stop_words), "title_terms")).cast("double"),
        s_words=F.size("words"),
        n_digits=tx.digit_count(sentence).cast("double"),
        cap_ratio=tx.capital_ratio(sentence, F.col("words")),
    ).select(
        "doc_id", "n_sentences", "scored.sent_idx", "scored.tfidf_norm",
        "overlap", "s_words", "n_digits", "cap_ratio",
    )
    return _with_label(_with_positions(measured))


def _with_positions(rows: DataFrame) -> DataFrame:
    by_weight = W.partitionBy("doc_id").orderBy(F.round("tfidf_norm", 9))
    return rows.withColumn(
        "rel_pos", F.col("sent_idx") / F.greatest(F.col("n_sentences") - 1, F.lit(1))
    ).withColumn("tfidf_pct", F.percent_rank().over(by_weight))


def _with_label(rows: DataFrame, labelled: int = fv.LABELLED_SENTENCES) -> DataFrame:
    """1 for the sentences sharing most words with the headline; the overlap is no feature."""
    by_overlap = W.partitionBy("doc_id").orderBy(F.desc("overlap"), "sent_idx")
    ranked = rows.withColumn("overlap_rank", F.row_number().over(by_overlap))
    chosen = (F.col("overlap_rank") <= labelled) & (F.col("overlap") > 0)
    return ranked.withColumn("label", chosen.cast("double"))


def assemble(features: DataFrame, columns: Sequence[str] = fv.FEATURES) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(features)
    return vectors.select("doc_id", "sent_idx", "label", "features")


def fit_gbt(features: DataFrame, task_rows: int = TASK_ROWS, **params) -> GBTClassificationModel:
    """Train on every sentence of the training documents.  Pass a written table: trees are grown in many passes.

    Buckets are brought together, without a shuffle, into tasks of about
    ``task_rows`` sentences, but at least one a core.
    """
    # errors of all rows are kept in storage; they need no copy in the checkpoint folder besides
    settings = {"checkpointInterval": -1, **fv.GBT_PARAMS, **params}
    classifier = GBTClassifier(featuresCol="features", labelCol="label", **settings)
    train = features.filter(is_training(F.col("doc_id")))
    tasks = max(features.sparkSession.sparkContext.defaultParallelism, math.ceil(train.count() / task_rows))
    return classifier.fit(assemble(train).coalesce(tasks))


def gbt_predictions(model: GBTClassificationModel, features: DataFrame) -> DataFrame:
    """(doc_id, sent_idx, label, rawPrediction, p) for the test documents."""
    held_out = assemble(features.filter(~is_training(F.col("doc_id"))))
    scored = model.transform(held_out).withColumn("p", vector_to_array("probability")[1])
    return scored.select("doc_id", "sent_idx", "label", "rawPrediction", "p")


def by_score(predictions: DataFrame, score: str = "p", label: str = "label", partitions: int | None = None) -> DataFrame:
    """(score, positive, negative, part): one row a score, range partitioned by it; write this table before ``exact_auc``.

    Equal scores are one row, so no tie lies across the border of two ranges.
    """
    counts = predictions.groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(label) > 0).cast("long")).alias("positive"), F.sum((F.col(label) <= 0).cast("long")).alias("negative"))
    ranged = counts.repartitionByRange(partitions, "score") if partitions else counts.repartitionByRange("score")
    return ranged.withColumn("part", F.spark_partition_id())


def exact_auc(scores: DataFrame) -> DataFrame:
    """(n, n_positive, auc), exact: the chance that a positive row scores above a negative one, ties counting half.

    ``scores`` is a written ``by_score`` table.  Negatives are counted up inside
    each range, and one row per range carries them over: no row is binned and no
    range but its own is sorted.  NULL without rows of both kinds.
    """
    sums = scores.groupBy("part").agg(F.sum("negative").alias("sum"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = F.broadcast(sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset")))
    own = W.partitionBy("part").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("negative").over(own), F.lit(0)) + F.col("offset")
    # twice the pairs won, in whole numbers
    won = F.col("positive").cast("decimal(38,0)") * (2 * below + F.col("negative"))
    counted = scores.join(offsets, "part").withColumn("won", won).agg(
        F.coalesce(F.sum(F.col("positive") + F.col("negative")), F.lit(0)).alias("n"),
        F.coalesce(F.sum("positive"), F.lit(0)).alias("n_positive"), F.sum("won").alias("won"))
    pairs = F.col("n_positive").cast("double") * (F.col("n") - F.col("n_positive"))
    return counted.select("n", "n_positive", F.when(pairs > 0, F.col("won").cast("double") / (2 * pairs)).alias("auc"))


def area_under_roc(predictions: DataFrame) -> float:
    """The exact AUC of predictions (p, label); the counts by score are checkpointed."""
    shared_folder(predictions.sparkSession)  # sets the checkpoint folder of a local session
    return exact_auc(by_score(predictions).checkpoint()).first()["auc"]


def importances(spark: SparkSession, model: GBTClassificationModel, columns: Sequence[str] = fv.FEATURES) -> DataFrame:
    values = [(name, float(v)) for name, v in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def gbt_summary(predictions: DataFrame, docs: DataFrame, k: int = fv.SUMMARY_SENTENCES) -> DataFrame:
    return summary_from(docs, pick_top(predictions, "p", k), "gbt_summary")
