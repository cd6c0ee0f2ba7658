"""Sentence table, sentence scores, and summaries built from picked sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import tokens as tk
from .weights import IdfIndex, attach_idf, bare, with_rare


def sentence_table(docs: DataFrame, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> DataFrame:
    """One row per (doc_id, sent_idx): sentence, its terms and its word count."""
    rows = docs.select("doc_id", "n_sentences", F.posexplode("sentences").alias("sent_idx", "sentence"))
    return rows.withColumn("terms", tk.content_terms(F.col("sentence"), stop_words)).withColumn(
        "s_words", tx.word_count(F.col("sentence"))
    )


def position_weight(sent_idx: Column) -> Column:
    return 1 + 1 / (1 + sent_idx)


def sentence_scores(
    docs: DataFrame, index: IdfIndex, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS
) -> DataFrame:
    """TF-IDF score of every sentence, those without any term included.

    Sentences partition a document's tokens, so a term's frequency in the
    document is its number of rows here.  The document's rare terms stand beside
    its sentences, as an entry without a number, so the window that counts a term
    also hands it its idf.  On tables bucketed by doc_id neither the joins, the
    window nor the grouping need a shuffle.
    """
    numbered = F.transform("sentences", lambda s, i: F.struct(
        i.alias("sent_idx"), bare(tk.content_terms(s, stop_words)).alias("terms")))
    beside = F.array(F.struct(F.lit(None).cast("int").alias("sent_idx"), F.col("rare").alias("terms")))
    entries = with_rare(docs.select("doc_id", "sentences"), index).select(
        "doc_id", F.inline(F.concat(numbered, beside)))
    terms = entries.select("doc_id", "sent_idx", F.inline_outer("terms"))
    of_term = W.partitionBy("doc_id", "term")
    counted = terms.select(
        "doc_id", "sent_idx", "term",
        F.count("sent_idx").over(of_term).alias("tf"), F.max("idf").over(of_term).alias("idf"),
    ).filter(F.col("sent_idx").isNotNull())
    weight = F.coalesce(F.col("tf") * F.col("idf"), F.lit(0.0))
    sums = attach_idf(counted, index.hot).groupBy("doc_id", "sent_idx").agg(
        F.sum(weight).alias("wsum"), F.count("term").alias("n_terms")
    )
    length = F.sqrt(F.greatest("n_terms", F.lit(1)).cast("double"))
    return sums.withColumn("tfidf_norm", F.col("wsum") / length).withColumn(
        "tfidf_score", F.col("tfidf_norm") * position_weight(F.col("sent_idx"))
    )


def rank_sentences(scores: DataFrame, score: str, k: int) -> DataFrame:
    """(doc_id, sent_idx, r) for the ``k`` best sentences.

    Scores equal to nine decimals count as ties, and the earlier sentence wins.
    """
    best = W.partitionBy("doc_id").orderBy(F.desc(F.round(score, 9)), "sent_idx")
    return scores.select("doc_id", "sent_idx", F.row_number().over(best).alias("r")).filter(F.col("r") <= k)


def pick_top(scores: DataFrame, score: str, k: int = fv.SUMMARY_SENTENCES) -> DataFrame:
    """(doc_id, picked): indices of the ``k`` best sentences in document order."""
    ranked = rank_sentences(scores, score, k)
    return ranked.groupBy("doc_id").agg(F.sort_array(F.collect_list("sent_idx")).alias("picked"))


def join_picked(sentences: Column, picked: Column) -> Column:
    return F.array_join(F.transform(picked, lambda i: F.get(sentences, i)), " ")


def summary_from(docs: DataFrame, picks: DataFrame, name: str) -> DataFrame:
    """(doc_id, <name>): picked sentences of each document joined in their original order."""
    return docs.select("doc_id", "sentences").join(picks, "doc_id").select(
        "doc_id", join_picked(F.col("sentences"), F.col("picked")).alias(name)
    )


def lead(k: int = fv.SUMMARY_SENTENCES) -> Column:
    return F.array_join(F.slice("sentences", 1, k), " ")


def lead_summary(docs: DataFrame, k: int = fv.SUMMARY_SENTENCES, name: str = "lead3") -> DataFrame:
    """The first ``k`` sentences; a projection, no grouping needed."""
    return docs.select("doc_id", lead(k).alias(name))


def tfidf_summary(scores: DataFrame, docs: DataFrame, k: int = fv.SUMMARY_SENTENCES) -> DataFrame:
    return summary_from(docs, pick_top(scores, "tfidf_score", k), "tfidf_summary")
