"""Graph ranking of the sentences of each document.

The similarity of two sentences is the cosine of their tf-idf vectors.  The words
of a document go to Arrow tasks as one array, in the bucket they lie in, where the
vectors of many documents are built and multiplied at once.  The n x n similarity
matrix S = X X' - diag is never formed, nor are sentence pairs: a product with S
is two sparse products with X, so work and memory follow the number of
(sentence, term) entries, whatever share of the sentences a term links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import tokens as tk
from ..functions.graph import graph_ranks
from .sentences import summary_from
from .weights import smoothed_idf


def sentence_vectors(docs: DataFrame, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc_id, n_sentences, sent_idx, term, term_no, df, x): unit tf-idf vectors, idf within the document."""
    rows = docs.select("doc_id", "n_sentences", F.posexplode("sentences").alias("sent_idx", "sentence"))
    terms = rows.select(
        "doc_id", "n_sentences", "sent_idx", F.explode(tk.word_runs(F.col("sentence"), stop_words)).alias("term")
    )
    tf = terms.groupBy("doc_id", "n_sentences", "sent_idx", "term").agg(F.count("*").alias("tf"))
    # both windows share one sort by (doc_id, term)
    counted = tf.withColumn("df", F.count("*").over(W.partitionBy("doc_id", "term"))).withColumn(
        "term_no", F.dense_rank().over(W.partitionBy("doc_id").orderBy("term")) - 1
    )
    weighted = counted.withColumn("w", F.col("tf") * smoothed_idf(F.col("n_sentences"), F.col("df")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("doc_id", "sent_idx")))
    return weighted.select(
        "doc_id", "n_sentences", "sent_idx", "term", "term_no", "df", (F.col("w") / norm).alias("x")
    )


def textrank(
    docs: DataFrame,
    stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS,
    damping: float = fv.DAMPING,
    rounds: int = fv.RANK_ROUNDS,
) -> DataFrame:
    """(doc_id, similarity, ranks): two arrays with one value for each sentence of the document.

    ``similarity`` is the sum to all other sentences.  Only terms used by two
    sentences or more link anything; without any, all ranks are the base rank.
    """
    words = F.transform("sentences", lambda s: tk.word_runs(s, stop_words))
    solved = docs.select("doc_id", graph_ranks(words, damping, rounds).alias("solved"))
    return solved.select("doc_id", "solved.similarity", F.col("solved.rank").alias("ranks"))


def sentence_ranks(ranked: DataFrame) -> DataFrame:
    """(doc_id, sent_idx, similarity, rank) for every sentence."""
    both = F.arrays_zip("similarity", F.col("ranks").alias("rank"))
    rows = ranked.select("doc_id", F.posexplode(both).alias("sent_idx", "r"))
    return rows.select("doc_id", "sent_idx", "r.similarity", "r.rank")


def pick_ranked(ranked: DataFrame, k: int = fv.SUMMARY_SENTENCES) -> DataFrame:
    """(doc_id, picked): indices of the ``k`` best ranked sentences in document order.

    Ranks equal to nine decimals tie and the earlier sentence wins, so a document
    without links is summarised by its first ``k`` sentences.
    """
    keyed = F.transform("ranks", lambda r, i: F.struct((-F.round(r, 9)).alias("key"), i.alias("sent_idx")))
    best = F.slice(F.array_sort(keyed), 1, k)
    return ranked.select("doc_id", F.sort_array(best["sent_idx"]).alias("picked"))


def textrank_summary(ranked: DataFrame, docs: DataFrame, k: int = fv.SUMMARY_SENTENCES) -> DataFrame:
    """The best ranked sentences of each document in their original order."""
    return summary_from(docs, pick_ranked(ranked, k), "textrank_summary")
