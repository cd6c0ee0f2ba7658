"""Summary of a text from its own statistics only, the assistant's offline engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import tokens as tk
from ..functions.exprs import once
from .sentences import position_weight, rank_sentences
from .weights import smoothed_idf


def local_scores(split: DataFrame, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc_id, sent_idx, score) from term counts inside each text."""
    rows = split.select("doc_id", F.size("sentences").alias("n"), F.posexplode("sentences").alias("sent_idx", "s"))
    terms = rows.select(
        "doc_id", "n", "sent_idx", F.explode_outer(tk.content_terms(F.col("s"), stop_words)).alias("term")
    )
    # one sort by (doc_id, term, sent_idx) serves both windows
    in_text = W.partitionBy("doc_id", "term")
    previous = F.lag("sent_idx").over(in_text.orderBy("sent_idx"))
    first_use = F.when(previous == F.col("sent_idx"), 0).otherwise(1)
    counted = (
        terms.withColumn("first_use", first_use)
        .withColumn("tf", F.count("term").over(in_text))
        .withColumn("df", F.sum("first_use").over(in_text))
    )
    weight = F.col("tf") * smoothed_idf(F.col("n"), F.col("df"))
    sums = counted.groupBy("doc_id", "sent_idx").agg(F.sum(weight).alias("wsum"), F.count("term").alias("n_terms"))
    length = F.sqrt(F.greatest("n_terms", F.lit(1)).cast("double"))
    return sums.select(
        "doc_id", "sent_idx", (F.col("wsum") / length * position_weight(F.col("sent_idx"))).alias("score")
    )


def local_summary(
    texts: DataFrame, k: int = fv.SUMMARY_SENTENCES, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS
) -> DataFrame:
    """(doc_id, best): up to ``k`` sentences of ``texts`` (doc_id, text) in original order.

    ``best`` holds structs (sent_idx, r, sentence) with ``r`` the rank by score,
    so a shorter summary is a filter on ``r``.  The texts should be partitioned
    or bucketed by doc_id; then nothing below is shuffled.
    """
    split = once(texts.select("doc_id", "text"), sentences=tk.split_long_sentences(F.col("text"))).drop("text")
    ranked = rank_sentences(local_scores(split, stop_words), "score", k)
    picked = ranked.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_idx", "r"))).alias("picked"))
    with_text = F.transform(
        "picked",
        lambda p: F.struct(p["sent_idx"].alias("sent_idx"), p["r"].alias("r"),
                           F.get("sentences", p["sent_idx"]).alias("sentence")),
    )
    return split.join(picked, "doc_id", "left").select("doc_id", with_text.alias("best"))


def best_sentences(best, k: int = fv.SUMMARY_SENTENCES):
    """Sentences of rank ``k`` or better; an empty array when there are none."""
    chosen = F.transform(F.filter(best, lambda b: b["r"] <= k), lambda b: b["sentence"])
    return F.coalesce(chosen, F.array().cast("array<string>"))
