"""Term statistics: document frequency, smoothed idf, tf-idf weights, keywords."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.exprs import bounded_key

# Broadcast bound: at most this many terms, each with a key of bounded length.
HOT_TERMS = 500_000
# df classes an octave is cut into, when the least df of the broadcast terms is chosen
CLASSES = 16
NEVER = 1 << 62


def document_frequency(docs: DataFrame) -> DataFrame:
    """Documents per term.

    Distinct terms are taken inside each row, so the only shuffle carries
    partial counts of the vocabulary, not one row per (document, term).
    """
    terms = docs.select(F.explode(F.array_distinct("tokens")).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def smoothed_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1


def idf_table(docs: DataFrame) -> DataFrame:
    """(term, df, idf) over all documents of the table, test documents included."""
    n_docs = docs.count()
    return document_frequency(docs).withColumn("idf", smoothed_idf(F.lit(n_docs), F.col("df")))


@dataclass(frozen=True)
class IdfIndex:
    """An idf table arranged for joining.

    ``hot`` (key, idf) is of bounded size.  ``rare`` (doc_id, rare) has the terms
    outside of it, one array of (term, idf) a document; None if there are none.
    """

    hot: DataFrame
    rare: DataFrame | None


def least_hot_df(idf: DataFrame, hot_terms: int = HOT_TERMS) -> int:
    """The df from which on a term is hot, such that at most ``hot_terms`` are; 1 if all terms are.

    Terms are counted by classes of df of nearly equal logarithm, a few hundred
    rows at any size.  The class that would exceed the limit is left out whole, so
    a term that is not hot has about one in ``hot_terms`` of the postings at most.
    """
    df_class = F.floor(F.log2("df") * CLASSES)
    classes = idf.groupBy(df_class.alias("c")).agg(F.count("*").alias("n"), F.min("df").alias("least"))
    least, total = NEVER, 0
    for row in sorted(classes.collect(), reverse=True):
        total += row["n"]
        if total > hot_terms:
            return least
        least = row["least"]
    return 1


def hot_idf(idf: DataFrame, least: int) -> DataFrame:
    return idf.filter(F.col("df") >= least).select(bounded_key(F.col("term")).alias("key"), "idf")


def rare_idf(docs: DataFrame, idf: DataFrame, hot: DataFrame, least: int, partitions: int) -> DataFrame:
    """(doc_id, rare): the terms of each document that are not hot, with their idf.

    Only distinct pairs of a document and a rare term are shuffled, to the rest of
    the idf table and back to their document; no rare term is frequent enough to
    be skewed.
    """
    terms = docs.select("doc_id", F.explode(F.array_distinct("tokens")).alias("term"))
    pairs = terms.join(F.broadcast(hot.select("key")), bounded_key(F.col("term")) == F.col("key"), "left_anti")
    found = pairs.join(idf.filter(F.col("df") < least).select("term", "idf"), "term")
    # packed by the hash that buckets are made with, so the result fits the document tables
    packed = found.repartition(partitions, "doc_id").groupBy("doc_id")
    return packed.agg(F.collect_list(F.struct("term", "idf")).alias("rare"))


def with_rare(docs: DataFrame, index: IdfIndex) -> DataFrame:
    """``docs`` with ``rare``, empty where a document has only hot terms."""
    empty = F.array().cast("array<struct<term: string, idf: double>>")
    if index.rare is None:
        return docs.withColumn("rare", empty)
    return docs.join(index.rare, "doc_id", "left").withColumn("rare", F.coalesce("rare", empty))


def bare(terms: Column) -> Column:
    """Terms in the form of ``rare``, without an idf."""
    return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(None).cast("double").alias("idf")))


def attach_idf(postings: DataFrame, hot: DataFrame) -> DataFrame:
    """Adds the idf of hot terms where there is none yet; a row without a term stays without.

    A left join with a table of bounded size: no posting is moved, at no size of the vocabulary.
    """
    known = F.broadcast(hot.select("key", F.col("idf").alias("hot_idf")))
    joined = postings.join(known, bounded_key(F.col("term")) == F.col("key"), "left")
    return joined.withColumn("idf", F.coalesce("idf", "hot_idf")).drop("key", "hot_idf")


def term_weights(docs: DataFrame, index: IdfIndex) -> DataFrame:
    """(doc_id, term, w) with w = tf * idf."""
    listed = F.concat(bare(F.col("tokens")), "rare")
    tf = (
        with_rare(docs.select("doc_id", "tokens"), index).select("doc_id", F.inline(listed))
        .groupBy("doc_id", "term").agg(F.count_if(F.col("idf").isNull()).alias("tf"), F.max("idf").alias("idf"))
    )
    return attach_idf(tf, index.hot).select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))


def keywords(weights: DataFrame, k: int = fv.KEYWORDS_PER_DOC) -> DataFrame:
    """The ``k`` heaviest terms of each document, heaviest first, ties in alphabetical order."""
    heaviest = W.partitionBy("doc_id").orderBy(F.desc(F.round("w", 9)), "term")
    ranked = weights.select("doc_id", "term", F.row_number().over(heaviest).alias("r")).filter(F.col("r") <= k)
    listed = F.array_sort(F.collect_list(F.struct("r", "term")))
    return ranked.groupBy("doc_id").agg(listed["term"].alias("keywords"))
