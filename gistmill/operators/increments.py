"""Statistics kept up to date: partial results per batch of documents, merged when they are read.

Document frequencies are added up.  Distinct words are kept as HyperLogLog sketches
and lengths as KLL sketches, one row per batch and group, which merge upwards to
any coarser grouping without the documents being read again.  A batch costs
its own documents; reading costs one row per term or group and part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.versions import VersionedTable
from .weights import document_frequency, smoothed_idf

TERMS = "term string, df long"
#: 2 ** 14 registers: a standard error of 1.04 / 2 ** 7, 0.8 %, of the number of distinct words.
REGISTERS_LOG2 = 14
DISTINCT_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)
#: A quantile's rank is wrong by at most 1.65 % of the rows: with 99 % confidence at k = 200, and far beyond that at this k.
KLL_K = 800
RANK_ERROR = 0.0165


class TermCounts(VersionedTable):
    """Documents per term of all batches of documents (tokens) so far."""

    def __init__(self, spark, folder: str):
        super().__init__(spark, folder, TERMS)

    def add_documents(self, docs: DataFrame, batch: str) -> bool:
        return self.add(document_frequency(docs), batch, docs.count())

    def idf(self, version: int | None = None) -> DataFrame:
        """(term, df, idf) of one version: its counts and its number of documents."""
        counts = self.read(version).groupBy("term").agg(F.sum("df").alias("df"))
        return counts.withColumn("idf", smoothed_idf(F.lit(self.docs(version)), F.col("df")))

    def compact_terms(self) -> None:
        self.compact(lambda rows: rows.groupBy("term").agg(F.sum("df").alias("df")))


def group_sketches(docs: DataFrame, *by: str) -> DataFrame:
    """(by..., n_docs, words, lengths): sketches of the distinct words and of the numbers of words of each group.

    Both are built per task before they are shuffled, so a group of any size costs one sketch a task.
    """
    lengths = docs.groupBy(*by).agg(
        F.count("*").alias("n_docs"), F.kll_sketch_agg_bigint(F.col("n_words").cast("bigint"), F.lit(KLL_K)).alias("lengths"))
    words = docs.select(*by, F.explode(F.array_distinct("tokens")).alias("word")).groupBy(*by).agg(
        F.hll_sketch_agg("word", REGISTERS_LOG2).alias("words"))
    same = F.lit(True)
    for c in by:
        same = same & lengths[c].eqNullSafe(words[c])
    return lengths.join(words, same, "left").select(*[lengths[c] for c in by], "n_docs", "words", "lengths")


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """``group_sketches`` rows brought together per ``by``, or overall."""
    return sketches.groupBy(*by).agg(
        F.sum("n_docs").alias("n_docs"), F.hll_union_agg("words").alias("words"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"))


class GroupSketches(VersionedTable):
    """Sketches per category of all batches of documents (category, tokens, n_words) so far."""

    def __init__(self, spark, folder: str):
        super().__init__(spark, folder, "category string, n_docs long, words binary, lengths binary")

    def add_documents(self, docs: DataFrame, batch: str) -> bool:
        return self.add(group_sketches(docs, "category"), batch, docs.count())

    def compact_groups(self) -> None:
        self.compact(lambda rows: merged(rows, "category"))


def distinct_words() -> Column:
    """The number of distinct words that a sketch has seen, about."""
    return F.coalesce(F.hll_sketch_estimate("words"), F.lit(0))


def length_quantile(share: float) -> Column:
    return F.kll_sketch_get_quantile_bigint("lengths", F.lit(share))


def with_rank_errors(sketches: DataFrame, docs: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(category, n_docs, error_...): how far the rank of each sketched quantile is from the share, 0 within a run of ties.

    Documents are counted by length first, so a category of any size is a few rows a length.
    """
    counts = docs.groupBy("category", F.col("n_words").cast("bigint").alias("v")).agg(F.count("*").alias("n"))
    asked = sketches.select(F.col("category").alias("of"), "n_docs", *[length_quantile(q).alias(f"q{i}") for i, q in enumerate(shares)])
    rows = counts.join(asked, F.col("category").eqNullSafe(F.col("of")))
    errors = []
    for i, q in enumerate(shares):
        below = F.sum(F.when(F.col("v") < F.col(f"q{i}"), F.col("n")).otherwise(0)) / F.sum("n")
        upto = F.sum(F.when(F.col("v") <= F.col(f"q{i}"), F.col("n")).otherwise(0)) / F.sum("n")
        errors.append(F.greatest(below - q, q - upto, F.lit(0.0)).alias(f"error_{round(100 * q)}"))
    return rows.groupBy("category", "n_docs").agg(*errors)
