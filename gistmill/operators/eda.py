"""Corpus profile: sizes, frequencies, histograms, quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# --- one-row and key/value summaries -------------------------------------------
def corpus_profile(docs: DataFrame) -> DataFrame:
    return docs.agg(
        F.round(F.avg("n_words"), 1).alias("mean_words"),
        F.percentile_approx("n_words", 0.5).alias("median_words"),
        F.max("n_words").alias("max_words"),
        F.round(F.avg("n_sentences"), 1).alias("mean_sentences"),
    )


def eda_summary(raw: DataFrame, docs: DataFrame) -> DataFrame:
    """(metric, value) rows.

    The exact median keeps one counter per distinct document length, and the
    vocabulary is counted from distinct words, so no task sees the whole corpus.
    """
    sizes = docs.agg(
        F.count("*").alias("docs_kept"),
        F.sum("n_tokens_clean").alias("total_tokens"),
        F.round(F.avg("n_words"), 1).alias("mean_words"),
        F.percentile("n_words", 0.5).alias("median_words"),
        F.max("n_words").alias("max_words"),
        F.round(F.avg("n_sentences"), 1).alias("mean_sentences"),
        F.round(F.avg("avg_sent_len"), 1).alias("mean_words_per_sentence"),
    )
    parts = [
        raw.agg(F.count("*").alias("docs_raw")),
        sizes,
        word_frequency(docs).agg(F.count("*").alias("vocabulary")),
        docs.groupBy("category").count().agg(F.count("category").alias("categories")),
    ]
    long = [
        p.select([F.col(c).cast("double") for c in p.columns]).unpivot([], p.columns, "metric", "value")
        for p in parts
    ]
    result = long[0]
    for part in long[1:]:
        result = result.unionByName(part)
    return result


# --- words -----------------------------------------------------------------------
def word_frequency(docs: DataFrame) -> DataFrame:
    """Occurrences per word; combined before the shuffle, so frequent words stay cheap."""
    return docs.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count("*").alias("count"))


def top_words(frequency: DataFrame, k: int) -> DataFrame:
    return frequency.orderBy(F.desc("count"), "word").limit(k)


def with_range_number(frequency: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition by (count desc, word) and note the partition; write this table before ranking."""
    order = [F.desc("count"), F.asc("word")]
    ranged = frequency.repartitionByRange(partitions, *order) if partitions else frequency.repartitionByRange(*order)
    return ranged.withColumn("part", F.spark_partition_id())


def zipf_rank(ranged: DataFrame) -> DataFrame:
    """Global rank by (count desc, word) without a single-task sort.

    ``ranged`` is a written ``with_range_number`` table: rank = rows in earlier
    ranges + position in the own range.  Only one row per range is broadcast.
    """
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    own = W.partitionBy("part").orderBy(F.desc("count"), "word")
    return (
        ranged.withColumn("position", F.row_number().over(own))
        .join(F.broadcast(offsets), "part")
        .select("word", "count", (F.col("offset") + F.col("position")).alias("rank"))
    )


# --- histograms --------------------------------------------------------------------
def _clipped_counts(values: DataFrame, value: Column, cap: int, *keys: str) -> DataFrame:
    """Rows per clipped whole number: at most ``cap`` + 1 rows for each key."""
    # least() skips NULLs, so they go first
    present = values.select(*keys, value.alias("v")).dropna(subset=["v"])
    clipped = present.select(*keys, F.least("v", F.lit(cap)).cast("long").alias("v"))
    return clipped.groupBy(*keys, "v").agg(F.count("*").alias("n"))


def equal_width_histogram(values: DataFrame, value: Column, bins: int, cap: int) -> DataFrame:
    """``bins`` bins of equal width between the least and the greatest clipped value.

    Counting by value first leaves at most ``cap`` + 1 rows, the only ones
    gathered.  The last bin is closed, and empty bins are listed.
    """
    counts = _clipped_counts(values, value, cap)
    gathered = counts.agg(
        F.min("v").alias("least"), F.max("v").alias("most"),
        F.collect_list(F.struct("v", "n")).alias("counts"),
    ).filter("least IS NOT NULL")
    flat = F.col("least") == F.col("most")
    lo = F.when(flat, F.col("least") - 0.5).otherwise(F.col("least").cast("double"))
    hi = F.when(flat, F.col("most") + 0.5).otherwise(F.col("most").cast("double"))

    def bin_of(v: Column) -> Column:
        # the product is a whole number, so values on a bin edge stay exact
        position = F.floor((v - F.col("least")) * bins / F.greatest(F.col("most") - F.col("least"), F.lit(1)))
        return F.when(flat, F.lit(bins // 2)).otherwise(F.least(position, F.lit(bins - 1)))

    def rows_in(b: Column) -> Column:
        inside = F.filter(F.col("counts"), lambda c: bin_of(c["v"]) == b)
        return F.aggregate(inside, F.lit(0).cast("long"), lambda total, c: total + c["n"])

    width = (hi - lo) / bins
    listed = gathered.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return listed.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_from"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("bin_to"),
        rows_in(F.col("bin")).alias("n"),
    )


def fixed_edge_histogram(values: DataFrame, value: Column, start: int, stop: int, step: int, cap: int) -> DataFrame:
    """Bins [start, start+step), …; the last one is closed, values outside are left out."""
    counts = _clipped_counts(values, value, cap)
    bins = (stop - start) // step
    last = start + bins * step
    edges = counts.sparkSession.range(bins).select(
        F.col("id").alias("bin"), (F.col("id") * step + start).alias("bin_from"),
        (F.col("id") * step + start + step).alias("bin_to"),
    )
    inside = counts.filter(F.col("v").between(start, last)).select(
        F.least(F.floor((F.col("v") - start) / step), F.lit(bins - 1)).alias("bin"), "n"
    )
    sums = inside.groupBy("bin").agg(F.sum("n").alias("n"))
    return edges.join(sums, "bin", "left").fillna({"n": 0})


# --- categories ----------------------------------------------------------------------
def top_categories(docs: DataFrame, k: int) -> DataFrame:
    counts = docs.groupBy("category").agg(F.count("*").alias("n_docs"))
    return counts.orderBy(F.desc("n_docs"), "category").limit(k)


def length_box(docs: DataFrame, k: int = 8, cap: int = 1000) -> DataFrame:
    """Box-plot figures of document length for the ``k`` largest categories.

    Lengths are counted by value first, so a category with a third of all
    documents is still at most ``cap`` + 1 rows when quartiles are taken.
    """
    counts = _clipped_counts(docs, F.col("n_words"), cap, "category")
    largest = F.broadcast(top_categories(docs, k))
    box = (
        counts.join(largest, "category")
        .groupBy("category", "n_docs")
        .agg(
            F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
            F.collect_list("v").alias("lengths"),
        )
        .select("category", "n_docs", "lengths", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])
        .withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    )
    above = F.filter("lengths", lambda v: v >= F.col("q1") - F.col("reach"))
    below = F.filter("lengths", lambda v: v <= F.col("q3") + F.col("reach"))
    return box.select(
        "category", "n_docs",
        F.least(F.array_min(above).cast("double"), "q1").alias("whisker_low"),
        "q1", F.col("q2").alias("median"), "q3",
        F.greatest(F.array_max(below).cast("double"), "q3").alias("whisker_high"),
    )
