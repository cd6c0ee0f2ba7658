"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow with a target of words.  Its documents queue in a
shuffled order, up to ``REPEATS`` times; a copy's virtual finish time is the
words of its source up to its end, divided by the source's target.  Sorted by
finish time, the copies of all sources form the mix, which is cut where the
budget of words is used up.  A source is served its whole target by virtual time
1, so the copy in service then is taken in part, and a long document neither
starves its source nor overfills it.

Targets: sources share the budget by weight, but none is given more than
``REPEATS`` times its size; the excess is shared again by weight.  That settles
at one level of words per unit of weight, found in one pass over the sources
ordered by the level at which each is full.

Scale: a source is dealt to buckets by the first digits of its documents'
shuffle key and the mix to slices of virtual time, both of bounded size; running
totals are taken inside them, and offsets from one small row per bucket or
slice.  So a source with a third of all rows is spread like the others.  Texts
are read once and never shuffled by ``mix_report``.

Only DataFrame functions are used.  Defined results: a null text has no words,
and a document without words takes nothing; a null source is a source of its own,
the last; null and repeated ids are judged row by row, equal rows as if numbered;
the shuffle key is a digest of id and text, so reruns agree and ties are between
equal rows only; an empty table gives an empty mix; columns of any name pass
through ``mix_documents`` unchanged, apart from the text of a copy taken in part.
Very long texts are counted in place.  Rows equal in id and text share a bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .stages import unused, written

WORD = "[^\\x20\\x09-\\x0D]+"
REPEATS = 3
#: Rows that a bucket or a slice holds at most on average.
ROWS_PER_TASK = 50_000


def sized(docs: DataFrame, *carried: str) -> DataFrame:
    """One written row a document: row, doc_id, source, flow, key, size and the ``carried`` columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    return written(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("flow"),
        F.substring(digest, 1, 16).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), *carried), "sized")


def targets(sizes: DataFrame, weights: DataFrame | None = None, budget: int | None = None, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (flow, source, source_size) with weight, rank, target and budget of every source.

    ``weights`` has the columns source and weight, a source without a row weighs
    nothing; by default sources weigh 1, 2, 3, repeating, in order of code point.
    Sources, not documents, are ordered in one task.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("flow", "source", "source_size", F.row_number().over(by_name).alias("rank"))
    if weights is None:
        weighed = ranked.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double"))
    else:
        given = weights.groupBy(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("flow")).agg(
            F.sum(F.col("weight").cast("double")).alias("weight"))
        weighed = ranked.join(given, "flow", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    most = F.col("source_size") * repeats
    whole = F.sum(F.when(F.col("weight") > 0, most)).over(W.partitionBy())
    wanted = F.lit(budget).cast("bigint") if budget is not None else F.sum("source_size").over(W.partitionBy())
    bounded = weighed.withColumn("budget", F.least(wanted, F.coalesce(whole, F.lit(0))))
    full_at = W.orderBy(F.when(F.col("weight") > 0, most / F.col("weight")).asc_nulls_first(), "rank")
    before, after = full_at.rowsBetween(W.unboundedPreceding, -1), full_at.rowsBetween(W.currentRow, W.unboundedFollowing)
    filled = F.coalesce(F.sum(F.when(F.col("weight") > 0, most)).over(before), F.lit(0))
    level = F.when(F.col("weight") > 0, (F.col("budget") - filled).cast("double") / F.sum("weight").over(after))
    return (
        bounded.withColumn("level", level).withColumn("level", F.max("level").over(W.partitionBy()))
        .withColumn("target", F.coalesce(F.least(most.cast("double"), F.col("level") * F.col("weight")), F.lit(0.0)))
        .drop("level")
    )


def _queued(rows: DataFrame, n: int, repeats: int, weights: DataFrame | None, budget: int | None) -> DataFrame:
    """``rows`` with the figures of their source, and ``before``: the words of it that queue ahead."""
    digits = max(0, math.ceil(math.log(max(n, 1) / ROWS_PER_TASK, 16)))
    dealt = rows.withColumn("bucket", F.substring("key", 1, digits))
    sums = written(dealt.groupBy("flow", "source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    flows = targets(sums.groupBy("flow", "source").agg(F.sum("words").alias("source_size")), weights, budget, repeats)
    ahead = W.partitionBy("flow").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("flow", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset")).join(
        flows.drop("source"), "flow")
    queue = W.partitionBy("flow", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    return dealt.join(written(offsets, "offsets"), ["flow", "bucket"]).withColumn(
        "before", F.col("offset") + F.sum("size").over(queue) - F.col("size"))


def mix(rows: DataFrame, repeats: int = REPEATS, weights: DataFrame | None = None, budget: int | None = None):
    """The copies in the mix, one row each, and every row with its source's size and target; ``rows`` as of ``sized``.

    A copy has row, epoch, finish (its virtual time, 1 at most), mix_at (the words of the mix before it) and taken.
    """
    n = rows.count()
    queued = written(_queued(rows, n, repeats, weights, budget), "queued")
    epochs = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    start = F.col("epoch") * F.col("source_size") + F.col("before")
    served = (
        queued.where("size > 0 AND target > 0").select("*", epochs.alias("epoch")).withColumn("start", start)
        .where("start < target")
        .withColumn("finish", F.least(F.lit(1.0), (F.col("start") + F.col("size")) / F.col("target")))
        .withColumn("words", F.least("size", F.ceil("target") - F.col("start")))
    )
    slices = max(1, math.ceil(n / ROWS_PER_TASK))
    copies = written(served.select(
        "row", "doc_id", "epoch", "rank", "key", "size", "finish", "words", "budget",
        F.floor(F.col("finish") * slices).alias("slice")), "copies")
    ahead = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = copies.groupBy("slice").agg(F.sum("words").alias("sum")).select(
        "slice", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("offset"))
    order = W.partitionBy("slice").orderBy("finish", "rank", "epoch", "key", "doc_id", "size")
    running = F.sum("words").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = copies.join(offsets, "slice").withColumn("mix_at", F.col("offset") + running - F.col("words"))
    kept = placed.where("mix_at < budget").withColumn("taken", F.least("words", F.col("budget") - F.col("mix_at")))
    return kept.select("row", "epoch", "finish", "mix_at", "size", "taken"), queued


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    copies, queued = mix(sized(docs.select("doc_id", "source", "text")), **options)
    taken = copies.groupBy("row").agg(F.sum("taken").alias("taken"))
    return queued.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))


def _first_words(text: Column, words: Column) -> Column:
    """``text`` up to the end of its ``words``-th word, the spaces between words as they are."""
    spaced = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    return F.array_join(F.slice(spaced, F.lit(1), words.cast("int")), "")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in its order: the columns of ``docs`` per copy, and behind them mix_at and mix_words.

    A name that ``docs`` has already gets underscores.  The text of a copy taken
    in part ends behind its last word.  Written rows are range partitioned by
    place, so the files read one after the other are the mix.
    """
    whole = unused("whole", docs.columns + ["row", "doc_id", "source", "flow", "key", "size"])
    at, words = unused("mix_at", docs.columns), unused("mix_words", docs.columns)
    rows = sized(docs.withColumn(whole, F.struct(*[F.col(f"`{c}`") for c in docs.columns])), whole)
    copies, _ = mix(rows.drop(whole), **options)
    texts = rows.select(F.col("row").alias("text_row"), F.col(whole).alias("whole"))
    joined = copies.join(texts, F.col("row") == F.col("text_row"))
    cut = F.when(F.col("taken") < F.col("size"), _first_words(F.col("whole.text"), F.col("taken"))).otherwise(F.col("whole.text"))
    columns = [cut.alias(c) if c == "text" else F.col("whole").getField(c).alias(c) for c in docs.columns]
    return joined.repartitionByRange("mix_at").sortWithinPartitions("mix_at").select(
        *columns, F.col("mix_at").alias(at), F.col("taken").alias(words))
