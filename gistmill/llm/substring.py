"""Removal of long passages that an earlier document already has.

A generalised suffix tree over words, cut at the depth of the shortest passage
and split by variable-length prefixes.  Only suffixes at content-defined places
(``arrays.anchors``) are rooted: every passage of ``min_words`` words holds one
of them, followed by at least ``min_words - reach + 2`` words of the passage.

1. Suffixes are grouped by that first, short prefix.  A group with a single
   document is a leaf: nothing below it repeats across documents.
2. The other groups are split by longer prefixes: the paths of ``min_words``
   words that pass through the suffix.  Each path is a deep internal node, kept
   as a fingerprint with the least document below it, so a node's suffixes are
   combined before they are shuffled and no group is ever held in memory.
3. A passage of a document is removed if its node has a smaller document.

Fingerprints have 64 bits.  Defined results: a null or empty text has no words;
a null ``doc_id`` is neither a source nor changed; exact repeats of a row
(same id and text) are one document; an id must not stand for different texts.
Very long texts are searched whole; of equal ids the texts must be equal; an empty table gives no rows;
``remove_repeats`` returns columns of any other names as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import row_key, unused, written

MIN_WORDS = 50
REACH = 26


def suffix_groups(docs: DataFrame, min_words: int, reach: int) -> DataFrame:
    """doc_id, place, back, path: rooted suffixes with the fingerprint of their first prefix."""
    short = min_words - reach + 2
    if short < reach:
        raise ValueError("reach must be at most min_words // 2 + 1")

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                words = ar.Words(texts[low:high])
                values = words.hashes()
                text, place, back = ar.sampled(values, words.first[:-1], words.first[1:], reach, short)
                path = ar.span_hash(ar.prefix_sums(values), words.first[text] + place, short)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high][text]), pa.array(place.astype(np.int32)),
                     pa.array(back.astype(np.int32)), ar.signed(path)],
                    names=["doc_id", "place", "back", "path"])

    return docs.where("doc_id is not null").mapInArrow(root, "doc_id bigint, place int, back int, path bigint")


def deep_nodes(shared: DataFrame, min_words: int, later_only: bool) -> DataFrame:
    """node, doc_id, place: passages below the split groups; ``later_only`` leaves out the first document of a group."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            texts = ar.text_bytes(batch.column("text"))
            # as flat arrays: a Python object for each suffix of a batch would take many times their size
            suffixes = batch.column("suffixes")
            ends = np.concatenate(([0], np.cumsum(suffixes.value_lengths().to_numpy(zero_copy_only=False))))
            flat = suffixes.flatten()
            at, reach_back, later = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("place", "back", "later"))
            for low, high in ar.blocks(texts):
                words = ar.Words(texts[low:high])
                sums = ar.prefix_sums(words.hashes())
                owners, places = [], []
                for i in range(high - low):
                    own = slice(ends[low + i], ends[low + i + 1])
                    wanted = later[own] if later_only else np.ones(len(later[own]), bool)
                    start = np.unique(ar.spread_back(at[own][wanted].astype(np.int64), reach_back[own][wanted].astype(np.int64)))
                    start = start[start + min_words <= words.counts[i]]
                    owners.append(np.full(len(start), i))
                    places.append(start)
                owner, place = np.concatenate(owners), np.concatenate(places)
                node = ar.span_hash(sums, words.first[owner] + place, min_words)
                yield pa.RecordBatch.from_arrays(
                    [ar.signed(node), pa.array(ids[low:high][owner]), pa.array(place.astype(np.int32))],
                    names=["node", "doc_id", "place"])

    return shared.mapInArrow(extend, "node bigint, doc_id bigint, place int")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """The documents with a possible repeat (doc_id, text), written, and doc_id, starts of the passages to remove."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    suffixes = suffix_groups(plain, min_words, reach)
    groups = written(
        suffixes.groupBy("path").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").select("path", "least"), "prefixes")  # written, so that a hot prefix can be split in the join
    rooted = (
        suffixes.join(groups, "path")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("place", "back", (F.col("doc_id") > F.col("least")).alias("later")))
             .alias("suffixes"))
    )
    shared = written(plain.join(rooted, "doc_id"), "passages")
    nodes = written(
        deep_nodes(shared, min_words, False)
        .groupBy("node").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").select("node", "least"), "nodes")
    removed = (
        deep_nodes(shared, min_words, True).join(nodes, "node").where("doc_id > least")
        .groupBy("doc_id").agg(F.collect_set("place").alias("starts"))
    )
    return shared.select("doc_id", "text"), removed


def cut(changed: DataFrame, min_words: int) -> DataFrame:
    """doc_id, n_removed, kept: words left after removal, joined by one space."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, starts in zip(ar.text_bytes(batch.column("text")), batch.column("starts"), strict=True):
                words = text.split()
                gone = ar.cover(len(words), starts.values.to_numpy(), min_words)
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_removed", "kept"])

    return changed.mapInArrow(drop, "doc_id bigint, n_removed bigint, kept string")


def changed_documents(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """doc_id, n_removed, kept of every document that loses words."""
    shared, removed = repeated_passages(docs, min_words, reach)
    return cut(shared.dropDuplicates(["doc_id"]).join(removed, "doc_id"), min_words)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; untouched texts stay as they are.

    Rows without an id count as later than all others, rows equal in id and text
    as one document.  Columns may have any other names.
    """
    key, changed_id, left = (unused(name, docs.columns) for name in ("key", "changed_id", "left"))
    keyed = docs.withColumn(key, row_key())
    changed = changed_documents(keyed.select(F.col(key).alias("doc_id"), "text"), min_words, reach).select(
        F.col("doc_id").alias(changed_id), F.col("kept").alias(left))
    joined = keyed.join(changed, F.col(key) == F.col(changed_id), "left")
    text = F.when(F.col(changed_id).isNull(), F.col("text")).otherwise(F.col(left))
    return joined.withColumn("text", text).select(*docs.columns)


def word_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha256 of the words joined by one space."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in ar.text_bytes(batch.column("text")):  # the words of one text at a time, not of the batch
                words = text.split()
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "digest"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id bigint, n_words bigint, digest string")


def removal_report(docs: DataFrame, min_words: int = MIN_WORDS, reach: int = REACH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    changed = changed_documents(docs, min_words, reach).select(
        "doc_id", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    return word_digest(docs).join(changed, "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
