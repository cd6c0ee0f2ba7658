"""Removal of byte strings that occur more than once, by bucket-pointer refinement of suffixes.

A suffix's bucket holds the suffixes that agree with it on a first stretch; a
bucket is refined by the bucket identifiers of its members at a later offset, and one
with a single member is finished.  Bucket identifiers are fingerprints of the
stretch, so a bucket's members meet by grouping, combined before the shuffle.

1. Suffixes at content-defined places (``arrays.anchors``) get the bucket of their
   first ``length - reach + 2`` bytes.  Every string of ``length`` bytes holds such
   a place, followed by that many bytes of the string.  Singletons are finished.
2. Buckets are refined to ``length`` bytes with the identifier of the bucket that the
   suffix ``reach - 2`` bytes further on is in.
3. Places between two neighbours that are both in shared buckets are covered.
   For the other gaps next to a shared suffix the buckets of all
   suffixes in the gap are refined, with all suffixes that share its first bucket.

Fingerprints have 64 bits; step 2 compares two of them.  Defined results: a null
or empty text has no bytes; a null ``doc_id`` takes no part; repeated rows (same id and
text) are two texts and repeat each other; an id must not stand for different texts.
Very long texts are searched whole; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import written

LENGTH = 400
REACH = 96
GRAM = 8


def byte_sums(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums over the bytes of all texts, and where each text starts and ends."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    return ar.prefix_sums(data.astype(np.uint64) + np.uint64(1)), ends - sizes, ends - 1


def first_buckets(docs: DataFrame, length: int, reach: int) -> DataFrame:
    """doc_id, place, back, bucket, pointer: the bucket at ``place`` and the one at the later offset (null past the end)."""
    stretch = length - reach + 2
    if stretch < reach + GRAM:
        raise ValueError("reach must be at most (length - 6) // 2")

    def sort_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                sums, starts, ends = byte_sums(texts[low:high])
                grams = ar.span_hash(sums, np.arange(max(len(sums) - GRAM, 0)), GRAM)
                text, place, back = ar.sampled(grams, starts, ends, reach, stretch)
                at = starts[text] + place
                whole = at + length <= ends[text]
                later = np.where(whole, at + length - stretch, at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high][text]), pa.array(place.astype(np.int32)), pa.array(back.astype(np.int32)),
                     ar.signed(ar.span_hash(sums, at, stretch)),
                     pa.array(ar.span_hash(sums, later, stretch).view(np.int64), mask=~whole)],
                    names=["doc_id", "place", "back", "bucket", "pointer"])

    return docs.where("doc_id is not null").mapInArrow(
        sort_in, "doc_id bigint, place int, back int, bucket bigint, pointer bigint")


def all_buckets(shared: DataFrame, length: int, flag: str) -> DataFrame:
    """full, doc_id, place: buckets of ``length`` bytes of all suffixes in the gaps that have ``flag``."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            texts = ar.text_bytes(batch.column("text"))
            gaps = batch.column("gaps").to_pylist()
            for low, high in ar.blocks(texts):
                sums, starts, ends = byte_sums(texts[low:high])
                owners, places = [], []
                for i in range(high - low):
                    found = np.array([(g["place"], g["back"]) for g in gaps[low + i] if g[flag]], np.int64).reshape(-1, 2)
                    place = np.unique(ar.spread_back(found[:, 0], found[:, 1]))
                    place = place[starts[i] + place + length <= ends[i]]
                    owners.append(np.full(len(place), i))
                    places.append(place)
                owner, place = np.concatenate(owners), np.concatenate(places)
                yield pa.RecordBatch.from_arrays(
                    [ar.signed(ar.span_hash(sums, starts[owner] + place, length)), pa.array(ids[low:high][owner]),
                     pa.array(place.astype(np.int32))], names=["full", "doc_id", "place"])

    return shared.mapInArrow(refine, "full bigint, doc_id bigint, place int")


def repeated_strings(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """The documents with a shared bucket (doc_id, text), written, and doc_id, starts of the strings to remove."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    suffixes = first_buckets(plain, length, reach)
    # the tables of shared buckets are written so that a hot bucket can be split in the join
    open_buckets = written(
        suffixes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "buckets")
    open_suffixes = written(suffixes.join(open_buckets, "bucket"), "suffixes")
    full = written(
        open_suffixes.where("pointer is not null").groupBy("bucket", "pointer").agg(F.count("*").alias("n"))
        .where("n > 1").select("bucket", "pointer", F.lit(True).alias("whole")), "refined")
    in_text = Window.partitionBy("doc_id").orderBy("place")  # one document's suffixes
    neighbour = F.lag("place").over(in_text) == F.col("place") - F.col("back")
    flagged = open_suffixes.join(full, ["bucket", "pointer"], "left").select(
        "doc_id", "place", "back", "bucket", F.coalesce("whole", F.lit(False)).alias("whole"))
    flagged = written(flagged.withColumn("open", ~F.coalesce(
        F.col("whole") & neighbour & F.lag("whole").over(in_text), F.lit(False))), "gaps")
    wanted = written(flagged.where("open").select("bucket").distinct().withColumn("wanted", F.lit(True)), "wanted")
    gaps = flagged.join(wanted, "bucket", "left").groupBy("doc_id").agg(F.collect_list(F.struct(
        "place", "back", "whole", "open", F.coalesce("wanted", F.lit(False)).alias("wanted"))).alias("gaps"))
    shared = written(plain.join(gaps, "doc_id"), "strings")
    repeated = written(
        all_buckets(shared, length, "wanted").groupBy("full").agg(F.count("*").alias("n"))
        .where("n > 1").select("full"), "repeated")
    starts = (
        all_buckets(shared, length, "open").join(repeated, "full").select("doc_id", "place")
        .union(flagged.where("whole").select("doc_id", "place"))
        .groupBy("doc_id").agg(F.collect_set("place").alias("starts"))
    )
    return shared.select("doc_id", "text"), starts


def changed_documents(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """doc_id, n_removed, n_spans, kept (bytes: a cut may fall inside a character), kept_sha256 of every document that loses bytes."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans = [], [], []
            for text, starts in zip(ar.text_bytes(batch.column("text")), batch.column("starts"), strict=True):
                gone = ar.cover(len(text), starts.values.to_numpy(), length)
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(len(ar.runs(gone)[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_removed", "n_spans", "kept", "kept_sha256"])

    shared, starts = repeated_strings(docs, length, reach)
    return shared.dropDuplicates(["doc_id"]).join(starts, "doc_id").mapInArrow(
        drop, "doc_id bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")


def removal_report(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.length(text).cast("bigint").alias("n_bytes"),
                        F.sha2(text, 256).alias("digest"))
    changed = changed_documents(docs, length, reach).select("doc_id", "n_removed", "n_spans", "kept_sha256")
    none = F.lit(0).cast("bigint")
    return whole.join(changed, "doc_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "digest").alias("kept_sha256"))
