"""Near-duplicate documents by MinHash with odd sketches.

A document is the set of its five-word shingles.  Documents with equal sets are
one class, represented by the least id; only representatives go on.

1. ``rows * bands`` minima give ``bands`` bucket keys and an odd sketch: a bitmap
   in which each minimum flips one bit.  Bits that differ between two sketches
   estimate the similarity, most precisely where it is high.
2. Each document is compared with one hub: of the members of its buckets, the one
   that meets most others.  Pairs whose sketches are far apart are dismissed; the
   others are confirmed on their full sets and become links.
3. Buckets whose members are not yet one component go on, without the documents
   that have too few shingles in common with other components to have a link
   (``still_possible``).  Their members are dealt to blocks, and each two blocks of
   a bucket meet in one task, which compares their sketches bit by bit.  Only pairs
   from different components whose sketches are close leave it, each from the first
   bucket that it shares, and are confirmed.  So no link between two members of a
   bucket is lost: they end in one component, or they were compared.

``bands`` follows from the threshold so that a pair at the threshold shares no
bucket with a probability of at most ``MISS``; a pair above it with less.

Defined results: a null or empty text has an empty set and is linked with
nothing; one to four words make one shingle; exact repeats of a row (same id and
text) are one document; a null id is alone and has a null component.
Very long texts are compared whole; an empty table gives no rows; of a group the least id stays.
``drop_near_duplicates`` judges rows without an id by their text and returns columns of any other names as they are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .components import components
from .stages import row_key, unused, with_membership, written

WORDS = 5
SIMILARITY = 0.8
ROWS = 6
MISS = 1e-7
SKETCH_BITS = 1024
SIGMAS = 5
BLOCK = 512  # members of a bucket that meet as many others in one task
CHUNK = 1024  # pairs with one document that are confirmed in one task, about
SHINGLE_ROWS = 1 << 16
LINKS = "a bigint, b bigint"


def band_count(similarity: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - similarity ** ROWS))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each text."""
    words = ar.Words(texts, lower=True)
    sums = ar.prefix_sums(words.hashes())
    out = []
    for first, n in zip(words.first[:-1].tolist(), words.counts.tolist(), strict=True):
        starts = np.arange(first, first + max(n - WORDS + 1, min(n, 1)))
        out.append(np.unique(ar.span_hash(sums, starts, np.full(len(starts), min(n, WORDS)))))
    return out


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """``n`` minima of each (non-empty) set, each under another hash function."""
    values = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    keys = ar.mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((n, len(sets)), np.uint64)
    for i, key in enumerate(keys):
        out[i] = np.minimum.reduceat((values * key) >> np.uint64(24), first)
    return out


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the columns of ``least``, as rows of 64-bit words."""
    n, docs = least.shape
    bits = np.zeros((docs, SKETCH_BITS), np.uint8)
    row = np.arange(docs)
    lanes = ar.mix(np.arange(n, dtype=np.uint64))
    for i in range(n):
        at = ar.mix(least[i] ^ lanes[i]) % np.uint64(SKETCH_BITS)
        bits[row, at.astype(np.int64)] ^= 1
    return np.packbits(bits, axis=1).view(np.int64)


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One key for each column and band."""
    keys = np.zeros((bands, least.shape[1]), np.uint64)
    for i in range(bands * ROWS):
        keys[i // ROWS] = ar.mix((keys[i // ROWS] * ar.BASE) ^ least[i]) + np.uint64(i + 1)
    return keys.T.copy().view(np.int64)


def signatures(docs: DataFrame, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, odd."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                sets = shingle_sets(texts[low:high])
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                keys = [None] * len(sets)
                odd = [None] * len(sets)
                if len(full):
                    least = minima([sets[i] for i in full], bands * ROWS)
                    for i, k, o in zip(full, band_keys(least, bands), odd_sketch(least), strict=True):
                        keys[i], odd[i] = k, o
                names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], pa.array(sizes), pa.array(names, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_key", "bands", "odd"])

    return docs.mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, odd array<bigint>")


def sketch_limit(similarity: float, samples: int) -> float:
    """The bits in which the sketches of two documents of ``similarity`` differ at most, ``SIGMAS`` deviations included."""
    flips = 2 * samples * (1 - similarity)  # minima that are not shared, each of which flips a bit
    left = math.exp(-2 * flips / SKETCH_BITS)
    expected = SKETCH_BITS / 2 * (1 - left)
    of_samples = 2 * samples * left * math.sqrt(similarity * (1 - similarity) / samples)
    of_collisions = SKETCH_BITS / 4 * (1 - left ** 2) - flips * left ** 2
    return expected + SIGMAS * math.sqrt(of_samples ** 2 + of_collisions)


def differing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bits in which sketches differ; the last axis has their words."""
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int32)


def sketch_rows(column: pa.Array) -> np.ndarray:
    """A column of sketches as rows of 64-bit words (unsigned, as bits of the absolute value are counted)."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, SKETCH_BITS // 64)


def shingle_table(docs: DataFrame, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """rep, shingles (the sorted fingerprints), bands and odd of every representative in ``reps``."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                sets = [x.tobytes() for x in shingle_sets(texts[low:high])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep")[low:high], pa.array(sets, pa.binary())], names=["rep", "shingles"])

    texts = docs.withColumnRenamed("doc_id", "rep").join(reps.select("rep"), "rep").select("rep", "text").dropDuplicates(["rep"])
    return texts.mapInArrow(shingles, "rep bigint, shingles binary").join(classes.select("rep", "bands", "odd"), "rep")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float, most: float) -> DataFrame:
    """The (written) pairs whose odd sketches differ in ``most`` bits or fewer, and whose full shingle sets reach ``similarity``.

    Sets are compared in whole percent.  The pairs with one hub are dealt to several tasks.
    """
    percent = round(100 * similarity)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = differing(sketch_rows(batch.column("odd_a")), sketch_rows(batch.column("odd_b"))) <= most
            keep = []
            for near, x, y in zip(close.tolist(), batch.column("set_a"), batch.column("set_b"), strict=True):
                if near:
                    p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    near = 100 * both >= percent * (len(p) + len(q) - both)
                keep.append(near)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    chunks = pairs.groupBy("b").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"), F.col("odd").alias("odd_a"))
    right = sets.join(chunks, F.col("rep") == F.col("b")).select(
        "b", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("shingles").alias("set_b"),
        F.col("odd").alias("odd_b"))
    dealt = pairs.join(chunks, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int").alias("chunk"))
    return dealt.join(left, "a").join(right, ["b", "chunk"]).select("a", "b", "set_a", "odd_a", "set_b", "odd_b").mapInArrow(
        compare, LINKS)


def mixed_buckets(labelled: DataFrame) -> DataFrame:
    """The rows of ``labelled`` (bucket, component, ...) in buckets with several components."""
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return written(labelled.join(mixed.where("least < most").select("bucket"), "bucket"), "members")


def still_possible(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``members`` whose document may have a link to another component, with bands, odd and ``n``, its shared shingles.

    A link needs ``similarity / (1 + similarity)`` of both sizes in common.  A shingle
    that no other component has cannot be in common, so a copy with many
    words of its own is settled by counting, without meeting the other copies.
    """
    percent = round(100 * similarity)
    least = written(members.groupBy("bucket").agg(F.min("size").alias("least")), "least")
    reps = written(
        members.join(least, "bucket").groupBy("rep").agg(
            F.first("component").alias("component"), F.first("size").alias("size"), F.min("least").alias("least")), "reps")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, components = batch.column("rep").to_numpy(), batch.column("component").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            for low in range(0, len(owner), SHINGLE_ROWS):
                own = owner[low:low + SHINGLE_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [ar.signed(values[low:low + SHINGLE_ROWS]), pa.array(reps[own]), pa.array(components[own])],
                    names=["shingle", "rep", "component"])

    rows = sets.join(reps, "rep").select("rep", "component", "shingles").mapInArrow(
        shingles, "shingle bigint, rep bigint, component bigint")
    common = written(
        rows.groupBy("shingle").agg(F.min("component").alias("first"), F.max("component").alias("last"))
        .where("first < last").select("shingle"), "common")
    enough = (
        rows.join(common, "shingle").groupBy("rep").agg(F.count("*").alias("n")).join(reps, "rep")
        .where(F.col("n") * (100 + percent) >= percent * (F.col("size") + F.col("least"))).select("rep", "n")
        .join(sets.select("rep", "bands", "odd"), "rep")
    )
    return members.join(written(enough, "possible"), "rep")


def close_pairs(members: DataFrame, similarity: float, most: float) -> DataFrame:
    """The pairs of ``members`` from different components, in one bucket, whose sketches are close and that share enough shingles.

    A bucket's members are dealt to blocks of about ``BLOCK``; each two blocks, and each with itself, are one task's work.
    """
    percent = round(100 * similarity)

    def meet(group: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(group).combine_chunks()
        rep, component, size, n, block = (rows.column(c).to_numpy() for c in ("rep", "component", "size", "n", "block"))
        odd = sketch_rows(rows.column("odd").combine_chunks())
        bucket, low, high = (rows.column(c)[0].as_py() for c in ("bucket", "low", "high"))
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        # what two documents have in common is at most what either shares with any other component
        enough = np.minimum(n[left, None], n[None, right]) * (100 + percent) >= percent * (size[left, None] + size[None, right])
        apart = np.zeros((len(left), len(right)), np.int32)
        for word in range(odd.shape[1]):
            apart += np.bitwise_count(odd[left, None, word] ^ odd[None, right, word])
        i, j = np.nonzero(enough & (component[left, None] != component[None, right]) & (apart <= most))
        x, y = left[i], right[j]
        if low == high:
            x, y = x[x < y], y[x < y]
        if not len(x):
            return None
        # a pair that shares several buckets leaves from the first of them
        bands = rows.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        own = np.zeros(len(x), bool)
        for k in range(0, len(x), CHUNK):
            same = bands[x[k:k + CHUNK]] == bands[y[k:k + CHUNK]]
            own[k:k + CHUNK] = bands[x[k:k + CHUNK], same.argmax(axis=1)] == bucket
        x, y = rep[x[own]], rep[y[own]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("bucket", "low", "high")]
            cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                key = tuple(int(k[start]) for k in keys) if end > start else last
                if held and key != last:
                    if (found := meet(held)) is not None:
                        yield found
                    held = []
                if end > start:
                    held.append(batch.slice(start, end - start))
                last = key
        if held and (found := meet(held)) is not None:
            yield found

    dealt = members.join(
        members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "bucket").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    meeting = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = meeting.select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "component",
        "size", "n", "bands", "odd")
    return pairs.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(blocks, LINKS)


def near_links(docs: DataFrame, classes: DataFrame, similarity: float, samples: int) -> DataFrame:
    """rep, component of the representatives that have links."""
    most = sketch_limit(similarity, samples)
    members = classes.select("rep", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    sizes = written(
        members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = written(members.join(sizes, "bucket"), "members")
    # the original of a group of copies meets more members than any copy does, and makes the best hub
    weights = written(members.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    members = written(members.join(weights, "rep").select("bucket", "rep", "size", "weight"), "members")
    sets = written(shingle_table(docs, weights, classes), "sets")
    best = F.max(F.struct("weight", (-F.col("rep")).alias("rep")))
    hubs = written(members.groupBy("bucket").agg(best.alias("hub")), "hubs")
    first = written(
        members.join(hubs, "bucket").groupBy(F.col("rep").alias("a")).agg((-F.max("hub")["rep"]).alias("b")).where("a <> b"),
        "pairs")
    links = written(confirmed(first, sets, similarity, most), "links")
    labels = components(links)
    labelled = members.select("bucket", "rep", "size").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "rep"))
    members = mixed_buckets(still_possible(mixed_buckets(labelled), sets, similarity))
    close = written(close_pairs(members, similarity, most), "close")
    found = written(confirmed(close, sets, similarity, most), "confirmed")
    if not found.isEmpty():
        labels = components(links.union(found))
    return labels.withColumnRenamed("node", "rep")


def duplicate_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the least id each document reaches by links of ``similarity`` or more."""
    bands = band_count(similarity)
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = written(signatures(plain, bands), "signatures")
    classes = written(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("odd").alias("odd"),
             F.first("n_shingles").alias("n_shingles")), "classes")
    labels = near_links(plain, classes, similarity, bands * ROWS)
    groups = written(
        classes.select("set_key", "rep").join(labels, "rep", "left")
        .select("set_key", F.coalesce("component", "rep").alias("component")), "groups")
    found = signed.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group, the one with the least id, with the columns of ``docs``.

    Of rows equal in id and text one stays.  Rows without an id are judged by their
    text and come after all others.  Columns may have any other names.
    """
    key, gone, again = (unused(name, docs.columns) for name in ("key", "gone", "again"))
    keyed = docs.withColumn(key, row_key())
    groups = written(duplicate_groups(keyed.select(F.col(key).alias("doc_id"), "text"), similarity), "decisions")
    repeated = written(groups.where("kept").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(again)), "again")
    kept = with_membership(keyed, groups.where("not kept"), gone, key=key).where(~F.col(gone))
    if not repeated.isEmpty():  # their texts alone are grouped
        same = F.col(key) == F.col(again)
        once = kept.join(repeated, same, "left_semi").dropDuplicates([key, "text"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.select(*docs.columns)
