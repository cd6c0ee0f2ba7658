"""Best-fit packing of documents into sequences, with conflicts.

A sequence (bin) holds ``capacity`` words.  It never holds two pieces of one
duplicate cluster (documents with the same lower-cased words) and at most ``per_source``
pieces of one source.  A longer document is cut into full sequences of its own and a
rest, which is packed like a short document.

Pieces are numbered and dealt by a hash of the number into shards of about ``SHARD`` pieces and
packed within them, longest first; what leaves a task is one small row per
piece, and a hot source or cluster is spread evenly over the shards.  In a shard,
bins stand in order of their residual room.  Each bin carries a bitmap of its clusters and one bitmap
per allowed repetition of a source.  The search starts at the least residual
that holds the piece and goes on to its successors until a bin is compatible;
only if none is, a bin is opened.  In a run of equal pieces all tighter bins
still conflict, but for the one just filled: it is tried first, then the search
resumes where it ended.

Defined results: a null or empty text has no words and is not packed (no rows);
null sources are one source; repeated rows are separate pieces of one cluster.
Ties go by cluster, source, id and part; very long texts are cut into pieces of a full sequence; an empty table
gives no rows; other columns are ignored, but for the one named as ``group``.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import written

CAPACITY = 2048
PER_SOURCE = 4
SHARD = 8_000


class Bins:
    """Bins in order of (residual, number)."""

    def __init__(self, per_source: int):
        self.order: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.per_source = per_source
        # the last piece, where its search ended, and its bin as it stands now: the only one before that place that may fit again
        self.last: tuple[tuple, tuple[int, int], tuple[int, int]] | None = None

    def fits(self, number: int, source: int, cluster: int) -> bool:
        return not (self.clusters[number] & cluster or self.sources[number][-1] & source)

    def place(self, size: int, source: int, cluster: int, capacity: int) -> int:
        """Put a piece into the tightest compatible bin and return its number; ``source`` and ``cluster`` are bits."""
        same = (size, source, cluster)
        start, filled = (size, -1), None
        if self.last and self.last[0] == same:
            start, filled = max(start, self.last[1]), self.last[2]
        if filled and filled[0] >= size and self.fits(filled[1], source, cluster):
            at, ended = bisect.bisect_left(self.order, filled), start
        else:
            at = bisect.bisect_left(self.order, start)
            while at < len(self.order) and not self.fits(self.order[at][1], source, cluster):
                at += 1
            ended = self.order[at] if at < len(self.order) else (capacity, len(self.clusters))
        if at < len(self.order):
            residual, number = self.order.pop(at)
        else:
            residual, number = capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
        left = (residual - size, number)
        self.last = (same, ended, left)
        bisect.insort(self.order, left)
        self.clusters[number] |= cluster
        carry = source
        levels = self.sources[number]
        for k, level in enumerate(levels):  # the k-th bitmap has the sources with more than k pieces
            levels[k], carry = level | carry, level & carry
        return number


def pack(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[int]:
    """Bin numbers of pieces that come longest first."""
    counts: dict = {}
    for c in clusters:
        counts[c] = counts.get(c, 0) + 1
    # a cluster with one piece in the shard can conflict with nothing and needs no bit
    bits = {c: 1 << i for i, c in enumerate(c for c, n in counts.items() if n > 1)}
    source_bits = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    bins = Bins(per_source)
    return [bins.place(n, source_bits[s], bits.get(c, 0), capacity)
            for n, s, c in zip(sizes, sources, clusters, strict=True)]


def pieces(docs: DataFrame, capacity: int, group: str | None = None) -> DataFrame:
    """doc_id, part, n_words, source, cluster: the pieces of every document.

    The cluster is the hash of column ``group``, or else of the lower-cased words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, source = batch.column("doc_id"), batch.column("source")
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                words = ar.Words(texts[low:high], lower=True)
                sums = ar.prefix_sums(words.hashes())
                cluster = ar.span_hash(sums, words.first[:-1], words.counts).view("int64")
                if group:
                    cluster = batch.column("cluster").to_numpy()[low:high]
                rows = [(low + i, part, min(capacity, n - part * capacity), c)
                        for i, (n, c) in enumerate(zip(words.counts.tolist(), cluster.tolist(), strict=True))
                        for part in range(math.ceil(n / capacity))]
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()),
                     source.take(at), pa.array([r[3] for r in rows], pa.int64())],
                    names=["doc_id", "part", "n_words", "source", "cluster"])

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
                        *([F.xxhash64(group).alias("cluster")] if group else []))
    return plain.mapInArrow(cut, "doc_id bigint, part int, n_words int, source string, cluster bigint")


def best_fit(
    docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD, group: str | None = None
) -> DataFrame:
    """doc_id, part, n_words, source, cluster, bin_id (shard and number), bin_offset, bin_words of every piece.

    ``group`` may name a column of duplicate clusters, such as the component ids of the near-duplicate search.
    """
    numbered = pieces(docs, capacity, group).withColumn("piece", F.monotonically_increasing_id())
    cut = written(numbered, "pieces")
    shards = max(1, math.ceil(cut.count() / shard))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_words", "cluster", "source", "doc_id", "part"],
                                ascending=[False, True, True, True, True], na_position="first")
        number = pack(rows["n_words"].tolist(), rows["source"].fillna("\0").tolist(), rows["cluster"].tolist(),
                      capacity, per_source)
        rows = rows.assign(number=number)
        rows["bin_offset"] = rows.groupby("number")["n_words"].cumsum() - rows["n_words"]
        rows["bin_words"] = rows.groupby("number")["n_words"].transform("sum")
        rows["bin_id"] = rows["shard"].astype(str) + "-" + rows["number"].astype(str)
        return rows[["doc_id", "part", "n_words", "source", "cluster", "bin_id", "bin_offset", "bin_words"]]

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(
        fill, "doc_id long, part int, n_words int, source string, cluster long, bin_id string, bin_offset int, bin_words int")
